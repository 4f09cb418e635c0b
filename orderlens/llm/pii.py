"""Personal data by anchor expansion.

One Aho-Corasick automaton passes over a text and finds the anchors: at-signs, plus signs and
digits, schemes (``://``) and identifier cues (``iban``, ``ssn``, ...; in any case).  Each anchor
is handed to the parser of its kind, which expands to both sides by fixed character classes and
validates what it has found.  A parser never goes back before the end of the last span
that it has read, so every character is read a bounded number of times per kind.

Kinds: ``email``, ``ip``, ``card`` and ``phone`` (the base: leftmost, non-overlapping per kind; a
candidate that fails its validation is dropped whole, without a retry inside it), and from the
schemes and cues ``userinfo`` (``name:secret`` before the host of a URL), ``iban`` (country, check
digits, 11 to 30 more; modulo 97) and ``ssn`` (3-2-4 digits in issued ranges after its cue).

Spans are code-point offsets, the end exclusive.  Cases: null and empty texts have no spans; long
texts are read whole; repeated rows and null ids keep a row each; an empty table gives an empty result; other
columns, whatever their names, play no part and are kept by ``mask_pii``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.llm.bpe import steps

Span = tuple[str, int, int]

# ---- fixed values: kinds in the order of reports, character classes, anchors ----
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "userinfo", "iban", "ssn")
DIGITS = frozenset("0123456789")
LETTERS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")
ALNUM = DIGITS | LETTERS
LOCAL = ALNUM | frozenset("._%+-")
LABEL = ALNUM | frozenset("-")
PHONE = DIGITS | frozenset(" ().-")
USERINFO = ALNUM | frozenset("-._~!$&'()*+,;=%:")
CUES = {"iban": ("iban",), "ssn": ("ssn", "social security")}  # lower case, as the text that is searched
AFTER_CUE = ("number", "no.", "is")
# ---------------------------------------------------------------------------------


@lru_cache(maxsize=1)
def _automaton():
    import ahocorasick

    a = ahocorasick.Automaton()
    a.add_word("@", ("at", 1))
    for d in "0123456789":
        a.add_word(d, ("digit", 1))
        a.add_word(f"+{d}", ("phone", 2))
    a.add_word("://", ("scheme", 3))
    for kind, words in CUES.items():
        for w in words:
            a.add_word(w, (kind, len(w)))
    a.make_automaton()
    return a


def _lowered(text: str) -> str:
    """``text`` in lower case, every character in its place."""
    low = text.lower()
    # a letter that becomes two in lower case would move what follows
    return low if len(low) == len(text) else "".join(c.lower() if c in LETTERS else c for c in text)


def _run(text: str, i: int, allowed: frozenset) -> int:
    """End of the run of allowed characters from ``i``."""
    n = len(text)
    while i < n and text[i] in allowed:
        i += 1
    return i


def email(text: str, at: int, floor: int) -> tuple[int, int] | None:
    """Local part before the at-sign, back to ``floor`` at most, and a host of two labels or more."""
    start = at
    while start > floor and text[start - 1] in LOCAL:
        start -= 1
    if start == at:
        return None
    end = _run(text, at + 1, LABEL)
    if end == at + 1:
        return None
    labels = 1
    while end < len(text) and text[end] == ".":
        after = _run(text, end + 1, LABEL)
        if after == end + 1:
            break
        end, labels = after, labels + 1
    return (start, end) if labels > 1 else None


def dotted(text: str, i: int) -> tuple[list[tuple[int, int]], int]:
    """IP addresses in the chain of digit groups and single dots from ``i``, and the chain's end."""
    groups = []
    while True:
        end = _run(text, i, DIGITS)
        groups.append((i, end))
        if end + 1 < len(text) and text[end] == "." and text[end + 1] in DIGITS:
            i = end + 1
        else:
            break
    found = []
    for g in range(0, len(groups) - 3, 4):
        four = groups[g : g + 4]
        if all(len(x := text[a:b].lstrip("0")) <= 3 and int(x or 0) <= 255 for a, b in four):
            found.append((four[0][0], four[3][1]))
    return found, end


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def card(text: str, i: int) -> tuple[tuple[int, int] | None, int]:
    """The run of digits with single spaces or hyphens between from ``i``: a card number or not; its end."""
    n, end, digits = len(text), i + 1, [text[i]]
    while end < n:
        c = text[end]
        if c in DIGITS:
            digits.append(c)
            end += 1
        elif (c == " " or c == "-") and end + 1 < n and text[end + 1] in DIGITS:
            digits.append(text[end + 1])
            end += 2
        else:
            break
    ok = 16 <= len(digits) <= 19 and luhn("".join(digits))
    return ((i, end) if ok else None), end


def phone(text: str, plus: int) -> tuple[tuple[int, int] | None, int]:
    """A plus sign, a digit, and a run that ends in its last digit: a number of 8 to 15 digits or not; its end."""
    end = _run(text, plus + 2, PHONE)
    while end > plus + 2 and text[end - 1] not in DIGITS:
        end -= 1
    if end < plus + 4:  # something must stand between the first digit and the last
        return None, plus
    n = sum(c in DIGITS for c in text[plus:end])
    return ((plus, end) if 8 <= n <= 15 else None), end


def userinfo(text: str, i: int) -> tuple[int, int] | None:
    """``name:secret`` from ``i``, behind a scheme, before an at-sign."""
    end = _run(text, i, USERINFO)
    ok = end < len(text) and text[end] == "@" and ":" in text[i:end].strip(":")
    return (i, end) if ok else None


def _after_cue(text: str, i: int) -> list[int]:
    """Where the value after a cue may begin: behind a few separators, and behind words like "number"."""
    places = [_run(text, i, frozenset(" :#=\t"))]
    for word in AFTER_CUE:
        end = places[-1] + len(word)
        if text[places[-1] : end].lower() == word:
            places.append(_run(text, end, frozenset(" :#=\t")))
    return places


def iban(text: str, cue: int) -> tuple[int, int] | None:
    for i in _after_cue(text, cue):  # "IS" is a country, too
        end, chars = i, []
        while end < len(text) and len(chars) < 34:
            if text[end] in ALNUM:
                chars.append(text[end])
            elif text[end] != " ":
                break
            end += 1
        value = "".join(chars).upper()
        # the grouping by spaces hides where the number ends: the longest valid prefix counts
        for n in range(len(value), 14, -1):
            v = value[:n]
            if v[:2].isalpha() and v[2:4].isdigit() and int("".join(str(int(c, 36)) for c in v[4:] + v[:4])) % 97 == 1:
                end, seen = i, 0
                while seen < n:
                    seen += text[end] != " "
                    end += 1
                return i, end
    return None


def ssn(text: str, cue: int) -> tuple[int, int] | None:
    i = _after_cue(text, cue)[-1]
    v = text[i : i + 11]
    ok = (
        len(v) == 11
        and v[3] == v[6] == "-"
        and all(c in DIGITS for c in v[:3] + v[4:6] + v[7:])
        and v[:3] not in ("000", "666")
        and v[0] != "9"
        and v[4:6] != "00"
        and v[7:] != "0000"
        and text[i + 11 : i + 12] not in DIGITS
    )
    return (i, i + 11) if ok else None


def find(text: str) -> list[Span]:
    """All spans of a text, by kind in the order of ``KINDS``, then by start."""
    found: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    done = dict.fromkeys((*KINDS, "chain"), 0)  # the end of what the parser of a kind has read
    n = len(text)

    def add(kind: str, span: tuple[int, int] | None) -> None:
        if span and span[0] >= done[kind]:
            found[kind].append(span)
            done[kind] = span[1]

    for end, (anchor, length) in _automaton().iter(_lowered(text)):
        i = end - length + 1
        if anchor == "digit":
            if i >= done["chain"]:
                spans, done["chain"] = dotted(text, i)
                found["ip"] += spans
            if i >= done["card"]:
                span, done["card"] = card(text, i)
                if span:
                    found["card"].append(span)
        elif anchor == "at":
            if i >= done["email"]:
                add("email", email(text, i, done["email"]))
        elif anchor == "phone":
            if i >= done["phone"]:
                span, done["phone"] = phone(text, i)
                if span:
                    found["phone"].append(span)
        elif anchor == "scheme":
            add("userinfo", userinfo(text, i + 3))
        elif anchor == "iban":
            if end + 1 == n or text[end + 1] not in LETTERS:
                add("iban", iban(text, end + 1))
        else:
            add("ssn", ssn(text, end + 1))
    return [(k, a, b) for k in KINDS for a, b in found[k]]


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def masked(text: str, spans: list[Span]) -> str:
    """``text`` with each span replaced by its kind in angle brackets; overlapping spans count as one."""
    out, at = [], 0
    for k, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"<{k}>"]
        at = max(at, b)
    return "".join([*out, text[at:]])


_SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))


def find_pii(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(id, spans array<struct<kind, start, end>>, base_sha256, spans_text) per row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            spans = [find(t) if t else [] for t in batch.column(1).to_pylist()]
            base = [joined([s for s in x if s[0] in BASE_KINDS]) for x in spans]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([[{"kind": k, "start": a, "end": b} for k, a, b in x] for x in spans], kind),
                    pa.array([hashlib.sha256(b.encode()).hexdigest() for b in base], pa.string()),
                    pa.array([joined(x) for x in spans], pa.string()),
                ],
                ["id", "spans", "base_sha256", "spans_text"],
            )

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType(
        [
            T.StructField("id", rows.schema["id"].dataType),
            T.StructField("spans", _SPANS),
            T.StructField("base_sha256", T.StringType()),
            T.StructField("spans_text", T.StringType()),
        ]
    )
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def mask_pii(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with each span of personal data in its text replaced by ``<kind>``; null texts stay null.

    Only the text goes through Python; all other columns, whatever their names, are passed through.
    """
    index = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(index).to_pylist()
            for s in steps([len(t or "") for t in texts]):
                part = batch.slice(s.start, s.stop - s.start)
                clean = pa.array([masked(t, find(t)) if t else t for t in texts[s]], pa.string())
                yield pa.RecordBatch.from_arrays(
                    [clean if i == index else c for i, c in enumerate(part.columns)], batch.schema.names
                )

    return docs.mapInArrow(run, docs.schema)


def pii_counts(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) per row of ``docs``."""
    found = find_pii(docs)
    counts = [F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}") for k in BASE_KINDS]
    return found.select("doc_id", *counts, "base_sha256", F.col("spans_text").alias("spans"))
