"""License scans by sentence rules, in DataFrame functions only.

1. A text is cut into sentences (a full stop, question or exclamation mark before white space, or an
   empty line); a sentence is normalised: A-Z lower-cased, everything but letters and digits one space.
2. Each sentence is mapped to the identifiers of the known license sentences that it holds, in the
   order of ``SENTENCES``.  What holds none is left out.
3. The identifiers of a text form a sequence.  The ordered rules (``RULES``) are matched against it from
   its start on: where several fit, the first rule listed wins, and what a rule has matched is used up.

All of this is done within the row: there is no shuffle, and a row's cost depends on its text only.
A copyright line's "all rights reserved" belongs to the license text that comes next (BSD texts begin with
it); elsewhere, also next to a mere reference to a license, it is reported as ``Proprietary``.
A text without any cue word can't hold a known sentence and is not cut up.

Cases: null and empty texts have no sentences and no licenses; long texts are read whole; repeated rows
and null ids keep a row each; an empty table gives an empty result; only id and text are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---- fixed values: license names, license sentences and rules over them ----
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
CUT = r"[.!?]['\")\]]*[ \t\r\n]+|\n[ \t\r]*\n"
CUES = r"licen[sc]|redistribut|permission|under|later|public domain|endorse|as is|all rights reserved"
REFERENCE = r"\b(licen[sc]ed|released|distributed|published|available|provided|covered|modify it|use this [a-z]+) under (the )?((terms|conditions) (of|and conditions of) )?(the )?"
VERSION = r"( licen[sc]e)?( as published by the free software foundation)?( either)?( version| v)? ?"
GNU = r"(gnu )?"
NAMES = {
    "Apache-2.0": r"apache( software)?( licen[sc]e)?( version| v)? ?2( 0)?\b",
    "MIT": r"(mit|expat)\b",
    "AGPL-3.0": GNU + r"(agpl|affero general public)" + VERSION + r"3\b",
    "LGPL-2.1": GNU + r"(lgpl|lesser general public)" + VERSION + r"2 1\b",
    "LGPL-3.0": GNU + r"(lgpl|lesser general public)" + VERSION + r"3\b",
    "GPL-2.0": GNU + r"(gpl|general public)" + VERSION + r"2\b",
    "GPL-3.0": GNU + r"(gpl|general public)" + VERSION + r"3\b",
    "MPL-2.0": r"(mozilla public licen[sc]e|mpl)( version| v)? ?2( 0)?\b",
    "BSD-2-Clause": r"(bsd 2 clause|2 clause bsd|simplified bsd)\b",
    "BSD-3-Clause": r"(bsd 3 clause|3 clause bsd|new bsd|modified bsd)\b",
    "ISC": r"isc licen[sc]e\b",
    "CC0-1.0": r"(cc0|creative commons zero)\b",
    "CC-BY-4.0": r"(cc by|creative commons attribution)( international)?( licen[sc]e)? 4 0\b",
    "CC-BY-SA-4.0": r"(cc by sa|creative commons attribution sharealike)( licen[sc]e)? 4 0\b",
    "CC-BY-NC-4.0": r"(cc by nc|creative commons attribution noncommercial)( licen[sc]e)? 4 0\b",
    "CC-BY-ND-4.0": r"(cc by nd|creative commons attribution noderivatives)( licen[sc]e)? 4 0\b",
    "CC-BY-NC-SA-4.0": r"(cc by nc sa|creative commons attribution noncommercial sharealike)( licen[sc]e)? 4 0\b",
}
SENTENCES = {
    **{f"names:{name}": REFERENCE + pattern for name, pattern in NAMES.items()},
    **{f"tag:{name}": r"\bspdx license identifier " + name.lower().replace("-", " ").replace(".", " ") + r"\b" for name in NAMES},
    "later-version": r"\b(any later version|or later)\b",
    "mit-grant": r"\bpermission is hereby granted free of charge to any person obtaining a copy of this software\b",
    "mit-notice": r"\bthe above copyright notice and this permission notice shall be included in all copies\b",
    "mit-as-is": r"\bthe software is provided as is without warranty of any kind\b",
    "isc-grant": r"\bpermission to use copy modify and( or)? distribute this software for any purpose with or without fee is hereby granted\b",
    "isc-as-is": r"\bthe software is provided as is and the author disclaims all warranties\b",
    "bsd-grant": r"\bredistribution and use in source and binary forms with or without modification are permitted\b",
    "bsd-source": r"\bredistributions of source code must retain the above copyright notice\b",
    "bsd-binary": r"\bredistributions in binary form must reproduce the above copyright notice\b",
    "bsd-endorse": r"\bneither the name of .* be used to endorse or promote products\b",
    "bsd-as-is": r"\bthis software is provided by the (copyright holders|regents|author).* as is\b",
    "apache-comply": r"\byou may not use this file except in compliance with the license\b",
    "apache-copy": r"\byou may obtain a copy of the license at\b",
    "apache-as-is": r"\bdistributed under the license is distributed on an as is basis\b",
    "unlicense-free": r"\bthis is free and unencumbered software released into the public domain\b",
    "all-rights-reserved": r"\ball rights reserved\b",
}
HEAD = "(<all-rights-reserved>)*"  # the copyright line that a license text begins with
RULES = [  # an identifier stands in angle brackets
    ("MIT", HEAD + "<mit-grant><mit-notice>(<mit-as-is>)?"),
    ("ISC", HEAD + "<isc-grant>(<isc-as-is>)?"),
    ("BSD-3-Clause", HEAD + "<bsd-grant><bsd-source><bsd-binary><bsd-endorse>(<bsd-as-is>)?"),
    ("BSD-2-Clause", HEAD + "<bsd-grant><bsd-source><bsd-binary>(<bsd-as-is>)?"),
    ("Apache-2.0", HEAD + "<names:Apache-2[.]0><apache-comply>(<apache-copy>)?(<apache-as-is>)?"),
    ("Apache-2.0", HEAD + "<apache-comply><apache-copy>(<apache-as-is>)?"),
    ("Unlicense", "<unlicense-free>"),
    *[(f"{name}-or-later", f"<(names|tag):{name.replace('.', '[.]')}><later-version>") for name in NAMES if "GPL" in name],
    *[(name, f"<(names|tag):{name.replace('.', '[.]')}>") for name in NAMES],
    ("Proprietary", "<all-rights-reserved>"),
]
# ----------------------------------------------------------------------------


def sentences(text: Column) -> Column:
    """The normalised sentences of a text that must not be null."""
    normal = lambda s: F.trim(F.regexp_replace(F.translate(s, UPPER, LOWER), "[^a-z0-9]+", " "))
    return F.transform(F.split(text, CUT), normal)


def identifiers(cut: Column, known: dict[str, str]) -> Column:
    """The identifiers of the known sentences among normalised ones, in order."""

    def of(sentence: Column) -> Column:
        marks = F.array(*[F.when(sentence.rlike(pattern), F.lit(name)) for name, pattern in known.items()])
        # a sentence without a cue holds nothing that is known
        return F.when(sentence.rlike(CUES), F.array_compact(marks)).otherwise(F.array().cast("array<string>"))

    return F.flatten(F.transform(cut, of))


def matched(sequence: Column, rules: list[tuple[str, str]]) -> Column:
    """The licenses whose rules match a sequence of identifiers in angle brackets, in order."""
    # regular expressions prefer the first alternative: the order of the rules is their rank
    found = F.regexp_extract_all(sequence, F.lit("|".join(f"({rule})" for _, rule in rules)), 0)

    def license_of(part: Column) -> Column:
        chosen = F
        for name, rule in rules:
            chosen = chosen.when(part.rlike(f"^{rule}$"), F.lit(name))
        return chosen

    return F.transform(found, license_of)


def scan(
    docs: DataFrame,
    text_col: str = "text",
    id_col: str = "doc_id",
    known: dict[str, str] = SENTENCES,
    rules: list[tuple[str, str]] = RULES,
) -> DataFrame:
    """(doc_id, sentence_ids array, licenses array) per row of ``docs``, both in the order of the text."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    # cue words may be broken over lines or written with other signs between
    cued = F.translate(text, UPPER, LOWER).rlike(CUES.replace(" ", "[^a-z0-9]+"))
    none = F.array().cast("array<string>")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.when(cued, sentences(text)).otherwise(none).alias("cut"))
    rows = rows.select("doc_id", identifiers(F.col("cut"), known).alias("sentence_ids"))
    sequence = F.array_join(F.transform("sentence_ids", lambda s: F.concat(F.lit("<"), s, F.lit(">"))), "")
    return rows.select("doc_id", "sentence_ids", matched(sequence, rules).alias("licenses"))


def license_report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_sentences, sentence_ids, n_licenses, licenses): recognised sentences and distinct licenses in order."""
    distinct = F.array_distinct("licenses")
    return scan(docs).select(
        "doc_id",
        F.size("sentence_ids").cast("long").alias("n_sentences"),
        F.array_join("sentence_ids", " ").alias("sentence_ids"),
        F.size(distinct).cast("long").alias("n_licenses"),
        F.array_join(distinct, ",").alias("licenses"),
    )
