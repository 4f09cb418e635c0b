"""DuckDB SQL of the operators that SQL can express, over the same tables."""

from __future__ import annotations

from orderlens.llm.licenses import CUT, LOWER, RULES, SENTENCES, UPPER

ORACLES: dict[str, str] = {}


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"

ORACLES["op7_mixing"] = r"""
WITH sizes AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5(coalesce(text, '')) AS digest
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INTEGER) AS weight
  FROM sizes GROUP BY source),
lined AS (
  SELECT *, 3 * source_size AS cap,
         row_number() OVER (ORDER BY (3 * source_size) / weight, source NULLS LAST) AS place FROM sources),
levels AS (
  SELECT l.*, ((SELECT CAST(sum(source_size) AS BIGINT) FROM lined)
               - (SELECT CAST(coalesce(sum(cap), 0) AS BIGINT) FROM lined b WHERE b.place < l.place))
              / (SELECT CAST(sum(weight) AS BIGINT) FROM lined r WHERE r.place >= l.place) AS level
  FROM lined l),
shared AS (SELECT arg_min(level, place) AS level FROM levels WHERE cap >= level * weight),
targets AS (
  SELECT source, source_size, cap,
         CASE WHEN cap < shared.level * weight THEN CAST(cap AS DOUBLE) ELSE shared.level * weight END AS target
  FROM levels, shared),
rates AS (
  SELECT *, CASE WHEN source_size = 0 THEN 0.0 WHEN target >= cap THEN 3.0 ELSE target / source_size END AS rate
  FROM targets),
drawn AS (
  SELECT d.doc_id, d.size, r.source_size, r.target, r.rate,
         CAST('0x' || substr(md5('mix-1:' || coalesce(CAST(d.doc_id AS VARCHAR), '') || ':' || d.digest || ':'
           || (row_number() OVER (PARTITION BY d.doc_id, d.source, d.digest) - 1)), 1, 13) AS BIGINT) / 4503599627370496.0 AS u
  FROM sizes d JOIN rates r ON d.source IS NOT DISTINCT FROM r.source)
SELECT doc_id, size, source_size, target,
       CAST((floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) * size AS BIGINT) AS taken
FROM drawn
"""

ORACLES["op5_warc"] = r"""
WITH digests AS (
  SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
bases AS (
  SELECT page_id, payload_bytes,
         array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           CAST(((CAST('0x' || substr(hex, CAST(i // 4 * 5 + 1 AS BIGINT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31) + 1 AS BIGINT), 1) FOR i IN range(0, 32)], '') AS payload_digest
  FROM digests),
newest AS (
  SELECT payload_digest, payload_bytes, max(page_id) AS newest FROM bases GROUP BY ALL)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM newest THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM newest THEN newest END AS refers_to
FROM bases JOIN newest USING (payload_digest, payload_bytes)
"""

ORACLES["op8_top_k"] = r"""
WITH rows AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM rows q JOIN rows c ON len(q.v) = len(c.v) AND q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS "rank" FROM scored)
SELECT query_id, "rank", vec_id, score FROM ranked WHERE "rank" <= 5
"""

# the sentences and rules are the operator's fixed values; how they are applied is written here anew
ORACLES["op9_licenses"] = f"""
WITH pieces AS (
  SELECT row_number() OVER () AS r, doc_id, string_split_regex(coalesce(text, ''), {_text(CUT)}) AS piece FROM documents),
lines AS (
  SELECT r, generate_subscripts(piece, 1) AS spot, unnest(piece) AS piece FROM pieces),
plain AS (
  SELECT r, spot, trim(regexp_replace(translate(piece, '{UPPER}', '{LOWER}'), '[^a-z0-9]+', ' ', 'g')) AS s FROM lines),
known AS (
  SELECT * FROM (VALUES {", ".join(f"({i}, {_text(n)}, {_text(p)})" for i, (n, p) in enumerate(SENTENCES.items()))}) t(place, name, pattern)),
hits AS (
  SELECT r, count(*) AS n, string_agg(name, ' ' ORDER BY spot, place) AS names,
         string_agg('<' || name || '>', '' ORDER BY spot, place) AS line
  FROM plain JOIN known ON regexp_matches(s, pattern) GROUP BY r),
parts AS (
  SELECT r, unnest(regexp_extract_all(line, {_text("|".join(f"({x})" for _, x in RULES))})) AS part,
         generate_subscripts(regexp_extract_all(line, {_text("|".join(f"({x})" for _, x in RULES))}), 1) AS spot FROM hits),
named AS (
  SELECT r, spot, CASE {" ".join(f"WHEN regexp_full_match(part, {_text(x)}) THEN {_text(n)}" for n, x in RULES)} END AS license FROM parts),
firsts AS (SELECT r, license, min(spot) AS spot FROM named GROUP BY r, license),
listed AS (SELECT r, count(*) AS n, string_agg(license, ',' ORDER BY spot) AS licenses FROM firsts GROUP BY r)
SELECT doc_id, CAST(coalesce(h.n, 0) AS BIGINT) AS n_sentences, coalesce(h.names, '') AS sentence_ids,
       CAST(coalesce(l.n, 0) AS BIGINT) AS n_licenses, coalesce(l.licenses, '') AS licenses
FROM pieces p LEFT JOIN hits h ON h.r = p.r LEFT JOIN listed l ON l.r = p.r
"""

ORACLES["op12_pivot_join"] = """
WITH RECURSIVE vectors AS (
  SELECT vec_id, embedding, vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
         AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
         AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AS valid FROM embeddings),
numbered AS (SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, CAST(embedding AS DOUBLE[]) AS v FROM vectors WHERE valid),
links AS (
  SELECT a.r, b.r AS other FROM numbered a JOIN numbered b ON a.r <> b.r AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.95),
reached AS (SELECT r, r AS other FROM numbered UNION SELECT reached.r, links.other FROM reached JOIN links ON reached.other = links.r),
least AS (SELECT reached.r, min(n.vec_id) AS component_id FROM reached JOIN numbered n ON reached.other = n.r GROUP BY ALL),
counts AS (SELECT r, count(*) AS n_links FROM links GROUP BY r)
SELECT n.vec_id, CAST(coalesce(c.n_links, 0) AS BIGINT) AS n_links, l.component_id, n.vec_id = l.component_id AS kept
FROM numbered n JOIN least l USING (r) LEFT JOIN counts c USING (r)
UNION ALL SELECT vec_id, CAST(0 AS BIGINT), vec_id, true FROM vectors WHERE NOT valid
"""

ORACLES["op13_divergence"] = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
words AS (
  SELECT r, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
kept AS (
  SELECT lang, term, CAST(count(*) AS HUGEINT) AS n FROM words GROUP BY ALL HAVING count(DISTINCT r) >= 10),
langs AS (SELECT lang, CAST(sum(n) AS HUGEINT) AS total, CAST(count(*) AS HUGEINT) AS v FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM docs),
counts AS (SELECT w.lang, w.source, w.term, CAST(count(*) AS HUGEINT) AS n FROM words w JOIN kept k USING (lang, term) GROUP BY ALL),
totals AS (SELECT lang, source, CAST(sum(n) AS HUGEINT) AS total FROM counts GROUP BY ALL),
probabilities AS (
  SELECT lang, g.source, k.term, coalesce(c.n, 0) AS n,
         1 + (1000000000 * (coalesce(c.n, 0) + 2)) // (coalesce(t.total, 0) + 2 * l.v) AS p,
         1 + (1000000000 * (k.n + 2)) // (l.total + 2 * l.v) AS q
  FROM groups g JOIN langs l USING (lang) JOIN kept k USING (lang) LEFT JOIN totals t USING (lang, source)
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
sums AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM probabilities a JOIN probabilities b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL SELECT lang, source, 'term', term, CAST(((p - q) * (p - q)) // (p + q) AS BIGINT) FROM probabilities WHERE n > 0 AND p > q),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM parts)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 10
"""

ORACLES["op11_spelling"] = r"""
WITH RECURSIVE crc_table AS (
  SELECT list(list_reduce(range(0, 8), lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b) ORDER BY b) AS t
  FROM (SELECT CAST(range AS BIGINT) AS b FROM range(0, 256))),
runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
         unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) AS run
  FROM documents),
counted AS (SELECT id, run, CAST(count(*) AS BIGINT) AS n, hex(encode(id || ':' || run)) AS h FROM runs WHERE length(run) >= 7 GROUP BY id, run),
hashed AS (
  SELECT run, n, xor(list_reduce(list_transform(range(0, CAST(length(h) // 2 AS BIGINT)), lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT)),
                                 lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) AS crc
  FROM counted, crc_table),
forms AS (
  SELECT CASE WHEN crc % 31 = 0 THEN substr(run, 1, crc % length(run)) || substr(run, crc % length(run) + 2) ELSE run END AS word, n FROM hashed),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM forms WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
places AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words),
replaced AS (SELECT word, n, i, substr(word, 1, i - 1) || '?' || substr(word, i + 1) AS pattern FROM places),
shorter AS (SELECT DISTINCT word, n, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM places),
near AS (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM replaced a JOIN replaced b ON a.pattern = b.pattern AND a.i = b.i AND a.word <> b.word
  UNION ALL SELECT s.word, s.n, w.word, w.n FROM shorter s JOIN words w ON s.rest = w.word
  UNION ALL SELECT w.word, w.n, s.word, s.n FROM shorter s JOIN words w ON s.rest = w.word),
ranked AS (
  SELECT *, count(*) OVER (PARTITION BY word) AS n_near, row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) AS place FROM near),
described AS (
  SELECT w.word, w.n, coalesce(r.n_near, 0) AS n_near, CASE WHEN r.other_n >= 10 * w.n THEN r.other END AS form,
         CASE WHEN r.other_n >= 10 * w.n THEN r.other_n END AS form_n
  FROM words w LEFT JOIN ranked r ON r.word = w.word AND r.place = 1),
followed AS (
  SELECT word, word AS at FROM described
  UNION ALL SELECT f.word, d.form FROM followed f JOIN described d ON f.at = d.word WHERE d.form IS NOT NULL)
SELECT d.word, d.form, f.at AS root, d.n, CAST(d.n_near AS BIGINT) AS n_near, d.form_n
FROM described d JOIN followed f USING (word) JOIN described e ON f.at = e.word AND e.form IS NULL
"""
