"""SQL twins (DuckDB) of the queries whose results SQL can express."""

from __future__ import annotations

from llm.licenses import IDS, RULES, SENTENCES
from llm.lines import EDITS, LEAST
from llm.mixing import BLOCK

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1 = f"""
WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents),
win AS (SELECT doc_id, s, md5(array_to_string(w[s + 1 : s + 35], ' ')) AS h FROM (
  SELECT doc_id, w, unnest(range(len(w) - 34)) AS s FROM d WHERE len(w) >= 35)),
twice AS (SELECT h FROM win GROUP BY h HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, s + k AS p FROM win JOIN twice USING (h), range(35) t(k)),
word AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS p FROM d),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id),
lost AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN lost USING (doc_id)
"""

OP2 = """
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
link AS (SELECT a.vec_id AS x, b.vec_id AS y FROM v a, v b WHERE a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.9),
reach AS (SELECT x, y FROM link UNION SELECT r.x, l.y FROM reach r JOIN link l ON r.y = l.x),
n AS (SELECT x, count(*) AS n FROM link GROUP BY x), c AS (SELECT x, min(y) AS c FROM reach GROUP BY x)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(c, vec_id)) AS component_id, vec_id <= coalesce(c, vec_id) AS kept
FROM v LEFT JOIN n ON vec_id = n.x LEFT JOIN c ON vec_id = c.x
"""

_known = ", ".join(f"('{text}', {IDS[name]})" for name, text in SENTENCES.items())
_rules = ", ".join(f"('{name}', ',{',,'.join(str(IDS[s]) for s in RULES[name])},')" for name in sorted(RULES))
OP5 = rf"""
WITH known(sentence, id) AS (VALUES {_known}), rules(name, rule) AS (VALUES {_rules}),
cut AS (SELECT doc_id, string_split(regexp_replace(text, '([.;:!?])[ \t\r\f\x0b]+', '\1' || chr(10), 'g'), chr(10)) AS parts FROM documents),
part AS (SELECT doc_id, unnest(parts) AS raw, generate_subscripts(parts, 1) AS p FROM cut),
plain AS (SELECT doc_id, p, trim(regexp_replace(regexp_replace(replace(lower(raw), 'licence', 'license'), '[^a-z0-9.]+', ' ', 'g'), '\.+( |$)', '\1', 'g')) AS s FROM part),
ids AS (SELECT doc_id, list(coalesce(id, -1) ORDER BY p) AS ids FROM plain LEFT JOIN known ON s = sentence WHERE s <> '' GROUP BY doc_id),
line AS (SELECT doc_id, list_filter(ids, lambda x: x >= 0) AS found, ',' || array_to_string(ids, ',,') || ',' AS line FROM ids),
hit AS (SELECT doc_id, name, (length(line) - length(replace(line, rule, ''))) // length(rule) AS times FROM line, rules WHERE contains(line, rule)),
sums AS (SELECT doc_id, string_agg(name, ',' ORDER BY name) AS licenses, sum(times)::BIGINT AS n FROM hit GROUP BY doc_id)
SELECT d.doc_id, coalesce(len(found), 0)::BIGINT AS n_sentences, coalesce(array_to_string(found, ','), '') AS sentence_ids,
  coalesce(licenses, '') AS licenses, coalesce(n, 0)::BIGINT AS n_matches
FROM documents d LEFT JOIN line USING (doc_id) LEFT JOIN sums USING (doc_id)
"""

_past = "e.blocks * b.weight <= ({0}) * e.weight"  # the targets of e run out before that block
_target = f"sum(CASE WHEN {_past} THEN e.blocks ELSE 0 END) + sum(CASE WHEN {_past} THEN 0 ELSE e.weight END) * ({{0}}) / b.weight"
#: Windows of all blocks from the exact shares over the whole run, then earliest deadline first, slot by slot.
OP8 = f"""
WITH RECURSIVE doc AS (SELECT doc_id, source, coalesce('=' || source, '') AS s, md5(coalesce(doc_id::VARCHAR, '')) AS k FROM documents),
ranked AS (SELECT *, row_number() OVER (PARTITION BY s ORDER BY k) - 1 AS rank FROM doc),
counts AS (SELECT s, sqrt(count(*)::DOUBLE) AS weight, ceil(count(*) / {BLOCK})::BIGINT AS blocks FROM doc GROUP BY s),
src AS (SELECT *, row_number() OVER (ORDER BY s) AS i FROM counts),
block AS (SELECT i, weight, unnest(range(blocks)) AS n FROM src),
span AS (SELECT b.i, b.n, floor({_target.format("b.n")} + 1e-9)::BIGINT AS release, ceil({_target.format("b.n + 1")} - 1e-9)::BIGINT AS due
  FROM block b, src e GROUP BY b.i, b.n, b.weight),
spans AS (SELECT list(releases ORDER BY i) AS release, list(dues ORDER BY i) AS due, sum(len(dues))::BIGINT AS total
  FROM (SELECT i, list(release ORDER BY n) AS releases, list(due ORDER BY n) AS dues FROM span GROUP BY i)),
edf(t, done, pick) AS (
  SELECT -1::BIGINT, list_transform(due, lambda x: 0::BIGINT), 0::BIGINT FROM spans
  UNION ALL
  SELECT t + 1, list_transform(done, lambda x, i: x + CASE WHEN i = p THEN 1 ELSE 0 END), p FROM (
    SELECT t, done, (list_min(list_transform(done, lambda x, i: CASE WHEN x < len(due[i]) AND release[i][x + 1] <= t + 1
      THEN due[i][x + 1] * 100000 + i END)) % 100000)::BIGINT AS p FROM edf, spans WHERE t + 1 < total)),
slot AS (SELECT t, pick AS i, row_number() OVER (PARTITION BY pick ORDER BY t) - 1 AS n FROM edf WHERE t >= 0)
SELECT doc_id, source, rank // {BLOCK} AS block_no, t AS slot, (rank % {BLOCK})::INTEGER AS place
FROM ranked JOIN src USING (s) JOIN slot ON slot.i = src.i AND slot.n = rank // {BLOCK}
"""

OP9 = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(coalesce({LOWER}, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sh AS (
  SELECT DISTINCT doc_id, array_to_string(w[s : s + 3], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 2)) AS s FROM d WHERE len(w) >= 4)
  UNION SELECT doc_id, array_to_string(w, ' ') FROM d WHERE len(w) BETWEEN 1 AND 3),
size AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sh a JOIN sh b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS (SELECT x, y FROM common JOIN size a ON x = a.doc_id JOIN size b ON y = b.doc_id WHERE 100 * c >= 80 * (a.n + b.n - c)),
reach AS (SELECT x, y FROM link UNION SELECT r.x, l.y FROM reach r JOIN link l ON r.y = l.x),
c AS (SELECT x, min(y) AS c FROM reach GROUP BY x)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, coalesce(c, d.doc_id)) AS component_id, d.doc_id <= coalesce(c, d.doc_id) AS kept
FROM d LEFT JOIN size USING (doc_id) LEFT JOIN c ON d.doc_id = c.x
"""

_counts = ", ".join(f"length(line) - length(replace(line, '{x}', '')) AS n_{x}" for x in "etaoin")
_apart = " + ".join(f"abs(a.n_{x} - b.n_{x})" for x in "etaoin")
#: levenshtein() counts bytes, so the letters beyond ASCII that the tables have are replaced by control characters.
_letters = "ßàáäçèéêíñóöúüÀÁÄÇÈÉÊÍÑÓÖÚÜ"
_plain = " || ".join(f"chr({k})" for k in [*range(1, 9), *range(14, 32), 127][: len(_letters)])


def _bytes(line: str) -> str:
    return f"translate({line}, '{_letters}', {_plain})"


OP10 = rf"""
WITH cut AS (SELECT doc_id, text, string_split(text, chr(10)) AS parts FROM documents),
raw AS (SELECT doc_id, unnest(parts) AS raw, generate_subscripts(parts, 1) - 1 AS no FROM cut),
line AS (SELECT doc_id, no, raw, trim(raw, chr(32) || chr(9) || chr(11) || chr(12) || chr(13)) AS line FROM raw),
first AS (SELECT line, min((doc_id, no)) AS at, length(line) AS n FROM line WHERE line <> '' GROUP BY line),
sized AS (SELECT *, {_bytes('line')} AS bytes, {_counts} FROM first WHERE n >= {LEAST - EDITS}),
near AS (SELECT DISTINCT greatest(a.at, b.at) AS at FROM sized a, (SELECT unnest(range({EDITS + 1})) AS more) m, sized b
  WHERE b.n = a.n + more AND a.line <> b.line AND CASE WHEN b.at > a.at THEN b.n ELSE a.n END >= {LEAST} AND {_apart} <= {2 * EDITS}
  AND CASE WHEN {_apart} <= {2 * EDITS} THEN levenshtein(a.bytes, b.bytes) <= {EDITS} END),
mark AS (SELECT l.doc_id, l.no, l.raw, l.line <> '' AS solid, l.line <> '' AND (f.at <> (l.doc_id, l.no) OR near.at IS NOT NULL) AS gone
  FROM line l LEFT JOIN first f ON l.line = f.line LEFT JOIN near ON f.at = near.at)
SELECT doc_id, count_if(solid)::BIGINT AS n_lines, count_if(gone)::BIGINT AS n_removed,
  sha256(coalesce(string_agg(raw, chr(10) ORDER BY no) FILTER (NOT gone), '')) AS text_sha256
FROM mark GROUP BY doc_id
"""

#: CRC-32 (reflected, polynomial EDB88320) of a decimal number: a byte at a time, each shifted out in eight steps.
_crc = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({0}::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
  lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, none: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"""
CRC = _crc.format("doc_id")


def _field(value: str) -> str:
    return f"coalesce(strlen({value}::VARCHAR) || ':' || {value}::VARCHAR, '-')"


def _leaf(more: str) -> str:
    return "sha256(" + " || ".join(map(_field, ["doc_id", "source", "lang", f"(n_chars + {more})", "text"])) + ")"


_LEVELS = """{to}(t, lv, i, h, n) AS (
  SELECT t, 0, i, h, count(*) OVER (PARTITION BY t) FROM {of}
  UNION ALL
  SELECT t, lv + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), (any_value(n) + 1) // 2 FROM {to} WHERE n > 1 GROUP BY t, lv, i // 2)"""
OP11 = f"""
WITH RECURSIVE hashed AS (
  SELECT doc_id, coalesce('=' || lang, '') AS t, {_leaf("0")} AS leaf, {_leaf(f"CASE WHEN {CRC} % 7 = 0 THEN 1 ELSE 0 END")} AS changed FROM documents),
leaf AS (SELECT *, row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, leaf AS h FROM hashed),
{_LEVELS.format(to="node", of="leaf")},
top AS (SELECT '^' AS t, row_number() OVER (ORDER BY t) - 1 AS i, h, t AS lang FROM node WHERE n = 1),
{_LEVELS.format(to="over", of="top")},
nodes AS (SELECT * FROM node UNION ALL SELECT * FROM over),
climb(doc_id, leaf, lang, t, lv, i, h, siblings, root) AS (
  SELECT doc_id, leaf, t, t, 0, i, coalesce(changed, leaf), '', NULL::VARCHAR FROM leaf
  UNION ALL
  SELECT doc_id, leaf, c.lang, CASE WHEN n.n > 1 THEN c.t WHEN c.t <> '^' THEN '^' END, CASE WHEN n.n > 1 THEN c.lv + 1 ELSE 0 END,
    CASE WHEN n.n > 1 THEN c.i // 2 ELSE top.i END,
    CASE WHEN n.n = 1 THEN c.h WHEN c.i % 2 = 1 THEN sha256(s.h || c.h) ELSE sha256(c.h || coalesce(s.h, '')) END, c.siblings || coalesce(s.h, ''), n.h
  FROM climb c JOIN nodes n ON n.t = c.t AND n.lv = c.lv AND n.i = c.i
  LEFT JOIN nodes s ON s.t = c.t AND s.lv = c.lv AND s.i = xor(c.i, 1) LEFT JOIN top ON top.lang = c.t)
SELECT doc_id, leaf, top.h AS subroot, root, sha256(siblings) AS proof_sha256, c.h AS folded_root, c.h = root AS verified
FROM climb c JOIN top USING (lang) WHERE c.t IS NULL
"""

_symbols = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_digit = "substr('" + _symbols + "', (('0x' || substr(sha1(coalesce(html, '')), 5 * k + 1, 5))::BIGINT >> {0} & 31)::INT + 1, 1)"
OP12 = f"""
WITH page AS (SELECT page_id, coalesce(html, '') AS body, array_to_string(list_transform(range(8), lambda k: {" || ".join(_digit.format(15 - 5 * x) for x in range(4))}), '') AS digest
  FROM pages),
told AS (SELECT *, min(page_id) OVER (PARTITION BY body) AS first FROM page)
SELECT page_id, strlen(body)::BIGINT AS payload_bytes, digest AS payload_digest,
  CASE WHEN page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM told
"""

#: A run has two neighbouring places c and c + 8, c a multiple of 8, whose eight words recur q on; all matches of such a q are looked at.
OP13 = f"""
WITH d AS (SELECT doc_id, {WORDS} AS w, {CRC} AS h FROM documents),
plan AS (SELECT *, len(w) AS n, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a FROM d),
sized AS (SELECT *, 1 + (n - a) // (3 + (h // 10) % 8) AS p FROM plan),
doc AS (SELECT doc_id, n, CASE WHEN a IS NULL THEN w ELSE list_transform(range(n), lambda i: w[CASE WHEN i < a THEN i ELSE a + (i - a) % p END + 1]) END AS w FROM sized),
gram AS (SELECT doc_id, n, i, md5(array_to_string(w[i + 1 : i + 8], ' ')) AS g FROM (SELECT *, unnest(range(n - 7)) AS i FROM doc WHERE n >= 24)),
period AS (SELECT DISTINCT a.doc_id, b.i - a.i AS q FROM gram a JOIN gram b USING (doc_id, g) WHERE a.i % 8 = 0 AND b.i > a.i AND 3 * (b.i - a.i) <= a.n),
place AS (SELECT doc_id, w, q, unnest(range(n - q)) AS i FROM doc JOIN period USING (doc_id)),
match AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM place WHERE w[i + 1] = w[i + q + 1]),
stretch AS (SELECT doc_id, q, min(i) AS s, count(*) + q AS l FROM match GROUP BY doc_id, q, island HAVING count(*) + q >= greatest(24, 3 * q)),
run AS (SELECT doc_id, s, l, min(q) AS q FROM stretch GROUP BY doc_id, s, l),
sums AS (SELECT doc_id, count(*) AS n_runs, arg_max((s, l, q), (l / q, -s, -q)) AS best, string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS runs FROM run GROUP BY doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + l)) AS i FROM run),
word AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS i FROM doc),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text FROM word ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc.doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, best[1]::BIGINT AS start, best[2]::BIGINT AS length, best[3]::BIGINT AS period,
  (1000 * best[2] // best[3])::BIGINT AS exponent_milli, sha256(coalesce(runs, '')) AS runs_sha256, sha256(coalesce(text, '')) AS collapsed_sha256
FROM doc LEFT JOIN sums USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

ORACLE = {
    "op1_passages": OP1, "op2_vectors": OP2, "op5_licenses": OP5, "op8_mixing": OP8, "op9_minhash": OP9, "op10_lines": OP10,
    "op11_merkle": OP11, "op12_warc": OP12, "op13_periodic": OP13,
}
