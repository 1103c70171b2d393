"""SQL twins of the registered queries, in plain ANSI-style SQL for DuckDB.

They state the result directly (quadratic ``contains`` joins, whole-table windows) and share no code
with the Spark plans.
"""

from __future__ import annotations

from themeloom.functions import fixed
from themeloom.plans.bindings import BATCH, BROKEN_ROW, MIN_LEN, N_BATCHES, OPEN_ROW, PROMPT_BUDGET, SEED, UNDATED_FILE

N = BATCH * N_BATCHES


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def norm(c: str) -> str:
    return f"trim(regexp_replace(coalesce({c}, ''), '{fixed.WHITESPACE_RUN}', ' ', 'g'), ' ')"


def strip(c: str) -> str:
    return f"trim({c}, {_q(fixed.OUTER_PUNCTUATION)})"


RATING = "CASE WHEN n_chars < 600 THEN '1' WHEN n_chars < 1200 THEN '2' WHEN n_chars < 2400 THEN '3' WHEN n_chars < 4800 THEN '4' ELSE '5' END"

REVIEWS = f"reviews AS (SELECT lang AS app, CAST(doc_id AS VARCHAR) AS name, {RATING} AS rating, text AS review FROM documents)"
LOG = f"""log AS (SELECT d.lang AS app, CAST(l.doc_id AS VARCHAR) AS name, l.doc_id + 1 AS global_seq,
  l.doc_id // {BATCH} AS batch_id, 'r0' AS run_id FROM labels l JOIN documents d ON d.doc_id = l.doc_id)"""
POOL = f"pool AS (SELECT * FROM reviews WHERE length(coalesce(review, '')) >= {MIN_LEN})"
AVAILABLE = "available AS (SELECT * FROM pool p WHERE NOT EXISTS (SELECT 1 FROM log l WHERE l.app = p.app AND l.name = p.name))"
QUOTAS = f"""strata AS (SELECT app, rating, count(*) AS n_rows FROM available GROUP BY app, rating),
t0 AS (SELECT *, CAST(sum(n_rows) OVER (PARTITION BY app) AS BIGINT) AS tot FROM strata),
t1 AS (SELECT *, least({N}, tot) AS n, CAST(round_even(CAST(least({N}, tot) * n_rows AS DOUBLE) / tot, 0) AS BIGINT) AS share,
  rating = max(rating) OVER (PARTITION BY app) AS is_last FROM t0),
t2 AS (SELECT *, least(n_rows, CASE WHEN is_last THEN n - coalesce(sum(share) OVER (PARTITION BY app ORDER BY rating
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) ELSE share END) AS q1 FROM t1),
t3 AS (SELECT *, n_rows - q1 AS spare, n - sum(q1) OVER (PARTITION BY app) AS missing FROM t2),
t4 AS (SELECT *, coalesce(sum(spare) OVER (PARTITION BY app ORDER BY rating ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spare_before FROM t3),
quotas AS (SELECT app, rating, n_rows, CAST(greatest(0, q1 + greatest(0, least(spare, missing - spare_before))) AS BIGINT) AS quota FROM t4)"""
PICKED = f"""ranked AS (SELECT a.*, q.quota, row_number() OVER (PARTITION BY a.app, a.rating ORDER BY md5(a.name || '|{SEED}'), a.name) AS rk
  FROM available a JOIN quotas q ON q.app = a.app AND q.rating = a.rating),
picked AS (SELECT * FROM ranked WHERE rk <= quota)"""
BATCHES = f"""ordered AS (SELECT *, row_number() OVER (PARTITION BY app ORDER BY md5(name || '|shuffle{SEED}'), name) AS pos FROM picked),
last AS (SELECT app, max(global_seq) AS ls, max(batch_id) AS lb FROM log GROUP BY app),
batches AS (SELECT o.app, coalesce(lb + 1, 0) + (pos - 1) // {BATCH} AS batch_id, coalesce(ls, 0) + pos AS global_seq, name, rating,
  {norm('review')} AS review_norm, '[ID:' || name || '] [rating:' || rating || '] ' || {norm('review')} AS entry
  FROM ordered o LEFT JOIN last l ON l.app = o.app WHERE pos <= {N})"""
RUN = "WITH " + ",\n".join([REVIEWS, LOG, POOL, AVAILABLE, QUOTAS, PICKED, BATCHES])

CODED = f"""coded AS (SELECT regexp_replace(source, '[0-9]+$', '') AS app, doc_id // {BATCH} AS batch_id, CAST(doc_id AS VARCHAR) AS name, lang AS theme,
  {RATING} AS rating, {norm('text')} AS review_norm FROM documents)"""
CODINGS = """sentences AS (SELECT app, batch_id, theme, trim(s, ' ') AS quote FROM coded, unnest(string_split(review_norm, '.')) AS u(s)),
codings AS (SELECT app, batch_id, theme, lower(substr(quote, 1, 2)) AS code, quote,
  'batch_' || CASE WHEN batch_id < 10 THEN '0' ELSE '' END || batch_id || '_' || theme || '.csv' AS src_file
  FROM sentences WHERE length(quote) >= 3)"""
WITH_CODINGS = f"WITH {CODED},\n{CODINGS}"
WITH_CODED = f"WITH {CODED}"
# what a coding file holds: rows whose unquoted code has a comma have a wrong column count
FILE_ROWS = f"""file_rows AS (SELECT *, CASE WHEN contains(code, ',') THEN 'column_count'
  WHEN {strip('quote')} = '' OR {strip("code")} IS NULL OR trim(code, ' ') = '' THEN 'empty' ELSE 'ok' END AS status FROM codings)"""
DICT = "dict AS (SELECT 'src' AS app, 'item_' || item_id AS code, text AS term FROM benchmark)"
MATCHES = "matches AS (SELECT DISTINCT c.app, c.name, d.code, d.term FROM coded c JOIN dict d ON contains(c.review_norm, d.term))"
FILED = """filed AS (SELECT DISTINCT app, batch_id, quote FROM
  (SELECT app, batch_id, quote FROM codings UNION ALL SELECT app, batch_id + 1, quote FROM codings))"""
SOURCES = """sources AS (SELECT DISTINCT c.app, c.batch_id, c.name, f.quote FROM coded c
  JOIN filed f ON f.app = c.app AND f.batch_id = c.batch_id AND contains(c.review_norm, f.quote))"""
FLAGS = f"""flags AS (SELECT 'src' AS app, doc_id // {BATCH} AS batch_id, CAST(doc_id AS VARCHAR) AS name, quality = 0 AS out_of_scope FROM labels)"""
CODE_N = "code_n AS (SELECT app, code, count(*) AS n FROM codings GROUP BY app, code)"
CODEBOOK = """samples AS (SELECT app, code, quote, row_number() OVER (PARTITION BY app, code ORDER BY length(quote), quote) AS r
  FROM (SELECT DISTINCT app, code, quote FROM codings)),
codebook AS (SELECT app, code, count(*) AS n, min(theme) AS theme,
  CASE WHEN count(*) >= 5 THEN 'code ' || code END AS definition FROM codings GROUP BY app, code HAVING count(*) >= 3)"""
DECISIONS = CODE_N + """,
decisions AS (
  SELECT app, 10 AS batch_id, 'merge' AS type, [code] AS src, [substr(code, 1, 1) || '*'] AS tgt FROM code_n WHERE n < 3
  UNION ALL SELECT DISTINCT app, 11, 'rename', [substr(code, 1, 1) || '*'], [substr(code, 1, 1) || '**'] FROM code_n WHERE n < 3
  UNION ALL SELECT app, 10, 'delete', [code], CAST([] AS VARCHAR[]) FROM code_n WHERE n = 3
  UNION ALL SELECT app, 10, 'split', [code], [code || '1', code || '2'] FROM code_n WHERE n = 4
  UNION ALL SELECT app, 8, 'rename', [code], [code || 'r'] FROM code_n WHERE n = 5
  UNION ALL SELECT app, 12, 'merge', [code || 'r'], [code] FROM code_n WHERE n = 5),
events AS (
  SELECT app, unnest(src) AS code, batch_id, type, false AS active, CASE WHEN len(tgt) = 1 THEN tgt[1] END AS target, len(tgt) AS n_tgt FROM decisions
  UNION ALL SELECT app, unnest(tgt), batch_id, type, true, NULL, 0 FROM decisions)"""
CANON = """last_event AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY app, code ORDER BY batch_id DESC, active DESC) AS rn FROM events)
  WHERE rn = 1 AND NOT active),
walk AS (SELECT app, code, code AS spot FROM last_event
  UNION ALL SELECT w.app, w.code, e.target FROM walk w JOIN last_event e ON e.app = w.app AND e.code = w.spot WHERE e.target IS NOT NULL),
ends AS (SELECT w.app, w.code, w.spot, e.n_tgt, e.code IS NOT NULL AS retired FROM walk w
  LEFT JOIN last_event e ON e.app = w.app AND e.code = w.spot WHERE e.code IS NULL OR e.target IS NULL),
canon AS (SELECT app, code, CASE WHEN NOT retired THEN spot END AS canonical,
  CASE WHEN NOT retired THEN 'mapped' WHEN n_tgt > 1 THEN 'split' ELSE 'deleted' END AS status FROM ends)"""
NEW = """first_seen AS (SELECT app, trim(code, ' ') AS code, min(batch_id) AS batch_id FROM codings GROUP BY 1, 2),
new_codes AS (SELECT b.app, b.batch_id, count(f.code) AS n_new FROM (SELECT DISTINCT app, batch_id FROM codings) b
  LEFT JOIN first_seen f ON f.app = b.app AND f.batch_id = b.batch_id GROUP BY b.app, b.batch_id)"""
TOTALS = """totals AS (SELECT *, row_number() OVER w AS ordinal, CAST(sum(n_new) OVER w AS BIGINT) AS n_codes_total
  FROM new_codes WINDOW w AS (PARTITION BY app ORDER BY batch_id))"""
ENTRIES = "entries AS (SELECT app, batch_id, count(*) AS n_entries FROM coded GROUP BY app, batch_id)"
FLAG_ENTRIES = FLAGS + ",\nentries AS (SELECT app, batch_id, count(*) AS n_entries FROM flags GROUP BY app, batch_id)"
ROLLING = """rolled AS (SELECT *, CASE WHEN ordinal >= 3 THEN CAST(sum(n_new) OVER w AS DOUBLE) / 3 END AS rolling_mean,
  ordinal >= 3 AND max(n_new) OVER w <= 2 AS all_last3_le2
  FROM totals WINDOW w AS (PARTITION BY app ORDER BY batch_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)),
report AS (SELECT *, CASE WHEN rolling_mean IS NULL THEN 'insufficient' WHEN rolling_mean >= 5 THEN 'far'
  WHEN rolling_mean >= 3 THEN 'trending' ELSE 'near' END AS status FROM rolled)"""
REPORT = f"{WITH_CODINGS},\n{NEW},\n{TOTALS},\n{ROLLING},\n{ENTRIES}"
SIZED = """sized AS (SELECT n.*, coalesce(e.n_entries, 0) AS n_entries FROM new_codes n
  LEFT JOIN entries e ON e.app = n.app AND e.batch_id = n.batch_id)"""
RATE = "CASE WHEN n_entries > 0 THEN n_new * CAST(100.0 AS DOUBLE) / n_entries ELSE CAST(0 AS DOUBLE) END AS new_rate"

_LAYER2 = _q("\n# 当前编码本\n" + fixed.PLACEHOLDER_MARKERS[0] + "\n")
LAYERS = f"""layers AS (SELECT app, stage, CAST(layer AS INTEGER) AS layer,
  CASE WHEN layer = 2 THEN {_LAYER2} ELSE chr(10) || chr(10) || ' ' || stage || ' ' || app || ' layer ' || layer || chr(10) END AS content
  FROM (SELECT DISTINCT lang AS app FROM documents), (VALUES ('inductive'), ('deductive')) s(stage), (VALUES (1), (2), (3), (4)) l(layer)
  WHERE stage = 'inductive' OR layer = 1 OR app = 'en')"""
TEXTS = "texts AS (SELECT app, batch_id, string_agg(entry, chr(10) || chr(10) ORDER BY global_seq) AS batch_text, count(*) AS n_entries FROM batches GROUP BY app, batch_id)"


def _strip_blank(c: str) -> str:
    run = fixed.WHITESPACE_RUN
    return f"regexp_replace({c}, '\\A{run}|{run}\\z', '', 'g')"


def _section(title: str, body: str) -> str:
    return f"{_q(fixed.PROMPT_RULE)} || chr(10) || {title} || chr(10) || {_q(fixed.PROMPT_RULE)} || chr(10) || {body}"


_GAP = " || chr(10) || chr(10) || "
_BEFORE, _AFTER = fixed.PROMPT_BATCH_TITLE.split("{batch_id}")
PROMPT = _GAP.join(
    [_section(_q(t), _strip_blank(f"l{i}")) for i, t in enumerate(fixed.PROMPT_TITLES, 1)]
    + [_section(f"{_q(_BEFORE)} || batch_id || {_q(_AFTER)}", _strip_blank("batch_text"))]
    + [_section(_q(fixed.PROMPT_START_TITLE), _q(fixed.PROMPT_START_TEXT))]
)
PROMPTS = f"""full_layers AS (SELECT app, stage, {", ".join(f"max(content) FILTER (layer = {i}) AS l{i}" for i in (1, 2, 3, 4))}
  FROM layers GROUP BY app, stage HAVING count(*) = 4),
prompts AS (SELECT t.app, stage, batch_id, n_entries, {PROMPT} AS prompt FROM texts t JOIN full_layers f ON f.app = t.app)"""

ORACLE: dict[str, str] = {}


def _add(name: str, *ctes: str, select: str) -> None:
    head = ",\n".join(ctes)
    if head and not head.startswith("WITH"):
        head = "WITH " + head
    ORACLE[name] = f"{head}\n{select}" if head else select


# --- sources and sinks --------------------------------------------------------------------------
_add("io1_read_reviews", REVIEWS, select="SELECT app, name, rating, review FROM reviews")
_add("io2_required_columns", REVIEWS, select="SELECT app, count(name) AS n_name, count(rating) AS n_rating, count(review) AS n_review FROM reviews GROUP BY app")
_add("io3_read_log", LOG, select="SELECT app, name, global_seq, batch_id, run_id FROM log")
_add("io4_append_log", RUN, select="""SELECT app, run_id, count(*) AS n FROM (SELECT app, run_id FROM log
  UNION ALL SELECT app, 'r1' FROM batches) GROUP BY app, run_id""")
_add("io5_scan_coding_files", WITH_CODINGS, """lines AS (SELECT app, src_file, doc, pos, code || ',"' || replace(quote, '"', '""') || '"' AS line FROM (
  SELECT c.app, CAST(c.name AS BIGINT) AS doc, pos, lower(substr(trim(s, ' '), 1, 2)) AS code, trim(s, ' ') AS quote,
    'batch_' || CASE WHEN batch_id < 10 THEN '0' ELSE '' END || batch_id || '_' || theme || '.csv' AS src_file
  FROM coded c, unnest(string_split(review_norm, '.')) WITH ORDINALITY AS u(s, pos)) WHERE length(quote) >= 3)""",
     select=f"""SELECT app, src_file, '好的' || chr(10) || {_q(fixed.CODING_HEADER)} || chr(10) || chr(10) || {_q(BROKEN_ROW)} || chr(10)
  || string_agg(line, chr(10) ORDER BY doc, pos) || chr(10) || {_q(OPEN_ROW)} || chr(10) || {_q(fixed.CODING_HEADER)} || chr(10) || chr(10) AS content
  FROM lines GROUP BY app, src_file
  UNION ALL SELECT DISTINCT app, {_q(UNDATED_FILE)}, {_q(fixed.CODING_HEADER)} || chr(10) || 'x,y' || chr(10) || chr(10) FROM lines""")
_add("io6_write_batches", RUN, select="SELECT app, batch_id, entry FROM batches")
_add("io7_write_unused", RUN, select=f"""SELECT app, '[ID:' || name || '] [rating:' || rating || '] ' || {norm('review')} AS entry FROM available a
  WHERE NOT EXISTS (SELECT 1 FROM batches b WHERE b.app = a.app AND b.name = a.name)""")
_add("io7_unused_header", RUN, "apps AS (SELECT DISTINCT app FROM reviews)", f"pool_left AS (SELECT DISTINCT app FROM available a WHERE app <> 'en' AND NOT EXISTS (SELECT 1 FROM batches b WHERE b.app = a.app AND b.name = a.name))",
     select=f"""SELECT app, unnest([{', '.join(_q(x) for x in fixed.UNUSED_HEADER)}]) AS line FROM apps
  UNION ALL SELECT app, unnest(['', {_q(fixed.UNUSED_NONE)}]) FROM apps WHERE app NOT IN (SELECT app FROM pool_left)""")
_add("io8_overwrite_guard", LOG, select="SELECT app, CASE WHEN app = 'en' THEN 'r0' ELSE 'r1' END AS run_id, count(*) AS n, true AS refused FROM log GROUP BY app")
_add("io9_codebook_csv", WITH_CODINGS, select="SELECT DISTINCT app, code, quote FROM codings")
_add("io10_export_dictionary", WITH_CODINGS, select="SELECT DISTINCT app, theme AS code, quote AS term FROM codings")
def _hashed(name: str, columns: str, by: str = "") -> str:
    cells = " || ".join(f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in sorted(columns.split()))
    names = "".join(f"{len(c)}:{c}" for c in sorted(columns.split()))
    return f"""SELECT {by and by + " AS part,"} count(*) AS n_rows, sha256('documents:{names}:' || count(*) || ':' || coalesce(sum(CAST(('0x' || substr(h, 1, 15)) AS BIGINT)), 0) || ':'
    || coalesce(sum(CAST(('0x' || substr(h, 16, 15)) AS BIGINT)), 0)) AS sha256 FROM (SELECT *, md5({cells}) AS h FROM {name}) {by and "GROUP BY " + by}"""


def _table_hash(name: str, columns: str) -> str:
    return f"SELECT '{name}' AS file, sha256 FROM ({_hashed(name, columns).replace('documents:', name + ':', 1)})"


_DOC = "doc_id text lang source n_chars"
_add("io11_partition_hashes", select=f"SELECT 'documents' AS file, part, n_rows, sha256 FROM ({_hashed('documents', _DOC, 'lang')})")
_add("io11_changed_partitions", f"""later AS (SELECT * REPLACE (CASE WHEN lang = 'es' THEN 'xx' ELSE lang END AS lang,
  CASE WHEN lang = 'fr' AND doc_id % 20 = 0 THEN text || '.' ELSE text END AS text) FROM documents),
old_parts AS ({_hashed('documents', _DOC, 'lang')}), new_parts AS ({_hashed('later', _DOC, 'lang')})""", select="""SELECT 'documents' AS file, coalesce(a.part, b.part) AS part,
  CASE WHEN a.sha256 IS NULL THEN 'added' WHEN b.sha256 IS NULL THEN 'removed' ELSE 'changed' END AS change
  FROM old_parts a FULL JOIN new_parts b ON a.part = b.part WHERE a.sha256 IS DISTINCT FROM b.sha256""")
_add("io11_run_manifest", f"""hashes AS ({_table_hash("documents", "doc_id text lang source n_chars")} UNION ALL {_table_hash("labels", "doc_id quality toxic")}),
groups AS (SELECT substr(sha256, 1, 2) AS g, sha256(string_agg(sha256, '' ORDER BY file, sha256)) AS h, count(*) AS n FROM hashes GROUP BY 1)""",
     select=f"""SELECT sha256(string_agg(h, '' ORDER BY g)) AS source_hash, CAST(sum(n) AS BIGINT) AS n_sources, '1' AS script_version, '{SEED}' AS seed, '{BATCH}' AS batch_size FROM groups""")
_add("io12_read_batches", RUN, select="SELECT app, batch_id, name, rating, review_norm FROM batches")
_add("io12_count_entries", RUN, select="SELECT app, batch_id, count(*) AS n_entries FROM batches GROUP BY app, batch_id")

# --- projections and filters --------------------------------------------------------------------
_add("pf1_min_length", REVIEWS, POOL, select="SELECT app, name, length(review) AS n_chars FROM pool")
_add("pf2_normalise", REVIEWS, select=f"SELECT app, name, {norm('review')} AS review_norm FROM reviews")
_add("pf3_entry", REVIEWS, select=f"SELECT app, '[ID:' || name || '] [rating:' || rating || '] ' || {norm('review')} AS entry FROM reviews")
_add("pf4_empty_rows", WITH_CODINGS, FILE_ROWS, f"files AS (SELECT DISTINCT app, src_file FROM file_rows), apps AS (SELECT DISTINCT app FROM file_rows)",
     select=f"""SELECT app, src_file, status, count(*) AS n FROM (SELECT app, src_file, status FROM file_rows
  UNION ALL SELECT app, src_file, unnest(['header', 'blank', 'blank', 'ok', 'open_quote']) FROM files
  UNION ALL SELECT app, {_q(UNDATED_FILE)}, unnest(['ok', 'blank']) FROM apps) GROUP BY app, src_file, status""")
_add("pf5_completed_batches", WITH_CODINGS, select="SELECT DISTINCT app, batch_id FROM codings")
_add("pf6_header_seek", WITH_CODINGS, select=f"""SELECT app, src_file, CAST(3 AS BIGINT) AS first_line, count(*) + 8 AS last_line FROM codings GROUP BY app, src_file
  UNION ALL SELECT DISTINCT app, {_q(UNDATED_FILE)}, 2, 3 FROM codings""")
_add("pf7_parse_codings", WITH_CODINGS, FILE_ROWS, select=f"""SELECT app, batch_id, theme, trim(code, ' ') AS code, {strip('quote')} AS quote FROM file_rows WHERE status = 'ok'
  UNION ALL SELECT DISTINCT app, batch_id, theme, '断行', '上半句' || chr(10) || '下半句' FROM file_rows""")
_add("pf8_rejects", f"""WITH {CODED},
placed AS (SELECT c.app, 'batch_' || CASE WHEN batch_id < 10 THEN '0' ELSE '' END || batch_id || '_' || theme || '.csv' AS src_file,
  CAST(c.name AS BIGINT) AS doc, pos, trim(s, ' ') AS quote, lower(substr(trim(s, ' '), 1, 2)) AS code
  FROM coded c, unnest(string_split(review_norm, '.')) WITH ORDINALITY AS u(s, pos) WHERE length(trim(s, ' ')) >= 3),
numbered AS (SELECT *, row_number() OVER (PARTITION BY app, src_file ORDER BY doc, pos) AS n FROM placed)""",
     select=f"""SELECT app, src_file, n + 5 AS line_no, code || ',"' || replace(quote, '"', '""') || '"' AS line, 'column_count' AS reason
  FROM numbered WHERE contains(code, ',')
  UNION ALL SELECT app, src_file, count(*) + 6, {_q(OPEN_ROW)}, 'open_quote' FROM numbered GROUP BY app, src_file
  UNION ALL SELECT DISTINCT app, {_q(UNDATED_FILE)}, CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR), 'file_name' FROM numbered""")
_add("pf9_parse_answers", WITH_CODINGS, select=f"""SELECT app, 'r' || batch_id AS response_id, batch_id, theme, trim(code, ' ') AS code, {strip('quote')} AS quote
  FROM codings WHERE trim(code, ' ') <> '' AND {strip('quote')} <> ''""")
_add("pf9_answer_rejects", WITH_CODINGS, select="""SELECT DISTINCT app, 'r' || batch_id AS response_id, theme, 'x,y,z' AS line, 'column_count' AS reason FROM codings
  UNION ALL SELECT DISTINCT app, 'r' || batch_id, '空', CAST(NULL AS VARCHAR), 'no_header' FROM codings
  UNION ALL SELECT DISTINCT app, 'r-1', CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), 'no_theme' FROM codings""")
_add("pf10_rule_flags", WITH_CODED, """quotes AS (SELECT app, theme AS code, review_norm AS quote FROM coded
  UNION ALL SELECT app, theme || '-' || batch_id, '[ID:' || name || '] [rating:' || rating || '] ' || review_norm FROM coded)""",
     select="""SELECT app, code, length(quote) AS n_chars, contains(quote, '[ID:') OR contains(quote, '[rating:') AS has_marks,
  contains(quote, '…') OR contains(quote, '...') AS has_ellipsis, length(code) > 5 AS code_too_long FROM quotes""")
_add("pf11_layer_status", LAYERS, select="SELECT app, stage, layer, layer = 2 AS is_placeholder, length(content) AS n_chars FROM layers")
_add("f1_strip_outer_punctuation", WITH_CODED, select=f"""SELECT app, {strip('w')} AS word, count(*) AS n
  FROM coded, unnest(string_split(review_norm, ' ')) AS u(w) GROUP BY 1, 2""")

# --- joins --------------------------------------------------------------------------------------
_add("j1_exclude_logged", REVIEWS, LOG, select="SELECT app, name, rating FROM reviews r WHERE NOT EXISTS (SELECT 1 FROM log l WHERE l.app = r.app AND l.name = r.name)")
_add("j2_unused", RUN, select="SELECT app, name, rating FROM available a WHERE NOT EXISTS (SELECT 1 FROM batches b WHERE b.app = a.app AND b.name = a.name)")
_add("j3_batch_sizes", WITH_CODINGS, FLAG_ENTRIES, NEW, SIZED, select="SELECT app, batch_id, n_entries FROM sized")
_add("j4_verbatim_pairs", WITH_CODINGS, FILED, SOURCES, select="SELECT app, batch_id, name, quote FROM sources")
_add("j4_verbatim_quotes", WITH_CODINGS, FILED, SOURCES, select="SELECT DISTINCT app, batch_id, quote FROM sources")
_add("j4_altered_quotes", WITH_CODINGS, FILED, SOURCES, select="SELECT app, batch_id, quote FROM filed EXCEPT SELECT app, batch_id, quote FROM sources")
_add("j5_dictionary_match", WITH_CODED, DICT, MATCHES, select="SELECT app, name, code, term FROM matches")
WORDS = f"""dict AS (SELECT DISTINCT 'src' AS app, lower({strip('w')}) AS code, {strip('w')} AS term
  FROM benchmark, unnest(string_split({norm('text')}, ' ')) AS u(w) WHERE length({strip('w')}) >= 5)"""
_add("j5_word_dictionary", WITH_CODED, WORDS, MATCHES, select="SELECT app, name, code, term FROM matches")
_add("j6_uncoded_reviews", WITH_CODED, DICT, FLAGS, MATCHES, select="""SELECT app, batch_id, name FROM coded c
  WHERE NOT EXISTS (SELECT 1 FROM flags f WHERE f.name = c.name AND f.out_of_scope) AND NOT EXISTS (SELECT 1 FROM matches m WHERE m.name = c.name)""")
_add("j7_codebook_reuse", WITH_CODINGS, CODEBOOK, select="""SELECT u.app, batch_id, count(*) AS n_codes, count(b.code) AS n_known, count(*) - count(b.code) AS n_new,
  CAST(count(b.code) AS DOUBLE) / count(*) AS reuse_share FROM (SELECT DISTINCT app, batch_id, code FROM codings) u
  LEFT JOIN codebook b ON b.app = u.app AND b.code = u.code GROUP BY u.app, batch_id""")
_add("j7_codes_outside_codebook", WITH_CODINGS, select="SELECT app, code, count(*) AS n_rows FROM codings GROUP BY app, code HAVING count(*) < 3")
_add("j8_revived_codes", WITH_CODINGS, DECISIONS, select="""SELECT app, batch_id, code, n_quotes, retired_in, type FROM (
  SELECT u.app, u.batch_id, u.code, u.n_quotes, e.batch_id AS retired_in, e.type, e.active,
    row_number() OVER (PARTITION BY u.app, u.batch_id, u.code ORDER BY e.batch_id DESC, e.active DESC) AS rn
  FROM (SELECT app, batch_id, code, count(*) AS n_quotes FROM codings GROUP BY app, batch_id, code) u
  JOIN events e ON e.app = u.app AND e.code = u.code AND e.batch_id < u.batch_id) WHERE rn = 1 AND NOT active""")
_add("j9_fallback_code", WITH_CODED, DICT, MATCHES, select=f"""SELECT c.app, c.batch_id, c.name, coalesce(m.code, {_q(fixed.OTHER_CODE)}) AS code
  FROM coded c LEFT JOIN (SELECT DISTINCT app, name, code FROM matches) m ON m.app = c.app AND m.name = c.name""")
_CANON = [WITH_CODINGS.replace("WITH ", "WITH RECURSIVE ", 1), DECISIONS, CANON]
_add("j10_canonical_map", *_CANON, select="SELECT app, code, canonical, status FROM canon")
_add("j10_canonical_codes", *_CANON, select="""SELECT c.app, coalesce(m.canonical, c.code) AS canonical, coalesce(m.status, 'kept') AS status, count(*) AS n
  FROM codings c LEFT JOIN canon m ON m.app = c.app AND m.code = c.code GROUP BY 1, 2, 3""")

# --- sampling -----------------------------------------------------------------------------------
_add("s1_simple_sample", REVIEWS, select=f"""SELECT app, name, rating FROM (SELECT *, row_number() OVER (PARTITION BY app ORDER BY md5(name || '|{SEED}'), name) AS rk
  FROM reviews) WHERE rk <= {N}""")
_add("s2_stratum_quotas", REVIEWS, LOG, POOL, AVAILABLE, QUOTAS, select="SELECT app, rating, n_rows, quota FROM quotas")
_add("s3_stratified_pick", REVIEWS, LOG, POOL, AVAILABLE, QUOTAS, PICKED, select="SELECT app, name, rating FROM picked")
_add("s4_sample_without_rating", REVIEWS, select=f"""SELECT app, name, row_number() OVER (PARTITION BY app ORDER BY md5(name || '|shuffle{SEED}'), name) AS position
  FROM (SELECT *, row_number() OVER (PARTITION BY app ORDER BY md5(name || '|{SEED}'), name) AS rk FROM reviews) WHERE rk <= {N}""")
_add("s5_assign_batches", RUN, select="SELECT app, batch_id, global_seq, name, rating, review_norm, entry FROM batches")
_add("s6_run_summary", RUN, f"""per_app AS (SELECT r.app, count(*) AS n_read, count(*) FILTER (length(review) < {MIN_LEN}) AS n_too_short,
  count(*) FILTER (length(review) >= {MIN_LEN} AND l.name IS NOT NULL) AS n_excluded, count(*) FILTER (length(review) >= {MIN_LEN} AND l.name IS NULL) AS n_available,
  count(*) FILTER (length(review) >= {MIN_LEN} AND l.name IS NULL AND b.name IS NULL) AS n_unused, count(*) - count(DISTINCT r.name) AS n_duplicate_names
  FROM reviews r LEFT JOIN log l ON l.app = r.app AND l.name = r.name LEFT JOIN batches b ON b.app = r.app AND b.name = r.name GROUP BY r.app),
drawn AS (SELECT app, count(*) AS n_actual, min(global_seq) AS first_seq, max(global_seq) AS last_seq, min(batch_id) AS first_batch, max(batch_id) AS last_batch
  FROM batches GROUP BY app)""", select=f"""SELECT p.app, n_read, n_too_short, n_excluded, n_available, CAST({N} AS BIGINT) AS n_requested, coalesce(n_actual, 0) AS n_actual,
  coalesce(last_batch - first_batch + 1, 0) AS n_batches,
  coalesce((SELECT count(*) FROM batches b WHERE b.app = p.app AND b.batch_id = d.last_batch), 0) AS last_batch_size,
  n_unused, first_seq, last_seq, first_batch, last_batch, n_duplicate_names, n_available < {N} AS is_short, n_available = 0 AS is_empty
  FROM per_app p LEFT JOIN drawn d ON d.app = p.app""")
_add("s7_rating_distribution", RUN, select="SELECT app, rating, count(*) AS n FROM batches GROUP BY app, rating")
_add("s8_gold_set", REVIEWS, select=f"""SELECT app, name, rating, {norm('review')} AS review_norm, gold_rank FROM (
  SELECT *, row_number() OVER (PARTITION BY app ORDER BY md5(name || '|gold{SEED}'), name) AS gold_rank FROM (
    SELECT *, row_number() OVER (PARTITION BY app ORDER BY md5(name || '|shuffle{SEED}'), name) AS pos FROM (
      SELECT *, row_number() OVER (PARTITION BY app ORDER BY md5(name || '|{SEED}'), name) AS rk FROM reviews) WHERE rk <= {N})
  WHERE pos <= {BATCH}) WHERE gold_rank <= 15""")

# --- aggregations -------------------------------------------------------------------------------
_add("a1_merge_summary", WITH_CODINGS, select="""SELECT app, count(*) AS n_rows, count(DISTINCT (code, quote)) AS n_distinct, count(DISTINCT code) AS n_codes
  FROM codings GROUP BY app""")
_add("a2_quotes_per_code", WITH_CODINGS, select="SELECT app, code, count(DISTINCT quote) AS n_quotes FROM codings GROUP BY app, code")
_add("a3_new_code_rate", WITH_CODINGS, FLAG_ENTRIES, NEW, SIZED, select=f"SELECT app, batch_id, n_new, n_entries, {RATE} FROM sized")
_add("a4_coding_summary", WITH_CODINGS, """ranked AS (SELECT *, row_number() OVER (PARTITION BY app, theme, code ORDER BY length(quote), quote) AS r
  FROM (SELECT DISTINCT app, theme, code, quote FROM codings)),
best AS (SELECT app, theme, code, string_agg(quote, ' | ' ORDER BY r) AS samples FROM ranked WHERE r <= 2 GROUP BY app, theme, code)""",
     select="""SELECT c.app, c.theme, c.code, c.n_quotes, b.samples FROM (SELECT app, theme, code, count(*) AS n_quotes FROM codings GROUP BY app, theme, code) c
  JOIN best b ON b.app = c.app AND b.theme = c.theme AND b.code = c.code""")
_add("a5_theme_rollup", WITH_CODINGS, select="""SELECT app, theme, code, count(*) AS n_quotes, CAST(0 AS INTEGER) AS level FROM codings GROUP BY app, theme, code
  UNION ALL SELECT app, theme, NULL, count(*), 1 FROM codings GROUP BY app, theme
  UNION ALL SELECT app, NULL, NULL, count(*), 3 FROM codings GROUP BY app
  UNION ALL SELECT NULL, NULL, NULL, count(*), 7 FROM codings""")
_add("a5_theme_shape", WITH_CODINGS, select="""SELECT app, theme, count(DISTINCT code) AS n_codes, count(*) AS n_quotes, count(DISTINCT code) BETWEEN 3 AND 8 AS codes_in_range,
  bool_or(code = theme) AS theme_used_as_code FROM codings GROUP BY app, theme""")
_add("a6_thin_codes", WITH_CODINGS, select="SELECT app, code, count(*) AS n_quotes FROM codings GROUP BY app, code HAVING count(*) < 3")
_add("a7_scope_rate", FLAGS, select="""SELECT app, batch_id, count(*) AS n_judged, count(*) FILTER (out_of_scope) AS n_out_of_scope,
  CAST(count(*) FILTER (out_of_scope) AS DOUBLE) / count(*) AS out_share, count(*) FILTER (out_of_scope) * 4 > count(*) AS warn FROM flags GROUP BY app, batch_id""")
_add("a8_gap_rate", WITH_CODED, DICT, MATCHES, """hit AS (SELECT app, batch_id, count(*) AS n_reviews, count(*) FILTER (name NOT IN (SELECT name FROM matches)) AS n_unmatched
  FROM coded GROUP BY app, batch_id)""", select="""SELECT app, batch_id, n_reviews, n_unmatched, CAST(n_unmatched AS DOUBLE) / n_reviews AS gap_share,
  CASE WHEN n_unmatched * 10 < n_reviews THEN 'other_or_ignore' WHEN n_unmatched * 5 > n_reviews THEN 'iterate_codebook' ELSE 'review' END AS band FROM hit""")
_add("a9_deductive_summary", WITH_CODED, DICT, MATCHES, """labelled AS (SELECT c.app, c.name, m.code IS NOT NULL AS matched, coalesce(m.code, c.theme) AS label FROM coded c
  LEFT JOIN (SELECT DISTINCT app, name, code FROM matches) m ON m.name = c.name)""",
     select="""SELECT app, matched, label, count(*) AS n_reviews, CAST(min(CAST(name AS BIGINT)) AS VARCHAR) AS example FROM labelled GROUP BY app, matched, label""")
_add("a9_deductive_quotes", WITH_CODED, DICT, MATCHES, """placed AS (SELECT c.app, c.batch_id, true AS matched, m.code AS label, m.term AS quote FROM matches m JOIN coded c ON c.name = m.name
  UNION ALL SELECT c.app, c.batch_id, false, c.theme, c.review_norm FROM coded c WHERE c.name NOT IN (SELECT name FROM matches)),
best AS (SELECT *, row_number() OVER (PARTITION BY app, batch_id, matched, label ORDER BY length(quote), quote) AS r FROM (SELECT DISTINCT * FROM placed)),
n AS (SELECT app, batch_id, matched, label, count(*) AS n_quotes FROM placed GROUP BY ALL)""",
     select="""SELECT n.*, (SELECT string_agg(quote, ' | ' ORDER BY r) FROM best b WHERE b.app = n.app AND b.batch_id = n.batch_id AND b.matched = n.matched AND b.label = n.label AND r <= 2) AS quotes FROM n""")
_add("a10_gold_agreement", """gold AS (SELECT d.lang AS app, d.doc_id, unnest(CASE WHEN quality = 1 AND toxic = 1 THEN ['quality', 'toxic'] WHEN quality = 1 THEN ['quality']
    WHEN toxic = 1 THEN ['toxic'] ELSE CAST([] AS VARCHAR[]) END) AS code, 'a' AS run FROM labels l JOIN documents d ON d.doc_id = l.doc_id
  UNION ALL SELECT d.lang, d.doc_id, unnest(CASE WHEN n_chars >= 4800 AND toxic = 1 THEN ['quality', 'toxic'] WHEN n_chars >= 600 THEN ['quality']
    ELSE CAST([] AS VARCHAR[]) END), 'b' FROM labels l JOIN documents d ON d.doc_id = l.doc_id),
sets AS (SELECT app, doc_id, coalesce(list_sort(list(DISTINCT code) FILTER (run = 'a')), []) AS a, coalesce(list_sort(list(DISTINCT code) FILTER (run = 'b')), []) AS b
  FROM gold GROUP BY app, doc_id),
scored AS (SELECT app, count(*) AS n_reviews, count(*) FILTER (a = b) AS n_same,
  CAST(sum(CAST(CAST(len(list_intersect(a, b)) AS DOUBLE) / len(list_distinct(list_concat(a, b))) AS DECIMAL(18, 12))) AS DOUBLE) / count(*) AS jac FROM sets GROUP BY app)""",
     select="""SELECT app, n_reviews, n_same, CAST(n_same AS DOUBLE) / n_reviews AS agreement, round(jac, 9) AS mean_jaccard,
  CASE WHEN n_same * 10 >= n_reviews * 9 THEN 'stable' WHEN n_same * 10 >= n_reviews * 7 THEN 'mild_drift' ELSE 'severe_drift' END AS band FROM scored""")
_add("a11_drifting_quotes", WITH_CODINGS, """sets AS (SELECT app, quote, batch_id, list_sort(list(DISTINCT theme)) AS codes FROM codings GROUP BY app, quote, batch_id)""",
     select="""SELECT app, quote, count(*) AS n_batches, CAST(len(list_distinct(flatten(list(codes)))) AS BIGINT) AS n_codes, CAST(sum(len(codes)) AS BIGINT) AS n_pairs
  FROM sets GROUP BY app, quote HAVING count(DISTINCT codes) > 1""")
_add("a12_overlapping_codes", WITH_CODINGS, """pairs AS (SELECT DISTINCT app, theme AS code, quote FROM codings), sizes AS (SELECT app, code, count(*) AS n FROM pairs GROUP BY app, code)""",
     select="""SELECT s.app, s.code_a, s.code_b, a.n AS n_a, b.n AS n_b, s.n_shared, CAST(s.n_shared AS DOUBLE) / (a.n + b.n - s.n_shared) AS jaccard FROM (
  SELECT x.app, x.code AS code_a, y.code AS code_b, count(*) AS n_shared FROM pairs x JOIN pairs y ON y.app = x.app AND y.quote = x.quote AND x.code < y.code GROUP BY 1, 2, 3) s
  JOIN sizes a ON a.app = s.app AND a.code = s.code_a JOIN sizes b ON b.app = s.app AND b.code = s.code_b""")
_add("a12_merge_candidates", WITH_CODED, """words AS (SELECT app, (batch_id // 4) || '-' || rating || '-' || theme AS code, unnest(string_split(review_norm, ' ')) AS quote FROM coded),
pairs AS (SELECT DISTINCT app, code, quote FROM words WHERE length(quote) >= 3), sizes AS (SELECT app, code, count(*) AS n FROM pairs GROUP BY app, code),
shared AS (SELECT x.app, x.code AS code_a, y.code AS code_b, count(*) AS n_shared FROM pairs x JOIN pairs y ON y.app = x.app AND y.quote = x.quote AND x.code < y.code GROUP BY 1, 2, 3)""",
     select="""SELECT s.app, s.code_a, s.code_b, a.n AS n_a, b.n AS n_b, s.n_shared, CAST(s.n_shared AS DOUBLE) / (a.n + b.n - s.n_shared) AS jaccard FROM shared s
  JOIN sizes a ON a.app = s.app AND a.code = s.code_a JOIN sizes b ON b.app = s.app AND b.code = s.code_b WHERE s.n_shared * 5 >= a.n + b.n - s.n_shared""")
_add("a13_codebook_size", WITH_CODINGS, """sizes AS (SELECT app, count(DISTINCT batch_id) AS n_batches, count(DISTINCT code) AS n_codes, count(DISTINCT theme) AS n_themes FROM codings GROUP BY app),
expected(app, measure, low, high) AS (VALUES ('src', 'n_batches', CAST(1 AS DOUBLE), CAST(5 AS DOUBLE)), ('src', 'n_codes', 12, 18), ('src', 'n_themes', 4, 6)),
long AS (SELECT app, 'n_batches' AS measure, CAST(n_batches AS DOUBLE) AS observed, n_batches > 5 AND n_codes > 40 AS bloated FROM sizes
  UNION ALL SELECT app, 'n_codes', n_codes, n_batches > 5 AND n_codes > 40 FROM sizes
  UNION ALL SELECT app, 'n_themes', n_themes, n_batches > 5 AND n_codes > 40 FROM sizes)""",
     select="""SELECT l.app, l.measure, observed, low, high, observed BETWEEN low AND high AS as_expected, bloated
  FROM long l JOIN expected e ON e.app = l.app AND e.measure = l.measure""")
_add("a14_codebook_completeness", WITH_CODINGS, CODEBOOK, """shown AS (SELECT b.app, b.code, s.quote || CASE WHEN b.n = 4 THEN '!' ELSE '' END AS quote FROM codebook b
  JOIN samples s ON s.app = b.app AND s.code = b.code AND s.r <= 3),
counts AS (SELECT app, code, count(*) AS n_samples, count(*) FILTER (NOT EXISTS (SELECT 1 FROM codings c WHERE c.app = shown.app AND c.code = shown.code AND c.quote = shown.quote)) AS n_unreal
  FROM shown GROUP BY app, code)""", select="""SELECT b.app, b.theme, b.code, b.definition IS NOT NULL AS has_definition, b.n >= 10 AS has_both_rules,
  c.n_samples, c.n_samples >= 3 AS enough_samples, c.n_unreal AS n_unreal_samples FROM codebook b JOIN counts c ON c.app = b.app AND c.code = b.code""")

# --- batch by batch -----------------------------------------------------------------------------
_add("w1_new_codes", WITH_CODINGS, NEW, select="SELECT app, batch_id, n_new FROM new_codes")
_add("w1_kept_first_seen", WITH_CODINGS, NEW, select="SELECT app, batch_id, n_new FROM new_codes")
_add("w2_cumulative_codes", WITH_CODINGS, NEW, TOTALS, select="SELECT app, batch_id, n_new, ordinal, n_codes_total FROM totals")
_add("w3_saturation_report", REPORT, select=f"""SELECT r.app, r.batch_id, ordinal, n_codes_total, n_new, n_entries, {RATE}, rolling_mean, status, all_last3_le2
  FROM report r JOIN entries e ON e.app = r.app AND e.batch_id = r.batch_id""")
_add("w4_final_status", REPORT, select="""SELECT app, batch_id, rolling_mean, status, all_last3_le2, n_codes_total FROM report r
  WHERE batch_id = (SELECT max(batch_id) FROM report x WHERE x.app = r.app)""")
_add("w5_stop_rule", WITH_CODINGS.replace("lower(substr(quote, 1, 2)) AS code", "theme AS code"), NEW, TOTALS, ROLLING, select="SELECT app, batch_id, n_new, all_last3_le2 FROM report")
_add("w6_recurring_gaps", WITH_CODINGS, DICT, MATCHES, """ordinals AS (SELECT app, batch_id, row_number() OVER (PARTITION BY app ORDER BY batch_id) AS ordinal
  FROM (SELECT DISTINCT app, batch_id FROM codings)),
gaps AS (SELECT DISTINCT c.app, c.batch_id, o.ordinal, c.theme || '-' || c.rating AS label FROM coded c JOIN ordinals o ON o.app = c.app AND o.batch_id = c.batch_id
  WHERE c.name NOT IN (SELECT name FROM matches)),
islands AS (SELECT *, ordinal - row_number() OVER (PARTITION BY app, label ORDER BY ordinal) AS island FROM gaps)""",
     select="""SELECT app, label, batch_id FROM (SELECT *, row_number() OVER (PARTITION BY app, label, island ORDER BY ordinal) AS run FROM islands) WHERE run >= 3""")
_add("w6_gap_islands", WITH_CODINGS, DICT, MATCHES, """ordinals AS (SELECT app, batch_id, row_number() OVER (PARTITION BY app ORDER BY batch_id) AS ordinal
  FROM (SELECT DISTINCT app, batch_id FROM codings)),
gaps AS (SELECT DISTINCT c.app, c.batch_id, o.ordinal, c.theme || '-' || c.rating AS label FROM coded c JOIN ordinals o ON o.app = c.app AND o.batch_id = c.batch_id
  WHERE c.name NOT IN (SELECT name FROM matches)),
islands AS (SELECT *, ordinal - row_number() OVER (PARTITION BY app, label ORDER BY ordinal) AS island FROM gaps)""",
     select="""SELECT app, label, min(batch_id) AS first_batch, max(batch_id) AS last_batch, count(*) AS n_batches FROM islands GROUP BY app, label, island HAVING count(*) >= 3""")
_add("w7_code_trend", WITH_CODINGS, """ordinals AS (SELECT app, batch_id, row_number() OVER (PARTITION BY app ORDER BY batch_id) AS ordinal FROM (SELECT DISTINCT app, batch_id FROM codings)),
n AS (SELECT c.app, c.batch_id, o.ordinal, c.code, count(*) AS n_quotes FROM codings c JOIN ordinals o ON o.app = c.app AND o.batch_id = c.batch_id GROUP BY 1, 2, 3, 4)""",
     select="""SELECT a.app, a.batch_id, a.code, a.n_quotes, CASE WHEN a.ordinal > 1 THEN a.n_quotes - coalesce(b.n_quotes, 0) END AS change
  FROM n a LEFT JOIN n b ON b.app = a.app AND b.code = a.code AND b.ordinal = a.ordinal - 1""")

# --- sorts, top-k, sets -------------------------------------------------------------------------
_add("t1_sorted_codebook", WITH_CODINGS, select="SELECT DISTINCT app, code, quote FROM codings")
_add("t2_top_codes", WITH_CODINGS, select="""SELECT app, batch_id, code, n_quotes, rank FROM (SELECT *, row_number() OVER (PARTITION BY app, batch_id ORDER BY n_quotes DESC, code) AS rank
  FROM (SELECT app, batch_id, code, count(*) AS n_quotes FROM codings GROUP BY app, batch_id, code)) WHERE rank <= 5""")
_add("t2_typical_quotes", WITH_CODINGS, select="""SELECT app, code, quote, rank FROM (SELECT *, row_number() OVER (PARTITION BY app, code ORDER BY length(quote), quote) AS rank
  FROM (SELECT DISTINCT app, code, quote FROM codings)) WHERE rank <= 2""")
_add("u1_union_codings", WITH_CODINGS, select="SELECT app, batch_id, theme, 2 * count(*) AS n FROM codings GROUP BY app, batch_id, theme")
_add("u2_merge_with_origin", WITH_CODINGS, select="""SELECT app, code, quote, min(batch_id) AS first_batch,
  arg_min(src_file, (batch_id, src_file)) AS first_file, count(*) AS n_rows FROM codings GROUP BY app, code, quote""")
_add("u3_codes_only_in", WITH_CODINGS, select="SELECT app, trim(code, ' ') AS code FROM codings WHERE batch_id = 0 EXCEPT SELECT app, trim(code, ' ') FROM codings WHERE batch_id = 1")
_add("u4_batch_codes", WITH_CODINGS, select="SELECT DISTINCT app, batch_id, trim(code, ' ') AS code FROM codings")

# --- codebook evolution -------------------------------------------------------------------------
_add("g1_upsert_codebook", WITH_CODINGS, select="""SELECT app, code, min(theme) AS theme, 'seen ' || count(*) AS definition, max(batch_id) + 1 AS batch_id
  FROM codings GROUP BY app, code HAVING count(*) % 2 = 0""")
_add("g2_change_counts", WITH_CODINGS, "firsts AS (SELECT app, code, min(batch_id) AS batch_id FROM codings GROUP BY app, code)", select="""SELECT app, batch_id, 'initial' AS type,
  CAST(1 AS BIGINT) AS n_changes, count(*) AS n_initial_codes FROM firsts WHERE batch_id = 0 GROUP BY app, batch_id
  UNION ALL SELECT app, batch_id, 'add', count(*), 0 FROM firsts WHERE batch_id > 0 GROUP BY app, batch_id""")
_add("g2_change_matrix", WITH_CODINGS, "firsts AS (SELECT app, code, min(batch_id) AS batch_id FROM codings GROUP BY app, code)", select="""SELECT app, batch_id,
  CAST(CASE WHEN batch_id = 0 THEN 1 ELSE 0 END AS BIGINT) AS n_initial, CASE WHEN batch_id = 0 THEN 0 ELSE count(*) END AS n_add,
  CAST(0 AS BIGINT) AS n_merge, CAST(0 AS BIGINT) AS n_split, CAST(0 AS BIGINT) AS n_rename, CAST(0 AS BIGINT) AS n_delete FROM firsts GROUP BY app, batch_id""")
_add("g3_codebook_as_of", WITH_CODINGS, DECISIONS, """history AS (SELECT app, code, batch_id, 1 AS seq, active FROM events
  UNION ALL SELECT app, code, min(batch_id), -1, true FROM codings GROUP BY app, code)""", select="""SELECT app, code, batch_id AS since_batch FROM (
  SELECT *, row_number() OVER (PARTITION BY app, code ORDER BY batch_id DESC, seq DESC, active DESC) AS rn FROM history WHERE batch_id <= 11) WHERE rn = 1 AND active""")

_STATES = """history AS (SELECT app, code, batch_id, 1 AS seq, active FROM events UNION ALL SELECT app, code, min(batch_id), -1, true FROM codings GROUP BY app, code),
states AS (SELECT app, code, batch_id, active FROM (SELECT *, row_number() OVER (PARTITION BY app, code, batch_id ORDER BY seq DESC, active DESC) AS rn FROM history) WHERE rn = 1)"""
_add("g3_codebook_versions", WITH_CODINGS, DECISIONS, _STATES, select="""SELECT app, code, batch_id AS since_batch, until_batch FROM (
  SELECT *, lead(batch_id) OVER (PARTITION BY app, code ORDER BY batch_id) AS until_batch FROM states) WHERE active""")
_add("g3_codings_as_of", WITH_CODINGS, DECISIONS, _STATES, "used AS (SELECT app, batch_id, code, count(*) AS n_quotes FROM codings GROUP BY app, batch_id, code)",
     select="""SELECT u.app, u.batch_id, u.code, u.n_quotes, s.active, s.batch_id AS since_batch
  FROM used u ASOF JOIN states s ON s.app = u.app AND s.code = u.code AND u.batch_id >= s.batch_id""")

# --- prompts ------------------------------------------------------------------------------------
_add("p1_batch_texts", RUN, TEXTS, select="SELECT app, batch_id, batch_text, n_entries FROM texts")
_add("p2_prompts", RUN, TEXTS, LAYERS, PROMPTS, select="SELECT app, stage, batch_id, prompt, length(prompt) AS n_chars FROM prompts")
_add("p3_prompt_log", RUN, TEXTS, LAYERS, PROMPTS, select="SELECT app, stage, batch_id, length(prompt) AS stored_chars FROM prompts")
_add("p4_missing_layers", LAYERS, select="""SELECT app, stage, CAST(layer AS INTEGER) AS layer FROM (SELECT DISTINCT lang AS app FROM documents),
  (VALUES ('inductive'), ('deductive')) s(stage), (VALUES (1), (2), (3), (4)) l(layer)
  EXCEPT SELECT app, stage, layer FROM layers""")
_add("p4_missing_batches", WITH_CODED, FLAGS, select="SELECT app, batch_id + 1 AS batch_id FROM coded EXCEPT SELECT app, batch_id FROM flags")
_add("p5_prompt_sizes", RUN, TEXTS, LAYERS, PROMPTS, "sizes AS (SELECT app, batch_id, sum(length(entry)) AS chars FROM batches GROUP BY app, batch_id)",
     select=f"""SELECT p.app, stage, p.batch_id, length(prompt) AS n_chars, n_entries, length(prompt) > {PROMPT_BUDGET} AS over_budget,
  CAST(floor(CAST({PROMPT_BUDGET} AS DOUBLE) * n_entries / chars) AS BIGINT) AS suggested_batch_size FROM prompts p JOIN sizes z ON z.app = p.app AND z.batch_id = p.batch_id""")
