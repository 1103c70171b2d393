"""Merkle manifest of a table of documents: built level by level, proved for every document by a recursive query.

Every row is a leaf, the hash of its columns (``leaf_hash``). The leaves of a language ascend by doc_id; every two consecutive
nodes become their hash, a last single one alone, until one is left, the subroot. The subroots by language (null first) become the
root in the same way.

* **Order.** Rows are written in order by range (language, doc_id), so a frequent language is spread over many files; the place
  of a row is the place of its file and its number in it. No task sorts a whole language.
* **Levels.** ``LEVELS`` levels are built at once over stretches of ``SPAN`` consecutive nodes, a bounded group. A stretch is stored
  as one row with its levels and the key of its parent stretch, in which its top is a node of the lowest level.
* **Climb.** A recursive query starts with all leaves, each perhaps tampered with, and joins the stretch that it is in by key: siblings
  are appended and hashes folded through the levels of the stretch, and the row goes on with the parent's key. A stretch near
  the root would meet all rows under one key, so the leaves of each lowest stretch (a home) have copies of their own of the stretches
  above them, cut down to the nodes beside their path, and a key never has more than ``SPAN`` rows. The depth of the recursion is the logarithm of the rows to the base ``SPAN``.

Nulls: a null column counts as ``-``, apart from any value; documents without language are a tree of their own, null ids come
first. Equal ids are ordered by their leaves, and equal leaves may change places without a change of any hash. A row that has no
n_chars, and one without id, is never tampered with. Texts of any length are hashed whole. An empty table has no rows and no root.
Other columns of the table are not looked at, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from llm.tables import stored

LEVELS = 9
SPAN = 1 << LEVELS
#: Rows of a file of narrow rows and of stretches, where their number is known.
ROWS, STRETCHES = 100_000, 1_000
TOP = "^"  # name of the tree over the subroots; those of languages are "" (null) and "=<language>"
COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def _field(value: Column) -> Column:
    """``-`` for null, else the number of bytes in UTF-8, a colon and the value."""
    value = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_hash(more_chars: Column | None = None) -> Column:
    """Lower-case hex SHA-256 of a row's columns; ``more_chars`` is added to n_chars."""
    values = {c: F.col(c) for c in COLUMNS}
    if more_chars is not None:
        values["n_chars"] = values["n_chars"] + more_chars
    return F.sha2(F.concat(*[_field(v) for v in values.values()]), 256)


def in_order(rows: DataFrame, group: str, *order: str) -> DataFrame:
    """``rows`` with ``pos``, the number from 0 of each row within its ``group`` (not null), by ``order``. Written once."""
    sorted_rows = stored(rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order))
    file = F.regexp_extract(F.col("_metadata.file_name"), r"^part-(\d+)", 1).cast("bigint")
    at = sorted_rows.select("*", file.alias("_file"), F.col("_metadata.row_index").alias("_row"))
    parts = at.groupBy(group, "_file").agg(F.count("*").alias("_n"), F.min("_row").alias("_first"))
    before = Window.partitionBy(group).orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)  # a row for each file
    starts = parts.select(group, "_file", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_start"))
    return at.join(few(starts), [group, "_file"]).withColumn("pos", F.col("_row") + F.col("_start")).drop("_file", "_row", "_start")


def few(rows: DataFrame, per_file: int = ROWS) -> DataFrame:
    """Store a small table in files of about ``per_file`` rows, so that those who read it need few tasks."""
    kept = stored(rows)
    files = kept.count() // per_file + 1
    return kept.coalesce(files)


#: Levels above the lowest one: all consecutive pairs of a level are hashed, ``_height`` times.
_BUILD = """aggregate(if(_height > 0, sequence(1, _height), cast(array() AS array<int>)), array(transform(_nodes, x -> x.hash)),
  (acc, i) -> concat(acc, array(transform(sequence(0, cast((size(element_at(acc, -1)) - 1) div 2 AS int)),
    j -> sha2(concat(get(element_at(acc, -1), 2 * j), coalesce(get(element_at(acc, -1), 2 * j + 1), '')), 256)))))"""


def trees_of(leaves: DataFrame) -> DataFrame:
    """``tree, n, depth, rank``: leaves, levels above them, and place of the tree among all."""
    size = F.col("n") - 1
    counts = leaves.groupBy("tree").agg(F.count("*").alias("n"))
    counts = few(counts.withColumn("depth", F.when(size > 0, F.length(F.bin(size))).otherwise(0)))
    if counts.rdd.getNumPartitions() > 1:  # so many trees that they are not sorted by one task
        return in_order(counts.withColumn("_all", F.lit(0)), "_all", "tree").drop("_all").withColumnRenamed("pos", "rank")
    return counts.withColumn("rank", F.row_number().over(Window.orderBy("tree")).cast("bigint") - 1)


def build(nodes: DataFrame, trees: DataFrame, depth: int, rows: int) -> DataFrame:
    """Stretches over the leaves ``tree, pos, hash`` of ``trees``, the deepest of which has ``depth`` levels over its leaves."""
    out = None
    for tier in range(max(-(-depth // LEVELS), 1)):
        spans = nodes.groupBy("tree", F.shiftright("pos", LEVELS).alias("no")).agg(
            F.sort_array(F.collect_list(F.struct("pos", "hash"))).alias("_nodes")  # SPAN at most
        )
        height = F.least(F.col("depth") - LEVELS * tier, F.lit(LEVELS)).cast("int")
        built = spans.join(trees, "tree").withColumn("_height", height).withColumn("levels", F.expr(_BUILD))
        more, place = F.col("depth") > LEVELS * (tier + 1), F.when(F.col("depth") > LEVELS * (tier + 1), F.col("no")).otherwise(F.col("rank"))
        rows = rows // SPAN + 1
        made = stored(built.select(
            "tree", F.lit(tier).alias("tier"), "no", "levels",
            F.when(more, F.col("tree")).when(F.col("tree") != TOP, F.lit(TOP)).alias("up_tree"), F.when(more, tier + 1).otherwise(0).alias("up_tier"),
            F.shiftright(place, LEVELS).alias("up_no"), place.bitwiseAND(SPAN - 1).cast("int").alias("up_place"),
        ).coalesce(rows // STRETCHES + 1))
        out = made if out is None else out.unionByName(made)
        nodes = made.filter("up_tree = tree").select("tree", F.col("no").alias("pos"), _top().alias("hash"))
    return out


def _top(levels: str = "levels") -> Column:
    return F.element_at(F.element_at(levels, -1), 1)


def manifest(leaves: DataFrame) -> DataFrame:
    """All stretches of the manifest over ``leaves`` (``tree, pos, hash`` of the languages' trees), one row each.

    ``tree, tier, no``: the key. ``levels``: hashes, the lowest level first. ``up_tree, up_tier, up_no, up_place``: the parent and the
    place in its lowest level; up_tree is null at the root.
    """
    trees = trees_of(leaves)
    size = trees.agg(F.count("*"), F.sum("n"), F.max("depth")).first()  # three numbers
    n_trees, rows, depth = size[0], size[1] or 0, size[2] or 0
    below = build(leaves, trees, depth, rows)
    subroots = below.filter(f"up_tree = '{TOP}' AND tree <> '{TOP}'")
    subroots = subroots.select(F.lit(TOP).alias("tree"), F.expr(f"up_no * {SPAN} + up_place").alias("pos"), _top().alias("hash"))
    top_depth = (n_trees - 1).bit_length() if n_trees > 1 else 0
    top = leaves.sparkSession.range(1).select(F.lit(TOP).alias("tree"), F.lit(top_depth).alias("depth"), F.lit(None).cast("bigint").alias("rank"))
    return below.unionByName(build(subroots, top, top_depth, n_trees))


def _copies(nodes: DataFrame, last: DataFrame) -> DataFrame:
    """Stretches by the homes below them: ``home, part, step, levels, pairs, up_place``; ``step`` counts them from the home upwards.

    The lowest stretches are the homes; copies of the others keep the pair of each level that the home's path runs through (``pairs``).
    """
    homes = nodes.filter(f"tree <> '{TOP}' AND tier = 0").select(
        F.col("tree").alias("home"), F.col("no").alias("part"), F.lit(0).alias("step"), "levels", F.lit(False).alias("pairs"), "up_place"
    )
    heights = last.select(F.col("tree").alias("home"), F.col("tier").alias("_last"), "_rank")
    tiers = nodes.filter(f"tree = '{TOP}'").agg(F.max("tier")).first()[0] or 0  # one number
    own = F.expr(f"""transform(if(_last > 0, sequence(1, _last), cast(array() AS array<int>)), t -> named_struct('step', t, 'tree', home, 'tier', t,
        'no', shiftright(part, {LEVELS} * t), 'place', shiftright(part, {LEVELS} * (t - 1)) & {SPAN - 1}))""")
    over = F.expr("array(" + ", ".join(
        f"named_struct('step', _last + {t + 1}, 'tree', '{TOP}', 'tier', {t}, 'no', shiftright(_rank, {LEVELS * (t + 1)}), "
        f"'place', shiftright(_rank, {LEVELS * t}) & {SPAN - 1})" for t in range(tiers + 1)
    ) + ")")
    path = homes.select("home", "part").join(heights, "home").select("home", "part", F.inline(F.concat(own, over)))
    pairs = F.expr("transform(levels, (level, i) -> slice(level, cast(shiftright(place, i) & -2 AS int) + 1, 2))")
    high = nodes.filter(f"tree = '{TOP}' OR tier > 0")
    copies = path.join(high, ["tree", "tier", "no"]).select("home", "part", "step", pairs.alias("levels"), F.lit(True).alias("pairs"), "up_place")
    return homes.unionByName(few(copies))


def climb_sql(levels: int) -> str:
    """The recursive query over stretches of ``levels`` levels. A key has at most a home's rows, so both sides are dealt by it."""
    return f"""
WITH RECURSIVE climb AS (
  SELECT doc_id, unhex(leaf) AS leaf, tree AS home, shiftright(pos, {levels}) AS part, 0 AS step, cast(pos & {(1 << levels) - 1} AS int) AS place,
    unhex(start) AS hash, cast(X'' AS binary) AS siblings
  FROM {{leaves}}
  UNION ALL
  SELECT doc_id, leaf, home, part, step + 1, up_place, unhex(up.hash), up.siblings
  FROM (
    SELECT c.*, n.up_place,
      aggregate(slice(n.levels, 1, size(n.levels) - 1), named_struct('place', c.place, 'hash', lower(hex(c.hash)), 'siblings', c.siblings),
        (a, level) -> named_struct('place', shiftright(a.place, 1),
          'hash', sha2(if(a.place & 1 = 1, concat(get(level, if(n.pairs, 0, a.place - 1)), a.hash), concat(a.hash, coalesce(get(level, if(n.pairs, 1, a.place + 1)), ''))), 256),
          'siblings', concat(a.siblings, coalesce(unhex(get(level, if(n.pairs, 1 - (a.place & 1), a.place ^ 1))), X'')))) AS up
    FROM (SELECT /*+ REPARTITION(home, part, step) */ * FROM climb WHERE place IS NOT NULL) c
    JOIN (SELECT /*+ REPARTITION(home, part, step) */ * FROM {{nodes}}) n ON c.home = n.home AND c.part = n.part AND c.step = n.step))
SELECT * FROM climb LIMIT ALL
"""


def proofs(leaves: DataFrame, nodes: DataFrame) -> DataFrame:
    """Climb from every leaf to the root.

    ``leaves``: ``doc_id, tree, pos, leaf`` (the hash in the manifest) and ``start`` (the hash to check). Returns ``doc_id, leaf, subroot,
    root, siblings`` (binary digests one after the other, from below) and ``folded_root``, what ``start`` and the siblings come to.
    """
    last = nodes.filter(f"up_tree = '{TOP}' AND tree <> '{TOP}'")  # the last stretch of each tree
    last = few(last.select("tree", "tier", F.expr(f"up_no * {SPAN} + up_place").alias("_rank"), _top().alias("subroot")))
    root = nodes.filter("up_tree IS NULL").select(_top()).first()  # one hash
    climb = leaves.sparkSession.sql(climb_sql(LEVELS), leaves=leaves, nodes=_copies(nodes, last))
    done = climb.filter("place IS NULL").join(last.select(F.col("tree").alias("home"), "subroot"), "home")
    text = {c: F.lower(F.hex(c)) for c in ("leaf", "hash")}
    return done.select(
        "doc_id", text["leaf"].alias("leaf"), "subroot", F.lit(root[0] if root else None).cast("string").alias("root"), "siblings",
        text["hash"].alias("folded_root"),
    )


def tree_name(lang: str = "lang") -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(lang)), F.lit(""))


def leaves_of(docs: DataFrame, more_chars: Column) -> DataFrame:
    """``doc_id, tree, pos, leaf, start`` of the documents; ``start`` is the leaf after ``more_chars`` were added to n_chars."""
    rows = docs.select(
        "doc_id", tree_name().alias("tree"), leaf_hash().alias("leaf"),
        F.when(more_chars != 0, leaf_hash(more_chars)).alias("changed"),
    )
    at = in_order(rows, "tree", "doc_id", "leaf")
    return at.select("doc_id", "tree", "pos", "leaf", F.coalesce("changed", "leaf").alias("start"))


def digests(docs: DataFrame) -> DataFrame:
    """Manifest of ``docs``, and the proof of every row after n_chars of some rows was raised by 1."""
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, 1).otherwise(0)
    leaves = leaves_of(docs, tampered)
    nodes = manifest(leaves.select("tree", "pos", F.col("leaf").alias("hash")))
    found = proofs(leaves, nodes)
    return found.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(F.lower(F.hex("siblings")), 256).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
