"""Line dedup by a segment-partition edit join, with DataFrame functions only.

A line of a text that equals an earlier line is removed, and so is a line of ``LEAST`` characters or more that is at most
``EDITS`` = 2 insertions, deletions or substitutions away from a different line, of any length, that occurs earlier; lines are in the
order of (doc_id, line number). Lines are compared without outer white space; lines without a word stay.

1. Distinct lines come from a 128-bit hash; each keeps its first place and the hashes of its segments, never its text.
2. A line of length l is cut into EDITS + 1 segments. Of two lines within EDITS edits, one has a segment that the other holds
   as a substring, near the same place. The longer line probes for the segments that a line 0, 1 or 2 characters shorter would
   have, at the places that the edits before and after a segment allow. Segments and probes meet in semi-joins, which leave
   the lines that share a segment with any other line; only these are looked at again, with their texts.
3. Among them segments and probes are joined to pairs. The join keeps a pair only if the lengths fit and the counts of twelve letters differ by no more than 2 * EDITS in total
   (an edit moves two counts by one at most), so neither drops a pair within EDITS edits.
4. Pairs are verified on their texts by a banded bit-parallel automaton: for each number of edits the reachable diagonals of
   the band are the bits of a mask, moved on by one character of the first line at a time.

A null text stays null and has no lines; rows that repeat a doc_id are told apart by a 128-bit hash of their text, and rows equal
in both count as one document. An empty table gives no rows. Very long lines are compared whole. Other columns are kept as they
are, whatever their names, but for n_lines and n_removed, which are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.tables import stored

EDITS, LEAST = 2, 30
PARTS = EDITS + 1
#: Letters whose counts are compared.
LETTERS = "etaoinshrdlc"
SPACE = " \t\n\x0b\x0c\r"
ROW = ["_id", "_tail", "_more"]


def _keyed(docs: DataFrame) -> DataFrame:
    """The name of each row, its text, and all other columns as one, so that no name can clash."""
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    names = [F.coalesce(F.col("doc_id").cast("long"), F.lit(-1).cast("long")), F.xxhash64("text"), F.xxhash64(F.lit(7), "text")]
    return docs.select(*[n.alias(c) for n, c in zip(names, ROW, strict=True)], "text", F.struct(*others).alias("_others"))


def _lines(docs: DataFrame) -> DataFrame:
    """Lines with a word, without outer white space; trimmed within the array, so that each line is trimmed once."""
    trimmed = F.transform(F.split("text", "\n"), lambda x: F.trim(x, F.lit(SPACE)))
    lines = docs.select(*ROW, F.posexplode(trimmed).alias("no", "line")).filter("line <> ''")
    return lines.withColumn("h1", F.xxhash64("line")).withColumn("h2", F.xxhash64(F.lit(7), "line"))


def _cuts(rest: int, shorter: int) -> list[tuple[int, int]]:
    """Segments of a line of PARTS * q + ``rest`` - ``shorter`` characters: segment k begins at k * q + the first number and
    has q + the second one characters. The last segments are the longer ones."""
    q, r = divmod(rest - shorter, PARTS)
    out, start = [], 0
    for k in range(PARTS):
        size = q + (r >= PARTS - k)
        out.append((start, size))
        start += size
    return out


def _hashes(places: list[set[tuple[int, int, int]]]) -> Column:
    """For each remainder of the length by PARTS, hashes of the substrings at (segment, start, size) as in ``_cuts``."""
    q = F.floor(F.col("n") / PARTS).cast("int")
    out = None
    for rest, found in enumerate(places):
        keys = F.array(*[F.xxhash64(F.lit(k), F.col("line").substr(q * k + (start + 1), q + size)) for k, start, size in sorted(found)])
        out = F.when(F.col("n") % PARTS == rest, keys) if out is None else out.when(F.col("n") % PARTS == rest, keys)
    return out


def _segments() -> Column:
    return _hashes([{(k, *cut) for k, cut in enumerate(_cuts(rest, 0))} for rest in range(PARTS)])


def _probes() -> Column:
    """The substrings at which a line up to EDITS characters shorter can have one of its segments."""
    places: list[set[tuple[int, int, int]]] = [set() for _ in range(PARTS)]
    for rest in range(PARTS):
        for shorter in range(EDITS + 1):
            for k, (start, size) in enumerate(_cuts(rest, shorter)):
                # edits left of the segment move it by k at most, those right of it by PARTS - 1 - k at most
                low, high = max(-k, shorter - (PARTS - 1 - k)), min(k, shorter + (PARTS - 1 - k))
                places[rest] |= {(k, start + move, size) for move in range(low, high + 1)}
    return _hashes(places)


def _letters() -> Column:
    """Counts of the letters modulo 32, five bits each."""
    bits = F.lit(0).cast("long")
    for k, letter in enumerate(LETTERS):
        count = (F.octet_length("line") - F.octet_length(F.replace(F.col("line"), F.lit(letter), F.lit("")))).bitwiseAND(F.lit(31)).cast("long")
        bits = bits.bitwiseOR(F.shiftleft(count, 5 * k))
    return bits


def _apart(x: Column, y: Column) -> Column:
    """At most the sum of the differences of the letter counts."""
    total = F.lit(0).cast("long")
    for k in range(len(LETTERS)):
        d = (F.shiftright(x, 5 * k) - F.shiftright(y, 5 * k)).bitwiseAND(F.lit(31))
        total = total + F.least(d, F.lit(32) - d)
    return total


def within(a: Column, b: Column) -> Column:
    """Whether lines ``a`` and ``b``, of lengths that differ by EDITS at most, are EDITS edits apart or less.

    Bit d of mask e says that after i characters of ``a`` some e edits lead to i + d - EDITS characters of ``b``. Equal characters
    keep a bit; an edit sets its neighbour of the next mask: the same bit for a substitution, one lower for a deletion, one
    higher for an insertion.
    """
    # the letters of both lines are bound to a name, or each step would split the lines anew
    letters = F.array(F.struct(F.split(a, "").alias("x"), F.split(b, "").alias("y")))
    return F.get(F.transform(letters, lambda s: _within(s["x"], s["y"])), F.lit(0))


def _within(x: Column, y: Column) -> Column:
    width = 2 * EDITS + 1
    full = (1 << width) - 1

    def forward(masks: list[Column]) -> list[Column]:
        """Insertions: they take no letter of ``x``."""
        out = [masks[0]]
        for m in masks[1:]:
            out.append(m.bitwiseOR(F.shiftleft(out[-1], 1)).bitwiseAND(F.lit(full)))
        return out

    names = [f"e{k}" for k in range(EDITS + 1)]
    start = [F.lit((1 << (EDITS + k + 1)) - (1 << EDITS)) for k in range(EDITS + 1)]

    def bound(state: Column, same: Column) -> Column:
        old = [state[n] for n in names]
        new = [old[0].bitwiseAND(same)]
        for k in range(1, EDITS + 1):
            new.append(old[k].bitwiseAND(same).bitwiseOR(old[k - 1]).bitwiseOR(F.shiftright(old[k - 1], 1)))
        return F.struct(*[m.alias(n) for m, n in zip(forward(new), names, strict=True)])

    def match(i: Column) -> Column:
        same = F.lit(0)
        for d in range(width):
            place = i + (d - EDITS)
            same = same + F.when((place >= 0) & (F.get(y, place) == F.get(x, i)), 1 << d).otherwise(0)
        return same

    masks = F.transform(F.sequence(F.lit(0), F.size(x) - 1), match)
    state = F.aggregate(masks, F.struct(*[m.alias(n) for m, n in zip(start, names, strict=True)]), bound)
    return F.call_function("shiftright", state[names[-1]], F.size(y) - F.size(x) + EDITS).bitwiseAND(F.lit(1)) == 1


def _close(n: str, m: str) -> Column:
    return (F.col(m) - F.col(n)).between(0, EDITS)


def _edited(docs: DataFrame, distinct: DataFrame) -> DataFrame:
    """``first`` places of distinct lines that are within EDITS edits of an earlier line."""
    base = distinct.filter("n is not null")
    held = base.select(F.explode("segments").alias("key"), F.col("h1").alias("ah"), F.col("n").alias("an"))
    asked = base.filter(F.col("n") >= LEAST).select(F.explode("probes").alias("key"), F.col("h1").alias("bh"), F.col("n").alias("bn"))
    # lines that share a segment with another line at all; few do, and nothing is paired yet
    meets = (F.col("key") == F.col("k")) & (F.col("ah") != F.col("bh")) & _close("an", "bn")
    longer = stored(asked.join(held.withColumnRenamed("key", "k"), meets, "left_semi"))
    shorter = held.join(longer.withColumnRenamed("key", "k"), meets, "left_semi")
    met = longer.select(F.col("bh").alias("h1")).union(shorter.select("ah")).distinct()
    places = base.select("h1", "first").join(met, "h1", "left_semi")
    needed = places.groupBy(*[F.col(f"first.{c}").alias(c) for c in ROW]).agg(F.collect_list("first.no").alias("nos"))
    texts = docs.select(*ROW, "text").join(needed, ROW).select(*ROW, F.explode("nos").alias("no"), F.split("text", "\n").alias("all"))
    texts = texts.select(F.struct(*ROW, "no").alias("first"), F.trim(F.get("all", F.col("no")), F.lit(SPACE)).alias("line"))
    texts = stored(texts.distinct().withColumn("n", F.length("line")).withColumn("letters", _letters()))

    held = texts.select(F.explode(_segments()).alias("key"), F.col("first").alias("a"), F.col("n").alias("an"), F.col("letters").alias("al"))
    asked = texts.filter(F.col("n") >= LEAST).select(F.explode(_probes()).alias("key"), F.col("first").alias("b"), F.col("n").alias("bn"), F.col("letters").alias("bl"))
    # of two lines of one length either finds the other
    once = (F.col("bn") > F.col("an")) | (F.col("a") < F.col("b"))
    # the later one goes if it is long enough; the longer one is
    once = once & ((F.col("a") < F.col("b")) | (F.col("an") >= LEAST))
    like = _apart(F.col("al"), F.col("bl")) <= 2 * EDITS
    pairs = held.join(asked, (held.key == asked.key) & _close("an", "bn") & once & like).select("a", "b").distinct()
    both = pairs.join(texts.select(F.col("first").alias("a"), F.col("line").alias("a_line")), "a").join(
        texts.select(F.col("first").alias("b"), F.col("line").alias("b_line")), "b"
    )
    return both.filter(within(F.col("a_line"), F.col("b_line"))).select(F.greatest("a", "b").alias("first")).distinct()


def repeated_lines(docs: DataFrame) -> DataFrame:
    """Places (``_id``, ``_tail``, ``no``) of the lines that go."""
    lines = _lines(docs)
    long = F.col("n") >= LEAST - EDITS  # a line a little under LEAST does not go, but others are compared with it
    marked = lines.withColumn("n", F.length("line")).select(
        "h1", "h2", F.struct(*ROW, "no").alias("place"), F.when(long, F.col("n")).alias("n"),
        F.when(long, _segments()).alias("segments"), F.when(F.col("n") >= LEAST, _probes()).alias("probes"),
    )
    distinct = marked.groupBy("h1", "h2").agg(
        F.min("place").alias("first"), F.count("*").alias("times"), F.first("n").alias("n"), F.first("segments").alias("segments"), F.first("probes").alias("probes")
    )
    distinct = stored(distinct)
    near = _edited(docs, distinct).withColumn("near", F.lit(True))
    verdict = distinct.select("h1", "h2", "first", "times").join(near, "first", "left").filter("times > 1 or near").select("h1", "h2", "first", "near")
    gone = lines.select("h1", "h2", F.struct(*ROW, "no").alias("place")).join(verdict, ["h1", "h2"]).filter("near or place <> first")
    return gone.select("place.*")


def dedup_lines(docs: DataFrame) -> DataFrame:
    """All rows and columns of ``docs``, with ``text`` cut to the lines that stay, ``n_lines`` and ``n_removed``.

    Line ends of lines that stay are kept as they are. Columns named n_lines or n_removed are replaced.
    """
    kept = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    keyed = _keyed(docs.select(*[F.col(f"`{c}`") for c in kept]))
    gone = repeated_lines(keyed.select(*ROW, "text")).groupBy(*ROW).agg(F.collect_set("no").alias("gone"))
    joined = keyed.join(gone, ROW, "left").withColumn("_all", F.split("text", "\n"))
    # the runs of lines between those that go
    ends = F.concat(F.array(F.lit(-1)), F.array_sort("gone"), F.array(F.size("_all")))
    stay = F.transform(F.sequence(F.lit(0), F.size("gone")), lambda k: F.slice("_all", F.get(ends, k) + 2, F.get(ends, k + 1) - F.get(ends, k) - 1))
    text = F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(F.flatten(stay), "\n"))
    n_lines = F.when(F.col("_all").isNull(), 0).otherwise(F.size(F.filter("_all", lambda line: F.trim(line, F.lit(SPACE)) != ""))).cast("long")
    return joined.select(
        *[text.alias("text") if c == "text" else F.col("_others").getField(c).alias(c) for c in kept], n_lines.alias("n_lines"),
        F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("long").alias("n_removed"),
    )


def digests(docs: DataFrame) -> DataFrame:
    done = dedup_lines(docs.select("doc_id", "text"))
    return done.select("doc_id", "n_lines", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))
