"""Exact phrase search: which texts contain which phrases.

Catalyst turns a ``contains`` join into a nested loop over all pairs, so it is never written here.
A phrase is looked for in texts of its own scope (an app, or one batch of an app), and each scope is
searched in one of three ways, with the same result:

* With few phrases a scope's phrases travel as one array, by an equi join on the scope. Each text is
  read once and only hits leave the row.
* With more, each phrase is found by a short piece of itself, its anchor: equal anchors meet in an
  equi join on hashes, and ``contains`` settles the few candidates. This misses nothing, because a
  text that contains a phrase contains its anchor too. An anchor is an n-gram of 1, 2, 4 or 8
  characters, and of the possible ones that shared with the fewest other phrases is taken, so a common
  opening does not pile up candidates. The anchors of a scope travel as one array of hashes, and only
  the n-grams of a text that are in it leave the row.
* Where a scope has too many phrases for an array, long phrases use a minimizer as anchor, the smallest
  hash in a run of ``RUN`` n-grams (Schleimer et al., Winnowing, 2003); a text then has to offer only
  about 2 / (RUN + 1) of its n-grams.

A dictionary of bounded size may instead go to all tasks, which make an automaton of each scope's phrases and read each text once.

Long and short phrases of a scope are counted apart, as the short ones are few in most data.

Where rows are shuffled by anchor, a summary of the n-grams that the texts offer is made first, in one pass: frequent-item sketches
of tasks, merged in two steps. Anchors are chosen among the n-grams that it does not know as frequent, and where a phrase has
only frequent ones, the rows of that anchor are dealt to as many keys as its share asks for. The same is done for a scope that holds
many texts. A phrase may carry what belongs to it (a code), so hits are not joined with the phrases again.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from themeloom.functions.text import ngrams
from themeloom.session import BROADCAST_ROWS, materialise

GRAM = 8
RUN = 8
LONG = GRAM + RUN - 1
# A scope with no more phrases and characters than this is searched phrase by phrase.
LIST_PHRASES = 200
LIST_CHARS = 200_000
# Largest dictionary, in characters of phrases and what they carry, that is sent to all tasks as automata.
AUTOMATON_CHARS = 1_000_000
# A scope with no more phrases than this sends its anchors to the texts.
SET_PHRASES = 20_000
# Largest number of anchors, over all scopes, that may be broadcast as arrays of hashes.
BROADCAST_HASHES = 2_000_000
# Largest phrase tables, in characters, that may be broadcast.
BROADCAST_CHARS = 32_000_000
_MINIMIZER = 0  # anchor class of long phrases; the others are n-gram lengths 1, 2, 4, 8
# A key with more than one row in so many is dealt to several; so at most this many keys are told to all tasks.
SHARES = 10_000
# Entries of a frequent-item sketch: its error is about 3.5 rows in so many, well below one in SHARES.
TRACKED = 131_072
_SKETCHES = 64
_CARRY = "_carry"
# Characters of the beginning by which phrases are looked up in the texts of a batch: powers of two, the longest that fits.
ANCHOR_CHARS = (16, 8, 4, 2, 1)
_MARK_BITS = 20
_ODD = np.uint64(0x9E3779B97F4A7C15)
_PAD = "\x00" * (GRAM - 1)
_COUNT_BITS = 16
_HASH_RANGE = 1 << (64 - _COUNT_BITS)


def _class(phrase: str) -> Column:
    n = F.length(phrase)
    return F.when(n >= LONG, _MINIMIZER).when(n >= 8, 8).when(n >= 4, 4).when(n >= 2, 2).otherwise(1)


def _hashes(grams: Column | str, n: int) -> Column:
    """48-bit hashes; equal hashes of different n-grams only add candidates."""
    if n == GRAM:
        return F.transform(grams, lambda g: F.shiftrightunsigned(F.xxhash64(g), _COUNT_BITS))
    return F.transform(grams, lambda g: F.shiftrightunsigned(F.xxhash64(F.substring(g, 1, n)), _COUNT_BITS))


def _run_minima(hashes: str) -> Column:
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(hashes) - (RUN - 1)))
    return F.array_distinct(F.transform(starts, lambda i: F.array_min(F.slice(hashes, i, F.lit(RUN)))))


def _spread(phrase: str, n: int) -> Column:
    """Hashes of up to four n-grams of a phrase: first, last and two between."""
    last = F.length(phrase) - n
    starts = [F.lit(0), F.floor(last / 3), F.floor(last * 2 / 3), last]
    return _hashes(F.array_distinct(F.array(*[F.substr(F.col(phrase), s.cast("int") + 1, F.lit(n)) for s in starts])), n)


def _phrase_anchors(phrases: DataFrame, scope: Sequence[str], minimizers: bool, frequent: DataFrame | None = None) -> DataFrame:
    """``phrases`` with the ``_anchor`` of each: the least frequent of the texts' n-grams, of those the least shared by phrases."""
    kind = _class("phrase")
    phrases = phrases.withColumn("_class", F.when(kind == _MINIMIZER, _MINIMIZER if minimizers else GRAM).otherwise(kind))
    possible = F.when(F.col("_class") == GRAM, _spread("phrase", GRAM))
    for n in (4, 2, 1):
        possible = possible.when(F.col("_class") == n, _spread("phrase", n))
    if minimizers:
        phrases = phrases.withColumn("_hashes", _hashes(ngrams("phrase", GRAM), GRAM))
        possible = possible.otherwise(_run_minima("_hashes"))
    each = phrases.select(*scope, "phrase", _CARRY, F.explode_outer(possible).alias("_anchor"))
    shared = each.groupBy(*scope, "_anchor").agg(F.count(F.lit(1)).alias("_n"))
    if frequent is not None:
        shared = shared.join(F.broadcast(frequent), "_anchor", "left").withColumn("_n", _rank(F.col("_n"), F.col("_rows")))
    # count above hash in one long: the smallest is the least shared, by a hash aggregate
    ranked = F.least("_n", F.lit(2 ** (_COUNT_BITS - 1) - 1)) * _HASH_RANGE + F.col("_anchor")
    choice = F.min(ranked).bitwiseAND(F.lit(_HASH_RANGE - 1))
    chosen = each.join(shared, [*scope, "_anchor"]).groupBy(*scope, "phrase")
    return chosen.agg(choice.alias("_anchor"), F.any_value(_CARRY).alias(_CARRY))


def _rank(shared: Column, rows: Column) -> Column:
    """The magnitude of the frequency first, in 6 bits, then the phrases that share the anchor, in 9."""
    return F.coalesce(F.ceil(F.log2(rows)), F.lit(0)) * 512 + F.least(shared, F.lit(511))


def _frequent(offered: DataFrame) -> DataFrame:
    """``_anchor, _rows, _fan`` of the n-grams with more than one in ``SHARES`` of all rows that the texts offer; ``_rows`` is about the
    number of texts. At most ``SHARES`` rows, so the table may be sent to all tasks."""
    seed = offered.sparkSession.range(1).select(F.lit(0).cast("int").alias("_b"), F.lit(-1).cast("bigint").alias("_anchor"))  # a sketch of nothing cannot be merged
    rows = _explode(offered.select("_offered")).filter("_anchor IS NOT NULL").select((F.spark_partition_id() % _SKETCHES).alias("_b"), "_anchor")
    sketches = rows.unionByName(seed).groupBy("_b").agg(F.expr(f"approx_top_k_accumulate(_anchor, {TRACKED})").alias("_s"), F.count(F.lit(1)).alias("_n"))
    # grouped, as a task without any sketch cannot merge
    merged = sketches.groupBy(F.lit(0).alias("_g")).agg(F.expr(f"approx_top_k_estimate(approx_top_k_combine(_s, {TRACKED}), {SHARES})").alias("_top"), F.sum("_n").alias("_all"))
    each = merged.select("_all", F.explode("_top").alias("_t")).select("_all", F.col("_t.item").alias("_anchor"), F.col("_t.count").alias("_rows"))
    return materialise(_fans(each.filter("_anchor >= 0")))


def _fans(shares: DataFrame) -> DataFrame:
    """Of keys with ``_rows`` out of ``_all``, those with more than one row in ``SHARES``, and the number of keys to deal them to."""
    fan = F.ceil(F.col("_rows") * SHARES / F.greatest("_all", F.lit(SHARES))).cast("bigint")
    return shares.withColumn("_fan", fan).filter("_fan > 1").drop("_all")


def _dealt(many: DataFrame, few: DataFrame, keys: list[str], fans: DataFrame, name: str) -> DataFrame:
    """Join of ``many`` rows, told apart by ``name``, with ``few`` on ``keys``; keys of ``fans`` (a bounded table) are dealt to several."""
    fans = F.broadcast(fans.select(*[c for c in fans.columns if c in keys], "_fan"))
    on = [c for c in fans.columns if c in keys]
    left = many.join(fans, on, "left").withColumn("_salt", F.coalesce(F.pmod(F.xxhash64(name), "_fan"), F.lit(0))).drop("_fan")
    salts = F.sequence(F.lit(0).cast("bigint"), F.coalesce("_fan", F.lit(1)) - 1)
    right = few.join(fans, on, "left").withColumn("_salt", F.explode(salts)).drop("_fan")
    return left.join(right, [*keys, "_salt"]).drop("_salt")


def _by_scope(texts: DataFrame, lists: DataFrame, scope: list[str], name: str, small: bool) -> DataFrame:
    """Texts with the one row of ``lists`` of their scope. A scope with many texts is dealt to several keys."""
    if small:
        return texts.join(F.broadcast(lists), scope)
    counts = texts.groupBy(*scope).agg(F.count(F.lit(1)).alias("_rows"))
    total = counts.agg(F.sum("_rows")).first()[0] or 0  # one number
    return _dealt(texts, lists, scope, materialise(_fans(counts.withColumn("_all", F.lit(total).cast("bigint")))), name)


def _offered(texts: DataFrame, text: str, classes: set[int]) -> DataFrame:
    """Add the hashes a text has to offer for the phrase classes that occur.

    The padding gives every position a full n-gram, whose beginnings are the shorter n-grams.
    """
    texts = texts.withColumn("_grams", ngrams(F.concat(text, F.lit(_PAD)), GRAM))
    parts = [_hashes("_grams", n) for n in sorted(classes - {_MINIMIZER})]
    if _MINIMIZER in classes and GRAM not in classes:  # all 8-grams include the minimizers
        texts = texts.withColumn("_hashes", _hashes("_grams", GRAM))
        parts.append(_run_minima("_hashes"))
    offered = parts[0] if len(parts) == 1 else F.concat(*parts)
    kept = [c for c in texts.columns if c not in ("_grams", "_hashes")]
    return texts.select(*kept, offered.alias("_offered"))


def _explode(offered: DataFrame) -> DataFrame:
    """``explode_outer``, because the filter that ``explode`` infers would compute the hashes twice."""
    kept = [c for c in offered.columns if c != "_offered"]
    return offered.select(*kept, F.explode_outer("_offered").alias("_anchor"))


def _by_list(texts: DataFrame, phrases: DataFrame, scope: list[str], text: str, name: str, small: bool) -> DataFrame:
    lists = phrases.groupBy(*scope).agg(F.collect_list(F.struct("phrase", _CARRY)).alias("_phrases"))
    both = _by_scope(texts, lists, scope, name, small)
    hits = F.filter("_phrases", lambda p: F.contains(F.col(text), p["phrase"]))
    found = both.select(*scope, name, F.explode_outer(hits).alias("_hit")).filter("_hit IS NOT NULL")
    return found.select(*scope, name, "_hit.phrase", f"_hit.{_CARRY}")


def _near_anchors(
    texts: DataFrame, anchors: DataFrame, scope: list[str], text: str, name: str, classes: set[int], broadcast_sets: bool
) -> DataFrame:
    """The distinct hashes of a text that are anchors of its scope; few of its n-grams leave the row."""
    sets = anchors.groupBy(*scope).agg(F.collect_set("_anchor").alias("_set"))
    near = _by_scope(texts, sets, scope, name, broadcast_sets)
    offered = _offered(near, text, {c or GRAM for c in classes})
    return offered.select(*texts.columns, F.array_intersect("_offered", "_set").alias("_offered"))


def _by_broadcast(
    texts: DataFrame, phrases: DataFrame, scope: list[str], text: str, name: str, classes: set[int], as_set: bool
) -> DataFrame:
    """Texts are searched where they are read; nothing is shuffled, so minimizers would not pay."""
    anchors = _phrase_anchors(phrases, scope, minimizers=False)
    if as_set:
        offered = _near_anchors(texts, anchors, scope, text, name, classes, True)
    else:
        offered = _offered(texts, text, {c or GRAM for c in classes})
        offered = offered.withColumn("_offered", F.array_distinct("_offered"))
    inside = F.contains(F.col(text), F.col("phrase"))
    hits = _explode(offered).join(F.broadcast(anchors), [*scope, "_anchor"])
    return hits.filter(inside).select(*scope, name, "phrase", _CARRY)


def _by_shuffle(
    texts: DataFrame, phrases: DataFrame, scope: list[str], text: str, name: str, classes: set[int], as_set: bool,
    small: bool,
) -> DataFrame:
    """Hashes find the candidates; texts then meet them by id, which shuffles each text once more."""
    keyed = texts.withColumn("_text", F.xxhash64(text))
    candidates = _candidates(keyed, phrases, scope, text, name, classes, as_set, small)
    inside = F.contains(F.col(text), F.col("phrase"))
    return candidates.distinct().join(keyed, [*scope, name, "_text"]).filter(inside).select(*scope, name, "phrase", _CARRY)


def _candidates(
    keyed: DataFrame, phrases: DataFrame, scope: list[str], text: str, name: str, classes: set[int], as_set: bool, small: bool
) -> DataFrame:
    """Texts (``name, _text``) and phrases that share an anchor. Frequent n-grams are avoided as anchors, and split where they are not."""
    if as_set:
        # among the n-grams that may become anchors; the rest of a text never leaves its row
        possible = _possible(phrases, scope)
        frequent = _frequent(_near_anchors(keyed, possible, scope, text, name, classes, small))
        anchors = _phrase_anchors(phrases, scope, False, frequent)
        offered = _near_anchors(keyed, anchors, scope, text, name, classes, small)
    else:
        offered = _offered(keyed, text, classes)
        frequent = _frequent(offered.withColumn("_offered", F.array_distinct("_offered")))
        anchors = _phrase_anchors(phrases, scope, True, frequent)
    offered = offered.select(*scope, name, "_text", F.array_distinct("_offered").alias("_offered"))
    met = _dealt(_explode(offered).filter("_anchor IS NOT NULL"), anchors, [*scope, "_anchor"], frequent, name)
    return met.select(*scope, name, "_text", "phrase", _CARRY)


def _possible(phrases: DataFrame, scope: list[str]) -> DataFrame:
    """All n-grams that may become anchors."""
    possible = F.when(F.length("phrase") >= GRAM, _spread("phrase", GRAM))
    for n in (4, 2, 1):
        possible = possible.when(F.length("phrase") >= n, _spread("phrase", n))
    return phrases.select(*scope, F.explode(possible).alias("_anchor"))


def _anchored_hits(texts: list[str | None], phrases: list[str]) -> list[list[str]] | None:
    """Per text the phrases it contains, by the hashes of the phrases' first characters at all places of the texts; None where
    these leave more candidates than the texts have characters."""
    joined = "".join(t or "" for t in texts)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    ends = np.cumsum([len(t or "") for t in texts])
    starting: list[dict[str, list[str]]] = [{} for _ in ANCHOR_CHARS]
    for p in phrases:
        step = next(i for i, n in enumerate(ANCHOR_CHARS) if len(p) >= n)
        starting[step].setdefault(p[: ANCHOR_CHARS[step]], []).append(p)
    found: list[set[str]] = [set() for _ in texts]
    left = len(joined) + 1_000
    for n, of in zip(ANCHOR_CHARS, starting, strict=True):
        if not of or len(joined) < n:
            continue
        anchors = list(of)
        wanted = _window_hashes(np.frombuffer("".join(anchors).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64), n)[::n]
        known = np.zeros(1 << _MARK_BITS, bool)
        known[wanted >> np.uint64(64 - _MARK_BITS)] = True
        at_all = _window_hashes(codes, n)
        places = np.flatnonzero(known[at_all >> np.uint64(64 - _MARK_BITS)])  # a few too many; the characters settle it
        for at, r in zip(places.tolist(), np.searchsorted(ends, places, side="right").tolist(), strict=True):
            here = of.get(joined[at:at + n], ())
            left -= len(here)
            if left < 0:
                return None
            for p in here:
                if at + len(p) <= ends[r] and joined.startswith(p, at):
                    found[r].add(p)
    return [list(x) for x in found]


def _window_hashes(codes: np.ndarray, n: int) -> np.ndarray:
    """64-bit hashes of all windows of ``n`` codes, a power of two; windows with other texts differ but for chance."""
    hashes, width = codes * _ODD + _ODD, 1
    while width < n:
        hashes = (hashes[:-width] ^ (hashes[:-width] >> np.uint64(29))) * _ODD + hashes[width:]
        width *= 2
    return hashes


def _automaton_hits(texts: list[str | None], phrases: list[str]) -> list[list[str]]:
    """Per text the phrases it contains: the phrases become an automaton (Aho and Corasick, 1975), which reads each text once."""
    import ahocorasick  # needed by tasks of this search only

    automaton = ahocorasick.Automaton()
    for p in phrases:
        automaton.add_word(p, p)
    automaton.make_automaton()
    return [list(dict.fromkeys(p for _, p in automaton.iter(t))) if t else [] for t in texts]


def _found_in_group(scope: list[str], text: str, name: str):
    """Hits of one scope. Phrases are mostly told apart by their first characters, so most are settled where these stand in a text;
    phrases and texts that are not go to an automaton."""

    def run(texts: pa.Table, phrases: pa.Table) -> pa.Table:
        hits: list[tuple] = []
        if texts.num_rows and phrases.num_rows:
            wanted, read = list(dict.fromkeys(phrases.column("phrase").to_pylist())), texts.column(text).to_pylist()
            found = _anchored_hits(read, wanted)
            if found is None:
                found = _automaton_hits(read, wanted)
            key = [texts.column(c)[0].as_py() for c in scope]
            for n, own in zip(texts.column(name).to_pylist(), found, strict=True):
                hits += [(*key, n, p) for p in own]
        kinds = [*[texts.schema.field(c) for c in (*scope, name)], pa.field("phrase", pa.string())]
        columns = zip(*hits, strict=True) if hits else [[] for _ in kinds]
        return pa.table([pa.array(list(c), f.type) for c, f in zip(columns, kinds, strict=True)], schema=pa.schema(kinds))

    return run


def find_in_batches(
    texts: DataFrame, phrases: DataFrame, scope: Sequence[str], text: str = "review_norm", name: str = "name"
) -> DataFrame:
    """As ``find_phrases``, for scopes that are small on both sides, such as the batches of a run.

    Texts and phrases of a scope meet in one task by one exchange each; duplicates of phrases are dropped there. The phrases are indexed
    once for all texts of the scope, so the work is their length, that of the texts and the hits. The scope must bound both sides, as they are gathered.
    """
    scope = list(scope)
    phrases = phrases.select(*scope, "phrase").filter(F.length("phrase") > 0)
    texts = texts.select(*scope, name, text)
    kinds = [*[f"`{c}` {k}" for c, k in texts.dtypes if c != text], "phrase string"]
    both = texts.groupBy(*scope).cogroup(phrases.groupBy(*scope))
    return both.applyInArrow(_found_in_group(scope, text, name), ", ".join(kinds)).distinct()


def _found_by_automata(terms, scope: list[str], text: str, name: str):
    """Hits in a stream of texts: the terms of a scope, rows ``scope, phrase, _carry``, become an automaton when its first text comes."""

    def run(batches):
        import ahocorasick  # needed by tasks of this search only

        own: dict[tuple, dict[str, list[int]]] = {}
        for i, (*key, phrase) in enumerate(zip(*(terms.value.column(c).to_pylist() for c in (*scope, "phrase")), strict=True)):
            own.setdefault(tuple(key), {}).setdefault(phrase, []).append(i)
        automata: dict[tuple, object] = {}
        for batch in batches:
            rows: list[int] = []
            found: list[int] = []
            keys = zip(*(batch.column(c).to_pylist() for c in scope), strict=True)
            for r, (key, t) in enumerate(zip(keys, batch.column(text), strict=True)):
                if key not in own or not (t := t.as_py()):
                    continue
                if key not in automata:
                    automata[key] = ahocorasick.Automaton()
                    for phrase, places in own[key].items():
                        automata[key].add_word(phrase, tuple(places))
                    automata[key].make_automaton()
                hits = {places for _, places in automata[key].iter(t)}
                for places in hits:
                    found += places
                    rows += [r] * len(places)
            at, of = pa.array(rows, pa.int64()), pa.array(found, pa.int64())
            columns = {c: batch.column(c).take(at) for c in (*scope, name)} | {c: terms.value.column(c).take(of).combine_chunks() for c in ("phrase", _CARRY)}
            yield pa.RecordBatch.from_pydict(columns)

    return run


def _by_automata(texts: DataFrame, terms: DataFrame, scope: list[str], text: str, name: str) -> DataFrame:
    """A dictionary of bounded size goes to all tasks, and each text is read once where it lies; only hits leave a task."""
    spark = texts.sparkSession
    # rows without a scope match nothing, as in a join
    table = terms.dropna(subset=scope).toArrow()
    out = StructType([*[texts.schema[c] for c in (*scope, name)], terms.schema["phrase"], terms.schema[_CARRY]])
    return texts.mapInArrow(_found_by_automata(spark.sparkContext.broadcast(table), scope, text, name), out)


def find_phrases(
    texts: DataFrame, phrases: DataFrame, scope: Sequence[str], text: str = "review_norm", name: str = "name",
    carry: str | None = None, list_phrases: int = LIST_PHRASES, set_phrases: int = SET_PHRASES, max_rows: int = BROADCAST_ROWS,
    max_chars: int = BROADCAST_CHARS, automaton_chars: int = 0,
) -> DataFrame:
    """Distinct (scope, name, phrase) such that the text called ``name`` contains ``phrase``; with ``carry``, a column of ``phrases``,
    a row for each of its values that stand with the phrase.

    ``texts`` has the scope columns, ``name`` and ``text``; ``phrases`` the scope columns and
    ``phrase``. Sizes of the phrase lists are counted before the search is planned; phrases are not stored. A list of at most
    ``automaton_chars`` characters and ``max_rows`` rows goes to all tasks as automata.
    """
    scope = list(scope)
    texts = texts.select(*scope, name, text)
    carried = F.collect_set(carry) if carry else F.collect_set(F.lit(None).cast("string"))
    phrases = phrases.filter(F.length("phrase") > 0).groupBy(*scope, "phrase").agg(carried.alias(_CARRY))
    phrases = phrases.withColumn("_long", F.length("phrase") >= LONG)
    per_scope = phrases.groupBy(*scope, "_long").agg(
        F.count(F.lit(1)).alias("_n"), F.sum(F.length("phrase")).alias("_c"), F.collect_set(_class("phrase")).alias("_k"),
        F.sum(F.greatest(F.size(_CARRY), F.lit(1))).alias("_carried"), F.sum(F.length(F.array_join(_CARRY, ""))).alias("_carry_chars"),
    )
    way = (
        F.when((F.col("_n") <= list_phrases) & (F.col("_c") <= LIST_CHARS), "list")
        .when(F.col("_n") <= set_phrases, "set").otherwise("open")
    )
    per_scope = per_scope.withColumn("_way", way)
    sizes = per_scope.groupBy("_way").agg(
        F.sum("_n").alias("n"), F.sum("_c").alias("chars"), F.sum("_carried").alias("rows"), F.sum("_carry_chars").alias("carry_chars"), F.flatten(F.collect_set("_k")).alias("classes")
    ).collect()  # three rows at most
    if sizes and sum(s["rows"] for s in sizes) <= max_rows and sum(s["chars"] + s["carry_chars"] for s in sizes) <= automaton_chars:
        terms = phrases.select(*scope, "phrase", F.explode_outer(_CARRY).alias(_CARRY))
        hits = _by_automata(texts, terms, scope, text, name)
        return (hits.withColumnRenamed(_CARRY, carry).filter(F.col(carry).isNotNull()) if carry else hits.drop(_CARRY)).distinct()
    none = phrases.select(*scope, "phrase", _CARRY).limit(0)
    found = texts.select(*scope, name).limit(0).join(none, scope) if not sizes else None
    for size in sizes:
        part = phrases
        if len(sizes) > 1:
            part = phrases.join(per_scope.filter(F.col("_way") == size["_way"]), [*scope, "_long"], "left_semi")
        part, classes = part.select(*scope, "phrase", _CARRY), set(size["classes"])
        small = size["n"] <= max_rows and size["chars"] <= max_chars
        if size["_way"] == "list":
            hits = _by_list(texts, part, scope, text, name, small)
        elif small:
            hits = _by_broadcast(texts, part, scope, text, name, classes, size["_way"] == "set")
        else:
            hits = _by_shuffle(
                texts, part, scope, text, name, classes, size["_way"] == "set", size["n"] <= BROADCAST_HASHES
            )
        found = hits if found is None else found.unionByName(hits)
    if not carry:
        return found.select(*scope, name, "phrase").distinct()
    return found.select(*scope, name, "phrase", F.explode(_CARRY).alias(carry)).distinct()
