"""LM scoring by masked pseudo-likelihood.

Tokens are words in lower case, single characters of scripts written without spaces, and single signs. A small network sees the
two tokens on either side of a masked one and predicts it; a document's score is the sum of the log-probabilities of all of its
tokens, each given both sides. There is no token for rare words: the vocabulary is every word of the corpus.

The network knows ``CODES`` buckets of word hashes, so its size is fixed. It predicts the bucket of the masked token, and the
word takes its share of the bucket, ``P(word | sides) = P(bucket | sides) * n(word) / n(bucket)``, which sums up to one over
the vocabulary. The bucket is predicted in two halves of its number, ``P(high | sides) * P(low | high, sides)``.

1. Texts are cut into tokens once and stored as 64-bit hashes.
2. Words are counted over all documents, in a task first and then by Spark. The table of words grows with the corpus and stays
   distributed; the driver sees the sums of the buckets and the words that make up more than one token in ``FREQUENT``, of
   which there are fewer than ``FREQUENT``.
3. In each round every task goes over all windows of its texts and trains a copy of the network in numpy; the copies are
   averaged by the tokens that they have seen, in pieces of the weights.
4. The network is evaluated for each token of each text, equal windows of a task's pool once. The counts of frequent words are at
   hand in the tasks, those of the others are joined, from one row for each word of a task with the documents that hold it.

A null or empty text has no tokens, score 0 and no mean. With no text at all every document scores 0. Rows that repeat another
count and score like documents of their own. A very long text is evaluated in pieces of windows. Columns other than doc_id and
text are not looked at. A word that the corpus of ``fit`` lacks counts as seen once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, LongType, StructField, StructType

from llm.tables import stored
from llm.words import steps

#: Runs of letters and digits, and any other character but white space by itself. The ranges are scripts without spaces.
TOKEN = re.compile(r"[^\W\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u2e80-\ua4cf\uf900-\ufaff\U00020000-\U0003ffff]+|\S")
#: A text with more kinds of single characters is matched token by token.
KINDS = 48
HALF_BITS = 5
HALF = 1 << HALF_BITS
CODES = HALF * HALF
#: What stands beyond the edge of a text.
EDGE = CODES
SIDE = 2
HIDDEN = 32
ROUNDS, BATCH, RATE = 2, 4096, 5e-3
#: A copy takes this many steps a round at least, going over few windows more often.
STEPS = 60
#: Windows that a task shuffles at a time.
POOL = 1 << 17
FREQUENT = 10_000
#: Distinct words that a task holds before it hands their counts on.
HELD = 1 << 20
#: Weights of one row on the way to their average.
PIECE = 4096

SHAPES = {
    "into": (2 * SIDE, CODES + 1, HIDDEN), "bias": (HIDDEN,), "high": (HIDDEN, HALF), "high_base": (HALF,),
    "low": (HALF, HIDDEN, HALF), "low_base": (HALF, HALF),
}
SIZE = sum(int(np.prod(s)) for s in SHAPES.values())


class Apart(dict):
    """What a character becomes so that blanks part the tokens, worked out when it is first asked for: itself between blanks if it is
    a token by itself, a blank if it is white space beyond ``BLANKS``, nothing (no change) otherwise."""

    def __missing__(self, c: str) -> str:
        single = TOKEN.match(c) is not None and len(TOKEN.findall(c + c)) == 2
        self[c] = value = f" {c} " if single else " " if c.isspace() and c not in BLANKS else ""
        return value


#: White space that Arrow parts words at.
BLANKS = "\t\n\v\f\r "
APART = Apart()
#: The characters of ASCII that change. Looking for each takes less time than the set of a text's characters.
ASCII = [c for c in map(chr, range(128)) if APART[c]]


def parted(text: str | None) -> str:
    """The tokens of a text with ``BLANKS`` between them, and none at either end."""
    text = (text or "").lower()
    changed = [c for c in ASCII if c in text] if text.isascii() else [c for c in set(text) if APART[c]]
    if len(changed) > KINDS:
        return " ".join(TOKEN.findall(text))
    for c in changed:  # the same tokens, in less time than a match for each takes
        text = text.replace(c, APART[c])
    return text.strip(BLANKS)


def tokens_of(text: str | None) -> list[str]:
    return parted(text).split()


def hash_of(token: str) -> int:
    return xxhash.xxh3_64_intdigest(token.encode("utf-8", "surrogatepass"))


def codes_of(words: np.ndarray) -> np.ndarray:
    """Buckets of unsigned hashes: their leading bits."""
    return (words >> np.uint64(64 - 2 * HALF_BITS)).astype(np.int16)


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in steps(batch, "text"):
            # Arrow parts the tokens and finds the different ones, which alone are hashed
            texts = pa.array([parted(text) or None for text in part.column("text").to_pylist()], pa.large_string())
            tokens = pc.ascii_split_whitespace(texts)
            ends = np.cumsum(np.append(0, tokens.value_lengths().fill_null(0).to_numpy())).tolist()
            tokens = tokens.flatten().cast(pa.large_binary()).dictionary_encode()
            hashes = map(xxhash.xxh3_64_intdigest, tokens.dictionary.to_numpy(zero_copy_only=False))
            words = np.fromiter(hashes, "<u8", len(tokens.dictionary))[tokens.indices.to_numpy()]
            out = pa.array([words[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.binary())
            yield pa.record_batch([part.column("doc_id"), part.column("row"), out], ["doc_id", "row", "words"])


def tokenised(docs: DataFrame) -> DataFrame:
    """doc_id, row (a number of its own for each row) and words (token hashes, unsigned 64-bit little-endian)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    named = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("row"))
    return stored(named.mapInArrow(_tokens, f"doc_id {kind}, row bigint, words binary"), compression="zstd")


def word_lists(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(x, "<u8") for x in column.to_pylist()]


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def folded(words: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        word, back = np.unique(np.concatenate([*words, np.zeros(0, np.uint64)]), return_inverse=True)
        return word, np.bincount(back, np.concatenate([*counts, np.zeros(0)]), len(word)).astype(np.int64)

    def rows(word: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(word), 1 << 16):
            yield pa.record_batch([pa.array(word[at : at + (1 << 16)].view(np.int64)), pa.array(n[at : at + (1 << 16)])], ["word", "n"])

    words, counts, fresh, held = [], [], [], 0
    for batch in batches:
        for x in word_lists(batch.column("words")):
            fresh.append(x)
            held += len(x)
            if held > HELD:
                word, n = np.unique(np.concatenate(fresh), return_counts=True)
                word, n = folded([*words, word], [*counts, n])
                words, counts, fresh, held = [word], [n], [], 0
                if len(word) > HELD:
                    yield from rows(word, n)
                    words, counts = [], []
    if fresh:
        word, n = np.unique(np.concatenate(fresh), return_counts=True)
        words, counts = [*words, word], [*counts, n]
    yield from rows(*folded(words, counts))


def word_counts(tokens: DataFrame) -> DataFrame:
    """word (signed hash) and n of every word."""
    return stored(tokens.select("words").mapInArrow(_counts, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n")))


def windows_of(lists: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Codes on either side of every token [2 * SIDE, token], left to right, and its own; texts do not see each other."""
    size = np.array([len(x) for x in lists], np.int64)
    edge = np.full(SIDE, EDGE, np.int16)
    flat_codes = np.concatenate([edge, *(y for x in lists for y in (codes_of(x), edge))])
    at = np.arange(size.sum()) + SIDE * (1 + np.repeat(np.arange(len(lists)), size))
    moves = [*range(-SIDE, 0), *range(1, SIDE + 1)]
    return np.stack([flat_codes[at + m] for m in moves]), flat_codes[at]


def distinct(context: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One place of each different window, by target, and for each window which of these is its like."""
    key = target.astype(np.int64)
    for side in context:
        key *= EDGE + 1
        key += side
    order = np.argsort(key)
    key = np.take(key, order)
    new = np.concatenate([[True], key[1:] != key[:-1]])[: len(key)]
    which = np.empty(len(key), np.int64)
    which[order] = np.cumsum(new) - 1
    return order[new], which


Net = dict[str, np.ndarray]


def shaped(values: np.ndarray) -> Net:
    """Views of a vector of weights."""
    cuts = np.cumsum([int(np.prod(s)) for s in SHAPES.values()])[:-1]
    return {k: v.reshape(s) for (k, s), v in zip(SHAPES.items(), np.split(values, cuts), strict=True)}


def fresh(totals: np.ndarray) -> np.ndarray:
    """Weights that begin at the frequencies of the buckets, of which ``totals`` are the tokens."""
    random = np.random.Generator(np.random.PCG64(11))
    values = (random.standard_normal(SIZE) * 0.1).astype(np.float32)
    net, seen = shaped(values), totals.reshape(HALF, HALF) + 0.5
    net["bias"][:] = 0
    net["high_base"][:] = np.log(seen.sum(1) / seen.sum())
    net["low_base"][:] = np.log(seen / seen.sum(1, keepdims=True))
    return values


#: Weights that are worked on at a time, so that they stay in a core's cache.
STRIP = 1 << 15
#: Logits within this distance of 0 need no shift before ``exp``.
SAFE = 60.0
#: Places of the weights of each code in one position of ``into``, taken as pairs.
PLACES = np.arange((CODES + 1) * HIDDEN // 2).reshape(CODES + 1, HIDDEN // 2)


class Layers:
    """The network over batches of at most ``size`` windows, in memory that is taken once.

    Each upper half has one matrix: the weights of the upper halves beside those of the lower halves below it, and under both
    their bases, which a last input of 1 adds.
    """

    def __init__(self, net: Net, size: int):
        self.net, dtype = net, net["bias"].dtype
        self.heads, self.slopes = np.empty((2, HALF, HIDDEN + 1, 2 * HALF), dtype)
        self.hidden, self.room, self.back = np.empty((3, size, HIDDEN), dtype)
        self.inputs, self.ones = np.ones((size, HIDDEN + 1), dtype), np.ones(max(size, HALF), dtype)
        self.logits, self.starts = np.empty((size, 2 * HALF), dtype), np.arange(size) * (2 * HALF)
        self.pair, self.places = np.result_type(dtype, np.complex64), np.empty((size, HIDDEN // 2), np.int64)
        self.values = np.empty(SIZE, dtype)
        self.out = shaped(self.values)
        self.changed()

    def changed(self) -> None:
        """Take over the weights."""
        heads, net = self.heads, self.net
        heads[:, :HIDDEN, :HALF], heads[:, :HIDDEN, HALF:] = net["high"], net["low"]
        heads[:, HIDDEN, :HALF], heads[:, HIDDEN, HALF:] = net["high_base"], net["low_base"]
        # the hidden layer lies between -1 and 1
        self.safe = bool(np.abs(heads, out=self.slopes).sum(1).max() < SAFE)

    def forward(self, context: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int, int]], np.ndarray]:
        """For targets in ascending order: hidden layer, logits of upper halves and, beside them, of lower ones below the target's upper
        half, rows of each upper half that occurs (half, first, last + 1), and places of the target's two in the flat logits."""
        n, into = len(target), self.net["into"]
        hidden, room, inputs, logits = self.hidden[:n], self.room[:n], self.inputs[:n], self.logits[:n]
        np.take(into[0], context[0], axis=0, out=hidden, mode="clip")
        for p in range(1, 2 * SIDE):
            hidden += np.take(into[p], context[p], axis=0, out=room, mode="clip")
        hidden += self.net["bias"]
        # tanh by exp, which takes half the time
        hidden *= 2
        with np.errstate(over="ignore"):
            np.exp(hidden, out=hidden)
        hidden += 1
        np.divide(-2, hidden, out=hidden)
        hidden += 1
        inputs[:, :HIDDEN] = hidden
        high = target >> HALF_BITS
        cuts = np.searchsorted(high, np.arange(HALF + 1, dtype=high.dtype)).tolist()
        runs = [(k, a, b) for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if b > a]
        for k, a, b in runs:
            np.dot(inputs[a:b], self.heads[k], out=logits[a:b])  # less to set up than matmul
        if not self.safe:
            halves = logits.reshape(-1, HALF)
            halves -= halves.max(1, keepdims=True)
        starts = self.starts[:n]
        return hidden, logits, runs, np.stack([starts + high, starts + (target & (HALF - 1)) + HALF])

    def logs(self, context: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Log-probabilities of targets in ascending order."""
        _, logits, _, places = self.forward(context, target)
        chosen = np.take(logits, places).sum(0)
        np.exp(logits, out=logits)
        return chosen - np.log(logits.reshape(-1, HALF) @ self.ones[:HALF]).reshape(-1, 2).sum(1)

    def gradient(self, context: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Of the mean negative log-probability of the targets, which ascend, as a vector that the next call overwrites."""
        n, out = len(target), self.out
        hidden, wrong, runs, places = self.forward(context, target)
        inputs = self.inputs[:n]
        np.exp(wrong, out=wrong)
        halves = wrong.reshape(-1, HALF)
        halves *= ((1 / n) / (halves @ self.ones[:HALF]))[:, None]
        wrong.reshape(-1)[places] -= 1 / n
        back, slopes = self.back[:n], self.slopes
        if len(runs) < HALF:
            slopes[:] = 0
        for k, a, b in runs:
            np.dot(inputs[a:b].T, wrong[a:b], out=slopes[k])
            np.dot(wrong[a:b], self.heads[k, :HIDDEN].T, out=back[a:b])
        out["high"][:], out["low"][:] = slopes[:, :HIDDEN, :HALF].sum(0), slopes[:, :HIDDEN, HALF:]
        out["high_base"][:], out["low_base"][:] = slopes[:, HIDDEN, :HALF].sum(0), slopes[:, HIDDEN, HALF:]
        hidden *= hidden
        back *= np.subtract(1, hidden, out=hidden)
        out["bias"][:] = self.ones[:n] @ back
        # sums of rows by code; a complex number adds two weights at a time
        at, rows = self.places[:n].reshape(-1), back.reshape(-1).view(self.pair)
        out["into"][:] = 0
        for sums, codes in zip(out["into"].reshape(2 * SIDE, -1).view(self.pair), context, strict=True):
            np.take(PLACES, codes, axis=0, out=self.places[:n], mode="clip")
            np.add.at(sums, at, rows)
        return self.values


def log_probabilities(net: Net, context: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Of the targets, in any order."""
    one, which = distinct(context, target)
    context, target = np.take(context, one, axis=1), target[one]
    logs, layers = np.empty(len(one)), Layers(net, min(BATCH, len(one)))
    for at in range(0, len(one), BATCH):
        logs[at : at + BATCH] = layers.logs(context[:, at : at + BATCH], target[at : at + BATCH])
    return logs[which]


def gradient(net: Net, context: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Of the mean negative log-probability of the targets, which ascend, as a vector."""
    return Layers(net, len(target)).gradient(context, target)


class Copy:
    """A copy of the network under training (Adam), fed with windows."""

    def __init__(self, weights: np.ndarray, seed: int):
        self.values = weights.copy()
        self.layers = Layers(shaped(self.values), BATCH)
        self.mean, self.square, self.size = np.zeros_like(weights), np.zeros_like(weights), np.empty_like(weights)
        self.random, self.turn, self.seen = np.random.Generator(np.random.PCG64(seed)), 0, 0

    def over(self, context: np.ndarray, target: np.ndarray) -> None:
        order = self.random.permutation(len(target))
        for at in range(0, len(order), BATCH):
            pick = order[at : at + BATCH]
            pick = pick[np.argsort(target[pick], kind="stable")]
            slope = self.layers.gradient(np.take(context, pick, axis=1), target[pick])
            self.turn += 1
            for strip in range(0, SIZE, STRIP):
                self.step(slice(strip, strip + STRIP), slope)
            self.layers.changed()

    def step(self, strip: slice, slope: np.ndarray) -> None:
        """``mean`` holds ten times Adam's first moment and ``square`` a hundred times its second, which saves two products."""
        mean, square, slope, size = self.mean[strip], self.square[strip], slope[strip], self.size[strip]
        root = (0.01 / (1 - 0.99**self.turn)) ** 0.5
        mean *= 0.9
        mean += slope
        slope *= slope
        square *= 0.99
        square += slope
        np.sqrt(square, out=size)
        size += 1e-8 / root
        np.divide(mean, size, out=size)
        size *= 0.1 * RATE / (1 - 0.9**self.turn) / root
        self.values[strip] -= size


def _train(weights: np.ndarray, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        copy, held, n = Copy(weights, seed), [], 0
        for batch in batches:
            for x in word_lists(batch.column("words")):
                held.append(x)
                n += len(x)
                if n >= POOL:
                    copy.over(*windows_of(held))
                    copy.seen += n
                    held, n = [], 0
        if n:
            few = windows_of(held)
            copy.over(*few)
            copy.seen += n
            while copy.turn < STEPS:
                copy.over(*few)
        if copy.seen:
            pieces = range(0, SIZE, PIECE)
            sums = [(copy.values[at : at + PIECE].astype(np.float64) * copy.seen).tobytes() for at in pieces]
            yield pa.record_batch([pa.array(list(pieces), pa.int32()), pa.array(sums, pa.binary()), pa.array([copy.seen] * len(sums), pa.int64())], ["at", "sums", "seen"])

    return run


def _average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the pieces of one partition, of which it has no more than the weights have."""
    sums: dict[int, np.ndarray] = {}
    seen: dict[int, int] = {}
    for batch in batches:
        for at, values, n in zip(*(batch.column(k).to_pylist() for k in ("at", "sums", "seen")), strict=True):
            sums[at] = sums.get(at, 0) + np.frombuffer(values, np.float64)
            seen[at] = seen.get(at, 0) + n
    out = [(sums[at] / seen[at]).astype(np.float32).tobytes() for at in sums]
    yield pa.record_batch([pa.array(list(sums), pa.int32()), pa.array(out, pa.binary())], ["at", "values"])


@dataclass
class Model:
    """Words of the corpus (word, n), tokens of each bucket, hashes and counts of frequent words, weights."""

    words: DataFrame
    totals: np.ndarray
    frequent: np.ndarray
    counts: np.ndarray
    weights: np.ndarray


def fit_tokens(tokens: DataFrame) -> Model:
    words = word_counts(tokens)
    totals = np.zeros(CODES, np.int64)
    code = F.shiftrightunsigned("word", 64 - 2 * HALF_BITS).cast("int")
    for r in words.groupBy(code.alias("code")).agg(F.sum("n").alias("n")).collect():  # CODES rows at most
        totals[r["code"]] = r["n"]
    often = words.filter(F.col("n") * FREQUENT > int(totals.sum())).collect()  # fewer than FREQUENT rows
    frequent = np.array([r["word"] for r in often], np.int64).view(np.uint64)
    order = np.argsort(frequent)
    counts = np.array([r["n"] for r in often], np.int64)[order]
    weights = fresh(totals)
    for turn in range(ROUNDS):
        trained = tokens.select("words").mapInArrow(_train(weights, turn), "at int, sums binary, seen bigint")
        pieces = trained.repartition("at").mapInArrow(_average, "at int, values binary").collect()  # the weights once
        weights = weights.copy()
        for r in pieces:
            weights[r["at"] : r["at"] + PIECE] = np.frombuffer(r["values"], np.float32)
    return Model(words, totals, frequent[order], counts, weights)


def fit(docs: DataFrame) -> Model:
    """Word counts and network of all texts of ``docs``."""
    return fit_tokens(tokenised(docs))


def _score(model: tuple[np.ndarray, ...], schema: pa.Schema):
    """One row for each document (``is_word`` false, no word, its row as the only one in ``rows``) and one for each word that is not
    frequent and up to ``HELD`` of its places (the rows of the documents that hold it, as often as they do)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, totals, frequent, counts = model
        net, log_totals = shaped(weights), np.log(np.maximum(totals, 1))
        log_counts = np.log(np.append(counts, 1))
        words, owners, held = [], [], 0
        for batch in batches:
            lists, rows = word_lists(batch.column("words")), batch.column("row").to_numpy()
            sizes = np.array([len(x) for x in lists], np.int64)
            cuts = np.searchsorted(np.cumsum(sizes), np.arange(0, int(sizes.sum()) + POOL, POOL), "left").tolist()
            for a, b in zip([0, *cuts[1:]], [*cuts[1:], len(lists)], strict=True):
                if b > a:
                    total, word, owner = part(lists[a:b], sizes[a:b], rows[a:b], net, frequent, log_totals, log_counts)
                    yield documents(batch.slice(a, b - a), rows[a:b], sizes[a:b], total)
                    words.append(word)
                    owners.append(owner)
                    held += len(word)
                    if held > HELD:
                        yield from places(words, owners)
                        words, owners, held = [], [], 0
        if held:
            yield from places(words, owners)

    def part(lists, size, rows, net, frequent, log_totals, log_counts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of some documents: sums of what is known of their tokens, and the other words with the rows that hold them."""
        context, target = windows_of(lists)
        logs = log_probabilities(net, context, target)
        words, owner = np.concatenate([*lists, np.zeros(0, np.uint64)]), np.repeat(np.arange(len(lists)), size)
        place = np.searchsorted(frequent, words)
        common = np.zeros(len(words), bool)
        inside = place < len(frequent)
        common[inside] = frequent[place[inside]] == words[inside]
        logs += np.where(common, log_counts[np.where(common, place, -1)], 0.0) - log_totals[target]
        return np.bincount(owner, logs, len(lists)).astype(np.float64), words[~common], rows[owner[~common]]

    def documents(batch, rows, size, total) -> pa.RecordBatch:
        n = len(rows)
        one = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32)), pa.array(rows))
        return pa.record_batch([pa.array(rows), pa.array([False] * n), one, batch.column("doc_id"), pa.array(size), pa.array(total)], schema=schema)

    def places(words: list[np.ndarray], owners: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        word, owner = np.concatenate(words), np.concatenate(owners)
        order = np.argsort(word)
        word, owner = word[order], owner[order]
        begins = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        ends = np.append(begins[1:], len(word))
        for a in range(0, len(begins), 1 << 14):
            first, last = begins[a : a + (1 << 14)], ends[a : a + (1 << 14)]
            offsets = np.append(first, last[-1]) - first[0]
            held = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(owner[first[0] : last[-1]]))
            n = len(first)
            rest = [pa.nulls(n, schema.field(c).type) for c in ("doc_id", "n_tokens", "known")]
            yield pa.record_batch([pa.array(word[first].view(np.int64)), pa.array([True] * n), held, *rest], schema=schema)

    return run


def parts(tokens: DataFrame, model: Model) -> DataFrame:
    """What tasks find out by themselves of documents and of words, as ``_score`` says."""
    kind = tokens.schema["doc_id"].dataType
    plain = (model.weights, model.totals, model.frequent, model.counts)
    columns = StructType([
        StructField("word", LongType()), StructField("is_word", BooleanType()), StructField("rows", ArrayType(LongType())),
        StructField("doc_id", kind), StructField("n_tokens", LongType()), StructField("known", DoubleType()),
    ])
    return tokens.mapInArrow(_score(plain, to_arrow_schema(columns)), columns)


def score_tokens(tokens: DataFrame, model: Model) -> DataFrame:
    # none of these words makes up more than one token in FREQUENT; one that fit() has not seen counts as 1. Documents travel by their
    # row and meet no word
    counts = model.words.select("word", F.lit(True).alias("is_word"), F.log("n").alias("log_n"))
    found = parts(tokens, model).join(counts, ["word", "is_word"], "left")
    each = found.select(F.explode("rows").alias("row"), "doc_id", "n_tokens", "known", "log_n")
    whole = each.groupBy("row").agg(
        F.first("doc_id", ignorenulls=True).alias("doc_id"), F.max("n_tokens").alias("n_tokens"),
        (F.max("known") + F.coalesce(F.sum("log_n"), F.lit(0.0))).alias("log_prob"),
    )
    whole = whole.select("doc_id", "n_tokens", "log_prob")
    return whole.withColumn("mean_log_prob", F.when(F.col("n_tokens") > 0, F.col("log_prob") / F.col("n_tokens")))


def score(docs: DataFrame, model: Model) -> DataFrame:
    return score_tokens(tokenised(docs), model)


def score_corpus(docs: DataFrame) -> DataFrame:
    """doc_id, n_tokens, log_prob and mean_log_prob of every document, by a network fitted on the same documents."""
    tokens = tokenised(docs)
    return score_tokens(tokens, fit_tokens(tokens))
