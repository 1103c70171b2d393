"""Language identification by cross-parsing.

For each language a suffix automaton of labelled text tells how far any string goes on as a substring of that text. A
document is parsed into phrases, each the longest match in the text plus a new start; the fewer phrases a language needs
for each letter, the closer it is. Text is lower-cased; runs of other characters than letters are one space.

Documents are cut into pieces of ``PIECE`` symbols, all of which are parsed in step, and phrases are summed per document,
so the whole text counts and a very long text is no long loop. A null text, or one without a letter, gets ``und`` and score
0. Ties go to the language that sorts first. With no labelled text at all every document gets ``und``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.words import steps

#: Bounds of the labelled sample: documents a language, length of a document that is taken whole, symbols of text a language.
SAMPLE_DOCS = 200
SAMPLE_LENGTH = 20_000
SAMPLE_SPAN = 2_000  # characters that a longer text gives
SAMPLE_SYMBOLS = 25_000
LETTERS = 61  # letters of a language that fit a dense table; with space, other letters and padding 64
SPACE, OTHER, PAD, WIDTH = 0, 62, 63, 64
PIECE = 512
UNKNOWN = "und"


@lru_cache(maxsize=1)
def _is_letter() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)


def letter_runs(points: np.ndarray) -> np.ndarray:
    """Letters stay; each run of other characters becomes one 0."""
    out = np.where(_is_letter()[points], points, 0)
    return out[np.concatenate([[True], (out[1:] != 0) | (out[:-1] != 0)])] if len(out) else out


def suffix_automaton(symbols: list[int]) -> np.ndarray:
    """Transitions [state, symbol] of the smallest automaton that reads all substrings; -1: none. State 0 begins.

    The table is filled in place: an automaton of n symbols has fewer than 2 * n + 2 states.
    """
    table = np.full((2 * len(symbols) + 2, WIDTH), -1, np.int32)
    link, depth = [-1], [0]
    last = 0
    for s in symbols:
        column = table[:, s]
        new = len(link)
        link.append(0)
        depth.append(depth[last] + 1)
        at = last
        while at >= 0 and column[at] < 0:
            column[at] = new
            at = link[at]
        if at >= 0:
            onto = int(column[at])
            if depth[onto] != depth[at] + 1:
                twin = len(link)
                table[twin] = table[onto]
                link.append(link[onto])
                depth.append(depth[at] + 1)
                link[onto] = twin
                while at >= 0 and column[at] == onto:
                    column[at] = twin
                    at = link[at]
                onto = twin
            link[new] = onto
        last = new
    return table[: len(link)]


def parser(symbols: list[int]) -> np.ndarray:
    """One entry for each state and symbol: next state times WIDTH times 4, plus the phrases that end (0 to 2)."""
    table = suffix_automaton(symbols)
    start = np.maximum(table[0], 0) * (WIDTH * 4)
    lost = (table[0] < 0).astype(np.int32)  # a symbol that the text lacks is a phrase of its own
    out = np.where(table >= 0, table * np.int32(WIDTH * 4), start + 1 + lost)
    out[0] -= table[0] < 0
    out[:, PAD] = np.arange(len(table)) * (WIDTH * 4)
    return out.reshape(-1)


def transitions(symbols: list[int]) -> list[dict[int, int]]:
    """What ``suffix_automaton`` has, as a dictionary for each state; for any alphabet."""
    table: list[dict[int, int]] = [{}]
    link, depth = [-1], [0]
    last = 0
    for s in symbols:
        new = len(table)
        table.append({})
        link.append(0)
        depth.append(depth[last] + 1)
        at = last
        while at >= 0 and s not in table[at]:
            table[at][s] = new
            at = link[at]
        if at >= 0:
            onto = table[at][s]
            if depth[onto] != depth[at] + 1:
                twin = len(table)
                table.append(dict(table[onto]))
                link.append(link[onto])
                depth.append(depth[at] + 1)
                link[onto] = twin
                while at >= 0 and table[at].get(s) == onto:
                    table[at][s] = twin
                    at = link[at]
                onto = twin
            link[new] = onto
        last = new
    return table


class Dense:
    """Parses texts whose columns are symbols of a language with up to ``LETTERS`` letters."""

    other, pad = OTHER, PAD

    def __init__(self, symbols: list[int]):
        self.step = parser(symbols)

    def ended(self, columns: np.ndarray) -> np.ndarray:
        state, ended = (np.zeros(columns.shape[1], np.int32) for _ in range(2))
        for symbol in columns:
            state = self.step[state + symbol]
            ended += state & 3
            state >>= 2
        return ended + (state > 0)


class Sparse:
    """The same for more letters: transitions are looked up in a sorted table."""

    def __init__(self, symbols: list[int]):
        table = transitions(symbols)
        self.other = max(symbols) + 1
        self.pad, self.width = self.other + 1, self.other + 2
        pairs = sorted((state * self.width + s, to) for state, row in enumerate(table) for s, to in row.items())
        self.keys, self.to = np.array([k for k, _ in pairs]), np.array([t for _, t in pairs])
        self.start = np.zeros(self.width, np.int64)
        self.start[list(table[0])] = list(table[0].values())

    def ended(self, columns: np.ndarray) -> np.ndarray:
        state, ended = (np.zeros(columns.shape[1], np.int64) for _ in range(2))
        for symbol in columns:
            key = state * self.width + symbol
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            start, on, text = self.start[symbol], self.keys[at] == key, symbol != self.pad
            ended += text & ~on & (state > 0)
            ended += text & ~on & (start == 0)  # a symbol that the text lacks is a phrase of its own
            state = np.where(text, np.where(on, self.to[at], start), state)
        return ended + (state > 0)


class Model:
    """Parsers of all languages, each over an alphabet of its own: every letter of its sample."""

    def __init__(self, sample: tuple[tuple[str, str], ...]):
        self.languages = [x for x, _ in sample]
        runs = [letter_runs(code_points(t))[:SAMPLE_SYMBOLS] for _, t in sample]
        found = np.unique(np.concatenate([*runs, np.zeros(0, np.uint32)]))
        letters = found[found > 0]
        # documents are in symbols of all languages: space, letters, other letters, padding
        self.other, self.pad = len(letters) + 1, len(letters) + 2
        self.code = np.full(0x110000, self.other, np.min_scalar_type(self.pad))
        self.code[letters] = 1 + np.arange(len(letters))
        self.code[0] = SPACE
        self.parsers = []
        for r in runs:
            symbols = self.code[r]
            own = np.unique(symbols[symbols > 0])
            to_own = np.full(self.pad + 1, len(own) + 1, np.uint16)
            to_own[own] = 1 + np.arange(len(own))
            to_own[SPACE] = SPACE
            one = (Dense if len(own) <= LETTERS else Sparse)(to_own[symbols].tolist())
            to_own[to_own == len(own) + 1] = one.other
            to_own[self.pad] = one.pad
            self.parsers.append((to_own, one))

    def phrases(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Phrases [language, text], symbols of each text, and whether it has a letter."""
        runs = [letter_runs(code_points(t)) for t in texts]
        size = np.array([len(r) for r in runs], np.int64)
        lettered = np.array([bool(r.any()) for r in runs], bool)
        pieces = -(-size // PIECE)
        owner = np.repeat(np.arange(len(runs)), pieces)
        total = np.zeros((len(self.parsers), len(runs)), np.int64)
        if not len(owner):
            return total, size, lettered
        flat = np.full((len(owner), PIECE), self.pad, self.code.dtype)
        row = np.cumsum(pieces) - pieces
        view = flat.reshape(-1)
        for r, n, at in zip(runs, size, row, strict=True):
            view[at * PIECE : at * PIECE + n] = self.code[r]
        columns = np.ascontiguousarray(flat.T)
        for k, (to_own, one) in enumerate(self.parsers):
            total[k] = np.bincount(owner, weights=one.ended(to_own[columns]), minlength=len(runs))
        return total, size, lettered

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        texts = [t or "" for t in texts]
        total, size, lettered = self.phrases(texts)
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        rate = total / np.maximum(size, 1)
        order = np.argsort(rate, axis=0, kind="stable")
        best = np.take_along_axis(rate, order[:1], 0)[0]
        second = np.take_along_axis(rate, order[1:2], 0)[0] if len(rate) > 1 else np.ones(len(texts))
        score = np.where(lettered, np.clip(1 - best / np.maximum(second, 1e-12), 0, 1), 0.0)
        return [self.languages[k] if ok else UNKNOWN for k, ok in zip(order[0], lettered, strict=True)], score


@lru_cache(maxsize=1)
def model(sample: tuple[tuple[str, str], ...]) -> Model:
    return Model(sample)


def labelled_sample(docs: DataFrame, usable: Column) -> tuple[tuple[str, str], ...]:
    """Language and joined texts of about ``SAMPLE_DOCS`` documents of each language, chosen by a hash of doc_id.

    Counts come first, so that a hash limit picks the sample while the table is scanned and nothing large is moved.
    """
    fit = docs.filter(usable & F.col("lang").isNotNull()).filter(F.length(F.trim("text")) > 0)
    counts = {r["lang"]: r["n"] for r in fit.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return ()
    place = F.conv(F.substring(F.md5(F.col("doc_id").cast("string")), 1, 8), 16, 10).cast("double") / float(1 << 32)
    share = F.create_map(*[x for k, n in sorted(counts.items()) for x in (F.lit(k), F.lit(SAMPLE_DOCS / n))])
    span = F.when(F.length("text") > SAMPLE_LENGTH, F.substring(F.trim("text"), 1, SAMPLE_SPAN)).otherwise(F.col("text"))
    rows = fit.withColumn("_place", place).filter(F.col("_place") < share[F.col("lang")]).select("lang", "_place", "doc_id", span.alias("text")).collect()
    rows.sort(key=lambda r: (r["lang"], r["_place"], r["doc_id"]))
    return tuple((k, "\n".join(r["text"] for r in rows if r["lang"] == k)) for k in sorted({r["lang"] for r in rows}))


def _predict(sample: tuple[tuple[str, str], ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = model(sample)
        for batch in batches:
            for part in steps(batch, "text"):
                names, score = fitted.predict(part.column("text").to_pylist())
                yield pa.record_batch([*part.columns, pa.array(names, pa.string()), pa.array(score)], [*part.schema.names, "lang_pred", "score"])

    return run


def identify(docs: DataFrame, sample: tuple[tuple[str, str], ...]) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (how far the second language is behind, 0 to 1); predictions look at
    ``text`` alone. Columns of these names in ``docs`` are replaced."""
    docs = docs.drop("lang_pred", "score")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(_predict(sample), f"{fields}, lang_pred string, score double")


def held_out() -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2


def held_out_languages(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score; the model learns from documents that are not held out."""
    known = labelled_sample(docs, ~held_out())
    found = identify(docs.select("doc_id", "text"), known)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
