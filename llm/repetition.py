"""Quality rules on repetition, from suffix arrays of words.

Per text the suffixes of its word sequence are sorted by prefix doubling (all texts of a step at once, the text being the
first sort key) and the common prefix of neighbours follows from the ranks kept at each doubling. A suffix's longest repeat
is the larger of its two neighbouring common prefixes: the depth of the innermost common-prefix interval it lies in. The
spans of all repeats of at least ``MIN_REPEAT`` words are united; the method's verdict limits the share of word characters
they cover and the longest of them.

Null or empty texts have no words and fail the base rules; ties do not matter, as equal suffixes share their prefix.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from llm.words import Words, steps, text_parts, words_of

MIN_WORDS = 50
MIN_REPEAT = 10
MAX_COVERED = 0.3
MAX_REPEAT_SHARE = 0.2

SYMBOL = np.zeros(256, bool)
SYMBOL[list(b"#*$%&|<>")] = True
ASCII_SPACE = " \t\n\x0b\x0c\r"

SCHEMA = (
    "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "base_failed boolean, kept boolean, covered double, longest_repeat bigint"
)


def _classes(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of ``keys``, and for each place in it the place at which its run of equal keys begins."""
    order = np.argsort(keys)
    ordered = keys[order]
    begins = np.arange(len(keys))
    begins[1:][ordered[1:] == ordered[:-1]] = 0
    return order, np.maximum.accumulate(begins)


def longest_repeats(symbols: np.ndarray, text: np.ndarray, room: np.ndarray) -> np.ndarray:
    """For each position the length of the longest run of symbols that starts there and at another place of its text.

    ``symbols`` are small ids, ``text`` the text of each position (ascending), ``room`` the symbols left in the text.
    A rank is the place in the suffix order at which the suffixes that look alike so far begin, so a class is split in
    place. Classes of two or more hold no suffix that has ended, as two suffixes of one text differ in length.
    """
    n = len(symbols)
    if n < 2:
        return np.zeros(n, np.int64)
    order, begins = _classes(text * (int(symbols.max()) + 1) + symbols)
    rank = np.empty(n, np.int64)
    rank[order] = begins
    levels, width = [rank], 1
    alike = np.bincount(rank, minlength=n)[rank] > 1
    open_ = np.flatnonzero(alike)
    while len(open_):
        inside = room[open_] > width
        follow = np.zeros(len(open_), np.int64)  # 0: the text has ended
        follow[inside] = rank[open_[inside] + width] + 1
        order, begins = _classes(rank[open_] * (n + 1) + follow)
        at = open_[order]
        old = rank[at]
        first = np.arange(len(at))
        first[1:][old[1:] == old[:-1]] = 0
        rank = rank.copy()
        rank[at] = old + begins - np.maximum.accumulate(first)
        levels.append(rank)
        width *= 2
        open_ = at[np.bincount(begins, minlength=len(at))[begins] > 1]
    order = np.argsort(rank)
    a, b = order[:-1].copy(), order[1:].copy()
    shared = np.zeros(n - 1, np.int64)
    for level in range(len(levels) - 2, -1, -1):  # no two suffixes are alike at the last level
        live = np.flatnonzero((a < n) & (b < n))
        live = live[levels[level][a[live]] == levels[level][b[live]]]
        shared[live] += 1 << level
        a[live] += 1 << level
        b[live] += 1 << level
    longest = np.zeros(n, np.int64)
    longest[order[:-1]] = shared
    longest[order[1:]] = np.maximum(longest[order[1:]], shared)
    return longest


def covered(lengths: np.ndarray, least: int, span: int | None = None) -> np.ndarray:
    """Positions within a run that starts where ``lengths`` is ``least`` or more: ``lengths`` long, or ``span``."""
    n = len(lengths)
    starts = np.flatnonzero(lengths >= least)
    change = np.zeros(n + 1, np.int64)
    change[starts] += 1
    np.add.at(change, starts + (lengths[starts] if span is None else span), -1)
    return np.cumsum(change[:-1]) > 0


def per_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(values)])
    return sums[first[1:]] - sums[first[:-1]]


def repeated_lines(text: str | None) -> int:
    if not text:
        return 0
    lines = [x for x in text.split("\n") if x.strip(ASCII_SPACE)]
    return len(lines) - len(set(lines))


def measure(part: pa.RecordBatch) -> dict[str, np.ndarray]:
    words: Words = words_of(part.column("text"))
    raw, offsets = text_parts(part.column("text"))
    first, n_words = words.first, words.counts
    text = np.repeat(np.arange(len(n_words)), n_words)
    # code points of a word: its bytes but for continuation bytes
    heads = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    chars = heads[words.ends] - heads[words.starts]
    order, begins = _classes(words.hashes())
    symbols = np.empty(len(text), np.int64)
    symbols[order] = begins
    room = first[1:][text] - np.arange(len(text))
    lengths = longest_repeats(symbols, text, room)
    within = covered(lengths, MIN_REPEAT)
    word_chars = per_text(chars, first)
    share = per_text(chars * within, first) / np.maximum(word_chars, 1)
    longest = np.zeros(len(n_words), np.int64)
    np.maximum.at(longest, text, lengths)
    repeat_words = per_text(covered(lengths, 3, 3).astype(np.int64), first)
    symbol_sums = np.concatenate([[0], np.cumsum(SYMBOL[raw])])
    failed = (n_words < MIN_WORDS) | (100 * repeat_words > 50 * n_words)
    return {
        "n_words": n_words, "word_chars": word_chars, "n_symbols": symbol_sums[offsets[1:]] - symbol_sums[offsets[:-1]],
        "n_dup_lines": np.array([repeated_lines(t) for t in part.column("text").to_pylist()], np.int64),
        "n_repeat_words": repeat_words, "base_failed": failed,
        "kept": ~failed & (share <= MAX_COVERED) & (longest <= np.maximum(MAX_REPEAT_SHARE * n_words, MIN_REPEAT)),
        "covered": share, "longest_repeat": longest,
    }


def _run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in steps(batch, "text"):
            found = measure(part)
            yield pa.record_batch([part.column("doc_id"), *map(pa.array, found.values())], ["doc_id", *found])


def repetition_rules(docs: DataFrame) -> DataFrame:
    """Counts, base rules and verdict per document; see the module for the rules. Other columns are left behind."""
    return docs.select("doc_id", "text").mapInArrow(_run, SCHEMA)
