"""Encoding and decoding with a public word-level BPE vocabulary, by speculation and verification.

For each distinct word a greedy longest-match walk proposes tokens; all adjacent pairs are then checked at once for
*compatibility*: a pair is compatible if no merge across its border would have come before the merges that build the
two tokens. A word whose tokens can all be built and whose pairs are all compatible is encoded; only the others go
through exact merging. Texts are whole; a null text counts as empty and has no ids. Rows that repeat others or have no
doc_id count for themselves, an empty table gives no rows, and words may be of any length: those of over ``LONG`` bytes are
proposed from all their places at once and merged with a heap, in time about proportional to their length.

Rules of the vocabulary file (fixed by its ``normalizer`` and ``pre_tokenizer``): special tokens are cut out of the raw
text first, then NFC, lower case, and the split into contractions, letter runs, single digits and other runs.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.words import steps

#: Unicode's White_Space, as the vocabulary's pattern understands \s.
WHITE_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PIECES = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{WHITE_SPACE}\p{{L}}\p{{N}}]+")
# Letters and digits of Unicode versions after the one the vocabulary's tokenizer was built with (it takes
# them as other characters), and capital letters younger than Python's tables.
LATE_RANGES = (
    "558 58b-58c 88f c5c cdc 208f 209d-209f a7ce-a7cf a7d2 a7d4 a7dd a7e2 a7f1 ab6c-ab6d 107bb-107bf 10940-10959 10ec5-10ec7 "
    "10ed9-10eee 11b0a 11db0-11ddb 11de0-11de9 11df1 1246f 12475-1247f 12550-12686 16ea0-16eb8 16ebb-16ed3 16ff2-16ff6 187f8-187ff "
    "18cd6-18cda 18d09-18d20 18d80-18df2 18e00-19191 191a0-191d2 1b123-1b128 1b168 1d6a6 1df1f-1df24 1df2b-1df81 1df90-1df96 "
    "1dfcd-1dfff 1e6c0-1e6de 1e6e0-1e6e2 1e6e4-1e6e5 1e6e7-1e6ed 1e6f0-1e6f4 1e6fe-1e6ff 2b73a-2b73f 2b81e 2cea2-2cead 323b0-33479 "
    "3d000-3fc3f"
)
LATE_CAPITALS = {
    0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5, 0xA7DA: 0xA7DB, 0xA7DC: 0x19B,
    **{c: c + 32 for c in range(0x10D50, 0x10D66)}, **{c: c + 27 for c in range(0x16EA0, 0x16EB9)},
}
_late = "".join("-".join(rf"\U{int(x, 16):08x}" for x in r.split("-")) for r in LATE_RANGES.split())
LATE = regex.compile(f"[{_late}]")
LATE_PIECES = regex.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}--[{_late}]]+|[\p{{N}}--[{_late}]]|(?:[^{WHITE_SPACE}\p{{L}}\p{{N}}]|[{_late}])+", regex.V1
)
#: Words, and bytes of them, that a task remembers before it starts anew; bounds memory only.
REMEMBERED, REMEMBERED_BYTES = 60_000, 32 << 20
WORD_END = "</w>"
#: Words of more bytes are not taken side by side with others. Results are the same.
LONG = 200
#: Places of a long word that are walked at once; bounds memory only.
PLACES = 1 << 18
NEVER = np.iinfo(np.int32).max


def byte_letters() -> list[str]:
    """The printable stand-in of every byte: printable Latin-1 stands for itself, the rest is moved up from U+0100."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    moved = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(moved)) for b in range(256)]


class Vocabulary:
    """Tokens as symbol strings: symbols 0 to 255 are bytes, 256 more stands for the last byte of a word."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        ids = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.text = [""] * (max([*ids.values(), *self.special.values()]) + 1)
        for token, at in [*ids.items(), *self.special.items()]:
            self.text[at] = token
        to_byte = {c: b for b, c in enumerate(byte_letters())}
        self.base = np.zeros(512, np.int32)
        for b, letter in enumerate(byte_letters()):
            self.base[b], self.base[b + 256] = ids[letter], ids[letter + WORD_END]
        size = len(self.text)
        self.rank, self.left, self.right = np.full(size, -1, np.int32), np.zeros(size, np.int32), np.zeros(size, np.int32)
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = (ids[x] for x in (pair if isinstance(pair, list) else pair.split(" ")))
            made = ids[self.text[a] + self.text[b]]
            self.rank[made], self.left[made], self.right[made] = rank, a, b
            self.merges[a, b] = rank, made
        pairs = np.array([a * size + b for a, b in self.merges], np.int64)
        order = np.argsort(pairs)
        self.pairs, self.pair_rank = pairs[order], np.array([r for r, _ in self.merges.values()], np.int32)[order]
        self.made = np.array([t for _, t in self.merges.values()], np.int32)
        self.size = size
        self._tree(ids, to_byte)
        self._sound()

    def _tree(self, ids: dict[str, int], to_byte: dict[str, int]) -> None:
        """A prefix tree of all tokens; its edges are one sorted array of node * 512 + symbol."""
        edges: dict[int, int] = {}
        ends = [-1]
        for token, at in ids.items():
            last = token.endswith(WORD_END) and len(token) > len(WORD_END)
            symbols = [to_byte[c] for c in (token[: -len(WORD_END)] if last else token)]
            symbols[-1] += 256 * last
            node = 0
            for s in symbols:
                node = edges.setdefault(node * 512 + s, len(ends))
                if node == len(ends):
                    ends.append(-1)
            ends[node] = at
        keys = np.fromiter(edges, np.int64, len(edges))
        order = np.argsort(keys)
        self.edges, self.targets = keys[order], np.fromiter(edges.values(), np.int32, len(edges))[order]
        self.ends = np.array(ends, np.int32)

    def _sound(self) -> None:
        """Tokens that merging builds from their own bytes; a token is sound if its halves are and meet at their merge."""
        made = np.flatnonzero(self.rank >= 0)
        limit = self.rank[made]
        fits = self.compatible(self.left[made], self.right[made], limit, limit)
        self.sound = np.ones(self.size, bool)
        self.sound[made] = fits
        for t in made[np.argsort(self.rank[made])]:
            a, b = self.left[t], self.right[t]
            self.sound[t] &= self.sound[a] & self.sound[b] & (max(self.rank[a], self.rank[b]) < self.rank[t])

    def ranks_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a.astype(np.int64) * self.size + b
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.pair_rank[at], NEVER)

    def compatible(self, a: np.ndarray, b: np.ndarray, gone_a=None, gone_b=None) -> np.ndarray:
        """Whether tokens ``a`` and ``b`` stay apart side by side.

        Looks back in time: the younger of the two pieces at the border is undone step by step. ``gone`` is the rank
        of the merge that later swallows a piece. A merge across the border comes first if its rank is below both; of
        equal ranks the left one comes first. With ``gone`` given, the pair's own merge is not held against it.
        """
        a, b = a.copy(), b.copy()
        own = gone_a is not None
        gone_a = np.full(len(a), NEVER, np.int32) if gone_a is None else gone_a.copy()
        gone_b = np.full(len(a), NEVER, np.int32) if gone_b is None else gone_b.copy()
        good, open_ = np.ones(len(a), bool), np.arange(len(a))
        first = True
        while len(open_):
            x, y, gx, gy = a[open_], b[open_], gone_a[open_], gone_b[open_]
            rank = self.ranks_of(x, y)
            clash = (rank < gx) & ((rank < gy) if own and first else (rank <= gy)) & (rank != NEVER)
            good[open_[clash]] = False
            first = False
            rx, ry = self.rank[x], self.rank[y]
            undo_a = rx > ry
            gone_a[open_] = np.where(undo_a, rx, gx)
            gone_b[open_] = np.where(undo_a, gy, ry)
            a[open_] = np.where(undo_a, self.right[x], x)
            b[open_] = np.where(undo_a, y, self.left[y])
            open_ = open_[~clash & ((rx >= 0) | (ry >= 0))]
        return good

    def merge(self, words: list[bytes]) -> list[list[int]]:
        """Exact merging of all words side by side: in each word the pair of lowest rank, wherever it stands."""
        lengths = np.array([len(w) for w in words])
        token, owner = self.base[self.symbols(words, lengths)], np.repeat(np.arange(len(words)), lengths)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(token):
            rank = np.full(len(token), NEVER, np.int32)
            side = np.flatnonzero(owner[1:] == owner[:-1])
            rank[side] = self.ranks_of(token[side], token[side + 1])
            begins = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            size = np.diff(begins, append=len(token))
            least = np.repeat(np.minimum.reduceat(rank, begins), size)
            over = least == NEVER
            done.append((token[over], owner[over]))
            hit = (rank == least) & ~over
            # of overlapping pairs, as in "aaa", every other one from the left
            place = np.arange(len(token))
            run = place - np.maximum.accumulate(np.where(hit, -1, place)) - 1
            hit &= run % 2 == 0
            token = np.where(hit, self.made[np.where(hit, rank, 0)], token)
            stay = ~over
            stay[1:] &= ~hit[:-1]
            token, owner = token[stay], owner[stay]
        token, owner = (np.concatenate(x) for x in zip(*done, strict=True))
        order = np.argsort(owner, kind="stable")
        cuts = np.searchsorted(owner[order], np.arange(len(words) + 1)).tolist()
        ids = token[order].tolist()
        return [ids[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]

    @staticmethod
    def symbols(words: list[bytes], lengths: np.ndarray) -> np.ndarray:
        out = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        out[np.cumsum(lengths) - 1] += 256
        return out

    def propose(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Greedy longest matches of all words at once: tokens, and the word of each, in order."""
        lengths = np.array([len(w) for w in words])
        stop = np.cumsum(lengths)
        symbols = self.symbols(words, lengths)
        begin, word = stop - lengths, np.arange(len(words))
        tokens, owners, turns = [], [], []
        turn = 0
        while len(word):
            node, at = np.zeros(len(word), np.int64), begin.copy()
            found, until = np.full(len(word), -1, np.int32), begin.copy()
            walk = np.arange(len(word))
            while len(walk):
                key = node[walk] * 512 + symbols[at[walk]]
                place = np.minimum(np.searchsorted(self.edges, key), len(self.edges) - 1)
                on = self.edges[place] == key
                walk, place = walk[on], place[on]
                node[walk] = self.targets[place]
                at[walk] += 1
                token = self.ends[node[walk]]
                hit = walk[token >= 0]
                found[hit], until[hit] = token[token >= 0], at[hit]
                walk = walk[at[walk] < stop[word[walk]]]
            tokens.append(found)
            owners.append(word)
            turns.append(np.full(len(word), turn))
            turn += 1
            more = until < stop[word]
            begin, word = until[more], word[more]
        token, owner, turns_ = np.concatenate(tokens), np.concatenate(owners), np.concatenate(turns)
        order = np.lexsort((turns_, owner))
        return token[order], owner[order]

    def propose_long(self, word: bytes) -> np.ndarray:
        """Greedy longest matches of one word: the match at each place, of which those on the way from the first are taken."""
        symbols = self.symbols([word], np.array([len(word)]))
        found, until = np.zeros(len(word), np.int32), np.zeros(len(word), np.int64)
        for base in range(0, len(word), PLACES):
            walk = np.arange(base, min(base + PLACES, len(word)))
            at, node = walk.copy(), np.zeros(len(walk), np.int64)
            while len(walk):
                key = node * 512 + symbols[at]
                place = np.minimum(np.searchsorted(self.edges, key), len(self.edges) - 1)
                on = self.edges[place] == key
                walk, at, node = walk[on], at[on] + 1, self.targets[place[on]].astype(np.int64)
                token = self.ends[node]
                hit = token >= 0
                found[walk[hit]], until[walk[hit]] = token[hit], at[hit]
                more = at < len(word)
                walk, at, node = walk[more], at[more], node[more]
        jumps, way, at = until.tolist(), [], 0
        while at < len(word):
            way.append(at)
            at = jumps[at]
        return found[way]

    def merge_long(self, word: bytes) -> list[int]:
        """Exact merging of one word: pairs wait in a heap by rank and place; one that has changed since is passed over."""
        token = self.base[self.symbols([word], np.array([len(word)]))]
        size = len(token)
        rank = self.ranks_of(token[:-1], token[1:]).astype(np.int64)
        waits = np.flatnonzero(rank != NEVER)
        heap = np.sort(rank[waits] * size + waits).tolist()  # a sorted list is a heap
        tokens, after, before = token.tolist(), list(range(1, size + 1)), list(range(-1, size - 1))
        gone, merges = -1, self.merges
        while heap:
            order, at = divmod(heapq.heappop(heap), size)
            right = after[at]
            if tokens[at] == gone or right == size:
                continue
            pair = merges.get((tokens[at], tokens[right]))
            if pair is None or pair[0] != order:
                continue
            tokens[at], tokens[right] = pair[1], gone
            follow = after[at] = after[right]
            if follow < size:
                before[follow] = at
                if (new := merges.get((pair[1], tokens[follow]))) is not None:
                    heapq.heappush(heap, new[0] * size + at)
            if (left := before[at]) >= 0 and (new := merges.get((tokens[left], pair[1]))) is not None:
                heapq.heappush(heap, new[0] * size + left)
        return [t for t in tokens if t != gone]

    def proposals(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens proposed for all words, and the word of each, in order."""
        short = np.array([k for k, w in enumerate(words) if len(w) <= LONG], np.int64)
        if len(short) == len(words):
            return self.propose(words)
        tokens, owners = [], []
        if len(short):
            token, owner = self.propose([words[k] for k in short])
            tokens, owners = [token], [short[owner]]
        for k in np.setdiff1d(np.arange(len(words)), short).tolist():
            tokens.append(self.propose_long(words[k]))
            owners.append(np.full(len(tokens[-1]), k))
        owner = np.concatenate(owners)
        order = np.argsort(owner, kind="stable")
        return np.concatenate(tokens)[order], owner[order]

    def encode_words(self, words: list[bytes]) -> list[list[int]]:
        token, owner = self.proposals(words)
        bad = np.zeros(len(words), bool)
        bad[owner[~self.sound[token]]] = True
        side = np.flatnonzero(owner[1:] == owner[:-1])
        key, back = np.unique(token[side].astype(np.int64) * self.size + token[side + 1], return_inverse=True)
        fits = self.compatible((key // self.size).astype(np.int32), (key % self.size).astype(np.int32))
        bad[owner[side[~fits[back]]]] = True
        cuts = np.searchsorted(owner, np.arange(len(words) + 1)).tolist()
        ids = token.tolist()
        out = [ids[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        for k in np.flatnonzero(bad).tolist():
            if len(words[k]) > LONG:
                out[k] = self.merge_long(words[k])
        failed = [k for k in np.flatnonzero(bad).tolist() if len(words[k]) <= LONG]
        if failed:
            for k, exact in zip(failed, self.merge([words[k] for k in failed]), strict=True):
                out[k] = exact
        return out


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def pieces(text: str, vocab: Vocabulary) -> list[str]:
    """Normalised words of a text; special tokens stand among them with a leading NUL-NUL mark."""
    if vocab.cut is not None and vocab.cut.search(text):
        out: list[str] = []
        for k, part in enumerate(vocab.cut.split(text)):
            out += ["\0\0" + part] if k % 2 else _plain(part)
        return out
    return _plain(text)


def _plain(text: str) -> list[str]:
    if text.isascii():
        return PIECES.findall(text.lower())
    # lower case character by character: a capital sigma has one small form at any place
    text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
    if max(text, default="") > "\u0500":
        text = text.translate(LATE_CAPITALS)
        if LATE.search(text):
            return LATE_PIECES.findall(text)
    return PIECES.findall(text)


def _encode(path: str, column: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        known: dict[str, bytes] = {}
        held = 0
        for batch in batches:
            for part in steps(batch, column):
                if len(known) > REMEMBERED or held > REMEMBERED_BYTES:
                    known, held = {}, 0
                lists = [pieces(t or "", vocab) for t in part.column(column).to_pylist()]
                new = list({w for words in lists for w in words}.difference(known))
                for w in new:
                    if w.startswith("\0\0") and w[2:] in vocab.special:
                        known[w] = vocab.special[w[2:]].to_bytes(4, "little")
                new = [w for w in new if w not in known]
                if new:
                    for w, ids in zip(new, vocab.encode_words([w.encode() for w in new]), strict=True):
                        known[w] = np.array(ids, "<u4").tobytes()
                        held += len(w) + len(known[w])
                ids = [b"".join(map(known.__getitem__, words)) for words in lists]
                yield pa.record_batch([*part.columns, pa.array(ids, pa.binary()), pa.array([len(x) // 4 for x in ids], pa.int64())], [*part.schema.names, "ids", "n_tokens"])

    return run


def encode(docs: DataFrame, path: str, column: str = "text") -> DataFrame:
    """``docs`` with ``ids`` (binary: token ids as little-endian unsigned 32-bit integers) and ``n_tokens``.

    Columns of these names in ``docs`` are replaced.
    """
    docs = docs.drop("ids", "n_tokens")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(_encode(path, column), f"{fields}, ids binary, n_tokens bigint")


def _decode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text = vocabulary(path).text
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                out = [" ".join(map(text.__getitem__, np.frombuffer(x or b"", "<u4").tolist())) for x in part.column("ids").to_pylist()]
                yield pa.record_batch([*part.columns, pa.array(out, pa.string())], [*part.schema.names, "decoded"])

    return run


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` with ``decoded``: the tokens of ``ids`` joined by a space, as the file names no decoder; null ids give ''."""
    encoded = encoded.drop("decoded")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)
    return encoded.mapInArrow(_decode(path), f"{fields}, decoded string")


def round_trip(docs: DataFrame, path: str, column: str = "text") -> DataFrame:
    """``docs`` with ``ids``, ``n_tokens`` and ``decoded``, in one pass: a task needs one Python worker and not two."""
    docs = docs.drop("ids", "n_tokens", "decoded")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    encoder, decoder = _encode(path, column), _decode(path)
    return docs.mapInArrow(lambda batches: decoder(encoder(batches)), f"{fields}, ids binary, n_tokens bigint, decoded string")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens and SHA-256 of the ids and of the decoded text."""
    done = round_trip(docs.select("doc_id", "text"), path)
    return done.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
