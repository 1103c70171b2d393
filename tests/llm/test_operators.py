"""Operators against plain versions, and on nulls, empty tables, repeated rows and clashing columns."""

from __future__ import annotations

import hashlib
import time
import tracemalloc
from collections import Counter

import brute
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from llm import bpe, language, licenses, lines, minhash, mixing, passages, pseudo_likelihood, repetition, vectors
from llm.graph import components
from llm.words import words_of

PATH = public_tokenizers.path("word_bpe_49k.json")


def table(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def same(got, want):
    assert got == sorted(want, key=repr)


# 1 substring dedup


def test_passages_equal_brute_force(docs, rows):
    same(table(passages.digests(docs), "doc_id", "n_words", "n_removed", "kept_sha256"), brute.passages(rows))


def test_passages_repeated_rows_null_ids_and_empty_tables(make, rows, nothing):
    twice = [*rows[:13], rows[12], rows[12], (None, rows[17][1])]
    same(table(passages.digests(make(twice)), "doc_id", "n_words", "n_removed", "kept_sha256"), brute.passages(twice))
    assert passages.digests(nothing).count() == 0


def test_passages_overlap_of_equal_windows(make):
    rows = [(1, "x " * 36), (2, "x " * 34), (3, " ".join(f"w{i}" for i in range(35))), (4, " ".join(f"w{i}" for i in range(36)))]
    same(table(passages.digests(make(rows)), "doc_id", "n_words", "n_removed", "kept_sha256"), brute.passages(rows))


def test_long_passages_are_found_in_whole_and_in_part(make):
    text = " ".join(f"w{i}" for i in range(300))
    rows = [(1, text), (2, "before " + text + " after"), (3, " ".join(text.split()[100:180])), (4, "x " * 300)]
    same(table(passages.digests(make(rows)), "doc_id", "n_words", "n_removed", "kept_sha256"), brute.passages(rows))


def test_passages_are_located_by_the_automaton_and_verified():
    text = " ".join(f"w{i}" for i in range(100))
    words = words_of(pa.array([text, "a b " + text + " c", "w1 " * 40]))
    hashes = words.hashes()
    codes, sums = passages.codes_of(hashes).tobytes(), passages.window_sums(hashes)
    total = (sums[16:17] - sums[10]).view(np.int64)  # of the windows of 35 words that begin at words 10 to 15
    found = passages.located(words, hashes, {codes[10:50]}, total)
    assert np.flatnonzero(found).tolist() == [*range(10, 50), *range(112, 152)]
    assert not passages.located(words, hashes, {codes[10:50]}, total + 1).any()


def test_passages_of_texts_without_id_and_of_very_long_texts_among_other_columns(make):
    long = " ".join(f"v{i * i % 4099}" for i in range(60_000))
    short = " ".join(f"s{i}" for i in range(50))
    rows = [(None, long), (None, "start " + long[40_000:90_000]), (7, short), (7, short + " more"), (None, "u " + short[20:]), (8, None), *[(9, short)] * 30]
    df = make(rows).selectExpr("*", "1 AS id", "2 AS tail", "3 AS k", "4 AS listed", "5 AS offered", "6 AS times")
    same(table(passages.digests(df), "doc_id", "n_words", "n_removed", "kept_sha256"), brute.passages(rows))


# 2 embeddings


def vectors_of(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")


def test_vectors_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(vectors, "CELL", 20)
    monkeypatch.setattr(vectors, "CHUNK", 7)
    random = np.random.default_rng(5)
    x = random.standard_normal((150, 6))
    x[50:90] = x[:40] + random.standard_normal((40, 6)) * 0.2
    x[90:100] = x[3]
    x[100] = -x[3]
    x = x.astype(np.float32)
    got = {r.vec_id: r for r in vectors.near_vectors(vectors_of(spark, [(i, v.tolist()) for i, v in enumerate(x)])).collect()}
    y = x.astype(float)
    norm = np.linalg.norm(y, axis=1)
    close = (y @ y.T) / np.outer(norm, norm) >= 0.9
    np.fill_diagonal(close, False)
    found = brute.groups(range(150), zip(*np.nonzero(close), strict=True))
    assert [(got[i].n_links, got[i].component_id, got[i].kept) for i in range(150)] == [(int(close[i].sum()), found[i], found[i] == i) for i in range(150)]


def test_vectors_of_a_chain_are_one_component_in_any_order(spark):
    # neighbours on the circle are linked, others not
    x = [[float(np.cos(a)), float(np.sin(a))] for a in np.deg2rad(20 * np.arange(6))]
    random = np.random.default_rng(4)
    for ids in [[2, 3, 6, 5, 4, 1], *(random.permutation(6) + 1 for _ in range(3))]:
        got = vectors.near_vectors(vectors_of(spark, [(int(i), v) for i, v in zip(ids, x, strict=True)])).collect()
        assert sorted((r.vec_id, r.component_id) for r in got) == [(i, 1) for i in range(1, 7)]
        assert sum(r.n_links for r in got) == 10


def test_forest_of_a_chunk_ties_all_that_is_linked():
    x = np.array([[np.cos(a), np.sin(a)] for a in np.deg2rad(20 * np.arange(9))])
    random = np.random.default_rng(6)
    for _ in range(200):
        ids = random.permutation(9)  # of the places on the circle
        chunk = vectors.Chunk(np.arange(9), x[ids], 0.9)
        for at in range(0, 9, 2):
            guests = np.arange(9)[at : at + 2]
            chunk.meet(guests, np.ones(len(guests), np.int64), x[ids[guests]])
        assert set(brute.groups(range(9), chunk.forest).values()) == {0}


def test_vectors_that_link_with_nothing(spark):
    rows = [(1, None), (2, [0.0, 0.0]), (3, [1.0, None]), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]), (6, [1.0, 0.0]), (7, [2.0, 0.0]), (8, [1.0]), (9, [])]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vectors.near_vectors(vectors_of(spark, rows)).collect()}
    assert got == {**{i: (0, i, True) for i in (1, 2, 3, 4, 5, 8, 9)}, 6: (1, 6, True), 7: (1, 6, False)}
    assert vectors.near_vectors(vectors_of(spark, [])).count() == 0
    again = vectors.near_vectors(vectors_of(spark, [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (1, [1.0, 0.0]), (2, [3.0, 0.1])])).collect()
    assert len(again) == 4 and {(r.vec_id, r.component_id) for r in again} == {(1, 1), (2, 1)}


# 3 language model


def test_gradient_is_the_slope():
    random = np.random.default_rng(1)
    totals = random.integers(0, 50, pseudo_likelihood.CODES)
    values = pseudo_likelihood.fresh(totals).astype(np.float64)
    context, target = random.integers(0, pseudo_likelihood.CODES + 1, (4, 20)), np.sort(random.integers(0, pseudo_likelihood.CODES, 20))
    context[:, :4] = 7

    def loss(v):
        return -pseudo_likelihood.log_probabilities(pseudo_likelihood.shaped(v), context, target).mean()

    slope = pseudo_likelihood.gradient(pseudo_likelihood.shaped(values), context, target)
    at = 0
    for shape in pseudo_likelihood.SHAPES.values():
        size = int(np.prod(shape))
        k = at + int(np.abs(slope[at : at + size]).argmax())
        up, down = values.copy(), values.copy()
        up[k] += 1e-5
        down[k] -= 1e-5
        assert slope[k] == pytest.approx((loss(up) - loss(down)) / 2e-5, rel=1e-3)
        at += size
    assert at == pseudo_likelihood.SIZE


def test_bucket_probabilities_sum_up_to_one():
    net = pseudo_likelihood.shaped(pseudo_likelihood.fresh(np.arange(pseudo_likelihood.CODES)))
    context = np.tile(np.array([[1], [pseudo_likelihood.EDGE], [900], [3]]), (1, pseudo_likelihood.CODES))
    logs = pseudo_likelihood.log_probabilities(net, context, np.arange(pseudo_likelihood.CODES)[::-1])
    assert np.exp(logs.astype(float)).sum() == pytest.approx(1, abs=1e-4)


def test_word_counts_equal_brute_force(docs, rows, monkeypatch):
    monkeypatch.setattr(pseudo_likelihood, "HELD", 300)
    want = Counter(pseudo_likelihood.hash_of(w) for _, t in rows for w in pseudo_likelihood.tokens_of(t))
    got = pseudo_likelihood.word_counts(pseudo_likelihood.tokenised(docs)).collect()
    assert {r.word % 2**64: r.n for r in got} == want and len(got) == len(want)
    assert pseudo_likelihood.tokens_of("Ab-c 東京 d\u0301 12") == ["ab", "-", "c", "東", "京", "d", "\u0301", "12"]


def test_scores_are_sums_of_predictions_from_both_sides(make, rows, monkeypatch):
    monkeypatch.setattr(pseudo_likelihood, "FREQUENT", 200)  # some words are frequent and the others joined
    monkeypatch.setattr(pseudo_likelihood, "POOL", 500)
    rows = [*rows, (None, "no id"), (None, "no id"), (3, rows[6][1])]
    docs = make(rows).withColumns({c: F.lit("mine") for c in ("row", "words", "n_tokens", "log_prob", "rare", "known", "n", "word")})
    model = pseudo_likelihood.fit(docs)
    assert 0 < len(model.frequent) < 200
    net = pseudo_likelihood.shaped(model.weights)
    counts = Counter(w for _, t in rows for w in pseudo_likelihood.tokens_of(t))
    code = {w: pseudo_likelihood.hash_of(w) >> 54 for w in counts}
    totals = Counter()
    for w, n in counts.items():
        totals[code[w]] += n
    want = []
    for d, t in rows:
        tokens = pseudo_likelihood.tokens_of(t)
        codes = [pseudo_likelihood.EDGE] * 2 + [code[w] for w in tokens] + [pseudo_likelihood.EDGE] * 2
        total = 0.0
        if tokens:
            context = np.array([[codes[i], codes[i + 1], codes[i + 3], codes[i + 4]] for i in range(len(tokens))]).T
            total += float(pseudo_likelihood.log_probabilities(net, context, np.array(codes[2:-2])).sum())
            total += sum(np.log(counts[w] / totals[code[w]]) for w in tokens)
        want.append((-1 if d is None else d, len(tokens), total))
    got = pseudo_likelihood.score(docs, model).collect()
    found = sorted((-1 if r.doc_id is None else r.doc_id, r.n_tokens, r.log_prob) for r in got)
    assert [x[:2] for x in found] == [x[:2] for x in sorted(want)]
    assert [x[2] for x in found] == pytest.approx([x[2] for x in sorted(want)], rel=1e-4, abs=1e-4)
    assert all((r.mean_log_prob is None) == (r.n_tokens == 0) for r in got)


def test_averages_weigh_copies_by_their_tokens():
    sums = [(np.full(3, 2.0) * 10).tobytes(), (np.full(3, 5.0) * 30).tobytes(), (np.ones(2) * 4).tobytes()]
    batch = pa.record_batch([pa.array([0, 0, 4096], pa.int32()), pa.array(sums, pa.binary()), pa.array([10, 30, 4])], ["at", "sums", "seen"])
    (out,) = pseudo_likelihood._average(iter([batch]))
    assert {a: np.frombuffer(v, np.float32).tolist() for a, v in zip(*(c.to_pylist() for c in out.columns), strict=True)} == {0: [4.25] * 3, 4096: [1.0] * 2}


def test_training_beats_single_frequencies(make, nothing):
    texts = [(i, "the cat sat on the mat and the dog ran over the hill " * 20) for i in range(4)]
    scored = pseudo_likelihood.score_corpus(make(texts)).collect()
    assert min(r.mean_log_prob for r in scored) > -0.5
    assert pseudo_likelihood.score_corpus(nothing).count() == 0
    assert [r.log_prob for r in pseudo_likelihood.score_corpus(make([(1, None), (2, "")])).collect()] == [0, 0]


def test_a_word_leaves_a_task_once_whatever_the_number_of_its_documents(make, monkeypatch):
    monkeypatch.setattr(pseudo_likelihood, "FREQUENT", 2)  # no word makes up half of the tokens
    texts = [(i, "one two three four three") for i in range(50)]
    tokens = pseudo_likelihood.tokenised(make(texts).coalesce(1)).coalesce(1)
    model = pseudo_likelihood.fit_tokens(tokens)
    assert not len(model.frequent)
    rows = pseudo_likelihood.parts(tokens, model).collect()
    assert sorted(len(r.rows) for r in rows if r.is_word) == [50, 50, 50, 100]
    assert sorted(r.doc_id for r in rows if not r.is_word) == list(range(50))


def test_tokens_equal_single_matches():
    signs = "".join(chr(i) for i in range(0x3100))
    texts = [signs, signs[:128], "A_b-c.D\x1ce\x85f\xa0g\u3000h", "\u6771\u4eac Ab", "a,b" * 9, "\u0130 \u01c5 \u00df-\u00e9!", "", None]
    for text in texts:
        assert pseudo_likelihood.tokens_of(text) == pseudo_likelihood.TOKEN.findall((text or "").lower())


def test_stored_words_are_hashes_of_tokens_without_a_string_for_each():
    signs = "".join(chr(i) for i in range(0x3100))
    odd = [" \x1c\x85\xa0\n", " a\x1cb\x1fc\u2028d\x0be ", signs, "\u6771\u4eac, Ab", "\u0130 \U0001f600" + "x" * 9, "\ufeffa \u200b b\x00c"]
    for texts in ([None], ["one two, one two. " * 9, None, "", *odd], []):
        rows = pa.array(range(len(texts)), pa.int64())
        batch = pa.record_batch([rows, rows, pa.array(texts, pa.string())], ["doc_id", "row", "text"])
        got = [r for out in pseudo_likelihood._tokens(iter([batch])) for r in out.to_pylist()]
        tokens = [pseudo_likelihood.TOKEN.findall((t or "").lower()) for t in texts]
        assert [r["words"] for r in got] == [np.array([pseudo_likelihood.hash_of(w) for w in x], "<u8").tobytes() for x in tokens]
        assert [r["doc_id"] for r in got] == [r["row"] for r in got] == list(range(len(texts)))
    batch = pa.record_batch([[1], [1], ["one two three " * 100_000]], ["doc_id", "row", "text"])
    tracemalloc.start()
    (out,) = pseudo_likelihood._tokens(iter([batch]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(out.column("words")[0].as_py()) == 8 * 300_000
    assert peak < 12 << 20


def test_gradient_takes_no_memory_of_the_size_of_the_weights():
    random = np.random.default_rng(2)
    net = pseudo_likelihood.shaped(pseudo_likelihood.fresh(np.arange(pseudo_likelihood.CODES)))
    n = pseudo_likelihood.BATCH
    context, target = random.integers(0, pseudo_likelihood.CODES + 1, (4, n), np.int16), np.sort(random.integers(0, pseudo_likelihood.CODES, n, np.int16))
    layers = pseudo_likelihood.Layers(net, n)
    first = layers.gradient(context, target).copy()
    tracemalloc.start()
    again = layers.gradient(context, target)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert np.array_equal(first, again)
    assert peak < net["into"][0].nbytes * 1.5


def test_junk_and_shuffled_letters_score_below_prose(make):
    random = np.random.default_rng(5)
    stock = ["".join(random.choice(list("абвгдежзиклмнопрстуя"), random.integers(2, 8))) for _ in range(40)]
    prose = " ".join(random.choice(stock, 300))
    letters = np.array(list(prose))
    random.shuffle(letters)
    latin = ["".join(random.choice(list("abcdefghilmnorstu"), random.integers(2, 8))) for _ in range(80)]
    rows = [(i, " ".join(random.choice(latin, 200))) for i in range(40)]
    rows += [(100, prose), (101, "".join(letters)), (102, "z" * 400), (103, " ".join(str(x) for x in random.integers(10**8, size=200)))]
    got = {r.doc_id: r.mean_log_prob for r in pseudo_likelihood.score_corpus(make(rows)).collect()}
    middle = np.median([got[i] for i in range(40)])
    assert got[101] < got[100] - 0.5
    assert max(got[i] for i in (101, 102, 103)) < middle


# 4 BPE


def test_bpe_equals_the_library(docs, rows):
    library = Tokenizer.from_file(PATH)
    got = {r.doc_id: r for r in bpe.digests(docs, PATH).collect()}
    assert len(got) == len(rows)
    for d, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        assert got[d].n_tokens == len(ids)
        assert got[d].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[d].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_bpe_on_every_code_point_and_random_text():
    library, vocab = Tokenizer.from_file(PATH), bpe.vocabulary(PATH)
    assert vocab.sound.all()
    texts = [f"a{chr(c)}b" for c in range(0, 0x110000, 37) if not 0xD800 <= c < 0xE000]
    random = np.random.default_rng(3)
    texts += ["".join(random.choice(list("aeinorst' .é!1"), random.integers(1, 40))) for _ in range(800)]
    texts += ["a" * 50, "\x1c\x1d a\x85b", "<|startoftext|><|endoftext|>x<|endoftext", "ᾳ Σς ǅ ŉ", "\0\0<|endoftext|>", "ÅÅ"]
    got = [x for b in bpe._encode(PATH, "text")(iter([pa.record_batch([pa.array(texts)], ["text"])])) for x in b.column("ids").to_pylist()]
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == want


def test_bpe_of_long_words(make, monkeypatch):
    monkeypatch.setattr(bpe, "PLACES", 1000)
    random = np.random.default_rng(8)
    stock = ["".join(random.choice(list("etaoinshrdlu"), random.integers(2, 9))) for _ in range(300)]
    texts = ["".join(random.choice(list("acgt"), 20_000)), "a" * 5001, "ab" * 3000 + "a", "".join(random.choice(stock, 4000)), "!?" * 700 + "-" * 999]
    texts += ["é" * 301 + "语" * 500, "x" * bpe.LONG, "x" * (bpe.LONG + 1), "short " + "tion" * 100 + " words " + "tion" * 100, "the" * 3000 + "<|endoftext|>" + "q" * 400]
    library = Tokenizer.from_file(PATH)
    got = bpe.encode(make([*enumerate(texts), (None, texts[1]), (None, texts[1])]), PATH).collect()
    assert len(got) == len(texts) + 2
    for r in got:
        assert np.frombuffer(r.ids, "<u4").tolist() == library.encode(r.text, add_special_tokens=False).ids
    vocab = bpe.vocabulary(PATH)
    for t in [*texts[:4], "the", "of"]:
        assert vocab.merge_long(t.encode()) == vocab.merge([t.encode()])[0]
        assert vocab.propose_long(t.encode()).tolist() == vocab.propose([t.encode()])[0].tolist()


def test_bpe_of_a_word_of_a_million_letters():
    word = "".join(np.random.default_rng(9).choice(list("acgt"), 1_000_000))
    library, vocab = Tokenizer.from_file(PATH), bpe.vocabulary(PATH)
    start = time.process_time()
    want = library.encode(word, add_special_tokens=False).ids
    middle = time.process_time()
    assert vocab.encode_words([word.encode()])[0] == want
    assert time.process_time() - middle < 10 * (middle - start) + 2


def test_bpe_keeps_clashing_columns_apart(make, nothing):
    df = make([(1, "hello world")]).withColumn("ids", F.lit("old")).withColumn("n_tokens", F.lit(-1)).withColumn("decoded", F.lit("old"))
    row = bpe.decode(bpe.encode(df, PATH), PATH).first()
    assert row.n_tokens == 2 and row.decoded == "hello</w> world</w>" and row.source == "y"
    assert bpe.digests(nothing, PATH).count() == 0


# 5 licences


def test_license_rules_need_their_sentences_in_order(make, nothing):
    def full(name):
        return licenses.SENTENCES[name].capitalize()

    texts = {
        1: "Text. Released under the MIT License.\nMore text",
        2: f"{full('mit-grant')}. {full('mit-condition')}.",
        3: f"{full('mit-condition')}. {full('mit-grant')}.",
        4: f"{full('mit-grant')}. Something else. {full('mit-condition')}.",
        5: "Licensed under CC BY-NC 4.0. Licensed under the Apache Licence, Version 2.0.",
        6: None, 7: "", 8: "All rights reserved! All rights reserved.", 9: "We permit this; no licence is meant.",
    }
    got = {r.doc_id: (r.licenses, r.n_matches, r.n_sentences) for r in licenses.scan(make(list(texts.items()))).collect()}
    assert got == {
        1: ("mit-notice", 1, 1), 2: ("mit-text", 1, 2), 3: ("", 0, 2), 4: ("", 0, 2), 5: ("apache-2.0-notice,cc-by-nc-4.0", 2, 2),
        6: ("", 0, 0), 7: ("", 0, 0), 8: ("rights-reserved", 2, 2), 9: ("", 0, 0),
    }
    assert licenses.scan(nothing).count() == 0


MIT = """MIT License

Copyright (c) 2020 Someone

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.
"""
APACHE = """# Copyright 2020 Someone
#
# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.
# You may obtain a copy of the License at
#
#     http://www.apache.org/licenses/LICENSE-2.0
#
# Unless required by applicable law or agreed to in writing, software
# distributed under the License is distributed on an "AS IS" BASIS,
# WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
"""
GPL = """    This program is free software: you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation, either version 3 of the License, or
    (at your option) any later version.

    This program is distributed in the hope that it will be useful,
    but WITHOUT ANY WARRANTY; without even the implied warranty of
    MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
    GNU General Public License for more details.

    You should have received a copy of the GNU General Public License
    along with this program.  If not, see <https://www.gnu.org/licenses/>.
"""
BSD = """Copyright (c) 2020, Someone
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:
"""
MPL = """/* This Source Code Form is subject to the terms of the Mozilla Public
 * License, v. 2.0. If a copy of the MPL was not distributed with this
 * file, You can obtain one at https://mozilla.org/MPL/2.0/. */
"""


def test_public_texts_as_they_are_wrapped(make):
    texts = [MIT, APACHE, GPL, BSD, MPL, " ".join(GPL.split("\n")), MIT.replace("\n", "\r\n"), "Licensed under\n\nCC BY 4.0."]
    got = {r.doc_id: r.licenses for r in licenses.scan(make(list(enumerate(texts)))).collect()}
    assert got == {
        0: "mit-text", 1: "apache-2.0-header,apache-2.0-notice", 2: "gpl-3.0-header", 3: "bsd-text,rights-reserved", 4: "mpl-2.0-header",
        5: "gpl-3.0-header", 6: "mit-text", 7: "",
    }


def test_known_sentences_are_read_as_themselves():
    ids, pattern = licenses._known()
    for name, text in [(n, t) for n, more in licenses.WORDINGS.items() for t in more] + list(licenses.SENTENCES.items()):
        parts = licenses.re.findall(pattern, licenses.marked(text))
        assert [ids.get(licenses.plain(x)) for x in parts] == [licenses.NUMBER[name]], (name, parts)


# 6 language


def test_automaton_reads_exactly_the_substrings():
    text = [3, 4, 3, 3, 4, 5, 3, 4, 3, 3]
    auto = language.suffix_automaton(text)

    def reads(word):
        state = 0
        for s in word:
            state = auto[state, s]
            if state < 0:
                return False
        return True

    inside = {tuple(text[i:j]) for i in range(len(text)) for j in range(i, len(text) + 1)}
    words = [()]
    for _ in range(5):
        words = [(*w, s) for w in words for s in (3, 4, 5)]
        assert all(reads(w) == (w in inside) for w in words)


def test_phrases_equal_greedy_parsing():
    model = language.Model((("aa", "the cat sat on the mat"), ("bb", "der hund lief weg")))
    texts = ["the hat", "dog", "weg weg", "xyz", ""]
    total, size, _ = model.phrases(texts)
    for k, source in enumerate(("the cat sat on the mat", "der hund lief weg")):
        for i, t in enumerate(texts):
            phrases, at = 0, 0
            while at < len(t):
                far = at + 1
                while far <= len(t) and t[at:far] in source:
                    far += 1
                at = max(far - 1, at + 1)
                phrases += 1
            assert (total[k, i], size[i]) == (phrases, len(t))


def test_language_of_held_out_documents(make, nothing):
    english, german = "the quick brown fox jumps over the lazy dog and runs away ", "der schnelle braune fuchs springt über den faulen hund und läuft weg "
    docs = make([(i, (english if i % 3 == 0 else german) * 3) for i in range(60) if i % 3 < 2] + [(100, None), (101, "123 !!"), (None, english)])
    got = {r.doc_id: r for r in language.held_out_languages(docs).collect()}
    assert all(got[i].lang_pred == ("en" if i % 3 == 0 else "de") for i in range(60) if i % 3 < 2)
    assert [(got[i].lang_pred, got[i].score) for i in (100, 101)] == [("und", 0.0)] * 2
    assert {got[i].held_out for i in range(60) if i % 3 < 2} == {True, False}
    assert all(0 <= r.score <= 1 for r in got.values())
    assert language.held_out_languages(nothing).count() == 0
    unlabelled = language.held_out_languages(make([(2, english)])).collect()
    assert [r.lang_pred for r in unlabelled] == ["und"]


def phrases_by_hand(text, source):
    phrases, at = 0, 0
    while at < len(text):
        far = at + 1
        while far <= len(text) and text[at:far] in source:
            far += 1
        at, phrases = max(far - 1, at + 1), phrases + 1
    return phrases


def test_every_letter_of_every_script_counts():
    random = np.random.default_rng(7)
    starts = {"ar": 0x621, "el": 0x3B1, "ka": 0x10D0, "ru": 0x430, "zh": 0x4E00}
    letters = {k: [chr(c) for c in range(v, v + (400 if k == "zh" else 26)) if chr(c).isalpha() and chr(c).lower() == chr(c)] for k, v in starts.items()}
    sources = {k: "".join(random.choice([*x, " "], 1500)) for k, x in letters.items()}
    sources = {k: " ".join(v.split()) for k, v in sources.items()}
    model = language.Model(tuple(sources.items()))
    assert {type(p).__name__ for _, p in model.parsers} == {"Dense", "Sparse"}
    texts = ["".join(random.choice(x, 30)) for x in letters.values()] + [v[100:160].strip() for v in sources.values()] + ["xyz"]
    total, _, _ = model.phrases(texts)
    for k, source in enumerate(sources.values()):
        assert total[k].tolist() == [phrases_by_hand(t, source) for t in texts]


def test_languages_of_long_texts_only_are_learned(make):
    texts = {"en": "the quick brown fox jumps over the lazy dog ", "de": "der schnelle braune fuchs springt über den faulen hund "}
    docs = make([(i, (texts["en"] if i % 3 == 0 else texts["de"]) * 500) for i in range(12) if i % 3 < 2])
    got = {r.doc_id: r.lang_pred for r in language.identify(docs, language.labelled_sample(docs, F.lit(True))).collect()}
    assert got == {i: "en" if i % 3 == 0 else "de" for i in range(12) if i % 3 < 2}


# 7 repetition


def test_repetition_equals_brute_force(docs, rows):
    got = {r.doc_id: r for r in repetition.repetition_rules(docs).collect()}
    assert len(got) == len(rows)
    for d, t in rows:
        if t is None or len(t) < 5000:
            want = brute.repetition(t, repetition.MIN_REPEAT)
            assert {k: getattr(got[d], k) for k in want} == pytest.approx(want)
            n = want["n_words"]
            assert got[d].base_failed == (n < 50 or 100 * want["n_repeat_words"] > 50 * n)
            assert not (got[d].base_failed and got[d].kept)


def test_repetition_verdict(make, nothing, rows):
    passage = " ".join(f"w{i}" for i in range(60))
    clean, long = " ".join(f"c{i}" for i in range(200)), " ".join(f"d{i}" for i in range(170))
    got = {r.doc_id: (r.base_failed, r.kept) for r in repetition.repetition_rules(make([(1, clean), (2, f"{passage} {long} {passage}"), (3, None)])).collect()}
    assert got == {1: (False, True), 2: (False, False), 3: (True, False)}
    assert repetition.repetition_rules(nothing).count() == 0


# 8 mixing


def test_mix_keeps_rows_and_stays_within_a_block(make, spark, nothing):
    rows = [(i, f"t{i}") for i in range(900)]
    docs = make(rows).withColumn("source", F.expr("case when doc_id % 3 = 0 then 'hot' when doc_id % 10 = 1 then null else concat('s', doc_id % 4) end"))
    docs = docs.withColumn("slot", F.lit("old")).withColumn("quota", F.lit(1)).withColumn("cycle", F.lit(2))
    weights = {"hot": 3.0, "": 1.0, "s0": 2.0, "s1": 1.0, "s2": 1.0, "s3": 2.0}
    got = mixing.mix(docs, weights, block=2, cycle=20).collect()
    assert sorted(r.doc_id for r in got) == list(range(900)) and got[0].quota == 1
    order = {}
    for r in got:
        order.setdefault(r.slot, set()).add(r.source)
    assert sorted(order) == list(range(len(order))) and all(len(s) == 1 for s in order.values())
    sources = [next(iter(order[k])) for k in sorted(order)]
    last = {s: max(k for k, x in enumerate(sources) if x == s) for s in set(sources)}
    for s in set(sources):
        share = weights[s or ""] / 10
        for t in range(1, min(last.values()) + 1):
            assert abs(sources[:t].count(s) - share * t) < 1
        blocks = sorted({(r.slot, r.block_no) for r in got if r.source == s})
        assert [b for _, b in blocks] == list(range(len(blocks)))
    assert mixing.mix(nothing).count() == 0


@pytest.mark.parametrize(
    "weights, blocks",
    [([1, 1, 1], [9000] * 3), ([1, 1000], [40, 30000]), ([0.1, 0.2, 0.7, 3**0.5, 5], [900, 90, 2000, 1500, 300]), ([1.0 + k % 7 / 3 for k in range(900)], [5 + k % 11 for k in range(900)])],
)
def test_order_stays_within_a_block_of_the_true_target_over_the_whole_run(weights, blocks):
    order = mixing.order_of(weights, blocks)
    assert np.bincount(order).tolist() == blocks
    w, n = np.array(weights, float), np.array(blocks, float)
    ends = np.sort(n / w)
    slots_at = np.minimum(w * ends[:, None], n).sum(1)  # slots when a target runs out
    v = np.interp(np.arange(1, len(order) + 1), np.r_[0, slots_at], np.r_[0, ends])
    for s in range(len(w)):
        assert np.abs(np.cumsum(order == s) - np.minimum(w[s] * v, n[s])).max() < 1 + 1e-6


def test_mix_of_more_sources_than_400(make):
    docs = make([(i, "t") for i in range(1000)]).withColumn("source", F.expr("concat('s', doc_id % 450)"))
    got = mixing.mix(docs, block=2).collect()
    assert sorted(r.doc_id for r in got) == list(range(1000))
    assert sorted({(r.slot, r.source) for r in got}) == sorted((r.slot, r.source) for r in {r.slot: r for r in got}.values())
    assert len({(r.slot, r.place) for r in got}) == 1000 and {r.slot for r in got} == set(range(len({r.slot for r in got})))


# 9 near-duplicates


@pytest.mark.parametrize("size", [4, 5])
def test_near_duplicates_equal_brute_force(docs, rows, size):
    same(table(minhash.near_duplicates(docs, size), "doc_id", "n_shingles", "component_id", "kept"), brute.near(rows, size))


def test_near_duplicates_in_chunks(make, monkeypatch, nothing):
    monkeypatch.setattr(minhash, "CHUNK_DOCS", 3)
    base = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join([*base[:i], "x", *base[i + 1 :]])) for i in range(20)] + [(99, " ".join(base)), (100, " ".join(base))]
    same(table(minhash.near_duplicates(make(rows), 4), "doc_id", "n_shingles", "component_id", "kept"), brute.near(rows, 4))
    assert minhash.near_duplicates(nothing).count() == 0
    again = minhash.near_duplicates(make([(1, "a b c d e"), (1, "a b c d e"), (None, "a b c d e"), (None, None)])).collect()
    assert sorted(repr((r.doc_id, r.component_id)) for r in again) == ["(1, 1)", "(1, 1)", "(None, 1)", "(None, None)"]


def test_components(spark):
    random = np.random.default_rng(2)
    links = [(i, i + 1) for i in range(60)] + [(int(a), int(b)) for a, b in random.integers(100, 300, (120, 2))] + [(5, 5), (7, 6), (6, 7), (400, 399)]
    got = {r.id: r.component for r in components(spark.createDataFrame([*links, (None, 3)], "a bigint, b bigint")).collect()}
    nodes = {x for pair in links for x in pair if pair[0] != pair[1]}
    want = brute.groups(nodes, [p for p in links if p[0] != p[1]])
    assert got == want
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# 10 lines


def test_lines_equal_brute_force(docs, rows):
    done = lines.dedup_lines(docs.withColumn("n_lines", F.lit("old")).withColumn("first", F.lit(1)))
    assert "first" in done.columns and done.count() == len(rows)
    same(table(done, "doc_id", "n_lines", "n_removed", "text"), brute.lines(rows))


def test_edits_at_any_place(make, nothing):
    random = np.random.default_rng(8)
    line = "the quick brown fox jumps over the lazy dog"
    rows = [(0, line)]
    for i in range(1, 60):
        x = list(f"{line} {i % 3}") if i % 2 else list(line)
        for _ in range(random.integers(1, 4)):
            at, kind = random.integers(0, len(x)), random.integers(0, 3)
            x[at : at + (kind != 0)] = [] if kind == 1 else [random.choice(list("qzé"))]
        rows.append((i, "".join(x)))
    same(table(lines.dedup_lines(make(rows)), "doc_id", "n_lines", "n_removed", "text"), brute.lines(rows))
    assert lines.dedup_lines(nothing).count() == 0


def test_lines_of_rows_without_id_and_repeated_rows(make):
    got = table(lines.dedup_lines(make([(None, "same line\nown"), (3, "same line\nx"), (3, "same line\nx")])), "doc_id", "n_removed", "text")
    assert got == sorted([(None, 0, "same line\nown"), (3, 1, "x"), (3, 1, "x")], key=repr)


def test_lines_keep_columns_of_any_name(docs, rows):
    names = ["gone", "_id", "_tail", "_more", "_all", "_others", "no", "first", "place", "line", "h1", "near", "key", "a.b"]
    wide = docs.withColumns({c: F.lit(c) for c in names})
    done = lines.dedup_lines(wide)
    assert done.columns == [*docs.columns, *names, "n_lines", "n_removed"]
    same(table(done, "doc_id", "n_lines", "n_removed", "text"), brute.lines(rows))
    assert all(r[c] == c for r in done.collect() for c in names)


def test_lines_a_little_under_the_least_length_count_as_earlier_ones(make):
    base = "abcdefghij klmnopqrst uvwxyzABC"  # 31
    rows = [(1, base[:29]), (2, base[:30]), (3, base[:28]), (4, base), (5, base[:28] + "#"), (6, base[:27] + "!!!!"), (7, base[1:]), (8, base[:25])]
    for shift in range(len(rows)):
        turned = [(i, t) for i, (_, t) in enumerate(rows[shift:] + rows[:shift])]
        same(table(lines.dedup_lines(make(turned)), "doc_id", "n_lines", "n_removed", "text"), brute.lines(turned))
