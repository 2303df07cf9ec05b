"""Elias-Fano sequences, counts and scores against dictionaries."""

import math
from collections import Counter
from zlib import crc32

import numpy as np
import pytest

from corpusgauge.llm import lm
from corpusgauge.llm.elias_fano import EliasFano, encode


@pytest.mark.parametrize("n,top", [(0, 1), (1, 1), (1, 2**63), (5, 4), (1000, 1200), (1000, 2**20), (3000, 2**64 - 1), (257, 255)])
def test_sequences(n, top):
    draw = np.random.default_rng(n)
    values = np.sort(draw.integers(0, top, n, np.uint64, endpoint=True))
    data = np.frombuffer(encode(values) + b"\1" * 8, np.uint8)
    sequence = EliasFano(data)
    assert sequence.n == n and sequence.end == len(data) - 8
    assert (sequence.access(np.arange(n)) == values).all()
    asked = np.concatenate([values, draw.integers(0, top, 500, np.uint64, endpoint=True)])
    at = sequence.find(asked)
    have = set(values.tolist())
    for value, place in zip(asked.tolist(), at):
        assert (place >= 0) == (value in have) and (place < 0 or values[place] == value)
    some = np.arange(n)
    assert (sequence.find(values, some, some + 1) == some).all()


def brute(rows, parts=7, part=2):
    held = {at: doc_id is not None and crc32(str(doc_id).encode()) % parts == part for at, (doc_id, _) in enumerate(rows)}
    texts = [(text or "").encode().lower().split() + [None] for _, text in rows]
    words, pairs, starts = Counter(), Counter(), 0
    for at, text in enumerate(texts):
        if not held[at]:
            words.update(text)
            pairs.update(zip([""] + text, text))
            starts += 1
    total, distinct = sum(words.values()), len(words)
    out = []
    for at, text in enumerate(texts):
        base = full = 0.0
        for before, word in zip([""] + text, text):
            p = (words[word] + 1) / (total + distinct + 1)
            context = starts if before == "" else words[before]
            n = pairs[before, word]
            n = min(2 ** (round(8 * math.log2(n)) / 8), context) if n else 0
            base += math.log10(p)
            full += math.log10((n + lm.MU * p) / (context + lm.MU))
        out.append((rows[at][0], held[at], len(text), sum(words[word] > 0 for word in text), total, base, full))
    return out


def equal(got, wanted):
    got, wanted = (sorted(rows, key=lambda row: (str(row[:5]), row[5])) for rows in ([tuple(r) for r in got], wanted))
    assert [row[:5] for row in got] == [row[:5] for row in wanted]
    for one, other in zip(got, wanted):
        assert one[5:] == pytest.approx(other[5:], rel=1e-9)


def test_given_documents(spark, monkeypatch):
    monkeypatch.setattr(lm, "BYTES_PER_SHARD", 50_000)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(row.doc_id, row.text) for row in docs.collect()]
    got = lm.score_documents(docs).collect()
    equal(got, brute(rows))
    held = [row for row in got if row.held_out]
    assert sum(row.score for row in held) > sum(row.base_score for row in held)


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (None, "A a É é"), (3, "a " * 50000), (3, "x\x1cy end start"), (4, "a \t\n b"), (4, "a \t\n b"), (11, "zz a")]
    docs = spark.createDataFrame([(*row, 1) for row in rows], "doc_id long, text string, score int")
    equal(lm.score_documents(docs).collect(), brute(rows))
    assert lm.score_documents(docs.filter("false")).count() == 0
    only_held = docs.filter(lm.held_out(docs.doc_id, 7, 2))
    assert all(row.score == 0 and row.train_tokens == 0 for row in lm.score_documents(only_held).collect())


@pytest.mark.parametrize("n", [1, 254, 255, 10**6, 2**32 - 1, 2**32 + 1, 10**12, 10**18])
def test_large_counts_do_not_wrap(n):
    before, words = np.array([7, 9], np.uint64), np.array([5 << 40, 6 << 40], np.uint64)
    counts = np.array([n, 3])
    blocks = [(1, lm._pack(1, [words], counts)), (2, lm._pack(2, [before, lm.successor(words)], counts))]
    data, distinct, total = lm.shard_bytes(blocks)
    shard = lm.Shard(np.frombuffer(data, np.uint8))
    assert (distinct, total) == (2, n + 3) and len(data) % 8 == 0
    assert shard.count(np.array([5 << 40, 6 << 40, 1], np.uint64)).tolist() == [n, 3, 0]
    pairs = shard.pairs(np.array([7, 9, 7], np.uint64), lm.successor(np.array([5 << 40, 6 << 40, 6 << 40], np.uint64)))
    assert pairs == pytest.approx([n, 3, 0], rel=2 ** (1 / 16) - 1 + 1e-9)


def test_a_batch_looks_each_word_and_pair_up_once(monkeypatch):
    draw = np.random.default_rng(3)
    words = np.sort(draw.integers(0, 2**63, 50, np.uint64))
    before, after = np.repeat(words, 50), lm.successor(np.tile(words, 50))
    before, after, counts = lm._counted_pairs(before, after)
    data, _, _ = lm.shard_bytes([(2, lm._pack(2, [before, after], counts * 8))])
    shard, asked, find = lm.Shard(np.frombuffer(data, np.uint8)), [], EliasFano.find
    monkeypatch.setattr(EliasFano, "find", lambda self, values, *rest: asked.append(len(values)) or find(self, values, *rest))
    some = draw.integers(0, len(before), 20_000)
    lost = draw.random(20_000) < 0.1
    got = shard.pairs(np.where(lost, before[some] + np.uint64(1), before[some]), after[some])
    assert (got == np.where(lost, 0, 8)).all()
    assert asked[0] <= 100 and asked[1] <= 2500


def test_shard_files_are_plain_arrays(tmp_path):
    words = np.array([5, 6], np.uint64)
    data, _, _ = lm.shard_bytes([(1, lm._pack(1, [words], np.array([4, 9])))])
    lm.write_shard(str(tmp_path), 0, data)
    shard = lm.open_shard(str(tmp_path), 0)
    assert type(shard.words.lows) is np.ndarray and shard.count(words).tolist() == [4, 9]
