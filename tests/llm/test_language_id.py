"""Code lengths against trees of dictionaries, odd rows, and held-out accuracy."""

import math
import random
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np

from corpusgauge.llm import language_id as lid


def brute_bits(texts, data, order, least, known):
    """Bits of ``data`` by contexts of dictionaries; ``known`` counts contexts over all languages."""
    trees = defaultdict(Counter)
    for text in texts:
        padded = b"\0" * order + text
        for at in range(order, len(padded)):
            for length in range(order + 1):
                trees[padded[at - length : at]][padded[at]] += 1

    def chance(context, byte):
        seen = trees.get(context, Counter())
        total, distinct = sum(seen.values()), len(seen)
        if seen[byte]:
            return seen[byte] / (total + distinct)
        escape = distinct / (total + distinct) if total else 1.0
        return escape * (chance(shorter(context), byte) if context else 1 / 256)

    def shorter(context):
        context = context[1:]
        while context and known[context] < least:
            context = context[1:]
        return context

    bits, padded = 0.0, b"\0" * order + data
    for at in range(order, len(padded)):
        context = padded[at - order : at]
        if known[context] < least:
            context = shorter(context)
        bits -= math.log2(chance(context, padded[at]))
    return bits


def test_code_lengths_are_exact():
    draw = random.Random(1)
    texts = {"a": [bytes(draw.choices(b"abcd ", k=300)) for _ in range(5)], "b": [bytes(draw.choices(b"cdefg ", k=300)) for _ in range(5)]}
    order, least = 3, 4
    grams = Counter()
    known = Counter()
    for number, lang in enumerate(texts):
        for text in texts[lang]:
            padded = b"\0" * order + text
            for at in range(order, len(padded)):
                grams[number, int.from_bytes(padded[at - order : at + 1], "big")] += 1
                for length in range(1, order + 1):
                    known[padded[at - length : at]] += 1
    keys = list(grams)
    model = lid.build_model(
        list(texts), np.array([k[0] for k in keys]), np.array([k[1] for k in keys]), np.array([grams[k] for k in keys]), order, least, 100_000
    )
    for data in (b"abc abc", b"gfedc", b"zzz", b"a", b"ab\xffc defg", b"\0a\0"):
        got = model.code_lengths(data)
        wanted = [brute_bits(texts[lang], data.replace(b"z", b"\0").replace(b"\xff", b"\0"), order, least, known) for lang in texts]
        if b"\0" not in data and b"z" not in data and b"\xff" not in data:
            assert np.allclose(got, wanted, rtol=1e-5), data
        assert np.isfinite(got).all()


def test_blocks_do_not_change_the_sum(monkeypatch):
    grams = np.arange(97 << 16 | 97 << 8 | 97, (97 << 16 | 97 << 8 | 97) + 20)
    model = lid.build_model(["x"], np.zeros(20, int), grams, np.full(20, 40), 2, 1, 1000)
    data = bytes(random.Random(2).choices(b"abcdefgh", k=1000))
    whole = model.code_lengths(data)
    monkeypatch.setattr(lid, "BLOCK", 7)
    assert np.allclose(model.code_lengths(data), whole)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    truth = {row.doc_id: row for row in docs.collect()}
    got = lid.identify(docs).collect()
    assert len(got) == len(truth)
    right = rows = 0
    for row in got:
        assert row.held_out == (crc32(str(row.doc_id).encode()) % 4 == 2)
        assert 0 <= row.score <= 1
        if row.held_out:
            rows += 1
            right += row.lang_pred == truth[row.doc_id].lang
    assert right / rows > 0.97


def test_odd_rows(spark):
    rows = [(0, "the cat and the dog", "en", 1), (1, "der hund und die katze", "de", 1), (None, "the the and", None, 1), (3, None, "en", 1),
            (4, "", "en", 1), (5, "12 345 .,", "de", 1), (6, "the dog " * 30000, None, 1), (6, "the dog", None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int")
    got = lid.identify(docs, least_context=1).collect()
    assert len(got) == len(rows)
    unknown = [row for row in got if row.lang_pred == "und"]
    assert len(unknown) == 3 and all(row.score == 0 for row in unknown)
    assert all(row.lang_pred in ("en", "de", "und") for row in got)
    assert lid.identify(docs.filter("false")).count() == 0
    assert {row.lang_pred for row in lid.identify(docs.filter("lang is null")).collect()} == {"und"}
