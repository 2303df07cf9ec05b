"""Packing: ids by the library, every id in one piece, gapless sequences, little padding."""

import random
import zlib
from array import array
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from corpusgauge.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def check(docs, pieces, library, window):
    """docs: list of (id, text) with unique ids."""
    ids = {key: library.encode(text or "", add_special_tokens=False).ids + [1] for key, text in docs}
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for row in pieces:
        own = ids[row.doc_id][row.start : row.start + row.length]
        assert row.length == len(own) > 0
        assert row.ids_crc32 == zlib.crc32(array("I", own).tobytes())
        assert row.doc_tokens == len(ids[row.doc_id])
        by_doc[row.doc_id].append((row.start, row.length))
        by_sequence[row.sequence_id].append((row.offset, row.length))
    assert set(by_doc) == set(ids)
    for key, parts in by_doc.items():
        at = 0
        for start, length in sorted(parts):
            assert start == at
            at += length
        assert at == len(ids[key])
    used = []
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
        used.append(at)
    assert sum(size < window for size in used) <= 1
    return used


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_ids_equal_the_library(library):
    tokenizer, draw = packing.WordTokenizer(PATH), random.Random(3)
    ranges = [(0x21, 0x180), (0x20, 0x7F), (0x300, 0x370), (0x20, 0x3000)]
    texts = ["".join(chr(draw.randrange(*draw.choice(ranges))) for _ in range(60)) for _ in range(3000)]
    texts += ["".join(chr(draw.randrange(0x21, 0x180)) for _ in range(12)) for _ in range(5000)]
    texts += ["T\u0308 t\u0308 X\x1cy 'S'LL <|Endoftext|> <|endoftext|>A İſKÅ"]
    texts += [f"{word}{chr(sign)} {word.upper()}{chr(sign)}{word}" for sign in range(0x21, 0x7F) for word in ("abc", "s", "re", "")]
    for text in texts:
        wanted = array("I", library.encode(text, add_special_tokens=False).ids).tobytes()
        assert tokenizer.encode(tokenizer.split(text)) == wanted, repr(text)


@pytest.mark.parametrize("window", [2048, 32])
def test_given_documents(spark, library, window):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    pieces = packing.pack(docs, PATH, window).collect()
    check([(row.doc_id, row.text) for row in docs.collect()], pieces, library, window)


def test_odd_rows(spark, library):
    texts = [None, "", "A b's 12 İSTANBUL ÉCOLE é", "<|startoftext|> X<|ENDOFTEXT|>", "word " * 9000, "same", "same", "\x1c\xa0 \x85x", "ΑΣ ΑΣ"]
    rows = [(key, text, 7) for key, text in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length int")
    check([row[:2] for row in rows], packing.pack(docs, PATH).collect(), library, 2048)
    twice = packing.pack(docs.unionByName(docs).withColumn("doc_id", F.lit(0)), PATH)
    assert twice.count() >= 2 * len(rows)
    assert packing.pack(docs.filter("false"), PATH).count() == 0


def test_counts_fit_the_histogram():
    rng = np.random.default_rng(1)
    histogram = np.zeros(64, int)
    histogram[1:] = rng.integers(0, 1000, 63)
    combos = packing.combinations(64)
    x = packing.solve_counts(histogram, combos, sweeps=3000, tolerance=1e-7)
    fitted = np.zeros(64)
    for slot in range(3):
        np.add.at(fitted, combos[:, slot], x)
    fitted[0] = 0
    gradient = (histogram - fitted)[combos].sum(axis=1) * 1.0
    assert (x >= 0).all() and gradient.max() < 1e-2 * histogram.max()
    assert np.abs(gradient[x > 0]).max() < 1e-2 * histogram.max()


def test_every_tail_is_placed_once():
    histogram = np.zeros(2048, int)
    histogram[5], histogram[2043], histogram[700] = 1_000_000, 400_000, 3
    plan = packing.plan_tails(histogram)
    assert plan.sequences >= 400_000
    total = (np.arange(2048) * histogram).sum()
    assert plan.sequences * 2048 - total < 2048


def test_large_ids_beside_null_ids(spark):
    """Ids above 2**53 stay what they are where a batch holds null ids too."""
    rows = [(2**60 + 1 + at, f"text number {at} " * (1 + at % 40) * (30 if at % 50 == 0 else 1)) for at in range(200)] + [(None, "one"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = [row.doc_id for row in packing.pack(docs, public_tokenizers.path("word_bpe_49k.json")).select("doc_id").collect()]
    assert set(got) == {doc_id for doc_id, _ in rows}
    assert len(got) >= len(rows)


def test_tasks_of_a_worker_share_the_tokenizer(monkeypatch):
    built = []
    make = packing.WordTokenizer
    monkeypatch.setattr(packing, "WordTokenizer", lambda path: built.append(path) or make(path))
    packing.worker_state("none")
    path = public_tokenizers.path("word_bpe_49k.json")
    for _ in range(3):
        batch = packing.pa.RecordBatch.from_pydict({"row": [1, 2], "id": [5, None], "text": ["some words", ""]})
        (out,) = packing.token_batches(iter([batch]), path, 8192, bytes([1, 0, 0, 0]))
        assert out.column("doc_tokens").to_pylist()[1] == 1
    assert len(built) == 1
    packing.worker_state("none")
