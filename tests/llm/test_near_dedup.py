"""Near-duplicate groups against all pairs of full sets."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from corpusgauge.llm import near_dedup as nd


def plain_set(text, words):
    parts = (text or "").encode().lower().split()
    if not parts:
        return frozenset()
    if len(parts) < words:
        return frozenset([tuple(parts)])
    return frozenset(tuple(parts[at : at + words]) for at in range(len(parts) - words + 1))


def brute(rows, words, percent):
    """(id, size, least id reachable) with ids unique and not null."""
    sets = {doc_id: plain_set(text, words) for doc_id, text in rows}
    postings, root = defaultdict(list), {doc_id: doc_id for doc_id in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for doc_id, own in sorted(sets.items()):
        shared = Counter(other for shingle in own for other in postings[shingle])
        for other, both in shared.items():
            if 100 * both >= percent * (len(own) + len(sets[other]) - both):
                a, b = find(doc_id), find(other)
                root[max(a, b)] = min(a, b)
        for shingle in own:
            postings[shingle].append(doc_id)
    return sorted((doc_id, len(own), find(doc_id)) for doc_id, own in sets.items())


def found(docs, **options):
    rows = nd.group(docs, **options).collect()
    assert all(row.kept == (row.doc_id == row.component_id) for row in rows)
    return sorted((row.doc_id, row.n_shingles, row.component_id) for row in rows)


@pytest.mark.parametrize("words,percent", [(3, 85), (5, 80)])
def test_given_documents(spark, words, percent):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    wanted = brute([(row.doc_id, row.text) for row in docs.collect()], words, percent)
    assert found(docs, words=words, percent=percent) == wanted


def family(draw, n):
    """Edits of one text, from none to many, and edits of edits: likeness on both sides of 0.85."""
    base = [f"w{draw.randrange(10**6)}" for _ in range(150)]
    texts = []
    for _ in range(n):
        words = list(draw.choice(texts).split()) if texts and draw.random() < 0.3 else base.copy()
        for _ in range(draw.choice([0, 1, 2, 3, 5, 8, 12])):
            words[draw.randrange(len(words))] = f"e{draw.randrange(10**6)}"
        texts.append(" ".join(words))
    return texts


def test_a_large_family_with_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(nd, "BLOCK", 16)
    draw = random.Random(8)
    rows = list(enumerate(family(draw, 300) + family(draw, 40) + ["same text of copies " * 10] * 30))
    draw.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(docs, words=3, percent=85) == brute(rows, 3, 85)


def test_odd_rows(spark):
    texts = [None, "", " \t\n", "one", "ONE", "one two", "one two three", "One  Two\tThree", "é É é", "É é é", "a b c " * 30000, "x\x1cy z w", "x\x1cy z w"]
    rows = [(at, text, b"") for at, text in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, sig binary")
    assert found(docs, words=3, percent=85) == brute([row[:2] for row in rows], 3, 85)
    twice = docs.unionByName(docs)
    assert sorted(set(found(twice, words=3, percent=85))) == brute([row[:2] for row in rows], 3, 85)
    nulls = spark.createDataFrame([(None, "a b c d"), (None, "a b c d"), (None, ""), (4, "a b c d")], "doc_id long, text string")
    assert Counter(row.component_id for row in nd.group(nulls, words=3).collect()) == {4: 3, None: 1}
    assert nd.group(docs.filter("false")).count() == 0


def test_pairs_within_the_distance_share_a_key():
    errors = nd.errors_allowed(0.85)
    draw = np.random.default_rng(1)
    ranges = nd.chunks(errors)
    assert 2 * len(ranges) > errors and ranges[0][0] == 0 and ranges[-1][1] == nd.VALUES
    for _ in range(2000):
        wrong = np.zeros(nd.VALUES, bool)
        wrong[draw.choice(nd.VALUES, errors, replace=False)] = True
        assert min(wrong[first:after].sum() for first, after in ranges) <= 1
