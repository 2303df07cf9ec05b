"""Vector codes against a plain version in Python's own numbers."""

import hashlib
import math
import random

import numpy as np
import pytest

from corpusgauge.durable import Steps
from corpusgauge.llm import vector_codes


def plainly(rows, parts, entries, rounds):
    """Rows of (id, vector, label) with usable vectors of one length."""
    ordered = sorted(rows, key=lambda row: (row[0] is None, row[0] or 0, row[1]))
    whole = [[math.floor(1024 * x) for x in vector] for _, vector, _ in ordered]
    width = len(whole[0]) // parts
    cut = [[tuple(v[p * width : (p + 1) * width]) for p in range(parts)] for v in whole]
    books = [[v[p] for v in cut[:entries]] for p in range(parts)]

    def assign(p, part):
        return min((sum((a - b) ** 2 for a, b in zip(part, entry)), at) for at, entry in enumerate(books[p]))

    for _ in range(rounds):
        moved = [list(book) for book in books]
        for p in range(parts):
            found = {}
            for v in cut:
                found.setdefault(assign(p, v[p])[1], []).append(v[p])
            for at, members in found.items():
                moved[p][at] = tuple(sum(column) // len(members) for column in zip(*members))
        books = moved
    out, by_label = [], {}
    for (vec_id, _, label), v in zip(ordered, cut):
        best = [assign(p, v[p]) for p in range(parts)]
        error = sum(d for d, _ in best)
        by_label[label] = by_label.get(label, 0) + error
        out.append((vec_id, "".join(f"{at:02x}" for _, at in best), error, label))
    digest = hashlib.sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()
    return sorted(((i, c, e, by_label[label], digest) for i, c, e, label in out), key=repr)


def coded(spark, rows, **options):
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, code string, id int")
    steps = Steps(spark)
    got = vector_codes.report(vector_codes.compress(vectors, steps=steps, **options), steps).collect()
    return sorted((tuple(row) for row in got), key=repr)


def vector(draw, width=8, coarse=False):
    return [draw.choice([-0.5, 0.0, 0.25]) if coarse else float(np.float32(draw.gauss(0, 0.3))) for _ in range(width)]


def test_walk_equals_all_distances():
    draw = np.random.default_rng(3)
    for spread, size in ((3, 40), (900, 300), (1 << 28, 60)):
        book = draw.integers(-spread, spread + 1, (17, 5))
        parts = np.unique(draw.integers(-spread, spread + 1, (size * 4, 5)), axis=0)
        walk = vector_codes.TrieWalk(book)
        halves = [walk.feed(parts[:7]), walk.feed(parts[7:])]
        distances = ((parts[:, None, :] - book[None]) ** 2).sum(axis=2)
        assert (np.concatenate([half[0] for half in halves]) == distances.argmin(axis=1)).all()
        assert (np.concatenate([half[1] for half in halves]) == distances.min(axis=1)).all()


@pytest.mark.parametrize("coarse", [False, True])
def test_codes_equal_the_plain_version(spark, coarse):
    draw = random.Random(1)
    rows = [(at * 3 % 401, vector(draw, coarse=coarse), draw.choice([None, 1, 2])) for at in range(400)]
    rows += [(rows[5][0], vector(draw), 1), (None, vector(draw), None), rows[7], (2**60 + 1, rows[0][1], 2)]
    rows += [(1000 + at, rows[0][1], 1) for at in range(200)]  # a third of the rows are equal
    got = coded(spark, [(*row, "clash", 1) for row in rows], entries=16, rounds=3)
    assert got == plainly(rows, 4, 16, 3)


def test_unusable_vectors(spark):
    draw = random.Random(2)
    rows = [(at, vector(draw), 1) for at in range(20)]
    dropped = [(-1, None, 1), (-2, [float("nan")] * 8, 1), (-3, [float("inf")] + [0.0] * 7, 1), (-4, [0.0] * 7 + [None], 1)]
    odd = [(-5, [0.0] * 3, 1), (30, [0.0] * 12, None), (31, [], 1)]
    got = coded(spark, [(*row, None, None) for row in rows + dropped + odd])
    wanted = plainly(rows, 4, 256, 4)
    assert [row for row in got if row[1] is not None] == wanted
    assert sorted((row[0], row[1], row[2]) for row in got if row[1] is None) == [(-5, None, None), (30, None, None), (31, None, None)]
    assert coded(spark, []) == [] and coded(spark, [(*row, None, None) for row in dropped]) == []
    assert [row[:3] for row in coded(spark, [(*odd[0], None, None)])] == [(-5, None, None)]
    with pytest.raises(Exception, match="exceeds"):
        coded(spark, [(1, [1e30] * 8, 1, None, None)])
