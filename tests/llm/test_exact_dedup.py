"""Exact duplicates against a plain version, and the index over several batches."""

import hashlib
import re
from collections import defaultdict

from corpusgauge.durable import Steps
from corpusgauge.llm import exact_dedup as xd


def plain(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def expected(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[plain(text)].append((-len(text or ""), doc_id is not None, doc_id or 0, doc_id))
    out = []
    for doc_id, text in rows:
        keep = min(groups[plain(text)])[3]
        out.append((doc_id, keep, len(groups[plain(text)]), doc_id == keep, hashlib.sha256(plain(text).encode()).hexdigest()))
    return sorted(map(str, out))


def test_odd_rows(spark):
    texts = [None, "", " \t\x0b\x0c\r\n", "a b", "ab", "a  b", "a  b", "a\xa0b", "A b", "é é", "x y " * 60000, "xy" * 60000, "a\x1cb"]
    rows = list(enumerate(texts)) + [(3, "a b"), (None, "null id"), (None, "null id"), (50, "null id")]
    docs = spark.createDataFrame([(*row, "z") for row in rows], "doc_id long, text string, digest string")
    assert sorted(str(tuple(row)) for row in xd.deduplicate_once(docs).collect()) == expected(rows)
    assert xd.deduplicate_once(docs.filter("false")).count() == 0


def test_beyond_the_broadcast(spark, monkeypatch):
    monkeypatch.setattr(xd, "BROADCAST_DIGESTS", 3)
    rows = [(at, "hot" if at % 3 else f"text {at % 20}") for at in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(str(tuple(row)) for row in xd.deduplicate_once(docs).collect()) == expected(rows)


def test_batches_meet_the_index(spark):
    steps = Steps(spark)
    index = xd.fresh_index(spark, steps, 10)
    batches = [[(5, "a b"), (6, "c")], [(1, "ab"), (2, "d"), (3, "d ")], []]
    kept = []
    for rows in batches:
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        kept += [(row.doc_id, row.keep_id, row.kept) for row in xd.deduplicate(index, docs, steps).collect()]
    assert sorted(kept) == [(1, 5, False), (2, 3, False), (3, 3, True), (5, 5, True), (6, 6, True)]
    table = spark.table(index.name)
    assert sorted(row.keep_id for row in table.collect()) == [3, 5, 6]
    known = index.new_only(spark.createDataFrame([("x", 1)], "digest string, keep_id long"))
    plan = known._jdf.queryExecution().toString()
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan
    index.forget()


def test_a_table_meets_the_index_in_batches(spark, monkeypatch):
    plans, found = [], xd.DigestIndex.new_only

    def new_only(index, groups):
        left = found(index, groups)
        plans.append((index.exists(), left._jdf.queryExecution().executedPlan().toString(), groups.count(), left.count()))
        return left

    monkeypatch.setattr(xd.DigestIndex, "new_only", new_only)
    rows = [(at, f"text {at % 30}" + " " * (at % 7)) for at in range(200)] + [(None, "text 3"), (7, None), (8, " ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for batches in (1, 2, 5):
        plans.clear()
        assert sorted(str(tuple(row)) for row in xd.deduplicate_once(docs, batches=batches).collect()) == expected(rows)
        assert [exists for exists, *_ in plans] == [False] + [True] * (batches - 1)
        assert all("SortMergeJoin" in plan and "LeftAnti" in plan for _, plan, *_ in plans[1:])
        # Later batches hold digests that the index knows; only new ones are appended.
        assert sum(new for *_, new in plans) == 31
        assert batches == 1 or any(new < groups for _, _, groups, new in plans[1:])
