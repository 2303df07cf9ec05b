"""Step tables: what is kept, and what goes."""

import os
import time
from pathlib import Path

import pytest

from corpusgauge.durable import CLEANUP, Steps, materialize, scratch


def folder_of(steps):
    return steps.folder.removeprefix("file:")


def test_scratch_deletes_the_runs_that_began_inside(spark):
    outer = Steps(spark)
    with scratch():
        inner = Steps(spark)
        made = inner.keep(spark.range(5))
        also = materialize(spark.range(3))
        kept = outer.keep(made.join(also, "id"))
        with scratch():
            nested = Steps(spark)
            nested.keep(spark.range(1))
        assert not os.path.exists(folder_of(nested)) and os.path.exists(folder_of(inner))
    assert not os.path.exists(folder_of(inner))
    assert sorted(row.id for row in kept.collect()) == [0, 1, 2]
    with pytest.raises(Exception):
        made.collect()


def test_scratch_deletes_after_a_failure_too(spark):
    with pytest.raises(KeyError):
        with scratch():
            inner = Steps(spark)
            inner.keep(spark.range(5))
            raise KeyError("x")
    assert not os.path.exists(folder_of(inner))


def test_a_step_table_leaves_no_shuffle_files(spark):
    """Before, they stayed until the driver happened to collect its garbage."""
    folders = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirsString()

    def shuffled():
        return {path.name for folder in folders for path in Path(folder).rglob("shuffle_*.data")}

    before = shuffled()
    kept = Steps(spark).keep(spark.range(1000).selectExpr("id % 7 AS k").groupBy("k").count().repartition(3, "count"))
    for _ in range(20):
        if not shuffled() - before:
            break
        time.sleep(0.5)
    assert not shuffled() - before and kept.count() == 7
    assert spark.conf.get(CLEANUP, None) is None
