"""Cutting lineage in a way that survives the loss of executors."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, taking it from ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder; on a cluster such a
    folder would vanish with its machine, so there the setting is required.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        configured = tempfile.mkdtemp(prefix="corpusgauge-checkpoint-")
    context.setCheckpointDir(configured)
    return configured


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once, as a table beside the checkpoints, and continue from that table.

    A checkpointed frame keeps the constraints of its old plan, and in loops these grow without
    bound; a table starts a fresh plan, lets later steps read only the columns they need, and
    gives the planner its true size.
    """
    return Steps(df.sparkSession).keep(df)


#: Spark deletes a query's shuffle files at its end, not only when the driver collects its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def _without_shuffle_files(spark: SparkSession) -> Iterator[None]:
    """Queries that run inside leave no shuffle files; a table's rows are read from the table from then on."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


_recorded: list[list[Steps]] = []


@contextlib.contextmanager
def scratch() -> Iterator[None]:
    """Delete, at the end, the step tables of every run that begins inside.

    What is still needed then must have been written by a run that began before.
    """
    made: list[Steps] = []
    _recorded.append(made)
    try:
        yield
    finally:
        _recorded.remove(made)
        for steps in made:
            steps.drop_all()


class Steps:
    """Step tables of one run, in a folder of their own that all executors share.

    A table stays until ``drop`` is called for it: a lazy result may still read it.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.folder = f"{ensure_checkpoint_dir(spark)}/step-{uuid.uuid4().hex}"
        self._paths: dict[int, str] = {}
        if _recorded:
            _recorded[-1].append(self)

    def path(self, name: str | None = None) -> str:
        return f"{self.folder}/{name or uuid.uuid4().hex}"

    def keep(self, df: DataFrame) -> DataFrame:
        """Write ``df`` and read it back."""
        path = self.path()
        with _without_shuffle_files(self.spark):
            df.write.parquet(path)
        kept = self.spark.read.schema(df.schema).parquet(path)
        self._paths[id(kept)] = path
        return kept

    def drop(self, *tables: DataFrame | str) -> None:
        """Delete tables (or paths of this run) that nothing reads any more."""
        for table in tables:
            path = table if isinstance(table, str) else self._paths.pop(id(table))
            if not path.startswith(f"{self.folder}/"):
                raise ValueError(f"{path} is not a step of this run")
            self._delete(path)

    def drop_all(self) -> None:
        """Delete the run's folder."""
        self._paths.clear()
        self._delete(self.folder)

    def _delete(self, path: str) -> None:
        jvm_path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        jvm_path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(jvm_path, True)
