"""CSV files cut into records by many tasks, also where quoted values span lines.

Spark's own reader takes a file whole when values may hold line ends. Here files are read as plain
lines, split as any text is. A line end lies inside a value where an odd number of quotes comes
before it (a doubled quote counts twice), so it is enough to know the parity of the quotes before
each split:

1. the quotes of each split are counted;
2. a running sum over a file's splits tells which of them begin inside a value;
3. each split joins its lines to records. Its first and last record may reach into other splits:
   these fragments, two per split at most, are put together by file.

The splits that begin inside a value are sent to all tasks: 16 bytes each, and there are no more of
them than splits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# What a row of the joined lines is: a record, the end of one that began in an earlier split (or a
# whole split inside of it), or the beginning of one that goes on in the next split.
WHOLE, REST, BEGUN = 0, 1, 2


class _Joiner:
    """Lines of one split, in order, to records and fragments."""

    def __init__(self, inside: bool, first: bool) -> None:
        self.inside, self.held, self.begun_here, self.header = inside, [], not inside, first

    def take(self, lines: list[str], quotes: np.ndarray) -> Iterator[tuple[str, int, bool]]:
        """(text, kind, whether it is the file's first record)."""
        odd = (quotes & 1).tolist()
        for line, turns in zip(lines, odd):
            self.held.append(line)
            if turns:
                self.inside = not self.inside
            if not self.inside:
                yield self._close(WHOLE if self.begun_here else REST)
                self.begun_here = True

    def _close(self, kind: int) -> tuple[str, int, bool]:
        text, header = "\n".join(self.held), self.header
        self.held, self.header = [], False
        return text, kind, header

    def finish(self) -> Iterator[tuple[str, int, bool]]:
        if self.held:
            yield self._close(BEGUN if self.begun_here else REST)


def csv_records(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """(record): the text of every record of the files, without each file's first one if it is a header."""
    lines = spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")
    )
    lines = lines.select("value", F.xxhash64("file").alias("file"), "start")
    quotes = F.length("value") - F.length(F.translate("value", '"', ""))
    splits = lines.groupBy("file", "start").agg(F.sum(quotes).alias("quotes"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    odd = splits.withColumn("before", F.coalesce(F.sum("quotes").over(before), F.lit(0))).filter("before % 2 = 1")
    inside = {(row["file"], row["start"]) for row in odd.select("file", "start").collect()}
    held = spark.sparkContext.broadcast(inside)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        joiner, at = None, None

        def rows(found: list, split: tuple) -> pa.RecordBatch:
            n = len(found)
            return pa.RecordBatch.from_pydict(
                {
                    "file": pa.array([split[0]] * n, pa.int64()),
                    "start": pa.array([split[1]] * n, pa.int64()),
                    "kind": pa.array([kind for _, kind, _ in found], pa.int32()),
                    "header": pa.array([first for _, _, first in found], pa.bool_()),
                    "record": pa.array([text for text, _, _ in found], pa.string()),
                }
            )

        for batch in batches:
            files, starts = batch.column("file").to_numpy(), batch.column("start").to_numpy()
            counts = pc.count_substring(batch.column("value"), '"').to_numpy()
            changes = np.flatnonzero((files[1:] != files[:-1]) | (starts[1:] != starts[:-1])) + 1
            for low, high in zip([0, *changes.tolist()], [*changes.tolist(), len(files)]):
                if low == high:
                    continue
                split = (int(files[low]), int(starts[low]))
                if split != at:
                    if joiner is not None:
                        yield rows(list(joiner.finish()), at)
                    joiner, at = _Joiner(split in held.value, header and split[1] == 0), split
                lines = batch.column("value").slice(low, high - low).to_pylist()
                yield rows(list(joiner.take(lines, counts[low:high])), split)
        if joiner is not None:
            yield rows(list(joiner.finish()), at)

    joined = lines.mapInArrow(join, "file bigint, start bigint, kind int, header boolean, record string")
    whole = joined.filter((F.col("kind") == WHOLE) & ~F.col("header")).select("record")
    # Fragments alone, in the files' order: a beginning opens a record, all rests after it belong to it.
    upto = Window.partitionBy("file").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    opened = F.sum(F.when(F.col("kind") == BEGUN, 1).otherwise(0)).over(upto)
    fragments = joined.filter(F.col("kind") != WHOLE).withColumn("number", opened)
    parts = F.array_sort(F.collect_list(F.struct("start", "kind", "record")), lambda a, b: F.signum(a["start"] - b["start"]).cast("int"))
    spanning = (
        fragments.groupBy("file", "number")
        .agg(parts.alias("parts"), F.max("header").alias("header"))
        .filter(~F.col("header"))
        .select(F.array_join("parts.record", "\n").alias("record"))
    )
    return whole.unionByName(spanning).select(F.regexp_replace("record", r"\r$", "").alias("record")).filter("record <> ''")
