"""Joins, ranks and row numbers that stay spread out when one key holds much of the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusgauge.durable import materialize

BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64_000_000
ROWS_PER_COPY = 1_000


def lookup_join(
    facts: DataFrame,
    dimension: DataFrame,
    key: str,
    weight: str,
    limit: int = BROADCAST_ROWS,
    row_bytes: int = 16,
) -> DataFrame:
    """Inner join of ``facts`` with a keyed table whose ``weight`` is the fact rows per key.

    A dimension of at most ``limit`` rows, which take at most BROADCAST_BYTES by their keys and the
    ``row_bytes`` that a row's other columns have at most, is broadcast.
    A larger one is cut at c = ceil(sum(weight) / limit): at most ``limit`` keys can weigh c or
    more, so the heavy keys are always safe to broadcast, and no key left for the shuffle holds
    more than c fact rows. Long keys lower the limit, so that the longest would fit that often.
    ``dimension`` must be cheap to read twice (materialized).
    """
    kind = dict(dimension.dtypes)[key]
    length = row_bytes + (F.octet_length(key) if kind in ("string", "binary") else F.lit(8))
    size, total, whole, longest = dimension.agg(
        F.count(F.lit(1)), F.sum(weight), F.sum(length.cast("bigint")), F.max(length)
    ).first()
    if (whole or 0) > BROADCAST_BYTES:
        limit = max(1, min(limit, BROADCAST_BYTES // longest))
    if size <= limit:
        return facts.join(F.broadcast(dimension), key)
    cut = -(-int(total) // limit)
    heavy = dimension.filter(F.col(weight) >= cut)
    light = dimension.filter(F.col(weight) < cut)
    marked = facts.join(F.broadcast(heavy.select(key).withColumn("_heavy", F.lit(True))), key, "left")
    in_heavy = marked.filter(F.col("_heavy")).drop("_heavy").join(F.broadcast(heavy), key)
    in_light = marked.filter(F.col("_heavy").isNull()).drop("_heavy").join(light, key)
    return in_heavy.unionByName(in_light)


def spread_join(
    facts: DataFrame,
    dimension: DataFrame,
    key: str,
    spread: str,
    rows_per_copy: int = ROWS_PER_COPY,
    narrow: DataFrame | None = None,
) -> DataFrame:
    """Inner join of ``facts`` with a keyed table whose rows are too wide to broadcast.

    A key of more than ``rows_per_copy`` fact rows gets a copy of its dimension row for each so many
    of them, and its facts are dealt over the copies by the hash of column ``spread``. Only the hot
    keys and their numbers are broadcast, at most BROADCAST_ROWS of them: with more fact rows, a
    copy serves more. Keys are counted in ``narrow``, a written table with the same keys, or in
    ``facts``, which must be cheap to read twice then.
    """
    counted = facts if narrow is None else narrow
    counts = counted.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    share = max(rows_per_copy, -(-counted.count() // BROADCAST_ROWS))
    hot = materialize(counts.filter(F.col("_n") > share).select(key, F.ceil(F.col("_n") / F.lit(share)).cast("int").alias("_copies")))
    if hot.isEmpty():
        return facts.join(dimension, key)
    hot, copies = F.broadcast(hot), F.coalesce("_copies", F.lit(1))
    dealt = facts.join(hot, key, "left").withColumn("_copy", F.pmod(F.xxhash64(spread), copies).cast("int"))
    copied = dimension.join(hot, key, "left").withColumn("_copy", F.explode(F.sequence(F.lit(0), copies - 1)))
    return dealt.drop("_copies").join(copied.drop("_copies"), [key, "_copy"]).drop("_copy")


def keep_first(
    df: DataFrame, key: Column | str, order: str, flag: str
) -> DataFrame:
    """Add ``flag``: true for the row with the least ``order`` among equal keys (NULLs equal).

    ``order`` must be unique. The least order per key is a partial aggregate and the join back
    runs on ``order``, so a key that fills a third of the table is never one task's work.
    """
    winners = (
        df.groupBy((key if isinstance(key, Column) else F.col(key)).alias("_key"))
        .agg(F.min(order).alias(order))
        .select(order, F.lit(True).alias(flag))
    )
    return df.join(winners, order, "left").withColumn(flag, F.coalesce(flag, F.lit(False)))


def hash_rank(
    df: DataFrame,
    within: Sequence[str],
    digest: str,
    tie: str,
    lead: Sequence[tuple[str, bool]] = (),
    name: str = "rank",
    digits: int = 3,
) -> DataFrame:
    """1-based rank inside ``within`` by the lead columns, then the md5 ``digest``, then ``tie``.

    ``lead`` lists (column, descending). Rows are numbered inside (within, lead, first ``digits``
    of the digest); md5 spreads evenly, so even a label with a third of all rows is cut into
    16**digits windows. Their start offsets come from a small table of counts.
    """
    lead_names = [column for column, _ in lead]
    cell = [*within, *lead_names, "_slot"]
    lead_order = [F.col(c).desc() if down else F.col(c).asc() for c, down in lead]
    slotted = df.withColumn("_slot", F.substring(digest, 1, digits))
    counts = slotted.groupBy(*cell).agg(F.count(F.lit(1)).alias("_cell_rows"))
    before = (
        Window.partitionBy(*within)
        .orderBy(*lead_order, "_slot")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = counts.select(
        *cell, F.coalesce(F.sum("_cell_rows").over(before), F.lit(0)).alias("_offset")
    )
    inside = Window.partitionBy(*cell).orderBy(digest, tie)
    matched = F.lit(True)
    for column in cell:
        matched = matched & F.col(f"s.{column}").eqNullSafe(F.col(f"o.{column}"))
    numbered = slotted.withColumn("_inside", F.row_number().over(inside))
    return (
        numbered.alias("s")
        .join(offsets.alias("o"), matched)
        .select("s.*", (F.col("_offset") + F.col("_inside")).cast("bigint").alias(name))
        .drop("_slot", "_inside")
    )


def number_rows(df: DataFrame, order: Sequence[Column | str], name: str) -> DataFrame:
    """Add the keys 1..n in ``order`` with a range sort and one offset per partition."""
    sorted_rows = materialize(
        df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id())
    )
    # The id holds the partition above bit 33 and the row inside it below.
    part = F.shiftright("_at", 33)
    located = sorted_rows.withColumn("_part", part).withColumn(
        "_row", F.col("_at") - F.shiftleft(part, 33)
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        located.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    )
    # One row per partition of the sort: a handful of thousands at most.
    return (
        located.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_start") + F.col("_row") + 1)
        .drop("_at", "_part", "_row", "_start")
    )
