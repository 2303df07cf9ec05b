"""Vectors compressed to one code per part, with codebooks fitted in whole numbers.

Each component x becomes floor(scale * x). A vector is cut into equal parts and each part position
has a codebook of ``entries`` entries. A round assigns every part to its nearest entry (squared
Euclidean distance, ties to the lower index) and moves each entry to the floor of its parts' mean;
an entry without parts stays.

Equal parts cost one assignment: the distinct parts and how often they occur are written once, in
lexicographic order. Read in that order they are the leaves of a trie over components, which is
walked depth first. A node carries the distances to all entries summed up to its depth, so parts
with a common beginning share them; at a leaf the least sum gives the entry, and the part is added
to that entry's sum by its weight. The walk goes block by block: of what came before, only the open
path (one vector of sums per depth) is kept.

The driver holds codebooks alone: parts x entries x components of a part, whatever the table's size.

Defined results: rows whose vector is null or holds a null or non-finite component are left out.
The number of components is that of the least kept id with a positive multiple of ``parts`` of them;
vectors of another length stay with a null code and a null error. Ids may be null (they come last)
or repeat (ties go to the lesser vector); each row gives one row. With fewer rows than entries the
codebooks have as many entries as rows. Null labels count as one label. A component beyond
+-2**28 after scaling raises, since squared distances would no longer fit. An empty table gives no
rows. Other columns are never read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusgauge.durable import Steps
from corpusgauge.operators.keyed import lookup_join

#: Leaves of the trie that are walked at once.
BLOCK = 512
LARGEST = 1 << 28
#: Labels whose sums are broadcast; see ``lookup_join`` for what happens beyond.
LABELS = 100_000


class TrieWalk:
    """Nearest entries of distinct parts that come in lexicographic order."""

    def __init__(self, codebook: np.ndarray) -> None:
        self.columns = np.ascontiguousarray(codebook.T.astype(np.int64))
        self.reach = int(np.abs(codebook).max(initial=0))
        self.path: np.ndarray | None = None  # the last part
        self.sums: list[np.ndarray] = []  # its distance sums, by depth

    def feed(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) per part; ``parts`` follow those fed before."""
        entries, distances = np.empty(len(parts), np.int64), np.empty(len(parts), np.int64)
        for at in range(0, len(parts), BLOCK):
            sums = self._block(parts[at : at + BLOCK])
            nearest = sums.argmin(axis=1)
            entries[at : at + BLOCK] = nearest
            distances[at : at + BLOCK] = sums[np.arange(len(sums)), nearest]
        return entries, distances

    def _block(self, parts: np.ndarray) -> np.ndarray:
        """Distance sums of every leaf of a block, to all entries."""
        depth = parts.shape[1]
        widest = 2 * max(self.reach, int(np.abs(parts).max()))
        kind = np.int32 if depth * widest * widest < 1 << 31 else np.int64
        # The first component in which a part leaves the path of the one before it.
        before = np.vstack([parts[:1] if self.path is None else self.path, parts[:-1]])
        differs = parts != before
        leaves_at = np.where(differs.any(axis=1), differs.argmax(axis=1), depth)
        if self.path is None:
            leaves_at[0] = 0
            self.sums = [np.zeros(self.columns.shape[1], np.int64)] * depth
        # Row 0 of every level is the open path; level -1 is the root.
        level = np.zeros((1, self.columns.shape[1]), kind)
        of_row = np.zeros(len(parts), np.int64)
        for k in range(depth):
            opens = leaves_at <= k
            rows = np.flatnonzero(opens)
            made = np.empty((len(rows) + 1, level.shape[1]), kind)
            made[0] = self.sums[k]
            np.subtract(parts[rows, k : k + 1].astype(kind), self.columns[k].astype(kind), out=made[1:])
            made[1:] *= made[1:]
            made[1:] += level[of_row[rows]]
            of_row = np.cumsum(opens)
            level = made
            self.sums[k] = made[of_row[-1]].copy()
        self.path = parts[-1:].copy()
        return level[of_row]


def nearest(codebook: np.ndarray, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entry, squared distance) of parts in any order, equal ones walked once."""
    distinct, back = np.unique(parts, axis=0, return_inverse=True)
    entries, distances = TrieWalk(codebook).feed(distinct)
    back = back.reshape(-1)
    return entries[back], distances[back]


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def scaled(vector: Column, scale: int) -> Column:
    """Whole components: floor(scale * x), also below zero."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale))


@dataclass
class Codes:
    """Codebooks as (part, entry, component), and per vector: id, label, code, error."""

    codebooks: np.ndarray
    rows: DataFrame

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.codebooks.reshape(-1).tolist())).encode()).hexdigest()


def _initial(whole: DataFrame, parts: int, entries: int) -> np.ndarray | None:
    """Codebooks made of the vectors with the least ids."""
    fits = (F.size("v") > 0) & (F.size("v") % parts == 0)
    order = [F.col("id").asc_nulls_last(), "v"]
    first = whole.filter(fits).orderBy(*order).select(F.size("v")).first()
    if first is None:
        return None
    # At most ``entries`` vectors.
    lines = whole.filter(F.size("v") == first[0]).orderBy(*order).select("v").limit(entries).collect()
    table = np.array([line.v for line in lines], np.int64)
    return table.reshape(len(table), parts, -1).transpose(1, 0, 2)


def _round(leaves: DataFrame, codebooks: np.ndarray) -> np.ndarray:
    """The codebooks after all distinct parts were assigned and the entries moved."""
    count, entries, width = codebooks.shape
    held = leaves.sparkSession.sparkContext.broadcast(codebooks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = held.value
        walks = [TrieWalk(book) for book in books]
        sums = np.zeros(books.shape, np.int64)
        weights = np.zeros(books.shape[:2], np.int64)
        for batch in batches:
            positions = batch.column("position").to_numpy()
            parts, weight = _matrix(batch.column("part"), width), batch.column("weight").to_numpy()
            for p in np.unique(positions):
                here = np.flatnonzero(positions == p)
                chosen, _ = walks[p].feed(parts[here])
                np.add.at(sums[p], chosen, parts[here] * weight[here, None])
                np.add.at(weights[p], chosen, weight[here])
        p, e = np.nonzero(weights)
        columns = {
            "position": pa.array(p, pa.int32()),
            "entry": pa.array(e, pa.int32()),
            "weight": pa.array(weights[p, e], pa.int64()),
            "sums": pa.array(sums[p, e].tolist(), pa.list_(pa.int64())),
        }
        yield pa.RecordBatch.from_pydict(columns)

    partial = leaves.mapInArrow(run, "position int, entry int, weight bigint, sums array<bigint>")
    moved = (
        partial.select("position", "entry", "weight", F.posexplode("sums").alias("at", "part_sum"))
        .groupBy("position", "entry", "at")
        .agg(F.sum(F.col("part_sum").cast("decimal(38,0)")).alias("total"), F.sum("weight").alias("n"))
        .collect()  # no more rows than the codebooks have components
    )
    held.unpersist()
    after = codebooks.copy()
    for position, entry, at, total, n in moved:
        after[position, entry, at] = int(total) // n
    return after


def compress(
    vectors: DataFrame,
    parts: int = 4,
    entries: int = 256,
    rounds: int = 4,
    scale: int = 1024,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    steps: Steps | None = None,
) -> Codes:
    """Fit the codebooks on all vectors, and code every vector with them."""
    steps = steps or Steps(vectors.sparkSession)
    finite = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    usable = F.coalesce(finite, F.lit(False))
    wide = F.exists(vector_col, lambda x: F.abs(x.cast("double")) > LARGEST / scale)
    # Spark may evaluate the column before the filter, so the check asks for usable rows itself.
    refused = F.raise_error(F.lit(f"a component exceeds {LARGEST} after scaling"))
    whole = vectors.filter(usable).select(
        F.col(id_col).alias("id"),
        F.col(label_col).alias("label"),
        F.when(usable & wide, refused).otherwise(scaled(F.col(vector_col), scale)).alias("v"),
    )
    codebooks = _initial(whole, parts, entries)
    if codebooks is None:
        empty = whole.select("id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("bigint").alias("error"))
        return Codes(np.zeros((parts, 0, 0), np.int64), empty)
    width = codebooks.shape[2]
    slices = F.array(*[F.slice("v", p * width + 1, width) for p in range(parts)])
    leaves = steps.keep(
        whole.filter(F.size("v") == parts * width)
        .select(F.posexplode(slices).alias("position", "part"))
        .groupBy("position", "part")
        .agg(F.count(F.lit(1)).alias("weight"))
        .repartitionByRange("position", "part")
        .sortWithinPartitions("position", "part")
    )
    for _ in range(rounds):
        codebooks = _round(leaves, codebooks)
    steps.drop(leaves)
    return Codes(codebooks, _coded(whole, codebooks))


def _coded(whole: DataFrame, codebooks: np.ndarray) -> DataFrame:
    parts, entries, width = codebooks.shape
    held = whole.sparkSession.sparkContext.broadcast(codebooks)
    digits = max(2, len(f"{entries - 1:x}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = held.value
        for batch in batches:
            sizes = batch.column("v").value_lengths().to_numpy()
            fit = np.flatnonzero(sizes == parts * width)
            table = _matrix(batch.column("v").take(pa.array(fit)), parts * width)
            codes, errors = [None] * len(sizes), [None] * len(sizes)
            chosen, total = [], np.zeros(len(fit), np.int64)
            for p in range(parts):
                entry, distance = nearest(books[p], table[:, p * width : (p + 1) * width])
                chosen.append(entry.tolist())
                total += distance
            for row, error, *code in zip(fit.tolist(), total.tolist(), *chosen):
                codes[row], errors[row] = "".join(f"{entry:0{digits}x}" for entry in code), error
            columns = [batch.column("id"), batch.column("label"), pa.array(codes, pa.string()), pa.array(errors, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "label", "code", "error"])

    kinds = dict(whole.dtypes)
    return whole.mapInArrow(run, f"id {kinds['id']}, label {kinds['label']}, code string, error bigint")


def report(codes: Codes, steps: Steps, id_col: str = "vec_id") -> DataFrame:
    """Per vector: id, code, error, the error summed over its label, the codebooks' digest."""
    named = F.coalesce(F.concat(F.lit("="), F.col("label").cast("string")), F.lit("null"))
    rows = steps.keep(codes.rows.select("id", named.alias("_label"), "code", "error"))
    sums = steps.keep(rows.groupBy("_label").agg(F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("_n")))
    return lookup_join(rows, sums, "_label", "_n", LABELS).select(
        F.col("id").alias(id_col), "code", "error", "label_error", F.lit(codes.digest()).alias("codebooks_sha256")
    )
