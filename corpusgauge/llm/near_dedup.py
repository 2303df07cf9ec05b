"""Near duplicates by a multi-index Hamming join over MinHash signatures.

A text's signature has ``VALUES`` b-bit min-hash values of its word shingles. Two texts of Jaccard
likeness J differ in a value with probability 1 - J, so links lie within ``errors_allowed`` unequal
values but for about one in a million. The signature is split into chunks so many that two
signatures within that distance have a chunk with at most one error (pigeonhole); leaving out each
value of each chunk in turn enumerates the allowed errors, so any such pair shares a key.

Buckets of equal keys are never listed pair by pair:

1. equal shingle sets are one class from the start;
2. in each bucket every member is compared with one pivot, on the full sets; components follow;
3. a bucket is open if its other members lie in several components. A text of which more than
   (1 - threshold) of the shingles occur in no other open text has no link there and is left out;
4. what is still open falls into families of texts that share open buckets. A family is compared in
   pairs of bounded blocks, where only pairs of different components within the signature
   distance are confirmed on the full sets.

So no link within the signature distance is lost, and copies and stars never meet pair by pair.

Defined results: null text counts as empty; without words a text has no shingles, no link and its
own component; with fewer words than a shingle the whole sequence is its one shingle; rows that
repeat an id share its component; rows with a null id take part and have a null component only if
no linked row has an id; an empty table gives no rows. Only the two named columns are read.
"""

from __future__ import annotations

import functools
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusgauge.durable import Steps
from corpusgauge.llm.bytebpe import Memo, worker_state
from corpusgauge.llm.graph import components
from corpusgauge.operators.keyed import lookup_join, spread_join

VALUES = 64
BLOCK = 128
#: Keys or ids broadcast at once (16 to 40 bytes each); more are joined by a shuffle.
BROADCAST_ROWS = 200_000
_ODD = np.uint64(0x9E3779B97F4A7C15)


def errors_allowed(threshold: float, values: int = VALUES, miss: float = 1e-6) -> int:
    """Least t for which a pair at the threshold differs in more than t values with chance < miss."""
    p, tail = 1 - threshold, 1.0
    for t in range(values):
        tail -= math.comb(values, t) * p**t * (1 - p) ** (values - t)
        if tail < miss:
            return t
    return values


def chunks(errors: int, values: int = VALUES) -> list[tuple[int, int]]:
    """Ranges of values such that ``errors`` errors leave one of them with at most one."""
    count = min(values, errors // 2 + 1)
    edges = [values * at // count for at in range(count + 1)]
    return list(zip(edges, edges[1:]))


# ---------------------------------------------------------------- shingles and signatures


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _word_hashes() -> Memo:
    def hashed(word: bytes) -> int:
        return int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")

    return worker_state("shingles", lambda: Memo(hashed, limit=100_000))


def shingle_set(text: str, words: int) -> np.ndarray:
    """Distinct 64-bit hashes of the word shingles, ascending. Only A-Z are lowered."""
    parts = text.encode().lower().split()  # bytes split at [\x20\x09-\x0D] alone
    if not parts:
        return np.zeros(0, np.uint64)
    codes = np.array(list(map(_word_hashes().__getitem__, parts)), np.uint64)
    length = min(words, len(parts))
    shingle = np.full(len(parts) - length + 1, length, np.uint64)
    for at in range(length):
        shingle = _mixed(shingle * _ODD + codes[at : at + len(shingle)])
    return np.unique(shingle)


@functools.lru_cache(maxsize=1)
def _multipliers() -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(20_001)
    return draw.integers(0, 1 << 63, VALUES, np.uint64) * np.uint64(2) + np.uint64(1), draw.integers(0, 1 << 63, VALUES, np.uint64)


def signature(shingles: np.ndarray) -> bytes:
    """``VALUES`` min-hash values, 16 bits of each."""
    times, plus = _multipliers()
    least = np.full(VALUES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 2048):
        block = shingles[at : at + 2048, None] * times + plus
        np.minimum(least, block.min(axis=0), out=least)
    return (_mixed(least) >> np.uint64(48)).astype("<u2").tobytes()


def sign(docs: DataFrame, words: int) -> DataFrame:
    """(id, n, set_key, sig) of each row of (id, text)."""
    kind = docs.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, keys, signatures = [], [], []
            for cell in batch.column("text"):
                shingles = shingle_set(cell.as_py(), words)
                sizes.append(len(shingles))
                keys.append(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest())
                signatures.append(signature(shingles))
            columns = [batch.column("id"), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(signatures, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n", "set_key", "sig"])
        worker_state("none")  # a worker that waits for its next task holds no memo

    return docs.mapInArrow(run, f"id {kind}, n bigint, set_key binary, sig binary")


def bucket_keys(classes: DataFrame, errors: int) -> DataFrame:
    """(key, node): one key for each chunk and each value of it that is left out."""
    ranges = chunks(errors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        times, plus = _multipliers()
        for batch in batches:
            for start in range(0, batch.num_rows, 4096):
                piece = batch.slice(start, 4096)
                nodes = piece.column("node").to_numpy()
                values = np.frombuffer(b"".join(piece.column("sig").to_pylist()), "<u2").reshape(-1, VALUES)
                weighed = _mixed((values.astype(np.uint64) + np.uint64(1)) * times + plus)
                keys = np.empty((len(nodes), VALUES), np.uint64)
                for first, after in ranges:
                    # The sum of a chunk's values without one of them names chunk and place too.
                    total = weighed[:, first:after].sum(axis=1, dtype=np.uint64)
                    place = np.arange(first + 1, after + 1, dtype=np.uint64) * _ODD
                    keys[:, first:after] = _mixed(total[:, None] - weighed[:, first:after] + place)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.ravel().view(np.int64)), pa.array(np.repeat(nodes, VALUES))], ["key", "node"]
                )

    return classes.select("node", "sig").mapInArrow(run, "key bigint, node bigint")


# ---------------------------------------------------------------- confirming


def _linked(one: np.ndarray, other: np.ndarray, percent: int) -> bool:
    small, large = sorted((len(one), len(other)))
    if 100 * small < percent * large:
        return False
    both = len(np.intersect1d(one, other, assume_unique=True))
    return 100 * both >= percent * (small + large - both)


def full_sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(node, n, shingles) of the wanted (node, id, set_key), cut again from the texts."""
    wanted = wanted.select("node", F.col("id").alias("rep"), "set_key")
    if wanted.count() <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, sizes, sets = [], [], []
            for node, key, cell in zip(batch.column("node").to_pylist(), batch.column("set_key").to_pylist(), batch.column("text")):
                shingles = shingle_set(cell.as_py(), words)
                # Rows that repeat an id or have none are told apart by their sets.
                if hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() == key:
                    nodes.append(node), sizes.append(len(shingles)), sets.append(shingles.tobytes())
            columns = [pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()), pa.array(sets, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["node", "n", "shingles"])
        worker_state("none")

    found = docs.join(wanted, F.col("id").eqNullSafe(F.col("rep"))).select("node", "set_key", "text")
    return found.mapInArrow(run, "node bigint, n bigint, shingles binary")


def _beside(pairs: DataFrame, nodes: DataFrame, column: str) -> DataFrame:
    """(a, b, x, y): a pair and the column's value of either node; the pivot of many pairs is copied.

    ``pairs`` is a written table.
    """
    sides = {end: nodes.select(F.col("node").alias(end), F.col(column).alias(name)) for end, name in (("a", "x"), ("b", "y"))}
    half = spread_join(pairs, sides["a"], "a", "b")
    return spread_join(half, sides["b"], "b", "a", narrow=pairs).select("a", "b", "x", "y")


def within_distance(pairs: DataFrame, classes: DataFrame, errors: int) -> DataFrame:
    """The pairs (a, b) whose signatures differ in at most ``errors`` values."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = [np.frombuffer(b"".join(batch.column(name).to_pylist()), "<u2").reshape(-1, VALUES) for name in ("x", "y")]
            near = pa.array((sides[0] != sides[1]).sum(axis=1) <= errors)
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(near), batch.column("b").filter(near)], ["a", "b"])

    return _beside(pairs, classes, "sig").mapInArrow(run, "a bigint, b bigint")


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs that are links by their full sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = zip(batch.column("x").to_pylist(), batch.column("y").to_pylist())
            good = pa.array([_linked(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent) for x, y in cells], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(good), batch.column("b").filter(good)], ["a", "b"])

    return _beside(pairs, sets, "shingles").mapInArrow(run, "a bigint, b bigint")


# ---------------------------------------------------------------- open buckets


def _open(members: DataFrame, steps: Steps) -> DataFrame:
    """Rows (key, node, component) of the buckets whose members lie in several components; kept as a table."""
    keys = members.groupBy("key").agg(
        F.min("component").alias("least"), F.max("component").alias("most"), F.count(F.lit(1)).alias("rows")
    )
    open_keys = steps.keep(keys.filter("least <> most").select("key", "rows"))
    opened = steps.keep(lookup_join(members, open_keys, "key", "rows", BROADCAST_ROWS).drop("rows"))
    steps.drop(open_keys)
    return opened


def _with_kin(sets: DataFrame, percent: int) -> DataFrame:
    """Nodes of which at least ``percent`` of the shingles occur in another open set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, n, cell in zip(batch.column("node").to_pylist(), batch.column("n").to_pylist(), batch.column("shingles").to_pylist()):
                codes = np.frombuffer(cell, np.int64)
                for at in range(0, len(codes), 65536):
                    part = codes[at : at + 65536]
                    rows = [pa.array(np.full(len(part), value, np.int64)) for value in (node, n)]
                    yield pa.RecordBatch.from_arrays([*rows, pa.array(part)], ["node", "n", "code"])

    postings = sets.mapInArrow(run, "node bigint, n bigint, code bigint")
    # A code of one node has that node as least and most; for the others it counts nothing.
    lone = postings.groupBy("code").agg(F.min("node").alias("node"), F.max("node").alias("most"), F.first("n").alias("n"))
    alone = lone.filter("node = most").groupBy("node").agg(F.count(F.lit(1)).alias("alone"), F.first("n").alias("n"))
    without = alone.filter(100 * (F.col("n") - F.col("alone")) < percent * F.col("n")).select("node")
    return sets.select("node").distinct().join(without, "node", "left_anti")


def _block_links(rows: DataFrame, sizes: DataFrame, errors: int, percent: int) -> DataFrame:
    """Links (a, b) between different components inside families, by pairs of blocks.

    ``rows``: node, family, component, sig, shingles. ``sizes``: family and its ``rows``, a written
    table; a large family is spread by blocks and never dealt to one task.
    """
    sized = lookup_join(rows, sizes, "family", "rows", BROADCAST_ROWS)
    sized = sized.withColumn("blocks", F.ceil(F.col("rows") / BLOCK).cast("int"))
    sized = sized.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    paired = sized.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "family",
        F.least("block", "other").alias("i"),
        F.greatest("block", "other").alias("j"),
        "block",
        "node",
        "component",
        "sig",
        "shingles",
    )

    def run(table: pa.Table) -> pa.Table:
        nodes, home = table.column("node").to_pylist(), table.column("component").to_pylist()
        block = np.array(table.column("block").to_pylist())
        values = np.frombuffer(b"".join(table.column("sig").to_pylist()), "<u2").reshape(-1, VALUES)
        sets = [np.frombuffer(cell, np.uint64) for cell in table.column("shingles").to_pylist()]
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        root = {component: component for component in home}

        def find(x):
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        out = []
        for at in range(len(nodes)):
            rest = np.arange(at + 1, len(nodes))
            if i != j:
                rest = rest[block[rest] != block[at]]
            near = rest[(values[rest] != values[at]).sum(axis=1) <= errors]
            for other in near:
                a, b = find(home[at]), find(home[other])
                if a != b and _linked(sets[at], sets[other], percent):
                    root[max(a, b)] = min(a, b)
                    out.append((nodes[at], nodes[other]))
        ends = list(zip(*out)) or [(), ()]
        return pa.table({"a": pa.array(ends[0], pa.int64()), "b": pa.array(ends[1], pa.int64())})

    return paired.groupBy("family", "i", "j").applyInArrow(run, "a bigint, b bigint")


# ---------------------------------------------------------------- the operator


def group(
    docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row: id, n_shingles, component_id (least id of the group), kept, set_key.

    Links: ``100 * intersection >= percent * union`` of the sets of ``words``-word shingles.
    """
    steps = Steps(docs.sparkSession)
    errors = errors_allowed(percent / 100)
    source = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    signed = steps.keep(sign(source, words))
    grouped = signed.filter("n > 0").groupBy("set_key").agg(
        F.min("id").alias("id"), F.first("sig").alias("sig"), F.first("n").alias("n"), F.count(F.lit(1)).alias("copies")
    )
    classes = steps.keep(grouped.withColumn("node", F.monotonically_increasing_id()))

    # Buckets of at least two members, with the member that the others are compared with.
    keys = bucket_keys(classes, errors)
    pivot = F.min(F.struct(F.xxhash64("node").alias("order"), "node"))
    buckets = keys.groupBy("key").agg(F.count(F.lit(1)).alias("size"), pivot.alias("pivot"))
    buckets = steps.keep(buckets.filter("size > 1").select("key", "size", F.col("pivot.node").alias("pivot")))
    members = steps.keep(
        lookup_join(keys, buckets, "key", "size", BROADCAST_ROWS).filter("node <> pivot").select("key", "node", "pivot")
    )
    ends = members.select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b"))
    pairs = steps.keep(ends.distinct())
    near = steps.keep(within_distance(pairs, classes, errors))
    steps.drop(pairs)
    touched = near.select(F.col("a").alias("node")).unionByName(near.select(F.col("b").alias("node"))).distinct()
    sets = steps.keep(full_sets(source, classes.join(touched, "node", "left_semi"), words))
    links = steps.keep(confirm(near, sets, percent))
    steps.drop(sets, near)
    first = components(links, steps)

    # Members of a bucket other than its pivot still have to meet across components.
    labelled = members.join(first, "node", "left").select(
        "key", "node", F.coalesce("component", "node").alias("component")
    )
    still = _open(labelled, steps)
    open_nodes = still.select("node").distinct()
    sets = steps.keep(full_sets(source, classes.join(open_nodes, "node", "left_semi"), words))
    kin = steps.keep(_with_kin(sets, percent))
    still = _open(still.join(kin, "node", "left_semi"), steps)
    sized = steps.keep(still.groupBy("key").agg(F.min("node").alias("b"), F.count(F.lit(1)).alias("rows")))
    spokes = lookup_join(still.select("key", F.col("node").alias("a")), sized, "key", "rows", BROADCAST_ROWS)
    families = components(spokes, steps).withColumnRenamed("component", "family")
    sizes = steps.keep(families.groupBy("family").agg(F.count(F.lit(1)).alias("rows")))
    rows = (
        families.join(still.select("node", "component").distinct(), "node")
        .join(classes.select("node", "sig"), "node")
        .join(sets.select("node", "shingles"), "node")
    )
    more = steps.keep(_block_links(rows, sizes, errors, percent))
    final = first
    if not more.isEmpty():
        final = components(links.unionByName(more), steps)

    # Least id of each group, back to the classes and to the rows; hot groups are broadcast.
    homes = steps.keep(
        classes.join(final, "node", "left").select("set_key", "id", "copies", F.coalesce("component", "node").alias("component"))
    )
    named = steps.keep(
        homes.groupBy("component").agg(F.min("id").alias("component_id"), F.count(F.lit(1)).alias("classes"))
    )
    of_class = steps.keep(
        lookup_join(homes, named, "component", "classes", BROADCAST_ROWS).select("set_key", "component_id", "copies")
    )
    linked = lookup_join(signed.filter("n > 0").select("id", "n", "set_key"), of_class, "set_key", "copies", BROADCAST_ROWS)
    columns = ["id", "n", "component_id", "set_key"]
    alone = signed.filter("n = 0").withColumn("component_id", F.col("id")).select(columns)
    return linked.select(columns).unionByName(alone).select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
        "set_key",
    )
