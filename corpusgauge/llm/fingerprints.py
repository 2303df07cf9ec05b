"""Lempel-Ziv phrase fingerprints: texts that would compress each other have like fingerprints.

A text is parsed into dictionary phrases (each the longest phrase seen before plus one character).
The phrases are hashed and the fingerprint is the ``size`` least distinct hashes, so the likeness of
two fingerprints estimates the Jaccard likeness of the phrase sets. The dictionary starts anew
after ``RESET`` phrases, which bounds memory on very long texts.

Every text is also compared with the next document by id and with its edited text (its second half
replaced by the beginning of the next document). The documents are cut into blocks of consecutive
ids; the first row of each block is sent along to the block before, so a block is one stream of
rows, each text moves once, and only the block boundaries reach the driver.

Defined results: null text counts as empty; an empty text has an empty fingerprint, which is like
an empty one (1) and unlike any other (0); ids sort with nulls first and, where they repeat, by a
hash of the text; after the last document comes the first (a single document is its own next);
an empty table gives no rows. Other columns are never read.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusgauge.operators.keyed import number_rows

SIZE = 128
RESET = 1 << 18
LEAST_BLOCK, MOST_BLOCKS = 2000, 4096
_MIX = np.uint64(0x9E3779B97F4A7C15)


class Parse:
    """A Lempel-Ziv parse that can be continued, and continued differently from a copy."""

    __slots__ = ("seen", "current", "hashes")

    def __init__(self) -> None:
        self.seen: set[str] = set()
        self.current = ""
        self.hashes: list[np.ndarray] = []

    def copy(self) -> Parse:
        other = Parse()
        other.seen, other.current, other.hashes = self.seen.copy(), self.current, self.hashes.copy()
        return other

    def feed(self, text: str) -> Parse:
        seen, current, new = self.seen, self.current, []
        add, found = seen.add, new.append
        for character in text:
            current += character
            if current not in seen:
                add(current)
                found(current)
                current = ""
                if len(seen) >= RESET:
                    seen.clear()
                    self._hash(new)
                    new.clear()
        self.current = current
        self._hash(new)
        return self

    def _hash(self, phrases: list[str]) -> None:
        if phrases:
            codes = map(crc32, map(str.encode, phrases))
            self.hashes.append(np.fromiter(codes, np.uint64, len(phrases)))

    def fingerprint(self, size: int = SIZE) -> np.ndarray:
        """The least distinct phrase hashes, ascending."""
        if not self.hashes:
            return np.zeros(0, np.uint32)
        codes = np.concatenate(self.hashes)
        codes = ((codes + np.uint64(1)) * _MIX) >> np.uint64(32)
        if len(codes) > 4 * size:
            # Repeats come only from resets; take more than enough before sorting.
            least = np.unique(np.partition(codes, 4 * size)[: 4 * size])
            if len(least) >= size:
                return least[:size].astype(np.uint32)
        return np.unique(codes)[:size].astype(np.uint32)


def shown(fingerprint: np.ndarray) -> str:
    return base64.b64encode(fingerprint.astype("<u4").tobytes()).decode()


def likeness(one: np.ndarray, other: np.ndarray, size: int = SIZE) -> float:
    """Share of the union's least hashes that both have."""
    if not len(one) or not len(other):
        return float(len(one) == len(other))
    least = np.union1d(one, other)[:size]
    both = np.isin(least, one, assume_unique=True) & np.isin(least, other, assume_unique=True)
    return float(both.sum() / len(least))


def edited(text: str, following: str) -> str:
    """The last half of the text replaced by as many characters of the following one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _key(identity, tie) -> tuple:
    return (identity is not None, identity if identity is not None else 0, tie)


class _Stream:
    """Rows of one block in order; each is finished when its successor is known."""

    def __init__(self) -> None:
        self.block, self.before, self.closed = None, None, False

    def take(self, block: int, extra: bool, identity, text: str) -> tuple | None:
        if block != self.block:
            self.block, self.before, self.closed = block, None, False
        if self.closed:
            return None
        half = len(text) - len(text) // 2
        parse = Parse().feed(text[:half])
        front = parse.copy()
        parse.feed(text[half:])
        fingerprint = parse.fingerprint()
        row = None
        if self.before is not None:
            own_id, own_text, own_front, own = self.before
            changed = edited(own_text, text)
            other = own_front.feed(changed[len(own_text) - len(own_text) // 2 :]).fingerprint()
            digest = hashlib.sha256(changed.encode()).hexdigest()
            row = (own_id, len(own_text), digest, shown(own), shown(other), likeness(own, other), likeness(own, fingerprint))
        self.before, self.closed = (identity, text, front, fingerprint), extra
        return row


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    kind = rows.schema["id"].dataType.simpleString()
    schema = (
        f"id {kind}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )
    order = number_rows(rows.select("id", "tie"), ["id", "tie"], "number")
    total = order.count()
    size = max(LEAST_BLOCK, -(-total // MOST_BLOCKS))
    starts = order.filter((F.col("number") - 1) % size == 0).select("id", "tie").collect()  # MOST_BLOCKS at most
    keys = sorted({_key(*row) for row in starts})
    blocks = max(1, len(keys))

    # Null ids are told apart before pandas sees the ids: a null among them would round the others.
    filler = next((identity for identity, _ in starts if identity is not None), None)

    @F.pandas_udf("block int, first boolean")
    def locate(ids: pd.Series, missing: pd.Series, ties: pd.Series) -> pd.DataFrame:
        found, first = [], []
        for identity, absent, tie in zip(ids, missing, ties):
            key = _key(None if absent else identity, tie)
            at = bisect.bisect_right(keys, key) - 1
            found.append(at)
            first.append(keys[at] == key)
        return pd.DataFrame({"block": found, "first": first})

    whole_id = F.coalesce("id", F.lit(filler).cast(kind))
    own = F.struct(F.col("at.block").alias("block"), F.lit(False).alias("extra"))
    ahead = F.struct(((F.col("at.block") + blocks - 1) % blocks).alias("block"), F.lit(True).alias("extra"))
    placed = (
        rows.withColumn("at", locate(whole_id, F.col("id").isNull(), "tie"))
        .withColumn("to", F.when(F.col("at.first"), F.array(own, ahead)).otherwise(F.array(own)))
        .select("id", "text", "tie", F.explode("to").alias("to"))
        .select("id", "text", "tie", "to.block", "to.extra")
        .repartitionById(blocks, "block")
        .sortWithinPartitions("block", "extra", "id", "tie")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = _Stream()
        wanted = ["n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
        kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        for batch in batches:
            id_type = batch.schema.field("id").type
            cells = zip(batch.column("block"), batch.column("extra"), batch.column("id"), batch.column("text"))
            done = [stream.take(*(cell.as_py() for cell in row)) for row in cells]
            done = [row for row in done if row is not None]
            if done:
                columns = list(zip(*done))
                arrays = [pa.array(columns[0], id_type)] + [pa.array(c, k) for c, k in zip(columns[1:], kinds)]
                yield pa.RecordBatch.from_arrays(arrays, ["id", *wanted])

    return placed.select("block", "extra", "id", "text").mapInArrow(run, schema).withColumnRenamed("id", id_col)
