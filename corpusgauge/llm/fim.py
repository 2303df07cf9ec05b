"""Fill-in-the-middle: documents cut into prefix, middle and suffix and put in another order.

Texts are handled as UTF-8 bytes. Code points and bytes differ only where a character takes more
than one byte, so only those characters are recorded (``ByteIndex``): their positions and the bytes
they take in excess of one. A cut is converted by one ``searchsorted`` among them; spans of ASCII
cost nothing but arithmetic.

Cuts lie between tokens: white space with the word after it, or the white space that ends a text.
Draws come from the SHA-256 of seed and id, so they do not depend on how rows are dealt out.

Defined results: null text counts as empty; an empty text, and one that holds a mark, stays plain
with null lengths; a null id draws as if it were written as nothing; rows that repeat an id are rows
of their own and draw alike; an empty table gives no rows. Other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The marks before prefix, suffix and middle, and the white space between tokens.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
WHITE = b" \t\n\v\f\r"
_IS_WORD = ~np.isin(np.arange(256), np.frombuffer(WHITE, np.uint8))
_MARKS = tuple(mark.encode() for mark in (PREFIX, SUFFIX, MIDDLE))


class ByteIndex:
    """Where code points and bytes of a UTF-8 text part: its multibyte characters alone.

    ``starts`` holds their byte positions, ``excess[i]`` the bytes beyond one of the first i of them.
    """

    __slots__ = ("starts", "excess", "places")

    def __init__(self, data: bytes) -> None:
        if data.isascii():
            self.starts = self.places = np.empty(0, np.int64)
            self.excess = np.zeros(1, np.int64)
            return
        codes = np.frombuffer(data, np.uint8)
        self.starts = np.flatnonzero(codes >= 0xC0)
        lead = codes[self.starts]
        self.excess = np.zeros(len(lead) + 1, np.int64)
        np.cumsum(1 + (lead >= 0xE0).astype(np.int64) + (lead >= 0xF0), out=self.excess[1:])
        #: Code-point positions of the same characters.
        self.places = self.starts - self.excess[:-1]

    def to_points(self, at: np.ndarray) -> np.ndarray:
        """Code points before byte positions that lie between characters."""
        return at - self.excess[np.searchsorted(self.starts, at)]

    def to_bytes(self, at: np.ndarray) -> np.ndarray:
        """Bytes before code-point positions."""
        return at + self.excess[np.searchsorted(self.places, at)]


def token_ends(data: bytes) -> np.ndarray:
    """Byte position after each token."""
    if not data:
        return np.empty(0, np.int64)
    word = _IS_WORD[np.frombuffer(data, np.uint8)]
    after = np.empty(len(word), bool)
    after[:-1] = word[1:]
    after[-1] = False
    ends = np.flatnonzero(word & ~after) + 1
    return ends if word[-1] else np.append(ends, len(data))


@dataclass(frozen=True)
class Rule:
    """How often texts are transformed, and which form they take (shares of a hundred)."""

    seed: str = "42"
    transformed: int = 50
    suffix_first: int = 80


def draws(id_col: Column, seed: str) -> Column:
    """Four unsigned 32-bit numbers from seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))), 256)
    return F.array(*[F.conv(F.substring(digest, 8 * at + 1, 8), 16, 10).cast("bigint") for at in range(4)])


def transform(data: bytes, h: tuple[int, int, int, int], rule: Rule) -> tuple[int, str, int | None, int | None, bytes]:
    """(tokens, form, prefix code points, middle code points, output) of one text."""
    ends = token_ends(data)
    n = len(ends)
    if not data or h[2] % 100 >= rule.transformed or any(mark in data for mark in _MARKS):
        return n, "plain", None, None, data
    units = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    cuts = np.array([int(ends[unit - 1]) if unit else 0 for unit in units])
    first, second = map(int, ByteIndex(data).to_points(cuts))
    low, high = map(int, cuts)
    prefix, middle, suffix = data[:low], data[low:high], data[high:]
    of_prefix, of_suffix, of_middle = _MARKS
    if h[3] % 100 < rule.suffix_first:
        form, parts = "spm", (of_suffix, suffix, of_prefix, prefix, of_middle, middle)
    else:
        form, parts = "psm", (of_prefix, prefix, of_suffix, suffix, of_middle, middle)
    return n, form, first, second - first, b"".join(parts)


def fill_in_middle(docs: DataFrame, rule: Rule = Rule(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n, form, prefix_chars, middle_chars, output."""
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"),
        draws(F.col(id_col), rule.seed).alias("h"),
    )
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary())
        names = ["n", "form", "prefix_chars", "middle_chars", "output"]
        for batch in batches:
            texts, numbers = batch.column("text"), batch.column("h").to_pylist()
            made = [transform(cell.as_py(), h, rule) for cell, h in zip(texts, numbers)]
            columns = [pa.array([line[at] for line in made], of) for at, of in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *columns], ["id", *names])

    schema = f"id {kind}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output binary"
    made = rows.mapInArrow(run, schema)
    return made.withColumn("output", F.col("output").cast("string")).withColumnRenamed("id", id_col)


def restore(output: Column, form: Column) -> Column:
    """The text that an output was made from.

    Only plain texts hold marks of their own, so the first of each mark is the one put in: no text
    can end a mark that it does not begin.
    """
    p, s, m = (F.instr(output, mark) for mark in (PREFIX, SUFFIX, MIDDLE))
    size = len(PREFIX)

    def between(start: Column, end: Column) -> Column:
        return output.substr(start + size, end - start - size)

    rest = output.substr(m + size, F.length(output))
    psm = F.concat(between(p, s), rest, between(s, m))
    spm = F.concat(between(p, m), rest, between(s, p))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def report(made: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Digests of the output and of the text restored from it."""
    return made.select(
        id_col,
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )
