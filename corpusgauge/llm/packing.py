"""Packing documents into windows by non-negative least squares over the length histogram.

Every document becomes its token ids and an end id. Whole windows are cut off its front; what is
left is a tail shorter than the window. Only the histogram of tail lengths (fewer than ``window``
counts) reaches the driver. There, all combinations of two or three lengths that fill a window
exactly are enumerated, repeat counts x >= 0 are fitted to the histogram h by minimising
|Ax - h|^2, rounded down, and the rest is filled greedily: first by more exact combinations, at
last end to end with cuts at window ends. So only the very last sequence is padded.

Tails are numbered by (length, row), so the plan is a short list of segments of that numbering, and
each task places its rows by searching that list.

Defined results: null text counts as empty and yields the end id alone; rows that repeat an id are
packed as rows of their own; an empty table gives no pieces. Other columns are never read.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusgauge.durable import Steps
from corpusgauge.llm.bytebpe import Memo, byte_alphabet, worker_state
from corpusgauge.operators.keyed import number_rows

#: Cut tails broadcast at once (16 bytes each); more are joined by a shuffle.
BROADCAST_CUTS = 200_000
PIECE = "id {id}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"


# ---------------------------------------------------------------- tokens


# Words of these characters, none of them a capital, pass the vocabulary's normalizer unchanged.
PLAIN_WORD = re.compile(r"[!-~À-ÖØ-öø-ſ]+")
# Fixed value: the vocabulary's pre-token pattern, for such words.
PLAIN_PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ſ]+|[0-9]|[^a-z0-9ß-öø-ſ]+")
PUNCTUATION = frozenset(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")
# Every combining mark lies here.
MARKS = re.compile("[\u0300-\U0010ffff]")
BYTE_SHOWN = {byte: shown for shown, byte in byte_alphabet().items()}


class WordTokenizer:
    """Ids of whole texts by the tokenizers library, asked once per word.

    The vocabulary drops white space and its pre-tokens never span any, so words between ASCII
    white space can be encoded alone. Capitals A-Z are lowered first (the vocabulary is lower
    case), except where a special string or a combining mark may be near. Words whose normal form and pre-tokens
    are plain go straight to the library's merges, the others through all of it. Words are
    remembered in a bounded memo.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.model = self.library.model
        self.pieces = Memo(self._piece, limit=50_000)
        self.memo = Memo(self._word, limit=200_000)

    def _merge(self, shown: str) -> bytes:
        return array("I", [token.id for token in self.model.tokenize(shown)]).tobytes()

    def _piece(self, piece: str) -> bytes:
        shown = piece if piece.isascii() else piece.encode().decode("latin-1").translate(BYTE_SHOWN)
        return self._merge(shown)

    def _word(self, word: bytes) -> bytes:
        if word.isalpha() and word.islower():  # a-z only: one pre-token
            return self._merge(word.decode())
        stem = word[:-1]
        if word[-1] in PUNCTUATION and stem.isalpha() and stem.islower():
            return self.memo[stem] + self.pieces[word[-1:].decode()]
        text = word.decode()
        if PLAIN_WORD.fullmatch(text) and "<|" not in text and text == text.lower():
            return b"".join(map(self.pieces.__getitem__, PLAIN_PIECE.findall(text)))
        return array("I", self.library.encode(text, add_special_tokens=False).ids).tobytes()

    def split(self, text: str) -> list[bytes]:
        """Words between ASCII white space, their A-Z lowered where that cannot change the ids."""
        if "<|" in text:
            return text.encode().split()
        if text.isascii() or not MARKS.search(text):
            return text.encode().lower().split()
        # A mark after a letter may compose with its small form and not with its capital.
        return [word.lower() if word.isascii() else word for word in text.encode().split()]

    def encode(self, words: list[bytes]) -> bytes:
        return b"".join(map(self.memo.__getitem__, words))


def word_tokenizer(path: str) -> WordTokenizer:
    """The worker's tokenizer for a vocabulary file."""
    return worker_state(f"word tokenizer {path}", lambda: WordTokenizer(path))


def token_batches(batches: Iterator[pa.RecordBatch], path: str, step: int, end: bytes) -> Iterator[pa.RecordBatch]:
    """A task's rows of :func:`tokenize`; the tokenizer and its memo stay for the worker's next task."""
    tokenizer = word_tokenizer(path)
    for batch in batches:
        for part in range(0, batch.num_rows, 250):
            piece = batch.slice(part, 250)
            words = [tokenizer.split(cell.as_py()) for cell in piece.column("text")]
            ids = [tokenizer.encode(own) + end for own in words]
            whole = [len(own) // step * step for own in ids]
            crcs = [[zlib.crc32(own[at : at + step]) for at in range(0, cut, step)] for own, cut in zip(ids, whole)]
            tails = [zlib.crc32(own[cut:]) for own, cut in zip(ids, whole)]
            columns = [
                piece.column("row"),
                piece.column("id"),
                pa.array([len(own) // 4 for own in ids], pa.int64()),
                pa.array(crcs, pa.list_(pa.int64())),
                pa.array(tails, pa.int64()),
                pa.array(ids, pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["row", "id", "doc_tokens", "full_crcs", "tail_crc", "ids"])


def tokenize(docs: DataFrame, path: str, window: int, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """(row, id, doc_tokens, full_crcs, tail_crc, ids) per row; ids are little-endian uint32."""
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).alias("id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"row bigint, id {kind}, doc_tokens bigint, full_crcs array<bigint>, tail_crc bigint, ids binary"
    end = array("I", [end_id]).tobytes()
    step = 4 * window

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return token_batches(batches, path, step, end)

    return rows.mapInArrow(run, schema)


# ---------------------------------------------------------------- plan


def combinations(window: int) -> np.ndarray:
    """All a <= b <= c with a + b + c = window and a >= 0; a = 0 stands for two lengths."""
    firsts = np.arange(window // 3 + 1)
    out = []
    for a in firsts:
        b = np.arange(max(a, 1), (window - a) // 2 + 1)
        out.append(np.stack([np.full_like(b, a), b, window - a - b], axis=1))
    return np.concatenate(out)


def _disjoint(combos: np.ndarray, gain: np.ndarray, window: int) -> np.ndarray:
    """Of the combinations with positive gain, a set that shares no length, best gains first."""
    chosen = []
    left = np.flatnonzero(gain > 0)
    if len(left) > 16 * window:  # the largest gains are enough for one round
        left = left[np.argpartition(-gain[left], 16 * window)[: 16 * window]]
    left = left[np.argsort(-gain[left], kind="stable")]
    while len(left):
        first = np.full(window, len(left))
        for slot in (2, 1, 0):
            np.minimum.at(first, combos[left, slot], np.arange(len(left)))
        first[0] = len(left)
        place = np.arange(len(left))
        is_first = [(first[combos[left, slot]] == place) | (combos[left, slot] == 0) for slot in range(3)]
        taken = left[is_first[0] & is_first[1] & is_first[2]]
        chosen.append(taken)
        used = np.zeros(window, bool)
        used[combos[taken].ravel()] = True
        used[0] = False
        left = left[~used[combos[left]].any(axis=1)]
    return np.concatenate(chosen) if chosen else np.zeros(0, int)


def solve_counts(histogram: np.ndarray, combos: np.ndarray, sweeps: int = 200, tolerance: float = 1e-3) -> np.ndarray:
    """Repeat counts x >= 0 that minimise |Ax - histogram|^2, by exact coordinate steps.

    A sweep moves a set of combinations without a common length, largest gradient first, each to
    its own minimum; it ends when no step would change a count by more than ``tolerance`` of the
    mean count. Starting from zero keeps the solution sparse.
    """
    window = len(histogram)
    real = combos > 0
    # |column|^2: a length that occurs twice in a combination weighs four times.
    same = (combos[:, 0] == combos[:, 1]) & real[:, 0], combos[:, 1] == combos[:, 2]
    weights = real.sum(axis=1) + 2 * (same[0] + same[1] + (same[0] & same[1]))
    x = np.zeros(len(combos))
    residual = histogram.astype(float)
    residual[0] = 0
    least = tolerance * max(histogram.mean(), 1e-9)
    for _ in range(sweeps):
        gradient = residual[combos].sum(axis=1)  # length 0 has no residual
        step = np.maximum(gradient / weights, -x)
        moved = _disjoint(combos, np.where(np.abs(step) > least, np.abs(step), 0), window)
        if not len(moved):
            break
        x[moved] += step[moved]
        for slot in range(3):
            np.subtract.at(residual, combos[moved, slot], step[moved])
        residual[0] = 0
    return x


@dataclass
class Plan:
    """Segments of the tails' numbering by (length, row).

    Segment i starts at ``first[i]``. In a whole segment tail k goes to sequence
    ``sequence[i] + k`` at ``offset[i]``; in one that is laid end to end (``offset`` -1) it starts
    ``sequence[i] + k * length`` positions into the shared stream of sequences from ``stream`` on.
    """

    first: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    length: np.ndarray
    stream: int
    sequences: int
    cuts: int


def plan_tails(histogram: np.ndarray) -> Plan:
    """Place every tail; ``histogram[l]`` tails have length l, 0 < l < window."""
    window = len(histogram)
    combos = combinations(window)
    left = histogram.astype(np.int64).copy()
    left[0] = 0
    repeats: list[tuple[int, int]] = []

    def take(index: int, wanted: int) -> None:
        lengths, times = np.unique(combos[index][combos[index] > 0], return_counts=True)
        count = min(wanted, int((left[lengths] // times).min()))
        if count > 0:
            left[lengths] -= count * times
            repeats.append((index, count))

    x = np.floor(solve_counts(histogram, combos) + 1e-9).astype(np.int64)
    support = np.flatnonzero(x)
    for index in support[np.argsort(-x[support], kind="stable")]:
        take(index, int(x[index]))
    while True:  # greedy on what rounding left
        stock = np.where(combos > 0, left[combos], np.iinfo(np.int64).max).min(axis=1)
        chosen = _disjoint(combos, stock.astype(float), window)
        before = len(repeats)
        for index in chosen:
            take(index, int(stock[index]))
        if len(repeats) == before:
            break

    starts = np.concatenate([[0], np.cumsum(histogram)])[:-1].astype(np.int64)
    starts -= int(histogram[0]) if len(histogram) else 0
    used = starts.copy()
    segments, sequence = [], 0
    for index, count in repeats:
        offset = 0
        for length in combos[index][combos[index] > 0]:
            segments.append((used[length], sequence, offset, length))
            used[length] += count
            offset += int(length)
        sequence += count
    stream, position = sequence, 0
    for length in np.flatnonzero(left)[::-1]:
        segments.append((used[length], position, -1, length))
        position += int(left[length]) * int(length)
    segments.sort()
    table = np.array(segments, dtype=np.int64).reshape(-1, 4)
    return Plan(*table.T, stream, stream + -(-position // window), position // window)


# ---------------------------------------------------------------- pieces


def pack(
    docs: DataFrame,
    path: str,
    window: int = 2048,
    end_id: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Sequences of tails come first, then the whole windows cut off the documents' fronts.
    """
    spark = docs.sparkSession
    steps = Steps(spark)
    tokens = steps.keep(tokenize(docs, path, window, end_id, id_col, text_col))
    kind = tokens.schema["id"].dataType.simpleString()
    piece = PIECE.format(id=kind)
    tails = tokens.withColumn("length", F.col("doc_tokens") % window).filter("length > 0")
    histogram = np.zeros(window, np.int64)
    for length, count in tails.groupBy("length").count().collect():  # fewer rows than the window
        histogram[length] = count
    plan = plan_tails(histogram)

    numbered = number_rows(
        tails.select("row", "id", "length", "doc_tokens", "tail_crc"), ["length", "row"], "number"
    )

    # Ids stay Arrow values: as pandas numbers, ids beside a null id would be rounded.
    carried = ["row", "id", "length", "doc_tokens", "tail_crc"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_state("none")  # all texts are cut: the workers hold no memo any more
        for batch in batches:
            number = batch.column("number").to_numpy() - 1
            length = batch.column("length").to_numpy()
            at = np.searchsorted(plan.first, number, side="right") - 1
            k, laid = number - plan.first[at], plan.offset[at] < 0
            position = plan.sequence[at] + k * length
            sequence = np.where(laid, plan.stream + position // window, plan.sequence[at] + k)
            offset = np.where(laid, position % window, plan.offset[at])
            arrays = [batch.column(name) for name in carried] + [pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, [*carried, "sequence_id", "offset"])

    fields = f"row bigint, id {kind}, length bigint, doc_tokens bigint, tail_crc bigint, sequence_id bigint, offset bigint"
    placed = steps.keep(
        numbered.select(*carried, "number").mapInArrow(place, fields)
    )
    uncut = placed.filter(F.col("offset") + F.col("length") <= window).select(
        "id",
        (F.col("doc_tokens") - F.col("length")).alias("start"),
        "length",
        F.col("tail_crc").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )

    cut = placed.filter(F.col("offset") + F.col("length") > window).select("row", "length", "sequence_id", "offset")
    few = plan.cuts <= BROADCAST_CUTS  # known exactly: one cut at the end of each sequence at most
    cut_rows = tokens.select("row", "id", "doc_tokens", "ids").join(F.broadcast(cut) if few else cut, "row")

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_state("none")
        for batch in batches:
            lines = batch.select(["doc_tokens", "ids", "length", "sequence_id", "offset"]).to_pylist()
            source, out = [], []
            for at, row in enumerate(lines):
                total, ids, length, sequence, offset = row.values()
                start, room = total - length, window - offset
                for begin, size, into, place in ((start, room, sequence, offset), (start + room, length - room, sequence + 1, 0)):
                    source.append(at)
                    out.append((begin, size, zlib.crc32(ids[4 * begin : 4 * (begin + size)]), total, into, place))
            names = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            arrays = [pa.array([line[at] for line in out], pa.int64()) for at in range(len(names))]
            yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(source, pa.int64())), *arrays], ["id", *names])

    # Whole windows get the numbers after the tails' sequences: offsets per partition, then inside it.
    part = F.shiftright("row", 33)
    fronts = tokens.filter(F.size("full_crcs") > 0).select("row", "id", "doc_tokens", "full_crcs", part.alias("part"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = fronts.groupBy("part").agg(F.sum(F.size("full_crcs")).alias("n"))  # one row per input split
    totals = totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("part").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    within = F.coalesce(F.sum(F.size("full_crcs")).over(inside), F.lit(0))
    whole = (
        fronts.withColumn("within", within)
        .join(F.broadcast(totals), "part")
        .select("id", "doc_tokens", (F.lit(plan.sequences) + F.col("base") + F.col("within")).alias("base"), F.posexplode("full_crcs").alias("at", "crc"))
        .select(
            "id",
            (F.col("at").cast("bigint") * window).alias("start"),
            F.lit(window).cast("bigint").alias("length"),
            F.col("crc").alias("ids_crc32"),
            "doc_tokens",
            (F.col("base") + F.col("at")).alias("sequence_id"),
            F.lit(0).cast("bigint").alias("offset"),
        )
    )
    pieces = uncut.unionByName(cut_rows.mapInArrow(split, piece)).unionByName(whole)
    return pieces.withColumnRenamed("id", id_col)
