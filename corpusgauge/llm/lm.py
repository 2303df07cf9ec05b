"""A bigram language model over all training documents, as a sharded Elias-Fano trie.

Counting: each task counts the words and word pairs of its documents and sends sorted blocks of
them, one per shard, so a hot word crosses the shuffle once per task. A shard is chosen by the hash
of the whole word or pair, so a word that begins a third of all pairs is spread over all shards.
The number of shards grows with the bytes of the corpus.

Each shard becomes one file in the run's shared folder, with two levels of an n-gram trie:

* words: Elias-Fano hashes with exact counts;
* pairs: Elias-Fano hashes of first words, monotone pointers to their successors, the successors
  (made monotone by the number of their context) and their counts in steps of 1/8 octave, of 16 bits.

Scoring maps the files into memory and looks up a batch of tokens shard by shard: first the
context, then its successor between the context's pointers.

p(w | v) = (n(vw) + MU p(w)) / (n(v) + MU) with p(w) = (n(w) + 1) / (N + V + 1).

Words are known by 64-bit hashes, successors in a context by 40 bits of theirs.

Defined results: null text counts as empty and consists of the end token; rows with a null id are
training rows; rows that repeat an id are rows of their own; without training rows every
probability is 1; an empty table gives no rows. Only the two named columns are read.
"""

from __future__ import annotations

import functools
import hashlib
import os
import tempfile
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusgauge.durable import Steps
from corpusgauge.llm.bytebpe import Memo, worker_state
from corpusgauge.llm.elias_fano import EliasFano, encode
from corpusgauge.llm.language_id import held_out

MU = 10.0
BYTES_PER_SHARD = 12_000_000
FLUSH_TOKENS = 1_500_000
STEPS_PER_OCTAVE = 8
#: Words whose hashes a worker remembers, twice: about 180 bytes each.
WORDS_HELD = 300_000
SUCCESSOR_BITS = np.uint64(40)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_OTHER = np.uint64(0xC2B2AE3D27D4EB4F)


def _hash(word: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")


# White space cannot be part of a word, so these are no words.
START, END = np.uint64(_hash(b" start")), np.uint64(_hash(b" end"))


def _words() -> Memo:
    return worker_state("language model", lambda: Memo(_hash, limit=WORDS_HELD))


def tokens(text: str) -> np.ndarray:
    """Hashes of the words (only A-Z lowered, cut at [\\x20\\x09-\\x0D]) and the end."""
    parts = text.encode().lower().split()
    codes = np.empty(len(parts) + 1, np.uint64)
    codes[:-1] = list(map(_words().__getitem__, parts))
    codes[-1] = END
    return codes


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _ODD
    return x ^ (x >> np.uint64(29))


def word_shard(codes: np.ndarray, shards: int) -> np.ndarray:
    return (_mixed(codes) % np.uint64(shards)).astype(np.int64)


def successor(codes: np.ndarray) -> np.ndarray:
    """What a pair keeps of its second word."""
    return codes >> (np.uint64(64) - SUCCESSOR_BITS)


def pair_shard(before: np.ndarray, after: np.ndarray, shards: int) -> np.ndarray:
    """Shard of first words and successors."""
    return (_mixed(before * _OTHER + after * _ODD) % np.uint64(shards)).astype(np.int64)


def previous(codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The context of each token; a text's first token follows START."""
    out = np.empty_like(codes)
    out[1:] = codes[:-1]
    out[starts] = START
    return out


def _runs(ordered: np.ndarray) -> np.ndarray:
    """Where each distinct value of a sorted array begins, and the end."""
    new = np.flatnonzero(ordered[1:] != ordered[:-1]) + 1
    return np.concatenate([[0], new, [len(ordered)]]) if len(ordered) else np.zeros(1, np.int64)


def _counted_pairs(
    before: np.ndarray, after: np.ndarray, counts: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs in order with their counts, or the sums of their counts.

    The number of the first word and the successor make one integer to sort.
    """
    words, number = np.unique(before, return_inverse=True)
    key = number.astype(np.uint64) << SUCCESSOR_BITS | after
    if counts is None:
        key.sort()
        edges = _runs(key)
        sums = np.diff(edges)
    else:
        order = np.argsort(key)
        key = key[order]
        edges = _runs(key)
        sums = np.add.reduceat(counts[order], edges[:-1]) if len(key) else np.zeros(0, np.int64)
    key = key[edges[:-1]]
    return words[(key >> SUCCESSOR_BITS).astype(np.int64)], key & ((np.uint64(1) << SUCCESSOR_BITS) - np.uint64(1)), sums


def _by_shard(shard: np.ndarray, shards: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each shard that occurs with its rows, in their order."""
    small = shard.astype(np.uint16) if shards <= 1 << 16 else shard  # sorted by digits
    order = np.argsort(small, kind="stable")
    edges = np.searchsorted(shard[order], np.arange(shards + 1))
    for number in np.flatnonzero(np.diff(edges)):
        yield int(number), order[edges[number] : edges[number + 1]]


# ---------------------------------------------------------------- counting

BLOCK_SCHEMA = "shard int, level int, data binary"


def _pack(level: int, keys: list[np.ndarray], counts: np.ndarray) -> bytes:
    """A block: each column shortened to the bytes it needs."""
    parts = [np.array([len(counts)], "<u8").tobytes()]
    if level == 1:
        parts.append(keys[0].astype("<u8").tobytes())
    else:
        context, at = np.unique(keys[0], return_index=True)
        runs = np.diff(np.append(at, len(counts))).astype("<u4")
        parts += [np.array([len(context)], "<u8").tobytes(), context.astype("<u8").tobytes(), runs.tobytes()]
        parts.append(np.ascontiguousarray(keys[1].astype("<u8")[:, None].view(np.uint8)[:, :5]).tobytes())
    small = np.minimum(counts, 255).astype(np.uint8)
    parts += [small.tobytes(), counts[counts >= 255].astype("<u8").tobytes()]
    return b"".join(parts)


def _unpack(level: int, data: bytes) -> tuple[list[np.ndarray], np.ndarray]:
    n, at = int(np.frombuffer(data, "<u8", 1)[0]), 8
    if level == 1:
        keys = [np.frombuffer(data, "<u8", n, at)]
        at += 8 * n
    else:
        m = int(np.frombuffer(data, "<u8", 1, at)[0])
        context = np.frombuffer(data, "<u8", m, at + 8)
        runs = np.frombuffer(data, "<u4", m, at + 8 + 8 * m)
        at += 8 + 12 * m
        wide = np.zeros((n, 8), np.uint8)
        wide[:, :5] = np.frombuffer(data, np.uint8, 5 * n, at).reshape(n, 5)
        keys = [np.repeat(context, runs), wide.view("<u8").ravel()]
        at += 5 * n
    counts = np.frombuffer(data, np.uint8, n, at).astype(np.int64)
    large = counts == 255
    counts[large] = np.frombuffer(data, "<u8", int(large.sum()), at + n)
    return keys, counts


def count_blocks(training: DataFrame, shards: int) -> DataFrame:
    """(shard, level, data): sorted counts of words (level 1) and pairs (level 2)."""

    def flush(texts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        codes = np.concatenate(texts)
        starts = np.cumsum([0] + [len(text) for text in texts[:-1]])
        before = previous(codes, starts)
        words, counts = np.unique(codes, return_counts=True)
        first, after, pairs = _counted_pairs(before, successor(codes))
        levels = [
            (1, word_shard(words, shards), [words], counts),
            (2, pair_shard(first, after, shards), [first, after], pairs),
        ]
        for level, shard, keys, counts in levels:
            for number, rows in _by_shard(shard, shards):
                data = _pack(level, [key[rows] for key in keys], counts[rows])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number], pa.int32()), pa.array([level], pa.int32()), pa.array([data], pa.binary())],
                    ["shard", "level", "data"],
                )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for cell in batch.column("text"):
                held.append(tokens(cell.as_py()))
                size += len(held[-1])
                if size >= FLUSH_TOKENS:
                    yield from flush(held)
                    held, size = [], 0
        if held:
            yield from flush(held)

    return training.select("text").mapInArrow(run, BLOCK_SCHEMA)


# ---------------------------------------------------------------- shard files


def shard_bytes(blocks: list[tuple[int, bytes]]) -> tuple[bytes, int, int]:
    """File of a shard from its blocks; also its distinct words and their occurrences."""
    parts = {level: [_unpack(level, data) for number, data in blocks if number == level] for level in (1, 2)}
    nothing = np.zeros(0, np.uint64)
    words = np.concatenate([nothing, *(keys[0] for keys, _ in parts[1])])
    words, number = np.unique(words, return_inverse=True)
    counts = np.zeros(len(words), np.int64)
    np.add.at(counts, number, np.concatenate([np.zeros(0, np.int64), *(own for _, own in parts[1])]))
    before, after = (np.concatenate([nothing, *(keys[at] for keys, _ in parts[2])]) for at in (0, 1))
    before, after, pairs = _counted_pairs(before, after, np.concatenate([np.zeros(0, np.int64), *(own for _, own in parts[2])]))
    context, at = np.unique(before, return_index=True)
    pointers = np.append(at, len(pairs)).astype(np.uint64)
    number = np.repeat(np.arange(len(context), dtype=np.uint64), np.diff(pointers.astype(np.int64)))
    codes = np.rint(STEPS_PER_OCTAVE * np.log2(pairs)).astype("<u2")  # up to 8 * 63: counts of 64 bits cannot wrap
    plain = [counts.astype("<u8").tobytes(), codes.tobytes() + bytes(-codes.nbytes % 8)]
    body = [encode(words), plain[0], encode(context), encode(pointers), encode(number << SUCCESSOR_BITS | after), plain[1]]
    return b"".join(body), len(words), int(counts.sum())


class Shard:
    """A mapped shard file."""

    def __init__(self, data: np.ndarray) -> None:
        self.words = EliasFano(data)
        at = self.words.end
        self.counts = data[at : at + 8 * self.words.n].view("<u8")
        self.contexts = EliasFano(data, at + 8 * self.words.n)
        self.pointers = EliasFano(data, self.contexts.end)
        self.successors = EliasFano(data, self.pointers.end)
        self.codes = data[self.successors.end : self.successors.end + 2 * self.successors.n].view("<u2")

    def count(self, codes: np.ndarray) -> np.ndarray:
        """Exact occurrences of words, 0 for unknown ones."""
        if not self.words.n:
            return np.zeros(len(codes), np.int64)
        at = self.words.find(codes)
        return np.where(at >= 0, self.counts[np.maximum(at, 0)], 0).astype(np.int64)

    def pairs(self, before: np.ndarray, after: np.ndarray) -> np.ndarray:
        """Occurrences of first words with successors as quantised, 0 for unknown ones."""
        out = np.zeros(len(after))
        # Words and pairs repeat: each is looked up once, in the order of the file.
        words, number = np.unique(before, return_inverse=True)
        context = self.contexts.find(words)
        known = np.flatnonzero(context[number] >= 0)
        if len(known):
            held = np.maximum(context, 0)
            first = self.pointers.access(held).astype(np.int64)
            stop = self.pointers.access(held + 1).astype(np.int64)
            keys = held[number[known]].astype(np.uint64) << SUCCESSOR_BITS | after[known]
            keys, where = np.unique(keys, return_inverse=True)
            own = np.zeros(len(keys), np.int64)
            own[where] = number[known]
            at = self.successors.find(keys, first[own], stop[own])
            times = np.where(at >= 0, np.exp2(self.codes[np.maximum(at, 0)] / STEPS_PER_OCTAVE), 0.0)
            out[known] = times[where]
        return out


def _filesystem(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder) if urlparse(folder).scheme else (fs.LocalFileSystem(), folder)


def write_shard(folder: str, shard: int, data: bytes) -> None:
    """Write under another name and move, so a repeated or lost attempt leaves no partial file."""
    system, path = _filesystem(folder)
    system.create_dir(path, recursive=True)
    draft = f"{path}/draft-{uuid.uuid4().hex}"
    with system.open_output_stream(draft) as out:
        out.write(data)
    system.move(draft, f"{path}/shard-{shard:07d}")


@functools.lru_cache(maxsize=1024)
def open_shard(folder: str, shard: int) -> Shard:
    """Map a shard file; from a store without local paths it is copied to the worker first."""
    system, path = _filesystem(folder)
    file = f"{path}/shard-{shard:07d}"
    if not isinstance(system, fs.LocalFileSystem):
        with tempfile.TemporaryFile() as copy, system.open_input_stream(file) as source:
            while piece := source.read(1 << 24):
                copy.write(piece)
            copy.flush()
            return Shard(np.memmap(copy, np.uint8, "r").view(np.ndarray))
    # A plain view: a memmap object makes every indexing slower.
    return Shard(np.memmap(file, np.uint8, "r").view(np.ndarray) if os.path.getsize(file) else np.zeros(0, np.uint8))


# ---------------------------------------------------------------- the model


@dataclass
class Model:
    """Where the shards lie and the totals: occurrences N, distinct words V, training texts."""

    folder: str
    shards: int
    total: int
    distinct: int
    texts: int


def train(training: DataFrame, steps: Steps, n_bytes: int, texts: int) -> Model:
    """Count and write the shards of (text) rows; nothing of the model passes the driver."""
    shards = max(4, -(-n_bytes // BYTES_PER_SHARD))
    folder = steps.path("lm")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict[int, list[tuple[int, bytes]]] = {}
        for batch in batches:
            for shard, level, data in zip(*(batch.column(name).to_pylist() for name in ("shard", "level", "data"))):
                blocks.setdefault(shard, []).append((level, data))
        for shard in sorted(blocks):
            data, distinct, total = shard_bytes(blocks.pop(shard))
            write_shard(folder, shard, data)
            columns = [pa.array([value], pa.int64()) for value in (shard, distinct, total, len(data))]
            yield pa.RecordBatch.from_arrays(columns, ["shard", "distinct", "total", "bytes"])

    # Every shard gets a block, also one that no word falls into.
    none = training.sparkSession.range(shards).select(
        F.col("id").cast("int").alias("shard"), F.lit(1).alias("level"), F.lit(bytes(8)).alias("data")
    )
    blocks = count_blocks(training, shards).unionByName(none).repartitionById(shards, "shard")
    written = steps.keep(blocks.mapInArrow(run, "shard bigint, distinct bigint, total bigint, bytes bigint"))
    sums = written.agg(F.sum("distinct").alias("distinct"), F.sum("total").alias("total")).first()
    return Model(folder, shards, int(sums.total or 0), int(sums.distinct or 0), texts)


def log_probabilities(model: Model, codes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per token: its count, log10 of its base probability and of the model's."""
    every, where = np.unique(codes, return_inverse=True)
    counts = np.zeros(len(every), np.int64)
    for number, rows in _by_shard(word_shard(every, model.shards), model.shards):
        counts[rows] = open_shard(model.folder, number).count(every[rows])
    own = counts[where]
    context = np.empty_like(own)
    context[1:] = own[:-1]
    context[starts] = model.texts
    before, after = previous(codes, starts), successor(codes)
    pairs = np.zeros(len(codes))
    for number, rows in _by_shard(pair_shard(before, after, model.shards), model.shards):
        pairs[rows] = open_shard(model.folder, number).pairs(before[rows], after[rows])
    base = (own + 1) / (model.total + model.distinct + 1)
    return own, np.log10(base), np.log10((np.minimum(pairs, context) + MU * base) / (context + MU))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(id, n_tokens, n_known, base_score, score) of (id, text)."""
    kind = docs.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                piece = batch.slice(at, 2000)
                texts = [tokens(cell.as_py()) for cell in piece.column("text")]
                sizes = np.array([len(text) for text in texts])
                starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
                codes = np.concatenate(texts)
                own, base, full = log_probabilities(model, codes, starts)
                sums = [np.add.reduceat(values, starts) for values in ((own > 0).astype(np.int64), base, full)]
                columns = [piece.column("id"), pa.array(sizes, pa.int64()), *map(pa.array, sums)]
                yield pa.RecordBatch.from_arrays(columns, ["id", "n_tokens", "n_known", "base_score", "score"])

    return docs.mapInArrow(run, f"id {kind}, n_tokens bigint, n_known bigint, base_score double, score double")


def score_documents(
    docs: DataFrame, parts: int = 7, part: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Learn from the rows that are not held out and score all."""
    steps = Steps(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    training = rows.filter(~held_out(F.col("id"), parts, part))
    sizes = training.agg(F.sum(F.octet_length("text").cast("bigint") + 1).alias("bytes"), F.count(F.lit(1)).alias("n")).first()
    model = train(training, steps, int(sizes["bytes"] or 0), int(sizes["n"]))
    return score(rows, model).select(
        F.col("id").alias(id_col),
        held_out(F.col("id"), parts, part).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.total).cast("bigint").alias("train_tokens"),
        "base_score",
        "score",
    )
