"""Language identification by prediction by partial matching over bytes.

Each language gets a tree of byte contexts of length 0 to ``order``. A byte's probability in a
context that has seen it is its count over (all counts + distinct bytes); the escape to the next
shorter context has the distinct bytes' share (method C, without exclusion); below the empty
context all 256 byte values are equal. Statistics are frozen after training, so the code length of
a byte depends on the last ``order`` bytes alone. Training therefore ends in one dense table: for
every context of any language the code lengths of all bytes in all languages, in bits. Scoring a
text is a look-up per byte, and its exact code length in each language is a sum.

The trees are fitted on a bounded sample: at most about ``sample_rows`` labelled rows per language,
chosen by a hash, counted on the workers. Contexts seen fewer than ``least_context`` times are left
to their next shorter one, and ``most_contexts`` bounds the table.

Defined results: a text that is null or has no letter is ``und`` with score 0; without any labelled
row every text is ``und``; a tie goes to the first language in alphabetical order; null labels are
not learned; rows that repeat an id are rows of their own; an empty table gives no rows. Only the
named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusgauge.llm.bytebpe import worker_state

UNKNOWN = "und"
BLOCK = 1 << 18


def held_out(key: Column, parts: int = 4, part: int = 2) -> Column:
    """True for rows whose key's CRC-32 (of its text) leaves remainder ``part``; never for null."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % parts == part, F.lit(False))


@dataclass
class PpmModel:
    """Dense code lengths.

    ``codes``: byte to symbol, symbol 0 for bytes no tree has seen. ``node``: number of the longest
    known context of the last ``order`` symbols (oldest first, mixed radix). ``bits``: per context
    and symbol one float32 for each language.
    """

    languages: list[str]
    order: int
    codes: np.ndarray
    node: np.ndarray
    bits: np.ndarray

    def code_lengths(self, data: bytes) -> np.ndarray:
        """Bits of the text in each language; the text is preceded by ``order`` unseen symbols."""
        symbols = np.concatenate([np.zeros(self.order, np.int64), self.codes[np.frombuffer(data, np.uint8)]])
        radix, size = int(self.codes.max()) + 1, len(data)
        total = np.zeros(len(self.languages))
        for at in range(0, size, BLOCK):
            stop = min(size, at + BLOCK)
            context = np.zeros(stop - at, np.int64)
            for back in range(self.order):
                context = context * radix + symbols[at + back : stop + back]
            cell = self.node[context] * np.int64(radix) + symbols[at + self.order : stop + self.order]
            total += self.bits[cell].sum(axis=0, dtype=np.float64)
        return total


def _sample(docs: DataFrame, sample_rows: int) -> DataFrame:
    """About ``sample_rows`` rows of each label, by a hash of id and text."""
    sizes = {row.lang: row.n for row in docs.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = F.lit(0.0)
    for lang, n in sizes.items():
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, sample_rows / n))).otherwise(share)
    draw = F.pmod(F.xxhash64("id", "text"), F.lit(1 << 30)) / float(1 << 30)
    return docs.filter(draw < share)


def count_contexts(sample: DataFrame, order: int) -> DataFrame:
    """(lang, gram, n): counts of all runs of ``order`` + 1 bytes, as one integer, per language.

    Shorter contexts follow by summing; the start of a text has zero bytes in front.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_state("language")  # lets go of what other operators keep
        for batch in batches:
            grams: dict[str, list[np.ndarray]] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
                data = np.frombuffer(b"\0" * order + text.as_py().encode(), np.uint8).astype(np.int64)
                gram = np.zeros(len(data) - order, np.int64)
                for back in range(order + 1):
                    gram = gram << 8 | data[back : back + len(gram)]
                grams.setdefault(lang, []).append(gram)
            for lang, parts in grams.items():
                found, counts = np.unique(np.concatenate(parts), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(found), pa.string()), pa.array(found, pa.int64()), pa.array(counts, pa.int64())],
                    ["lang", "gram", "n"],
                )

    counted = sample.select("lang", "text").mapInArrow(run, "lang string, gram bigint, n bigint")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def build_model(
    languages: list[str], lang: np.ndarray, gram: np.ndarray, n: np.ndarray, order: int, least_context: int, most_contexts: int
) -> PpmModel:
    """The dense table from (language number, run of order + 1 bytes, count)."""
    used = np.unique(np.concatenate([(gram >> (8 * back)) & 255 for back in range(order + 1)]))
    used = used[used != 0]  # symbol 0: the byte 0 and every byte not seen
    codes = np.zeros(256, np.int64)
    codes[used] = np.arange(1, len(used) + 1)
    radix = len(used) + 1
    symbols = [codes[(gram >> (8 * back)) & 255] for back in range(order, -1, -1)]  # oldest first
    # Contexts known for each length, by how often any language has seen them.
    contexts: list[np.ndarray] = [np.zeros(1, np.int64)]
    room = most_contexts - 1
    for length in range(1, order + 1):
        key = np.zeros(len(gram), np.int64)
        for back in range(length):
            key = key * radix + symbols[order - length + back]
        seen, where = np.unique(key, return_inverse=True)
        totals = np.bincount(where, weights=n, minlength=len(seen))
        frequent = totals >= least_context
        if frequent.sum() > room:
            frequent &= totals >= np.sort(totals)[-room] if room else False
        contexts.append(seen[frequent][:room])
        room -= len(contexts[-1])
    sizes = [len(part) for part in contexts]
    first = np.concatenate([[0], np.cumsum(sizes)])
    bits = np.empty((first[-1], radix, len(languages)), np.float32)
    even = np.full(radix, 1 / 256)
    parents = [np.zeros(1, np.int64)]
    for length in range(order + 1):
        keys = contexts[length]
        if length:
            # The next shorter context drops the oldest symbol; if that is unknown, so on.
            shorter = keys % radix ** (length - 1)
            parent = np.zeros(len(keys), np.int64)
            for size in range(length):
                tail = shorter % radix**size
                at = np.searchsorted(contexts[size], tail)
                hit = (at < sizes[size]) & (contexts[size][np.minimum(at, max(sizes[size] - 1, 0))] == tail) if sizes[size] else np.zeros(len(keys), bool)
                parent = np.where(hit, first[size] + at, parent)
            parents.append(parent)
        key = np.zeros(len(gram), np.int64)
        for back in range(length):
            key = key * radix + symbols[order - length + back]
        at = np.searchsorted(keys, key)
        known = (at < len(keys)) & (keys[np.minimum(at, max(len(keys) - 1, 0))] == key) if len(keys) else np.zeros(len(gram), bool)
        for number in range(len(languages)):
            mine = known & (lang == number)
            counts = np.bincount(at[mine] * radix + symbols[order][mine], weights=n[mine], minlength=len(keys) * radix)
            counts = counts.reshape(len(keys), radix)
            below = 2.0 ** -bits[parents[length], :, number].astype(float) if length else np.broadcast_to(even, (1, radix))
            total = counts.sum(axis=1, keepdims=True)
            distinct = (counts > 0).sum(axis=1, keepdims=True)
            weight = total + distinct
            escape = np.where(weight > 0, distinct / np.maximum(weight, 1), 1.0)
            chance = counts / np.maximum(weight, 1) + np.where(counts > 0, 0.0, escape * below)
            bits[first[length] : first[length + 1], :, number] = -np.log2(chance)
    node = np.zeros(radix**order, np.int32)
    every = np.arange(radix**order, dtype=np.int64)
    for length in range(1, order + 1):
        if sizes[length]:
            tail = every % radix**length
            at = np.searchsorted(contexts[length], tail)
            hit = (at < sizes[length]) & (contexts[length][np.minimum(at, sizes[length] - 1)] == tail)
            node[hit] = (first[length] + at[hit]).astype(np.int32)
    return PpmModel(languages, order, codes, node, bits.reshape(-1, len(languages)))


def train(
    labelled: DataFrame,
    order: int = 3,
    sample_rows: int = 2000,
    least_context: int = 32,
    most_contexts: int = 12_000,
) -> PpmModel | None:
    """Fit on rows (id, text, lang) without nulls in text and lang; None if there are none."""
    sample = _sample(labelled, sample_rows)
    # The number of distinct runs is bounded by the sample's bytes.
    grams = count_contexts(sample, order).toPandas()
    if not len(grams):
        return None
    languages = sorted(grams["lang"].unique())
    number = grams["lang"].map({lang: at for at, lang in enumerate(languages)}).to_numpy()
    return build_model(languages, number, grams["gram"].to_numpy(), grams["n"].to_numpy(), order, least_context, most_contexts)


def predict(docs: DataFrame, model: PpmModel | None, text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred, score (posterior under equal priors) and bits_per_byte."""
    text = F.col(text_col)
    if model is None:
        return docs.withColumns(
            {"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0), "bits_per_byte": F.lit(None).cast("double")}
        )
    held = docs.sparkSession.sparkContext.broadcast(model)  # bounded by most_contexts
    languages = model.languages

    @F.pandas_udf("lang_pred string, score double, bits_per_byte double")
    def judge(texts):
        import pandas as pd

        worker_state("language")
        model = held.value
        names, scores, rates = [], [], []
        for text in texts:
            if text is None:
                names.append(UNKNOWN), scores.append(0.0), rates.append(None)
                continue
            data = text.encode()
            lengths = model.code_lengths(data)
            best = int(lengths.argmin())
            gaps = np.minimum(lengths - lengths[best], 1000.0)
            names.append(languages[best])
            scores.append(float(1 / np.exp2(-gaps).sum()))
            rates.append(float(lengths[best] / len(data)))
        return pd.DataFrame({"lang_pred": names, "score": scores, "bits_per_byte": pd.Series(rates, dtype="float64")})

    has_letter = F.coalesce(text.rlike(r"\p{L}"), F.lit(False))
    judged = docs.withColumn("_judged", judge(F.when(has_letter, text)))
    return judged.select(
        *[F.col(f"`{name}`") for name in docs.columns if name not in ("lang_pred", "score", "bits_per_byte")],
        "_judged.lang_pred",
        "_judged.score",
        "_judged.bits_per_byte",
    )


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **options) -> DataFrame:
    """Per row: id, held_out, lang_pred, score, learned from the rows that are not held out."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    labelled = rows.filter(~held_out(F.col("id")) & F.col("text").isNotNull() & F.col("lang").isNotNull())
    model = train(labelled, **options)
    return predict(rows.drop("lang"), model).select(
        F.col("id").alias(id_col), held_out(F.col("id")).alias("held_out"), "lang_pred", "score", "bits_per_byte"
    )
