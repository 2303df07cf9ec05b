"""Token counts with a shortcut for pre-tokens that are one token.

Which vocabulary strings the merges give back whole is proved once per worker by running the
merges on each (``Vocabulary.whole``). A pre-token among them counts one without any merging; only
the others are merged. Counts of chunks between spaces are remembered in a bounded memo.

Defined results: null text counts as empty, with 0 bytes and 0 tokens; a special string inside a
text is one token; ids may be null or repeat, each row gives one row; an empty table gives no rows.
Other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusgauge.llm.bytebpe import Memo, Vocabulary, cut_at_spaces, pre_tokens, worker_state


class TokenCounter:
    def __init__(self, vocab: Vocabulary) -> None:
        self.vocab = vocab
        self.inner = Memo(lambda piece: self._chunk(" " + piece))
        self.merged = Memo(self._merged)

    def _merged(self, pre_token: str) -> int:
        return len(self.vocab.merge(pre_token.encode()))

    def _chunk(self, chunk: str) -> int:
        whole, total = self.vocab.whole, 0
        for pre_token in pre_tokens(chunk):
            total += 1 if pre_token.encode() in whole else self.merged[pre_token]
        return total

    def count(self, text: str) -> int:
        total = 0
        for part, special in self.vocab.segments(text):
            pieces = cut_at_spaces(part)
            if pieces is None:
                total += self._chunk(part)
            else:
                total += self._chunk(pieces[0]) + sum(map(self.inner.__getitem__, pieces[1:]))
            total += special is not None
        return total


def counter(path: str) -> TokenCounter:
    """The worker's counter for a vocabulary file."""
    return worker_state(f"token counts {path}", lambda: TokenCounter(Vocabulary(path)))


def count_tokens(
    docs: DataFrame, path: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens)."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path).count
        for batch in batches:
            sizes, tokens = [], []
            for cell in batch.column("text"):
                text = cell.as_py()
                sizes.append(len(text.encode()))
                tokens.append(count(text))
            columns = [batch.column("id"), pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n_bytes", "n_tokens"])

    counted = rows.mapInArrow(run, f"id {id_type}, n_bytes bigint, n_tokens bigint")
    return counted.select(
        F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
