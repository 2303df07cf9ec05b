"""BPE as a streaming transducer: tokens leave as soon as no later byte can change them.

Two tokens a, b are compatible if the merges turn the bytes of ab back into a, b; a sequence is the
encoding of its bytes if and only if all its neighbours are compatible. So the encoding of a prefix
is known by its last token and the prefix before it, and the transducer keeps that pair for the
last few positions. ``sufficient_lookahead`` computes from the merge list how many bytes after a
border decide it; tokens up to the last border that has as many bytes after it are stable and are
emitted. Memory is bounded by that lookahead, not by the text.

Defined results: null text counts as empty, with no ids and the digests of nothing; special strings
are one token each; ids may be null or repeat, each row gives one row; an empty table gives no rows.
Other columns are never read.
"""

from __future__ import annotations

import codecs
import gc
import hashlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusgauge.llm.bytebpe import (
    PRE_TOKEN,
    SPACE,
    Memo,
    Vocabulary,
    cut_at_spaces,
    pre_tokens,
    shadow,
    worker_state,
)

#: Characters after which a pre-token that is still open is passed on piece by piece.
OPEN_RUN = 4096
# Longest text that a pre-token's end can depend on: a contraction's two letters and one more.
HELD_BACK = 3
RUNS = [regex.compile(run) for run in (r"\p{L}+", r"\p{N}+", rf"[{SPACE}]+", rf"[^{SPACE}\p{{L}}\p{{N}}]+")]


def sufficient_lookahead(vocab: Vocabulary) -> int:
    """Bytes after a position within which the merges before it are decided.

    Whether merge r happens can touch the token on its left only through a merge of higher rank
    whose right part is r's left part or r's result. The longest chain of such merges, in bytes of
    their left parts, is found from the last merge back to the first.
    """
    size = {number: len(token) for token, number in ((t, n) for n, t in vocab.text.items())}
    reach_of_right: dict[int, int] = {}
    furthest = 0
    for (left, right), (_, merged) in sorted(vocab.merges.items(), key=lambda item: -item[1][0]):
        onward = max(reach_of_right.get(left, 0), reach_of_right.get(merged, 0))
        reach = size[left] + onward
        reach_of_right[right] = max(reach_of_right.get(right, 0), reach)
        furthest = max(furthest, reach)
    return furthest + vocab.longest


class Transducer:
    """Bytes of one pre-token in, stable ids out."""

    def __init__(self, vocab: Vocabulary) -> None:
        self.vocab = vocab
        self.whole, self.longest = vocab.whole, vocab.longest
        # The tokens read backwards, as nested tables by byte; a token's id stands under -1. A walk
        # backwards stops where no token can end that way.
        self.backwards: dict[int, dict | int] = {}
        for token, number in vocab.whole.items():
            node = self.backwards
            for byte in reversed(token):
                node = node.setdefault(byte, {})
            node[-1] = number
        # The two tokens that the last merge of a token joins, and the rank of that merge.
        self.parts = {number: tuple(vocab.merge(token, 2)) for token, number in vocab.whole.items() if len(token) > 1}
        self.formed = {number: vocab.merges[pair][0] for number, pair in self.parts.items()}
        self._joined = Memo(self._compatible, longest=2)
        #: Bytes after a border between tokens beyond which no later byte can move it.
        self.lookahead = sufficient_lookahead(vocab)
        self.start()

    def _compatible(self, pair: tuple[int, int]) -> bool:
        """Whether the merges never join anything across the border of the two tokens.

        Time runs backwards: the token that was formed later is undone to the part at the border.
        A pair of neighbours would have been merged if its rank came before that step's.
        """
        left, right = pair
        merges, parts, formed = self.vocab.merges, self.parts, self.formed
        limit = len(merges)
        while True:
            found = merges.get((left, right))
            if found is not None and found[0] < limit:
                return False
            of_left, of_right = formed.get(left, -1), formed.get(right, -1)
            if of_left > of_right:
                limit, left = of_left, parts[left][1]
            elif of_right >= 0:
                # Of equal merges the left one comes first, so the border's own would come before this.
                limit, right = of_right + 1, parts[right][0]
            else:
                return True

    def start(self) -> None:
        self.window = bytearray()  # bytes after the last emitted token
        self.last = [(0, -1)]  # per position of the window: where its last token begins, its id

    def push(self, data: bytes) -> list[int]:
        """Take bytes; return the ids that became stable."""
        out: list[int] = []
        for at in range(0, len(data), self.lookahead):
            for byte in data[at : at + self.lookahead]:
                self._step(byte)
            out += self._emit_stable()
        return out

    def finish(self) -> list[int]:
        """The remaining ids; the transducer is ready for the next pre-token."""
        rest = self._chain(len(self.window), 0)
        self.start()
        return rest

    def encode(self, data: bytes) -> list[int]:
        """A whole short pre-token: the same steps without the window."""
        token = self.whole.get(data)
        if token is not None:
            return [token]
        backwards, joined = self.backwards, self._joined
        starts, tokens = [0], [-1]
        for end in range(1, len(data) + 1):
            # Only one token goes on from an encoding to an encoding, so the order of trials is free.
            node, start = backwards, end
            while True:
                start -= 1
                node = node[data[start]]  # never missing: the token sought is still ahead
                if -1 in node:
                    token = node[-1]
                    if not start or joined[tokens[start], token]:
                        break
            starts.append(start)
            tokens.append(token)
        ids, end = [], len(data)
        while end:
            ids.append(tokens[end])
            end = starts[end]
        ids.reverse()
        return ids

    def _step(self, byte: int) -> None:
        self.window.append(byte)
        window, start = self.window, len(self.window)
        found, node = [], self.backwards
        while start:
            start -= 1
            node = node.get(window[start])
            if node is None:
                break
            if -1 in node:
                found.append((start, node[-1]))
        for start, token in reversed(found):
            before = self.last[start][1]
            if before < 0 or self._joined[before, token]:
                self.last.append((start, token))
                return
        raise AssertionError("a byte is always a token")

    def _chain(self, end: int, stop: int) -> list[int]:
        ids = []
        while end > stop:
            end, token = self.last[end]
            ids.append(token)
        ids.reverse()
        return ids

    def _emit_stable(self) -> list[int]:
        """The tokens up to the last border that has the lookahead's bytes after it."""
        stable = len(self.window)
        while stable > 0 and len(self.window) - stable < self.lookahead:
            stable = self.last[stable][0]
        if stable == 0:
            return []
        ids = self._chain(stable, 0)
        del self.window[:stable]
        # The last emitted token stays as the left neighbour of what follows.
        self.last = [(0, ids[-1])] + [(start - stable, token) for start, token in self.last[stable + 1 :]]
        return ids


class StreamingEncoder:
    """Text in pieces of any size in, ids out, for one text at a time.

    Special strings are not looked for here: they cut the text before it gets here.
    """

    def __init__(self, vocab: Vocabulary) -> None:
        self.transducer = Transducer(vocab)
        self.pre_token = Memo(lambda text: array("I", self.transducer.encode(text.encode())).tobytes())
        self.inner = Memo(lambda piece: self._ids(pre_tokens(" " + piece)))
        self.pending, self.open = "", None

    def _ids(self, found: list[str]) -> bytes:
        out = []
        for text in found:
            if len(text) <= OPEN_RUN:
                out.append(self.pre_token[text])
            else:
                ids = self.transducer.push(text.encode())
                out.append(array("I", ids + self.transducer.finish()).tobytes())
        return b"".join(out)

    def feed(self, text: str) -> bytes:
        """Ids that are certain now, as little-endian unsigned 32-bit integers."""
        self.pending += text
        return self._drain(final=False)

    def finish(self) -> bytes:
        return self._drain(final=True)

    def encode(self, text: str) -> bytes:
        """A whole text: cut at single spaces where it can be, else fed piece by piece."""
        pieces = cut_at_spaces(text)
        if pieces is not None:
            return self._ids(pre_tokens(pieces[0])) + b"".join(map(self.inner.__getitem__, pieces[1:]))
        fed = [self.feed(text[at : at + 65536]) for at in range(0, len(text), 65536)]
        return b"".join([*fed, self.finish()])

    def _drain(self, final: bool) -> bytes:
        out = []
        if self.open is not None:
            out.append(self._continue(final))
        if self.open is None and self.pending:
            seen = shadow(self.pending)
            limit = len(seen) if final else len(seen) - HELD_BACK
            done, found = 0, []
            for match in PRE_TOKEN.finditer(seen):
                if match.end() > limit:
                    break
                found.append(self.pending[match.start() : match.end()])
                done = match.end()
            out.append(self._ids(found))
            self.pending = self.pending[done:]
            if not final and len(self.pending) > OPEN_RUN:
                # One pre-token fills the rest: pass its bytes on and remember its kind.
                seen = shadow(self.pending)
                self.open = next(run for run in RUNS if run.match(seen, 1))
                cut = len(self.pending) - HELD_BACK
                out.append(self._push(self.pending[:cut]))
                self.pending = self.pending[cut:]
        return b"".join(out)

    def _push(self, text: str) -> bytes:
        return array("I", self.transducer.push(text.encode())).tobytes()

    def _continue(self, final: bool) -> bytes:
        seen = shadow(self.pending)
        match = self.open.match(seen)
        end = match.end() if match else 0
        if end == len(seen) and not final:
            cut = max(0, end - HELD_BACK)
            ids = self._push(self.pending[:cut])
            self.pending = self.pending[cut:]
            return ids
        if self.open is RUNS[2] and end and end < len(seen):
            end -= 1  # the last white space before other text begins the next pre-token
        ids = self._push(self.pending[:end]) + array("I", self.transducer.finish()).tobytes()
        self.pending, self.open = self.pending[end:], None
        return ids


def decode(vocab: Vocabulary, ids: array, block: int = 65536) -> Iterator[str]:
    """Text of the ids, piece by piece; a character may be spread over several tokens."""
    state = codecs.getincrementaldecoder("utf-8")("replace")
    text = vocab.text
    for at in range(0, len(ids), block):
        yield state.decode(b"".join(map(text.__getitem__, ids[at : at + block])))
    yield state.decode(b"", True)


def encode_text(encoder: StreamingEncoder, vocab: Vocabulary, text: str) -> array:
    """Ids of a whole text, special strings included."""
    ids = array("I")
    for part, special in vocab.segments(text):
        ids.frombytes(encoder.encode(part))
        if special is not None:
            ids.append(special)
    return ids


def encoder_for(path: str) -> StreamingEncoder:
    """The worker's encoder for a vocabulary file."""

    def build() -> StreamingEncoder:
        encoder = StreamingEncoder(Vocabulary(path))
        gc.freeze()  # the tables stay: the garbage collector need not walk through them again
        return encoder

    return worker_state(f"streaming encoder {path}", build)


def encode_documents(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False
) -> DataFrame:
    """Per row: id, n_tokens, ids_sha256, decoded_sha256; ``with_ids`` adds ids and decoded text."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    schema += ", ids binary, decoded string" if with_ids else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_for(path)
        vocab = encoder.transducer.vocab
        for batch in batches:
            out: dict[str, list] = {"n_tokens": [], "ids_sha256": [], "decoded_sha256": [], "ids": [], "decoded": []}
            for cell in batch.column("text"):
                ids = encode_text(encoder, vocab, cell.as_py())
                packed, digest, pieces = ids.tobytes(), hashlib.sha256(), []
                for piece in decode(vocab, ids):
                    digest.update(piece.encode())
                    if with_ids:
                        pieces.append(piece)
                out["n_tokens"].append(len(ids))
                out["ids_sha256"].append(hashlib.sha256(packed).hexdigest())
                out["decoded_sha256"].append(digest.hexdigest())
                if with_ids:
                    out["ids"].append(packed)
                    out["decoded"].append("".join(pieces))
            kinds = {"n_tokens": pa.int64(), "ids": pa.binary()}
            names = [name for name, cells in out.items() if len(cells) == batch.num_rows]
            if not with_ids:
                names = names[:3]
            arrays = [pa.array(out[name], kinds.get(name, pa.string())) for name in names]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *arrays], ["id", *names])

    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)
