"""SentencePiece encoding that keeps, for every piece, its span of bytes in the original text.

A text is normalised by the model's compiled character map: at each place the longest source
string in the map's double-array trie is replaced. What is replaced is recorded (``Alignment``),
the runs between replacements keep their bytes. Pieces come from the model's merges on the
normalised text; their lengths are summed up and projected through the alignment.

No piece holds a character that is followed by a space mark (this is checked when a model is
loaded), so the merges never cross the border before a run of space marks: what lies between those
borders is encoded alone and remembered in a bounded memo.

Decoding is a table of bytes per id. Byte pieces join to characters; where they do not, each byte
gives one replacement character.

Defined results: null text counts as empty, with no ids and the digests of nothing; strings like
``<s>`` inside a text are ordinary text; ids may be null or repeat, each row gives one row; an empty
table gives no rows. Other columns are never read. Models other than BPE, or with user-defined
symbols, a denormaliser or space marks as suffixes, are refused.
"""

from __future__ import annotations

import gc
import hashlib
import heapq
import re
from array import array
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

from corpusgauge.llm.bytebpe import Memo, worker_state

# The mark that stands for a space, kinds of pieces, kinds of models.
MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
BPE = 2
#: The map is never asked for more source strings than this at one place.
MOST_MATCHES = 32
#: Characters of a unit up to which a list of scores beats a heap, and the score of what does not join.
SHORT, NONE = 48, float("-inf")
#: Characters of texts whose units are looked up and merged together.
TOGETHER = 1 << 20
_MARK_BYTES = len(MARK.encode())


class CharacterMap:
    """Longest source string at a place, in the double-array trie of a compiled map."""

    def __init__(self, compiled: bytes) -> None:
        size = int.from_bytes(compiled[:4], "little")
        self.units = np.frombuffer(compiled, "<u4", size // 4, 4).tolist()
        self.replacements = compiled[4 + size :]
        self._starting: dict[str, bool] = {}

    def matches(self, data: bytes, at: int) -> Iterator[tuple[int, int]]:
        """(end, place of the replacement) of the source strings that begin at ``at``, shortest first."""
        units, node = self.units, 0
        for end in range(at, len(data) + 1):
            unit = units[node]
            if end > at:
                if unit & 0x800000FF != data[end - 1]:
                    return
                if unit >> 8 & 1:
                    yield end, units[node ^ (unit >> 10 << ((unit & 0x200) >> 6))] & 0x7FFFFFFF
            if end == len(data):
                return
            node ^= (unit >> 10 << ((unit & 0x200) >> 6)) ^ data[end]
            if node >= len(units):
                return

    def longest(self, data: bytes, at: int) -> tuple[int, str] | None:
        """(end, replacement) of the longest source string at ``at``."""
        found = None
        for turn, found in enumerate(self.matches(data, at), 1):
            if turn == MOST_MATCHES:
                break
        if found is None:
            return None
        end, place = found
        return end, self.replacements[place : self.replacements.index(b"\0", place)].decode()

    def starts(self, character: str) -> bool:
        """Whether a source string can begin with the character."""
        known = self._starting.get(character)
        if known is None:
            data, node, known = character.encode(), 0, True
            for byte in data:
                unit = self.units[node]
                node ^= (unit >> 10 << ((unit & 0x200) >> 6)) ^ byte
                if node >= len(self.units) or self.units[node] & 0x800000FF != byte:
                    known = False
                    break
            self._starting[character] = known
        return known


class Alignment:
    """Bytes of a normalised text to bytes of its source, by the replaced stretches alone.

    ``made`` and ``made_end`` bound what a stretch became, ``source`` and ``source_end`` what it
    was. Inside it every byte points to the stretch's beginning; between stretches bytes go along.
    """

    __slots__ = ("made", "made_end", "source", "source_end")

    def __init__(self, made, made_end, source, source_end) -> None:
        self.made, self.made_end = np.asarray(made, np.int64), np.asarray(made_end, np.int64)
        self.source, self.source_end = np.asarray(source, np.int64), np.asarray(source_end, np.int64)

    def to_source(self, at: np.ndarray) -> np.ndarray:
        if not len(self.made):
            return at
        stretch = np.searchsorted(self.made, at, "right") - 1
        inside = self.source[stretch]
        beyond = self.source_end[stretch] + at - self.made_end[stretch]
        placed = np.where(at < self.made_end[stretch], inside, beyond)
        return np.where(stretch < 0, at, placed)


@dataclass
class Encoding:
    """Ids and byte spans of one text; ``decimals`` are the ids written with commas."""

    ids: array
    spans: np.ndarray
    decimals: str


class PieceModel:
    """A model file: its normaliser, its merges, and its decoder."""

    def __init__(self, content: bytes) -> None:
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(content)
        spec, trainer = proto.normalizer_spec, proto.trainer_spec
        kinds = {piece.type for piece in proto.pieces}
        if trainer.model_type != BPE or kinds & {USER_DEFINED, UNUSED} or trainer.treat_whitespace_as_suffix:
            raise ValueError("only BPE models without user-defined or unused pieces can be read")
        if proto.denormalizer_spec.precompiled_charsmap:
            raise ValueError("models that change decoded text cannot be read")
        self.map = CharacterMap(spec.precompiled_charsmap) if spec.precompiled_charsmap else None
        self.dummy, self.squeeze, self.escape = spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces
        self.mark = MARK if self.escape else " "
        self.ids = {piece.piece: at for at, piece in enumerate(proto.pieces) if piece.type == NORMAL}
        self.scores = {piece.piece: piece.score for piece in proto.pieces if piece.type == NORMAL}
        reserved = {piece.piece: at for at, piece in enumerate(proto.pieces) if piece.type != NORMAL}
        self.bytes = [reserved[f"<0x{byte:02X}>"] for byte in range(256)] if trainer.byte_fallback else None
        self.unknown = next(at for at, piece in enumerate(proto.pieces) if piece.type == UNKNOWN)
        self.decimals = [str(at) for at in range(len(proto.pieces))]
        self.shown = [self._shown(piece, trainer) for piece in proto.pieces]
        self.is_byte = np.array([piece.type == BYTE for piece in proto.pieces])
        self.control = {at for at, piece in enumerate(proto.pieces) if piece.type == CONTROL}
        self.marked = [piece.type == NORMAL and piece.piece.startswith(MARK) for piece in proto.pieces]
        inner = re.compile(f"[^{re.escape(self.mark)}]{re.escape(self.mark)}")
        whole = any(inner.search(piece) for piece in self.ids)
        mark = re.escape(self.mark)
        self._units = re.compile("(?s).+" if whole else f"{mark}+[^{mark}]*|[^{mark}]+")
        self._memo = Memo(self._unit, limit=250_000)
        self._tables()

    @staticmethod
    def _shown(piece, trainer) -> bytes:
        if piece.type == BYTE:
            return bytes([int(piece.piece[3:5], 16)])
        if piece.type == CONTROL:
            return b""
        if piece.type == UNKNOWN:
            return trainer.unk_surface.encode()
        return piece.piece.replace(MARK, " ").encode()

    # Normalisation

    def normalise(self, text: str) -> tuple[str, Alignment]:
        if not text:
            return "", Alignment([], [], [], [])
        replaced = self.map is not None and any(map(self.map.starts, set(text)))
        if replaced or self.squeeze or not self.escape:
            return self._normalise_stretches(text)
        # Spaces alone are replaced: their places are found at once.
        spaces = np.flatnonzero(np.frombuffer(text.encode(), np.uint8) == 32)
        made = spaces + (_MARK_BYTES - 1) * np.arange(len(spaces))
        shown, source, source_end = text.replace(" ", MARK), spaces, spaces + 1
        if self.dummy:
            shown = MARK + shown
            made = np.concatenate([[0], made + _MARK_BYTES])
            source, source_end = np.concatenate([[0], source]), np.concatenate([[0], source_end])
        return shown, Alignment(made, made + _MARK_BYTES, source, source_end)

    def _stretches(self, text: str) -> Iterator[tuple[int, int, str, str]]:
        """(byte start, byte end, plain text before, replacement) of what is not copied as it is."""
        data = text.encode()
        starting = {" "} if self.map is None else {" "} | set(filter(self.map.starts, set(text)))
        pattern = re.compile(b"|".join(re.escape(c.encode()) for c in sorted(starting)))
        done = at = 0
        while (match := pattern.search(data, at)) is not None:
            start = match.start()
            found = self.map.longest(data, start) if self.map is not None else None
            if found is None:
                at = match.end()
                if match.group() != b" ":
                    continue
                found = (at, " ")
            at = found[0]
            yield start, at, data[done:start].decode(), found[1]
            done = at
        yield len(data), len(data), data[done:].decode(), ""

    def _normalise_stretches(self, text: str) -> tuple[str, Alignment]:
        parts: list[str] = []
        made, made_end, source, source_end = [], [], [], []
        length, after_space = 0, self.squeeze

        def put(shown: str, start: int, end: int) -> None:
            nonlocal length
            size = len(shown.encode())
            parts.append(shown)
            made.append(length)
            made_end.append(length + size)
            source.append(start)
            source_end.append(end)
            length += size

        skipped, started = 0, False
        for start, end, before, replacement in self._stretches(text):
            if not started and self.squeeze and not before and replacement == " ":
                skipped = end  # leading spaces go before the text begins
                continue
            if not started:
                if start == end and not before:
                    break  # nothing but spaces
                started = True
                put(self.mark if self.dummy else "", 0, skipped)
                source[-1] = skipped
            if before:
                parts.append(before)
                length += len(before.encode())
                after_space = False
            kept = replacement.lstrip(" ") if after_space else replacement
            if start < end:
                put(kept.replace(" ", self.mark), start, end)
            if kept:
                after_space = self.squeeze and kept.endswith(" ")
        shown = "".join(parts)
        alignment = Alignment(made, made_end, source, source_end)
        if self.squeeze and shown.endswith(self.mark):
            # Spaces at the end go; the text then ends where they began.
            cut = shown.rstrip(self.mark)
            size = len(cut.encode())
            stop = int(alignment.to_source(np.array([size]))[0])
            keep = bisect_right(made, size - 1) if size else 0
            alignment = Alignment(
                [*made[:keep], size], [*made_end[:keep], size], [*source[:keep], stop], [*source_end[:keep], stop]
            )
            shown = cut
        return shown, alignment

    # Merges

    def merge(self, unit: str) -> list[str]:
        """Pieces of a unit: the best-scored neighbours are joined, leftmost first."""
        return self._merge_short(unit) if len(unit) <= SHORT else self._merge_long(unit)

    def _merge_short(self, unit: str) -> list[str]:
        """The neighbours' scores side by side in a list: the best is looked for anew each time."""
        score = self.scores.get
        pieces = list(unit)
        ranks = list(map(score, map(add, pieces, unit[1:]), repeat(NONE)))
        while ranks:
            best = max(ranks)
            if best == NONE:
                break
            at = ranks.index(best)
            joined = pieces[at] + pieces[at + 1]
            pieces[at : at + 2] = (joined,)
            del ranks[at]
            if at:
                ranks[at - 1] = score(pieces[at - 1] + joined, NONE)
            if at < len(ranks):
                ranks[at] = score(joined + pieces[at + 1], NONE)
        return pieces

    def _merge_long(self, unit: str) -> list[str]:
        """The neighbours' scores in a heap."""
        scores = self.scores
        pieces: list[str | None] = list(unit)
        size = len(pieces)
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        heap = []
        for at in range(size - 1):
            score = scores.get(unit[at : at + 2])
            if score is not None:
                heap.append((-score, at, at + 1, 2))
        heapq.heapify(heap)
        while heap:
            _, left, right, length = heapq.heappop(heap)
            first, second = pieces[left], pieces[right]
            if first is None or second is None or len(first) + len(second) != length:
                continue  # one of them was joined to another piece since
            joined = pieces[left] = first + second
            pieces[right] = None
            follows = after[left] = after[right]
            if follows < size:
                before[follows] = left
                score = scores.get(joined + pieces[follows])
                if score is not None:
                    heapq.heappush(heap, (-score, left, follows, length + len(pieces[follows])))
            leads = before[left]
            if leads >= 0:
                score = scores.get(pieces[leads] + joined)
                if score is not None:
                    heapq.heappush(heap, (-score, leads, left, len(pieces[leads]) + length))
        return [piece for piece in pieces if piece is not None]

    def _unit(self, unit: str) -> bytes:
        """Id and step in bytes of the normalised text, in turn, as unsigned 32-bit integers."""
        pieces, known = self.merge(unit), self.ids
        try:
            ids = array("I", [known[piece] for piece in pieces])
            steps = array("I", map(len, map(str.encode, pieces)))
        except KeyError:
            ids, steps = self._with_unknown(pieces)
        both = array("I", bytes(8 * len(ids)))
        both[0::2], both[1::2] = ids, steps
        return both.tobytes()

    def _with_unknown(self, pieces: list[str]) -> tuple[array, array]:
        ids, steps = array("I"), array("I")
        for piece in pieces:
            number = self.ids.get(piece)
            size = len(piece.encode())
            if number is not None:
                ids.append(number)
                steps.append(size)
            elif self.bytes is not None:
                # The last byte holds the character's span; the others are empty before it.
                ids.extend(self.bytes[byte] for byte in piece.encode())
                steps.extend([0] * (size - 1) + [size])
            else:
                ids.append(self.unknown)
                steps.append(size)
        return ids, steps

    def encode(self, text: str) -> Encoding:
        shown, alignment = self.normalise(text)
        return self._finish(alignment, self._units.findall(shown))

    def _finish(self, alignment: Alignment, units: list[str]) -> Encoding:
        # The memo holds bytes alone, which the garbage collector does not walk through.
        found = b"".join(map(self._memo.__getitem__, units))
        both = np.frombuffer(found, np.uint32).reshape(-1, 2)
        ids, ends = both[:, 0], np.cumsum(both[:, 1], dtype=np.int64)
        if self.bytes is None and len(ids):
            # Runs of unknown pieces become one.
            stays = np.append((ids[:-1] != self.unknown) | (ids[1:] != self.unknown), True)
            ids, ends = ids[stays], ends[stays]
        spans = np.empty((len(ids), 2), np.uint32)
        if len(ids):
            bounds = alignment.to_source(np.concatenate([[0], ends]))
            spans[:, 0], spans[:, 1] = bounds[:-1], bounds[1:]
        kept = array("I", ids.tobytes())
        return Encoding(kept, spans, ",".join(map(self.decimals.__getitem__, kept)))

    def encode_many(self, texts: list[str]) -> Iterator[Encoding]:
        """The texts' encodings; units that the memo lacks are merged side by side."""
        at = 0
        while at < len(texts):
            size, held = 0, []
            while at < len(texts) and (not held or size + len(texts[at]) <= TOGETHER):
                shown, alignment = self.normalise(texts[at])
                held.append((alignment, self._units.findall(shown)))
                size += len(shown)
                at += 1
            memo, older = self._memo, self._memo.older
            lacking = {unit for _, units in held for unit in units if unit not in memo and unit not in older}
            self._merge_together(sorted((unit for unit in lacking if len(unit) <= SHORT), key=len))
            for alignment, units in held:
                yield self._finish(alignment, units)

    def _merge_together(self, units: list[str]) -> None:
        """Merge many units in step, one row each, into the memo; those with unknown characters are left out."""
        for first in range(0, len(units), 4096):
            part = units[first : first + 4096]
            width = len(part[-1])
            points = np.frombuffer("".join(unit.ljust(width, "\0") for unit in part).encode("utf-32-le"), np.uint32)
            ids = self.of_point[points].reshape(-1, width)
            columns = np.arange(width)
            lengths = np.array([len(unit) for unit in part])
            beyond = columns >= lengths[:, None]
            known = (beyond | (ids >= 0)).all(axis=1)
            ids, beyond = ids[known], beyond[known]
            part = [unit for unit, whole in zip(part, known.tolist()) if whole]
            ids[beyond] = -1
            if width > 1 and part:
                self._join_rows(ids)
            kept = ids >= 0
            both = np.empty((int(kept.sum()), 2), np.uint32)
            both[:, 0] = ids[kept]
            both[:, 1] = self.piece_bytes[both[:, 0]]
            data, end = both.tobytes(), 0
            for unit, count in zip(part, kept.sum(axis=1).tolist()):
                self._memo.put(unit, data[end : end + 8 * count])
                end += 8 * count

    def _join_rows(self, ids: np.ndarray) -> None:
        """Rows of piece ids, -1 at their ends: join the best neighbours of every row until none is left."""
        score, joined = self._pairs(ids[:, :-1], ids[:, 1:])
        live = np.arange(len(ids))
        while len(live):
            best = score.argmax(axis=1)
            at = np.arange(len(live))
            going = score[at, best] > NONE
            live, score, joined, best = live[going], score[going], joined[going], best[going]
            if not len(live):
                return
            at, row = np.arange(len(live)), ids[live]
            row[at, best] = joined[at, best]
            # What follows the pair moves up by one place.
            from_pair = np.arange(row.shape[1] - 1)
            moved = from_pair > best[:, None]
            row[:, :-1] = np.where(moved, row[:, 1:], row[:, :-1])
            row[:, -1] = -1
            if score.shape[1] > 1:
                behind = moved[:, :-1] | (from_pair[:-1] == best[:, None])
                score[:, :-1] = np.where(behind, score[:, 1:], score[:, :-1])
                joined[:, :-1] = np.where(behind, joined[:, 1:], joined[:, :-1])
            score[:, -1] = NONE
            for place in (best - 1, best):
                inside = np.flatnonzero((place >= 0) & (place < score.shape[1]))
                rows, columns = at[inside], place[inside]
                score[rows, columns], joined[rows, columns] = self._pairs(row[rows, columns], row[rows, columns + 1])
            ids[live] = row

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Score and id of the piece that two pieces join to."""
        keys = left.astype(np.int64) << 32 | right
        keys[(left < 0) | (right < 0)] = -1
        place = np.searchsorted(self.pair_keys, keys)
        place[place == len(self.pair_keys)] = 0
        met = self.pair_keys[place] == keys
        return np.where(met, self.pair_scores[place], NONE), np.where(met, self.pair_ids[place], -1)

    def _tables(self) -> None:
        """Pieces by code point, bytes of pieces, and the pairs of pieces that join, for merging in step."""
        self.of_point = np.full(0x110000, -1, np.int32)
        self.piece_bytes = np.zeros(len(self.decimals), np.uint32)
        pairs = {}
        for piece, number in self.ids.items():
            self.piece_bytes[number] = len(piece.encode())
            if len(piece) == 1:
                self.of_point[ord(piece)] = number
            for cut in range(1, len(piece)):
                left, right = self.ids.get(piece[:cut]), self.ids.get(piece[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = number
        self.pair_keys = np.array(sorted(pairs) or [-2], np.int64)
        self.pair_ids = np.array([pairs.get(key, -1) for key in self.pair_keys.tolist()], np.int32)
        score_of = np.full(len(self.decimals) + 1, NONE)
        for piece, number in self.ids.items():
            score_of[number] = self.scores[piece]
        self.pair_scores = score_of[self.pair_ids]

    # Decoding

    def decode(self, ids: array) -> str:
        shown = self.shown
        data = b"".join(map(shown.__getitem__, ids))
        if self.dummy or self.squeeze:
            data = data[self._leading_marks(ids) :]
        if self.control.isdisjoint(ids):  # a control piece shows nothing, but it parts byte pieces
            try:
                return data.decode()
            except UnicodeDecodeError:
                pass
        return self._decode_runs(ids)

    def _leading_marks(self, ids: array) -> int:
        """Spaces at the beginning that the encoder put in."""
        dropped = 0
        for number in ids:
            if number in self.control:
                continue
            if self.is_byte[number] or not self.marked[number]:
                break
            dropped += 1
            if not self.squeeze or self.shown[number] != b" ":
                break
        return dropped

    def _decode_runs(self, ids: array) -> str:
        """Byte pieces by runs: what is no character gives a replacement character per byte."""
        out, run = [], bytearray()
        for number in [*ids, None]:
            if number is not None and self.is_byte[number]:
                run += self.shown[number]
                continue
            at = 0
            while at < len(run):
                size = 1 if run[at] < 0x80 else 2 if run[at] < 0xE0 else 3 if run[at] < 0xF0 else 4
                try:
                    out.append(run[at : at + size].decode())
                    at += size
                except UnicodeDecodeError:
                    out.append("�")
                    at += 1
            run.clear()
            if number is not None:
                out.append(self.shown[number].decode())
        text = "".join(out)
        return text[self._leading_marks(ids) :] if self.dummy or self.squeeze else text


def model(path: str) -> PieceModel:
    """The worker's model of a file."""

    def read() -> PieceModel:
        with open(path, "rb") as file:
            made = PieceModel(file.read())
        gc.freeze()  # the tables stay: the garbage collector need not walk through them again
        return made

    return worker_state(f"pieces {path}", read)


def encode_documents(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", with_pieces: bool = False
) -> DataFrame:
    """Per row: id, n_tokens, ids_sha256, decoded_sha256, spans_sha256.

    The spans' digest is that of begin and end of every piece, in bytes of the text, as little-endian
    unsigned 32-bit integers. ``with_pieces`` adds ids, begins, ends and the decoded text.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string, spans_sha256 string"
    schema += ", ids array<int>, begins array<int>, ends array<int>, decoded string" if with_pieces else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = model(path)
        ints = pa.list_(pa.int32())
        kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), ints, ints, ints, pa.string()]
        names = ["n_tokens", "ids_sha256", "decoded_sha256", "spans_sha256", "ids", "begins", "ends", "decoded"]
        width = len(names) if with_pieces else 4
        for batch in batches:
            made: list[list] = [[] for _ in range(width)]
            for encoding in pieces.encode_many(batch.column("text").to_pylist()):
                decoded = pieces.decode(encoding.ids)
                cells = [
                    len(encoding.ids),
                    hashlib.sha256(encoding.decimals.encode()).hexdigest(),
                    hashlib.sha256(decoded.encode()).hexdigest(),
                    hashlib.sha256(encoding.spans.tobytes()).hexdigest(),
                ]
                if with_pieces:
                    cells += [list(encoding.ids), encoding.spans[:, 0].tolist(), encoding.spans[:, 1].tolist(), decoded]
                for column, value in zip(made, cells):
                    column.append(value)
            arrays = [pa.array(column, of) for column, of in zip(made, kinds)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *arrays], ["id", *names[:width]])

    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)
