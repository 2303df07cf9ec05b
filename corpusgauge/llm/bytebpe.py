"""A byte-level BPE vocabulary: its merges, its pre-tokens, and a bounded memo.

The file is read by path on each worker and kept for the worker's life.
"""

from __future__ import annotations

import ctypes
import functools
import heapq
import json
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
import regex

# White space by Unicode's White_Space property.
SPACE = r"\t-\r\x20\x85\xa0  -     　"
# Fixed value: the pre-token pattern of the vocabulary.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+"
    rf"| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)
PRE_TOKEN = regex.compile(PATTERN)
# Letters and numbers that Unicode gained after version 16, which the tokenizers
# follow; the pattern's engine may know them, but to the vocabulary they are neither.
LATER = re.compile(
    "[՘֋-֌࢏౜೜₏₝-₟꟎-꟏꟒꟔꟝꟢꟱"
    "꭬-꭭\U000107bb-\U000107bf\U00010940-\U00010959\U00010ec5-\U00010ec7\U00010ed9-\U00010eee"
    "\U00011b0a\U00011db0-\U00011ddb\U00011de0-\U00011de9\U00011df1\U0001246f\U00012475-\U0001247f"
    "\U00012550-\U00012686\U00016ea0-\U00016eb8\U00016ebb-\U00016ed3\U00016ff2-\U00016ff6"
    "\U000187f8-\U000187ff\U00018cd6-\U00018cda\U00018d09-\U00018d20\U00018d80-\U00018df2"
    "\U00018e00-\U00019191\U000191a0-\U000191d2\U0001b123-\U0001b128\U0001b168\U0001d6a6"
    "\U0001df1f-\U0001df24\U0001df2b-\U0001df81\U0001df90-\U0001df96\U0001dfcd-\U0001dfff"
    "\U0001e6c0-\U0001e6de\U0001e6e0-\U0001e6e2\U0001e6e4-\U0001e6e5\U0001e6e7-\U0001e6ed"
    "\U0001e6f0-\U0001e6f4\U0001e6fe-\U0001e6ff\U0002b73a-\U0002b73f\U0002b81e\U0002cea2-\U0002cead"
    "\U000323b0-\U00033479\U0003d000-\U0003fc3f]"
)
#: Bytes of a pre-token from which pairs are kept in a heap.
LONG = 64
UNASSIGNED = "͸"


def shadow(text: str) -> str:
    """The text as the pre-token pattern must see it, one code point for each of its own."""
    return text if text.isascii() else LATER.sub(UNASSIGNED, text)


def pre_tokens(text: str) -> list[str]:
    seen = shadow(text)
    if seen == text:
        return PRE_TOKEN.findall(text)
    return [text[match.start() : match.end()] for match in PRE_TOKEN.finditer(seen)]


# A space before white space: there the text cannot be cut at single spaces.
UNCUTTABLE = re.compile(r" \s")


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary file.

    Printable Latin-1 bytes stand for themselves; the others follow from code point 256 on.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    shown = {chr(byte): byte for byte in plain}
    others = [byte for byte in range(256) if byte not in set(plain)]
    shown.update({chr(256 + at): byte for at, byte in enumerate(others)})
    return shown


class Vocabulary:
    """Ids, bytes and merges of one file.

    ``ids``: bytes of a token to its id; ``text``: id to bytes; ``merges``: pair of ids to
    (rank, id of the merged token); ``special``: strings that are tokens wherever they stand.
    """

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, alphabet = spec["model"], byte_alphabet()
        ids = {bytes(alphabet[c] for c in token): number for token, number in model["vocab"].items()}
        self.text = {number: token for token, number in ids.items()}
        pairs = (pair if isinstance(pair, list) else pair.split(" ") for pair in model["merges"])
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (left, right) in enumerate(pairs):
            left, right = (bytes(alphabet[c] for c in part) for part in (left, right))
            self.merges.setdefault((ids[left], ids[right]), (rank, ids[left + right]))
        self.byte_ids = [ids[bytes([byte])] for byte in range(256)]
        self.special = {token["content"]: token["id"] for token in spec["added_tokens"]}
        for content, number in self.special.items():
            self.text[number] = content.encode()
        self._special = re.compile("|".join(map(re.escape, self.special))) if self.special else None
        #: Tokens that the merges give back whole, by bytes: proved here, by running the merges.
        self.whole = {token: number for token, number in ids.items() if self.merge(token) == [number]}
        self.longest = max(map(len, self.whole), default=1)

    def merge(self, data: bytes, stop: int = 1) -> list[int]:
        """Ids of one pre-token: the lowest-ranked adjacent pair is merged, leftmost first.

        Merging ends early when ``stop`` ids are left.
        """
        if len(data) > LONG:
            return self._merge_long(data, stop)
        ids = [self.byte_ids[byte] for byte in data]
        merges = self.merges
        while len(ids) > stop:
            best, at = None, -1
            for i, pair in enumerate(zip(ids, ids[1:])):
                found = merges.get(pair)
                if found is not None and (best is None or found[0] < best[0]):
                    best, at = found, i
            if best is None:
                break
            ids[at : at + 2] = [best[1]]
        return ids

    def _merge_long(self, data: bytes, stop: int) -> list[int]:
        """The same with a heap of pairs, in time about linear in the data."""
        ids: list[int | None] = [self.byte_ids[byte] for byte in data]
        size = left_over = len(ids)
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        heap = []

        def offer(left: int) -> None:
            right = after[left]
            if right < size and (found := self.merges.get((ids[left], ids[right]))) is not None:
                heapq.heappush(heap, (found[0], left, ids[left], ids[right], found[1]))

        for at in range(size - 1):
            offer(at)
        while heap and left_over > stop:
            _, left, first, second, merged = heapq.heappop(heap)
            right = after[left]
            if ids[left] != first or right >= size or ids[right] != second:
                continue  # one of them was merged with another neighbour since
            ids[left], ids[right] = merged, None
            left_over -= 1
            after[left] = after[right]
            if after[left] < size:
                before[after[left]] = left
            offer(left)
            if before[left] >= 0:
                offer(before[left])
        return [number for number in ids if number is not None]

    def segments(self, text: str) -> Iterator[tuple[str, int | None]]:
        """(ordinary text, id of the special string after it); special strings cut the text."""
        start = 0
        if self._special is not None:
            for match in self._special.finditer(text):
                yield text[start : match.start()], self.special[match.group()]
                start = match.end()
        yield text[start:], None


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


_held: tuple[str, object] = ("", None)


def worker_state(owner: str, make: Callable[[], object] = lambda: None):
    """What an operator keeps in a Python worker between tasks.

    Only one owner's state is held: a worker that serves several operators in turn does not add
    up their vocabularies and memos.
    """
    global _held
    if _held[0] != owner:
        if _held[0]:
            _held = ("", None)
            _give_back()
        _held = (owner, make())
    return _held[1]


def _give_back() -> None:
    """Return freed memory to the machine, so that a worker that waits does not hold it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


class Memo(dict):
    """Results of ``compute`` for short keys; at most ``2 * limit`` of them are held.

    When it is full the older half goes, and what is still in use returns from there.
    """

    def __init__(self, compute: Callable, limit: int = 150_000, longest: int = 64) -> None:
        super().__init__()
        self.compute, self.limit, self.longest, self.older = compute, limit, longest, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.compute(key)
            if len(key) > self.longest:
                return value
        self.put(key, value)
        return value

    def put(self, key, value) -> None:
        if len(self) >= self.limit:
            self.older = dict(self)
            self.clear()
        self[key] = value


def cut_at_spaces(text: str) -> list[str] | None:
    """Pieces between single spaces, or None where a space is followed by white space.

    Such a space begins a pre-token, so each piece but the first stands for a chunk that starts
    with its space and can be tokenized alone.
    """
    return None if UNCUTTABLE.search(text) else text.split(" ")
