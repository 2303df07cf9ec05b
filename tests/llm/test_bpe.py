"""Streaming BPE and token counts against the tokenizers library."""

import hashlib
import random
import time
from array import array

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from corpusgauge.llm import bpe_stream, token_counts
from corpusgauge.llm.bytebpe import vocabulary

PATH = public_tokenizers.path("byte_bpe_50k.json")
ALPHABETS = ["ab", "etaoin shr", "  \n\t  x1'", "aA1 .,!?'sret\n", "éçßñ你好🙂́ a", "Ᲊ꟎॰ a1", "'re'll <|endoftext|>"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def texts():
    draw = random.Random(5)
    made = ["", " ", "  ", "\n", "a", " a", "a ", "a  b", "a \n b", "<|endoftext|>", "x<|endoftext|> y <|endoftext|>", "\x1c \x1d a", "\x00\x01"]
    for alphabet in ALPHABETS:
        for length in (1, 2, 3, 5, 9, 20, 80, 400):
            made += ["".join(draw.choices(alphabet, k=length)) for _ in range(12)]
    made += ["".join(chr(draw.choice([draw.randrange(0x20, 0x3000), draw.randrange(0x10000, 0x20000)])) for _ in range(50)) for _ in range(60)]
    made += ["e" * 9000, " " * 9000 + "x", "ab" * 5000 + " \n", "\n" * 5000, "1" * 6000 + "'s", "ÃÂ" * 3000, ".!" * 5000]
    return made


def test_ids_and_counts_equal_the_library(library):
    vocab, encoder = vocabulary(PATH), bpe_stream.StreamingEncoder(vocabulary(PATH))
    counter = token_counts.TokenCounter(vocab)
    for text in texts():
        wanted = library.encode(text, add_special_tokens=False).ids
        assert list(bpe_stream.encode_text(encoder, vocab, text)) == wanted, repr(text[:80])
        assert counter.count(text) == len(wanted), repr(text[:80])
        assert "".join(bpe_stream.decode(vocab, array("I", wanted), 7)) == library.decode(wanted, skip_special_tokens=False)


def test_feeding_in_pieces_gives_the_same_ids(library):
    draw = random.Random(7)
    encoder = bpe_stream.StreamingEncoder(vocabulary(PATH))
    for text in texts():
        if "<|" in text:
            continue
        out, at = b"", 0
        while at < len(text):
            step = draw.choice([1, 2, 3, 50, 5000]) if len(text) < 600 else draw.choice([700, 5000])
            out += encoder.feed(text[at : at + step])
            at += step
        out += encoder.finish()
        ids = array("I")
        ids.frombytes(out)
        assert list(ids) == library.encode(text, add_special_tokens=False).ids, repr(text[:80])


def test_the_window_stays_within_the_lookahead():
    vocab = vocabulary(PATH)
    bound = bpe_stream.sufficient_lookahead(vocab)
    transducer = bpe_stream.Transducer(vocab)
    draw = random.Random(3)
    for alphabet in (b"a", b"ab", b"etaoinshr", bytes(range(256)), "ÃÂ".encode()):
        for _ in range(40):
            transducer.push(bytes(draw.choices(alphabet, k=100)))
            assert len(transducer.window) <= bound + 256
        transducer.finish()


def test_rows(spark, library):
    rows = [(1, None, "z"), (1, "", "z"), (None, "the end<|endoftext|>", None), (3, "word " * 20000, "z"), (3, "a b", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    wanted = []
    for doc_id, text, _ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        wanted.append((doc_id, len(ids), hashlib.sha256(array("I", ids).tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    encoded = bpe_stream.encode_documents(docs, PATH, with_ids=True)
    assert sorted(map(str, (tuple(row)[:4] for row in encoded.collect()))) == sorted(map(str, wanted))
    assert sorted(row.decoded for row in encoded.collect()) == sorted(text or "" for _, text, _ in rows)
    counts = token_counts.count_tokens(docs, PATH).collect()
    assert sorted((str(row.doc_id), row.n_bytes, row.n_tokens, row.over_limit) for row in counts) == sorted(
        (str(doc_id), len((text or "").encode()), n, n > 1024) for (doc_id, text, _), (_, n, _, _) in zip(rows, wanted)
    )
    empty = docs.filter("false")
    assert bpe_stream.encode_documents(empty, PATH).count() == token_counts.count_tokens(empty, PATH).count() == 0


def test_long_pre_tokens_take_seconds(library):
    draw = random.Random(11)
    counter = token_counts.TokenCounter(vocabulary(PATH))
    started = time.time()
    for text in ("".join(draw.choices("abcdefghijklmnopqrstuvwxyzABCDEF", k=200_000)), "a" * 200_000, "acgt" * 30_000):
        assert counter.count(text) == len(library.encode(text, add_special_tokens=False).ids)
    assert time.time() - started < 30


def test_emission_follows_the_bound(library):
    """What is emitted is what lies the lookahead behind the end, and no later byte changes it."""
    vocab = vocabulary(PATH)
    transducer, draw = bpe_stream.Transducer(vocab), random.Random(12)
    assert transducer.lookahead == bpe_stream.sufficient_lookahead(vocab)
    for alphabet in ("a", "ab", "the in", "etaoinshrdlu", "=-", "".join(map(chr, range(33, 127)))):
        data = "".join(c for c in draw.choices(alphabet, k=6000) if c != " ").encode()
        ids, at = [], 0
        while at < len(data):
            step = draw.choice([1, 7, 300])
            ids += transducer.push(data[at : at + step])
            at += step
            left = len(transducer.window)
            assert left < transducer.lookahead + vocab.longest + 1
        assert ids + transducer.finish() == vocab.merge(data)


def test_a_byte_costs_few_steps_through_the_tokens():
    class Node(dict):
        steps = 0

        def __getitem__(self, key):
            Node.steps += key >= 0
            return dict.__getitem__(self, key)

        def get(self, key, default=None):
            Node.steps += key >= 0
            return dict.get(self, key, default)

    def counted(node):
        return Node({key: counted(below) if isinstance(below, dict) else below for key, below in node.items()})

    vocab, draw = vocabulary(PATH), random.Random(11)
    transducer = bpe_stream.Transducer(vocab)
    words = ["".join(draw.choices("etaoinshrdlu", k=12)).encode() for _ in range(2000)]
    wanted = [transducer.encode(word) for word in words]
    transducer.backwards = counted(transducer.backwards)
    assert [transducer.encode(word) for word in words] == wanted == [vocab.merge(word) for word in words]
    assert Node.steps <= 2.5 * sum(map(len, words))
