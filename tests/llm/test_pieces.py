"""SentencePiece encoding, spans and decoding against the library."""

import hashlib
import random
import time

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import sentencepiece_model_pb2, sentencepiece_pb2

from corpusgauge.llm import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")


def variant(name):
    """The model as it is, or with another normaliser (its merges stay)."""
    proto = sentencepiece_model_pb2.ModelProto()
    with open(PATH, "rb") as file:
        proto.ParseFromString(file.read())
    if name != "own":
        rule, squeeze, dummy = name
        compiled = sentencepiece_model_pb2.ModelProto()
        compiled.ParseFromString(sentencepiece.SentencePieceNormalizer(rule_name=rule).serialized_model_proto())
        proto.normalizer_spec.precompiled_charsmap = compiled.normalizer_spec.precompiled_charsmap
        proto.normalizer_spec.remove_extra_whitespaces = squeeze
        proto.normalizer_spec.add_dummy_prefix = dummy
    return proto.SerializeToString()


VARIANTS = ["own", ("nfkc", False, True), ("nmt_nfkc_cf", True, True), ("nmt_nfkc", True, False), ("nfkc_cf", False, False)]
MODELS = {str(name): variant(name) for name in VARIANTS}
OURS = {name: pieces.PieceModel(content) for name, content in MODELS.items()}
LIBRARY = {name: sentencepiece.SentencePieceProcessor(model_proto=content) for name, content in MODELS.items()}
ALPHABET = "abe  tTh▁\n\t\0é😀ﬁ㍿Ⅷ²ｶﾞ가한́​　İßＡ<s>日本"


def agree(name, text):
    ours, library = OURS[name], LIBRARY[name]
    wanted = sentencepiece_pb2.SentencePieceText()
    wanted.ParseFromString(library.encode(text, out_type="serialized_proto"))
    got = ours.encode(text)
    assert list(got.ids) == [piece.id for piece in wanted.pieces], (name, text)
    assert got.spans.tolist() == [[piece.begin, piece.end] for piece in wanted.pieces], (name, text)
    assert got.decimals == ",".join(map(str, got.ids))
    assert ours.decode(got.ids) == library.decode(list(got.ids)), (name, text)


@pytest.mark.parametrize("name", MODELS)
def test_equals_the_library(name):
    @given(st.text(st.sampled_from(ALPHABET), max_size=40))
    @settings(max_examples=400, deadline=None)
    def check(text):
        agree(name, text)

    check()
    draw = random.Random(4)
    for text in ("", " ", "   ", "▁", "The end. \n\n   of it ", "<s></s><unk><0x0A>", "x" * 3000, "ab" * 5000, "".join(chr(draw.randrange(1, 0xD000)) for _ in range(4000))):
        agree(name, text)


@pytest.mark.parametrize("name", MODELS)
def test_any_ids_decode_as_the_library_does(name):
    draw = random.Random(9)
    for _ in range(400):
        ids = [draw.choice([1, 2, draw.randrange(3, 259), draw.randrange(32000), 29871, 259]) for _ in range(draw.randrange(12))]
        assert OURS[name].decode(ids) == LIBRARY[name].decode(ids), (name, ids)


@pytest.mark.parametrize("name", MODELS)
def test_texts_together_equal_texts_alone(name):
    draw = random.Random(6)
    texts = ["".join(draw.choices(ALPHABET + "etaoin   ", k=draw.randrange(60))) for _ in range(600)] + ["", "▁▁▁ the", "x" * 70]
    texts += [" ".join("".join(draw.choices("etaoinshrdlu", k=draw.randrange(1, 14))) for _ in range(3000))]
    for text, got in zip(texts, pieces.PieceModel(MODELS[name]).encode_many(texts), strict=True):
        assert list(got.ids) == LIBRARY[name].encode(text), (name, text)


def test_a_long_run_takes_seconds():
    draw = random.Random(2)
    text = "".join(draw.choices("abcdefghijklmnopqrstuvwxyzABCDEF0123456789+/", k=200_000))
    started = time.time()
    agree("own", text)
    assert time.time() - started < 20


def test_rows(spark):
    rows = [(1, None, "z"), (1, "", "z"), (None, "the end<s>", None), (2**60 + 1, "word é  " * 20000, "z"), (3, "a b", "z"), (3, "a b", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = pieces.encode_documents(docs, PATH, with_pieces=True).collect()
    digest = lambda text: hashlib.sha256(text.encode()).hexdigest()
    wanted = []
    for doc_id, text, _ in rows:
        ids = LIBRARY["own"].encode(text or "")
        wanted.append((doc_id, len(ids), digest(",".join(map(str, ids))), digest(LIBRARY["own"].decode(ids))))
    assert sorted((tuple(row)[:4] for row in got), key=repr) == sorted(wanted, key=repr)
    for row in got:
        assert len(row.ids) == len(row.begins) == len(row.ends) == row.n_tokens
    short = pieces.encode_documents(docs, PATH).collect()
    assert sorted((tuple(row) for row in short), key=repr) == sorted((tuple(row)[:5] for row in got), key=repr)
    assert pieces.encode_documents(docs.limit(0), PATH).collect() == []
