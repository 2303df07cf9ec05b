"""Fill-in-the-middle against a plain version by code points."""

import hashlib
import random
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusgauge.llm import fim

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plainly(doc_id, text):
    tokens = TOKEN.findall(text)
    assert "".join(tokens) == text
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[at : at + 8], 16) for at in range(0, 32, 8)]
    low, high = sorted((h[0] % (len(tokens) + 1), h[1] % (len(tokens) + 1)))
    a, b, c = "".join(tokens[:low]), "".join(tokens[low:high]), "".join(tokens[high:])
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        form, output, lengths = "plain", text, (None, None)
    elif h[3] % 100 < 80:
        form, output, lengths = "spm", f"<S>{c}<P>{a}<M>{b}", (len(a), len(b))
    else:
        form, output, lengths = "psm", f"<P>{a}<S>{c}<M>{b}", (len(a), len(b))
    return len(tokens), form, *lengths, output


@given(st.text(st.sampled_from("a é日😀 \n<>PSM　"), max_size=60))
@settings(max_examples=300, deadline=None)
def test_index_converts_both_ways(text):
    index, points = fim.ByteIndex(text.encode()), np.arange(len(text) + 1)
    cuts = np.array([len(text[:at].encode()) for at in points])
    assert (index.to_bytes(points) == cuts).all() and (index.to_points(cuts) == points).all()
    assert len(index.starts) == sum(ord(c) > 127 for c in text)
    ends = [match.end() for match in TOKEN.finditer(text)]
    assert list(index.to_points(fim.token_ends(text.encode()))) == ends


def test_rows(spark):
    draw = random.Random(5)
    texts = [None, "", "   ", "<", "a<S>b", "<P", ">>", "S><P<M <<S", "word " * 200_000, "日本 語　x\n" * 30_000, "x" * 300_000]
    texts += ["".join(draw.choices("a é日😀 \n<>PSM　", k=draw.randrange(40))) for _ in range(300)]
    rows = [(at if at % 50 else None, text, "clash", 1) for at, text in enumerate(texts)] + [(7, "a b c", "x", 2), (7, "a b c", "x", 2), (2**60 + 1, "é b c d", "x", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, output string, n int")
    got = [tuple(row) for row in fim.fill_in_middle(docs).collect()]
    wanted = [(doc_id, *plainly(doc_id, text or "")) for doc_id, text, _, _ in rows]
    assert sorted(map(repr, got)) == sorted(map(repr, wanted))
    assert {row[2] for row in got} == {"plain", "spm", "psm"}
    digest = lambda text: hashlib.sha256(text.encode()).hexdigest()
    report = [tuple(row) for row in fim.report(fim.fill_in_middle(docs)).collect()]
    expected = [(doc_id, *plain[:4], digest(plain[4]), digest(text or "")) for (doc_id, text, _, _), plain in ((row, plainly(row[0], row[1] or "")) for row in rows)]
    assert sorted(map(repr, report)) == sorted(map(repr, expected))


def test_empty_table(spark):
    assert fim.report(fim.fill_in_middle(spark.createDataFrame([], "doc_id string, text string"))).collect() == []
