"""Phrase fingerprints against a plain parse, and the order of documents over block borders."""

import base64
import hashlib

import numpy as np
import pytest

from corpusgauge.llm import fingerprints as fp


def plain_phrases(text):
    seen, current = set(), ""
    for character in text:
        current += character
        if current not in seen:
            seen.add(current)
            current = ""
    return seen


def whole(text):
    return fp.Parse().feed(text).fingerprint()


def expected(rows):
    """rows sorted by id."""
    out = []
    for (doc_id, text), (_, following) in zip(rows, rows[1:] + rows[:1]):
        text, following = text or "", following or ""
        half = len(text) // 2
        changed = text[: len(text) - half] + following[:half]
        prints = whole(text), whole(changed), whole(following)
        out.append((doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest(), fp.shown(prints[0]), fp.shown(prints[1]),
                    fp.likeness(prints[0], prints[1]), fp.likeness(prints[0], prints[2])))
    return out


def test_parse_and_likeness():
    text = "abracadabra abracadabra é🙂 abracadabra"
    assert fp.Parse().feed(text).seen == plain_phrases(text)
    assert fp.Parse().feed(text[:9]).copy().feed(text[9:]).seen == plain_phrases(text)
    one, other = plain_phrases(text), plain_phrases(text[:20] + "zzzz")
    assert fp.likeness(whole(text), whole(text[:20] + "zzzz")) == pytest.approx(len(one & other) / len(one | other))
    assert fp.likeness(whole(""), whole("")) == 1.0 and fp.likeness(whole(""), whole("a")) == 0.0
    assert np.frombuffer(base64.b64decode(fp.shown(whole(text))), "<u4").tolist() == whole(text).tolist()


def test_dictionary_resets(monkeypatch):
    monkeypatch.setattr(fp, "RESET", 50)
    parse = fp.Parse().feed("the quick brown fox " * 500)
    assert len(parse.seen) < 50 and len(parse.fingerprint()) > 20


@pytest.mark.parametrize("block", [7, 2000])
def test_given_documents(spark, monkeypatch, block):
    monkeypatch.setattr(fp, "LEAST_BLOCK", block)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = sorted((row.doc_id, row.text) for row in docs.collect())
    assert sorted(tuple(row) for row in fp.fingerprint_documents(docs).collect()) == expected(rows)


def test_odd_rows(spark):
    rows = [(None, "null first"), (1, None), (2, ""), (5, "x"), (6, "word " * 40000), (9, "é🙂"), (9, "é🙂")]
    docs = spark.createDataFrame([(*row, 1) for row in rows], "doc_id long, text string, block int")
    got = [tuple(row) for row in fp.fingerprint_documents(docs).collect()]
    assert sorted(map(str, got)) == sorted(map(str, expected(rows)))
    assert fp.fingerprint_documents(docs.filter("false")).count() == 0
    assert [tuple(row) for row in fp.fingerprint_documents(docs.filter("doc_id = 5")).collect()] == expected([(5, "x")])


def test_large_ids_beside_null_ids(spark, monkeypatch):
    """Ids above 2**53 stay what they are where a batch holds null ids too."""
    monkeypatch.setattr(fp, "LEAST_BLOCK", 20)
    rows = [(2**60 + 1 + at, f"text number {at} " * (1 + at % 40) * (30 if at % 50 == 0 else 1)) for at in range(200)] + [(None, "one"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = [row.doc_id for row in fp.fingerprint_documents(docs).select("doc_id").collect()]
    assert set(got) == {doc_id for doc_id, _ in rows}
    assert len(got) == len(rows)
