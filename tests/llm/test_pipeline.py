"""The stages of the pipeline, each against a plain version on its own input."""

import hashlib
import re
from collections import defaultdict

import corpus_pipeline as pipeline
from tests.llm.test_near_dedup import brute
from tests.llm.test_secrets import KINDS

SF_DIR = "/root/testdata/sf0.001"


def rows_of(frame):
    return sorted((tuple(row) for row in frame.collect()), key=repr)


def test_stages_on_given_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    kept = pipeline.language(spark, docs, SF_DIR)
    assert kept.columns == docs.columns
    with_letters = [row for row in rows_of(docs) if any(map(str.isalpha, row[1] or ""))]
    assert rows_of(kept) == with_letters  # prose in learned languages: nothing else goes

    single = pipeline.exact(spark, kept, SF_DIR)
    best = {}
    for row in with_letters:
        key = re.sub(r"[\x20\x09-\x0D]", "", row[1])
        if key not in best or (-len(row[1]), row[0]) < (-len(best[key][1]), best[key][0]):
            best[key] = row
    assert rows_of(single) == sorted(best.values(), key=repr)

    apart = pipeline.near(spark, single, SF_DIR)
    groups = brute([row[:2] for row in best.values()], 5, 80)
    stay = {doc_id for doc_id, _, least in groups if doc_id == least}
    assert rows_of(apart) == sorted((row for row in best.values() if row[0] in stay), key=repr)

    clean = {row.doc_id: row for row in pipeline.redact(spark, apart, SF_DIR).collect()}
    assert set(clean) == stay
    for row in best.values():
        if row[0] in stay:
            hit = any(len(m.group(g)) >= least for p, g, least in KINDS.values() for m in p.finditer(row[1]))
            shown = clean[row[0]]
            assert ("[SECRET]" in shown.text) == hit and shown.n_chars == len(shown.text) if hit else shown.text == row[1]

    tokens = defaultdict(int)
    for piece in pipeline.run(spark, SF_DIR).collect():
        tokens[piece.doc_id] += piece.length
        assert 0 <= piece.offset and piece.offset + piece.length <= 2048
    assert set(tokens) == stay


def test_odd_rows(spark):
    text = "the cat and the dog saw a bird on the roof of the old house by the sea "
    rows = [(1, text, "en", None, 5, 0), (1, text, "en", None, 5, 0), (None, text * 3, None, "x", None, 1), (2, None, "en", "x", 0, 1),
            (3, "", "en", "x", 0, 1), (4, "123 456", "en", "x", 7, 1), (5, "a bird and a dog in the old roof token=abcdefghijklmnopq by the cat", "en", "x", 9, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, row_number int")
    for _, stage in pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "row_number"]
    got = rows_of(docs)
    assert len({hashlib.md5(row[1].encode()).hexdigest() for row in got}) == len(got)
    assert all(row[2] == "en" for row in got) and any("[SECRET]" in row[1] for row in got)
    assert pipeline.pack(spark, docs, "").count() >= len(got)
    empty = spark.createDataFrame([], docs.schema)
    for _, stage in pipeline.STAGES:
        assert stage(spark, empty, "").count() == 0


def test_hits_of_many_spans_are_joined_by_a_shuffle(spark, monkeypatch):
    monkeypatch.setattr(pipeline, "BROADCAST_ROWS", 20)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = "a 0123456789abcdef b"
        for copies, hint in ((1, True), (30, False)):
            docs = spark.createDataFrame([(1, text * copies, "en"), (2, "the cat", "en")], "doc_id long, text string, lang string")
            clean = pipeline.redact(spark, docs, "")
            assert ("BroadcastHashJoin" in clean._jdf.queryExecution().executedPlan().toString()) == hint
            assert rows_of(clean) == [(1, "a [SECRET] b" * copies, "en"), (2, "the cat", "en")]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
