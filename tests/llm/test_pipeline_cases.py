"""Every stage of the pipeline on rows that are odd in some way, and on no rows."""

import os

import pytest

import corpus_pipeline

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, score string, id int, ids string, "
    "n_tokens string, component_id int, blob string, findings string, body int, item_id string, "
    "__blob int, __findings string, __key int, `a.b` int, key int, _key int, spans int, kept_id int"
)


def row(doc, text, **more):
    names = [field.split()[0].strip("`") for field in SCHEMA.split(", ")]
    values = {"lang": "en", "source": "s", "n_chars": None if text is None else len(text), "score": "x"} | more
    return tuple({"doc_id": doc, "text": text, **values}.get(name) for name in names)


def odd_rows():
    plain = " ".join(f"plain{i}" for i in range(80))
    secret = "password=deadbeefdeadbeefdeadbeef"
    return [
        row(1, plain), row(2, plain + " end"), row(3, plain), row(3, plain),
        row(4, None), row(5, ""), row(6, " \n\t"), row(7, "éa 漢 🙂 " * 30000), row(8, "x" * 200_000),
        row(None, plain), row(None, None, lang=None, source=None), row(9, "one"), row(10, secret), row(10, secret),
        row(11, f"{secret}, {secret}"), row(12, "word " * 60_000),
    ]


def test_stages_on_odd_rows(spark):
    docs = spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)
    ids = lambda df: sorted((r.doc_id for r in df.select("doc_id").collect()), key=str)
    found = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(spark, docs, SF_DIR).cache()
        found[name] = ids(docs)
        if name != "byte_bpe":
            assert docs.columns == before.columns, name
            assert {r.score for r in docs.collect()} == {"x"}, name
    assert found["toxicity"] == ids(spark.createDataFrame(odd_rows(), SCHEMA))
    assert found["near_dedup"] == sorted([1, 4, 5, 6, 7, 8, 9, 10, 11, 12, None, None], key=str)
    assert found["byte_bpe"] == found["secret_scan"] == found["decontamination"] == found["near_dedup"]
    texts = {r.doc_id: r.text for r in docs.collect() if r.doc_id is not None}
    assert texts[10] == "[secret]" and texts[11] == "[secret], [secret]" and texts[4] is None
    counts = {r.doc_id: r.n_tokens for r in docs.collect() if r.doc_id is not None}
    assert counts[4] == counts[5] == 0 and counts[8] > 0 and counts[12] >= 60_000


def test_stages_on_no_rows(spark):
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR)
        assert docs.collect() == []
