"""The pipeline stage by stage, and every query on the smallest tables."""

import pytest
from awkward import rows, table
from compare import TESTDATA, compare, duck
from test_dedup import exact_brute, near_brute

import corpus_pipeline
from weighline.llm import language_id, queries, secrets

SF = f"{TESTDATA}/sf0.001"


def brute(data, known):
    """The rows before packing, in plain Python; ``known``: the texts whose language was told."""
    data = [(i, t) for i, t in data if t in known]
    keep = exact_brute(data)
    data = list({(keep[t][0], t) for _, t in data})
    best = {}
    for (i, t), (*_, group) in zip(data, near_brute(data, 5, 80)):
        best[group] = min(best.get(group, (i, t)), (i, t), key=lambda x: (x[0] is None, x[0] or 0))
    return sorted((i, secrets.redacted(t)) for i, t in best.values())


def stages(spark, docs, tmp_path):
    out = []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        out.append(docs)
    return out


def test_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    data = [(r.doc_id, r.text) for r in docs.collect()]
    known = {r.text for r in language_id.keep_known(docs).collect()}
    *kept, packed = stages(spark, docs, tmp_path)
    assert all(k.columns == docs.columns for k in kept)
    want = brute(data, known)
    assert sorted((r.doc_id, r.text) for r in kept[-1].collect()) == want
    assert {r.doc_id for r in packed.collect()} == {i for i, _ in want}
    run = corpus_pipeline.run(spark, SF)
    assert sorted(map(tuple, run.select("doc_id", "piece", "length", "ids_crc32").collect())) == sorted(
        map(tuple, packed.select("doc_id", "piece", "length", "ids_crc32").collect()))


def test_awkward_rows(spark, tmp_path):
    data = [(i, t) for i, t in rows() if i is not None and i != 3]
    docs = table(spark, data)
    known = {r.text for r in language_id.keep_known(docs).collect()}
    kept = stages(spark, docs, tmp_path)[3]
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == brute(data, known)


def test_stages():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "exact", "near", "secrets", "packing"]


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, name):
    got = queries.QUERIES[name](spark, SF)
    documents = spark.read.parquet(f"{SF}/documents.parquet").count()
    assert got.select("doc_id").distinct().count() == documents
    if name in queries.ORACLE:
        assert compare(duck(SF), queries.ORACLE[name], got) is None
