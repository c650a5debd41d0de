import os

import __spark_entry__ as entry
import corpus_pipeline
import duckdb
import pytest
from conftest_paths import SF_SMALL
from corpus_fixture import CLASH, frame, labels
from eventide.llm.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "embeddings", "labels"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, t)}.parquet')")
    return c


def test_one_query_for_each_operator():
    names = entry.queries()
    for n in range(1, 11):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names and set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    res = con.execute(ORACLES[name])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(df.columns)
    norm = lambda v: float(f"{v:.12g}") if isinstance(v, float) else v
    got = sorted((tuple(norm(x) for x in r) for r in df.select(*cols).collect()), key=repr)
    assert got == sorted((tuple(norm(x) for x in r) for r in res.fetchall()), key=repr)


def test_stages_take_effect(spark):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "line_dedup", "simhash", "mixing", "packing"]
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, counts = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_SMALL)
        if name != "packing":
            assert docs.columns == columns
        docs = corpus_pipeline.materialise(docs, "test-stage")
        counts.append(docs.count())
    lab = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    good = lab.where("quality = 1").count()
    assert counts[0] >= good and counts[1] == counts[0] and counts[2] < counts[1]
    run = corpus_pipeline.run(spark, SF_SMALL)
    assert run.columns == docs.columns and run.count() == counts[-1]


def test_stages_on_odd_rows(spark, tmp_path):
    labels(spark, [(1, 1, 0), (2, 1, 0), (5, 1, 0), (0, 1, 0)]).write.parquet(str(tmp_path / "labels.parquet"))
    for data in (None, []):
        docs = frame(spark, data, clash=True)
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, str(tmp_path))
            assert name == "packing" or out.columns == docs.columns
            assert (out.count() > 0) == (data is None)
            if name != "packing":
                assert data == [] or out.select(*CLASH).distinct().count() == 1
                docs = corpus_pipeline.materialise(out, "test-odd")
