"""Registered queries against their SQL, and the pipeline stage by stage."""

import duckdb
import pytest
from conftest_llm import brute_base

import __spark_entry__ as E
import corpus_pipeline as C
from invdex.llm import decontaminate, simhash, toxicity
from invdex.llm.common import table, written

SF = "/root/testdata/sf0.001"


def key(rows):
    return sorted(rows, key=repr)


@pytest.mark.parametrize("name", ["op1_decontaminate", "op3_mixing", "op4_chat", "op9_warc"])
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = E.queries()[name](spark, SF)
    res = con.execute(E.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(df.columns)
    assert key(tuple(r[c] for c in cols) for r in df.collect()) == key(res.fetchall())


def test_fourteen_queries():
    names = [n for n in E.queries() if n.startswith("op") or n == "pipeline"]
    assert len(names) == 14


def test_stages(spark):
    docs = table(spark, SF, "documents")
    columns, before = docs.columns, docs
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    for name, stage in C.STAGES:
        after = written(stage(spark, before, SF), "test-stage")
        if name == "toxicity":
            model = toxicity.fit(before, table(spark, SF, "labels"))
            assert ids(after) == ids(toxicity.score(before, *model).filter("score < 0.5"))
        elif name == "near_duplicates":
            assert ids(after) == sorted({r.component_id for r in simhash.near_duplicates(before).collect()})
        elif name == "decontamination":
            judged = decontaminate.judge(decontaminate.scan(before, table(spark, SF, "benchmark")))
            assert ids(after) == ids(judged.filter("not contaminated")) and len(ids(after)) < before.count()
        elif name == "personal_data":
            assert ids(after) == ids(before)
            assert not any(brute_base(r.text) for r in after.collect())
        else:
            taken = after.groupBy("source").agg({"size": "sum", "target": "max", "repetition": "max"}).collect()
            assert all(r["max(repetition)"] <= 3 for r in taken)
            assert set(columns) <= set(after.columns)
        if name != "mixing":
            assert after.columns == columns
        before = after


def test_empty_and_odd_tables(spark, edge, nothing, tmp_path):
    root = str(tmp_path)
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{root}/benchmark.parquet")
    for docs in (nothing, edge):
        for name, stage in C.STAGES[:-1]:
            out = stage(spark, docs, root)
            assert out.columns == docs.columns
            docs = written(out, "test-odd")
        C.STAGES[-1][1](spark, docs, root).count()
