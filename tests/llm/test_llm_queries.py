"""The registered queries: against their SQL on the smallest tables, and the pipeline stage by stage."""

from __future__ import annotations

import os
import re
from collections import Counter

import pytest

import __spark_entry__ as contract
import corpus_pipeline
from tandem.llm import decontaminate, secrets, simhash, toxicity
from tandem.llm.workload import LLM_ORACLES, LLM_QUERIES

duckdb = pytest.importorskip("duckdb")
SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="given tables not present")


@pytest.mark.parametrize("name", sorted(LLM_ORACLES))
def test_query_agrees_with_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "labels", "conversations"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    df, found = LLM_QUERIES[name](spark, SF), con.sql(LLM_ORACLES[name])
    order = [found.columns.index(c) for c in df.columns]
    assert Counter(map(tuple, df.collect())) == Counter(tuple(r[i] for i in order) for r in found.fetchall())


def test_one_query_for_each_operator():
    every = contract.queries()
    numbers = Counter(int(m[1]) for q in every if (m := re.match(r"op(\d+)_", q)))
    assert numbers == Counter(range(1, 14)) and "pipeline" in every
    assert set(LLM_ORACLES) <= set(contract.oracle_sql())


def test_each_stage_does_what_its_operator_says(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels, items = spark.read.parquet(f"{SF}/labels.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    ids = lambda df: {r["doc_id"] for r in df.select("doc_id").collect()}
    stages = dict(corpus_pipeline.STAGES)
    one = stages["toxicity"](spark, docs, SF).cache()
    assert ids(one) == ids(toxicity.score_documents(docs, labels).where("predicted = 0"))
    two = stages["simhash near-duplicates"](spark, one, SF).cache()
    assert ids(two) == {r["component_id"] for r in simhash.near_duplicates(one).collect()}
    three = stages["benchmark decontamination"](spark, two, SF).cache()
    assert ids(three) == ids(decontaminate.contamination(two, items).where("not contaminated"))
    four = stages["secret scans"](spark, three, SF).cache()
    assert ids(four) == ids(three) and secrets.find_secrets(four).where("spans <> ''").count() <= 1
    assert one.columns == two.columns == three.columns == four.columns == docs.columns
    assert four.where("n_chars <> length(text)").count() == 0
    assert one.count() > two.count() > three.count() > 0
    last = {r["doc_id"]: r["n_ids"] for r in stages["sentencepiece"](spark, four, SF).collect()}
    assert {r["doc_id"]: r["n_ids"] for r in corpus_pipeline.run(spark, SF).collect()} == last
    assert set(last) == ids(four)
    for df in (one, two, three, four):
        df.unpersist()


def test_stages_on_empty_and_odd_documents(spark):
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0)], "doc_id long, text string, lang string, source string, n_chars long")
    for docs, n in ((odd.where("false"), 0), (odd, 1)):
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF)
        assert docs.count() == n
