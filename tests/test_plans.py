"""What the plans must and must not hold."""

import os
import re

import pytest

from checks.queries import QUERIES
from reviewloom.operators import skew

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data here")

PYTHON = r"PythonUDF|BatchEvalPython|ArrowEvalPython|MapInPandas|FlatMapGroups"
# the caller's own function, and accents, which only Python composes
CALLS_OUT = {"summarize", "compose_accents"}
# these write files when they are built, so their own plan is only the read-back
RUN_WHEN_BUILT = {n for n in QUERIES if n.startswith(("read_", "write_", "land_", "enrich_", "stream_", "index_",
                                                    "follow_", "ingest_"))}


def plan_of(spark, name):
    df = QUERIES[name](spark, SF_DIR)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - RUN_WHEN_BUILT - CALLS_OUT))
def test_plan_stays_in_the_jvm_and_joins_on_keys(spark, name):
    plan = plan_of(spark, name)
    assert not re.search(PYTHON, plan)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "SinglePartition" not in plan or name in {"request_stats", "preview"}


def final_plan(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("Initial Plan")[0]


def test_flagship_scans_and_shuffles_the_reviews_once(spark):
    plan = final_plan(QUERIES["score_reviews_per_file"](spark, SF_DIR))
    assert plan.count("FileScan parquet") == 1 and "ReusedExchange" in plan
    assert "Window" not in plan


def test_with_hot_products_too_there_is_one_scan(spark, monkeypatch):
    monkeypatch.setattr(skew, "ROWS_PER_SPLIT", 1)
    monkeypatch.setattr(skew, "BROADCAST_FROM", 1)  # as with a million rows per split
    plan = final_plan(QUERIES["score_reviews_per_file"](spark, SF_DIR))
    assert plan.count("FileScan parquet") == 1 and "__splits" in plan
    # without deduplication the reviews are read twice, for the averages and for the rows
    plan = final_plan(QUERIES["score_late_reviews_per_file"](spark, SF_DIR))
    assert plan.count("FileScan parquet") == 2


def test_scan_reads_only_the_needed_columns(spark):
    plan = plan_of(spark, "score_reviews_per_file")
    schemas = set(re.findall(r"ReadSchema: struct<([^>]*)>", plan))
    assert schemas == {"doc_id:bigint,text:string,lang:string,source:string"}
    assert "ReadSchema: struct<event_type:string,value:double>" in plan_of(spark, "request_stats")


def test_cleaning_runs_after_the_filters_only(spark):
    plan = plan_of(spark, "clean_reviews_relaxed")
    conditions = "".join(line for line in plan.splitlines() if "Filter" in line)
    assert "RLIKE" in conditions and "regexp_replace" not in conditions


def test_null_tests_reach_the_scan(spark):
    from reviewloom.operators.clean import clean_reviews
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").selectExpr(
        "text as comment", "source as name", "cast(doc_id as string) as rating_star")
    plan = clean_reviews(docs, "relaxed")._jdf.queryExecution().executedPlan().toString()
    assert "IsNotNull(text)" in plan and "IsNotNull(source)" in plan


def test_copies_are_dropped_before_the_shuffle(spark):
    plan = plan_of(spark, "dedup_comments")
    assert "partial_min" in plan and "Window" not in plan
