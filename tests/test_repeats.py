"""Writes that fail and are repeated."""

import json
import os

import pytest
from pyspark.sql import functions as F

from reviewloom.session import ARROW_ROWS
from reviewloom.sources.documents import FileTarget, document_key, read_documents, upsert_documents
from reviewloom.sources.files import read_reviews
from reviewloom.sources.sinks import append_reviews

REVIEW = "name string, comments string, rating double"


def _reviews(spark, rows):
    return spark.createDataFrame(rows, REVIEW).repartition(3)


def _failing(df, marker, name):
    """``df``, whose task with this name's row fails after the others have written, until the marker exists."""
    def check(batches):
        import os
        import time
        for batch in batches:
            yield batch
            if name in batch["name"].tolist() and not os.path.exists(marker):
                time.sleep(1.0)
                raise RuntimeError("lost")
    return df.mapInPandas(check, df.schema)


def test_a_failed_and_repeated_write_leaves_each_document_once(spark, tmp_path):
    path, marker = str(tmp_path / "index"), str(tmp_path / "mended")
    first = [(f"p{i}", f"text {i}", float(i)) for i in range(20)]
    upsert_documents(_reviews(spark, first), path, ["name"], bulk="2")
    more = [(f"p{i}", f"new text {i}", None) for i in range(15, 30)]
    with pytest.raises(Exception, match="lost"):
        upsert_documents(_failing(_reviews(spark, more), marker, "p22"), path, ["name"], bulk="2")
    found = read_documents(spark, path, REVIEW)
    assert sorted(map(tuple, found.collect())) == sorted(first), "a failed write leaves the index as it was"
    open(marker, "w").close()
    for _ in range(2):
        upsert_documents(_failing(_reviews(spark, more), marker, "p22"), path, ["name"], bulk="2")
        got = sorted(tuple(r) for r in read_documents(spark, path, REVIEW).collect())
        assert got == sorted(first[:15] + more)


def test_a_task_that_runs_again_leaves_its_documents_once(spark, tmp_path):
    """The first attempt has written documents when it is lost."""
    path, marker = str(tmp_path / "index"), str(tmp_path / "lost")

    def lose_once(batches):
        import os
        import time
        for batch in batches:
            yield batch
        if not os.path.exists(marker):
            time.sleep(2.0)
            open(marker, "w").close()
            raise RuntimeError("lost")
    rows = [(f"p{i}", "x", 1.0) for i in range(1000)]
    df = spark.createDataFrame(rows, REVIEW).coalesce(1)
    before = spark.conf.get(ARROW_ROWS)
    spark.conf.set(ARROW_ROWS, "10")  # so that rows reach the writer before the others are read
    try:
        upsert_documents(df.mapInPandas(lose_once, df.schema), path, ["name"], bulk="1")
    finally:
        spark.conf.set(ARROW_ROWS, before)
    assert os.path.exists(marker)
    assert sorted(tuple(r) for r in read_documents(spark, path, REVIEW).collect()) == sorted(rows)
    files = [f for _, _, names in os.walk(os.path.join(path, "documents")) for f in names]
    assert len(files) == 2, "what the lost attempt left is there, and not read"


def test_a_driver_that_dies_before_the_commit(tmp_path):
    target = FileTarget(str(tmp_path))
    place = target.open("w1")
    target.bulk(place, [{"doc_key": "1"}])
    assert not (tmp_path / "commits").exists()
    target.publish("w1", [place])
    target.publish("w2", [])
    assert [n.split("-")[0] for n in sorted(os.listdir(tmp_path / "commits"))] == ["000000000001", "000000000002"]
    line = json.loads((tmp_path / "commits" / "000000000001-w1.json").read_text())
    assert line["file"].startswith("w1/") and line["number"] == 1


def test_ids_tell_values_apart(spark):
    rows = spark.createDataFrame([("a", None), (None, "a"), ("", "a"), ('a","b', ""), ("a", 'b",""'), ("a", "b")],
                                 "x string, y string")
    assert rows.select(document_key("x", "y").alias("k")).distinct().count() == 6


def test_no_rows_and_empty_commits(spark, tmp_path):
    path = str(tmp_path / "index")
    upsert_documents(_reviews(spark, [("p", "x", 1.0)]), path, ["name"])
    upsert_documents(_reviews(spark, [("p", "x", 1.0)]).filter(F.lit(False)), path, ["name"])
    assert read_documents(spark, path, REVIEW).count() == 1


def test_a_repeated_append_adds_nothing(spark, tmp_path):
    path, marker = str(tmp_path / "landing"), str(tmp_path / "mended")
    raw = "rating_star string, comment string, name string"

    def batch(rows):
        return spark.createDataFrame(rows, raw).repartition(3)
    first, second = [("5", "a, b", "p")], [(str(i % 5), f"text {i}", f"q{i}") for i in range(12)]
    assert append_reviews(batch(first), path, "day-1")
    with pytest.raises(Exception, match="lost"):
        append_reviews(_failing(batch(second), marker, "q7"), path, "day-2")
    open(marker, "w").close()
    assert append_reviews(_failing(batch(second), marker, "q7"), path, "day-2")
    assert not append_reviews(batch(second), path, "day-2") and not append_reviews(batch(first), path, "day-1")
    got = sorted((r.rating_star, r.comment, r.name) for r in read_reviews(spark, path).collect())
    assert got == sorted(first + second)
    with pytest.raises(ValueError):
        append_reviews(batch(first), path, "../elsewhere")
