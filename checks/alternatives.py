"""Times the chosen forms against the obvious other ones; run as ``python -m checks.alternatives``."""

from __future__ import annotations

import os
import statistics
import time

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from checks import views as v
from reviewloom.functions import text
from reviewloom.operators.clean import STRICT, clean_reviews, dedup_comments, require_columns
from reviewloom.operators.rating import average_rating, with_product_rating
from reviewloom.plans.score import score_reviews
from reviewloom.session import build_session


def _run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def _median(action, runs: int = 3) -> float:
    taken = []
    for run in range(runs + 1):
        start = time.perf_counter()
        action()
        if run:
            taken.append(time.perf_counter() - start)
    return round(statistics.median(taken), 2)


def _keep(df: DataFrame) -> DataFrame:
    """The strict rules asked of the cleaned text."""
    return df.filter((F.length("comments") > 0) & (F.size(F.split("comments", " ")) >= 10)
                     & (F.length("comments") <= 3000))


def _composed(raw: DataFrame) -> DataFrame:
    cleaned = text.blank_if_long_token(text.clean_text("comment"))
    return _keep(require_columns(raw).withColumn("comments", cleaned))


def _python_udf(raw: DataFrame) -> DataFrame:
    @F.udf("string")
    def clean(comment):
        import re
        words = re.sub(r"[^\w\s]|_", " ", comment).split()
        return "" if any(len(w) > 6 for w in words) else " ".join(words)

    return _keep(require_columns(raw).withColumn("comments", clean("comment")))


def _per_file(spark: SparkSession, sf_dir: str) -> None:
    """One file after the other, each cleaned, deduplicated, averaged and joined back, with the
    three actions a summary needs (first product, its payload, the result)."""
    raw = v.reviews_raw(spark, sf_dir)
    for scope in [r.scope for r in raw.select("scope").distinct().collect()]:
        kept = _composed(raw.filter(F.col("scope") == scope)).withColumn(
            "rating_star", F.col("rating_star").try_cast("double")).dropDuplicates(["comments"])
        rated = kept.join(kept.groupBy("name").agg(F.avg("rating_star").alias("rating")), "name")
        out = rated.select("name", "rating", "comments")
        first = out.select("name").first().name
        out.filter(F.col("name") == first).groupBy("name").agg(
            F.collect_list("comments")).toJSON().collect()
        _run(out)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = build_session("alternatives", "local[8]", shuffle_partitions=8,
                          **{"spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    raw = v.reviews_raw(spark, sf_dir)
    rows = v.reviews(spark, sf_dir).withColumnRenamed("comment", "comments")
    by_text = Window.partitionBy("scope", "comments").orderBy("row_id")
    by_name = Window.partitionBy("scope", "name")
    averages = average_rating(rows, ["scope"])
    forms = {
        "clean: rules on raw text (chosen)": lambda: _run(clean_reviews(raw, STRICT).drop("pos")),
        "clean: rules on cleaned text": lambda: _run(
            dedup_comments(_composed(raw).drop("comment"))),
        "clean: Python UDF": lambda: _run(dedup_comments(_python_udf(raw).drop("comment"))),
        "dedup: min of struct (chosen)": lambda: _run(dedup_comments(rows, ["scope"], ["row_id"])),
        "dedup: row_number": lambda: _run(
            rows.withColumn("n", F.row_number().over(by_text)).filter("n = 1")),
        "dedup: dropDuplicates (arbitrary row)": lambda: _run(
            rows.dropDuplicates(["scope", "comments"])),
        "rating: spread join (chosen)": lambda: _run(with_product_rating(rows, ["scope"])),
        "rating: plain join": lambda: _run(rows.join(averages, ["scope", "name"])),
        "rating: window": lambda: _run(rows.withColumn("rating", F.avg("rating_star").over(by_name))),
        "job: all files in one plan (chosen)": lambda: _run(
            score_reviews(raw, ["scope"], order_by=["row_id"])),
        "job: file after file, three actions each": lambda: _per_file(spark, sf_dir),
    }
    for name, action in forms.items():
        print(f"{_median(action):8.2f}  {name}", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
