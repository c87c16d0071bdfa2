"""Rating pages that land one by one, put together into files of whole pages."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle, TimerValues

from reviewloom.operators.workset import MAX_REVIEWS
from reviewloom.session import ship_package
from reviewloom.sources.ratings import landed_reviews, page_size
from reviewloom.streaming.arrivals import BATCH, state_store

PRODUCT = ("itemid", "shopid")


class _Product(StatefulProcessor):
    """How far a product's pages have come: the next page, the ratings so far, and pages ahead of their turn."""

    def __init__(self, keys: Sequence[str], max_reviews: int):
        self.keys, self.max_reviews = list(keys), max_reviews

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.progress = handle.getValueState("progress", "next bigint, kept bigint, done boolean")
        self.waiting = handle.getMapState("waiting", "page_no bigint", "n bigint, page string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        following, kept, done = self.progress.get() if self.progress.exists() else (0, 0, False)
        if done:
            return
        for batch in rows:
            for number, n, page in zip(batch["page_no"], batch["n"], batch["page"]):
                # of a page that comes twice the first one counts
                if number >= following and not self.waiting.containsKey((int(number),)):
                    self.waiting.updateValue((int(number),), (int(n), page))
        out = []
        while not done and self.waiting.containsKey((following,)):
            n, page = self.waiting.getValue((following,))
            self.waiting.removeKey((following,))
            if n:
                out.append((following, page, False))
                kept += n
            following += 1
            done = not n or kept >= self.max_reviews
        if done:
            out.append((None, None, True))
            self.waiting.clear()
        self.progress.update((following, kept, done))
        if out:
            found = pd.DataFrame(out, columns=["page_no", "page", "complete"]).astype({"page_no": "Int64"})
            for i, name in enumerate(self.keys):
                found.insert(i, name, [key[i]] * len(out))
            yield found

    def close(self) -> None:
        pass


def whole_pages(pages: DataFrame, json_col: str = "page", keys: Sequence[str] = PRODUCT, page_no: str = "page_no",
                max_reviews: int = MAX_REVIEWS) -> DataFrame:
    """``keys, page_no, page, complete``: a stream's pages in their order, and one row when a product is complete.

    Pages count from 0. A product ends with its first page without ratings, or with the page that brings it
    to ``max_reviews`` ratings: the limit is asked for before each page, so pages stay whole. Pages ahead of their
    turn wait in the product's state, pages after the end and pages that come again are left out. Nothing
    else of a product is kept, so its state does not grow with its reviews. The complete row has no page.
    """
    ship_package(pages.sparkSession)
    rows = pages.select(*keys, F.col(page_no).cast("bigint").alias("page_no"), page_size(json_col).alias("n"),
                        F.col(json_col).alias("page"))
    schema = T.StructType([rows.schema[k] for k in keys]).add("page_no", "long").add("page", "string").add(
        "complete", "boolean")
    return rows.groupBy(*keys).transformWithStateInPandas(_Product(keys, max_reviews), schema, "append", "None")


def ingest_page_stream(pages: DataFrame, landed: str, manifest: str, checkpoint: str, json_col: str = "page",
                       keys: Sequence[str] = PRODUCT, page_no: str = "page_no", max_reviews: int = MAX_REVIEWS,
                       available_now: bool = False) -> StreamingQuery:
    """Land the reviews of a stream of rating pages, and list a product's file once it is complete.

    Reviews go below ``landed`` as ``source_file`` (the keys, joined by ``_``), ``page_no, page_row, rating_star,
    comment, name``; ``manifest`` lists the complete files in ``filename``. Each batch owns a folder of both
    and replaces it when it runs again. Readers take the files that are listed.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        name = F.concat(F.concat_ws("_", *keys), F.lit(".csv"))
        kept = batch.persist()  # the state was worked out once for both
        try:
            reviews = landed_reviews(kept.filter(~F.col("complete")).select(
                name.alias("source_file"), "page_no", "page"), "page")
            reviews.write.mode("overwrite").parquet(f"{landed}/{BATCH}={batch_id}")
            kept.filter("complete").select(name.alias("filename")).write.mode("overwrite").parquet(
                f"{manifest}/{BATCH}={batch_id}")
        finally:
            kept.unpersist()

    with state_store(pages.sparkSession):
        writer = whole_pages(pages, json_col, keys, page_no, max_reviews).writeStream.foreachBatch(write).option(
            "checkpointLocation", checkpoint).outputMode("append")
        return (writer.trigger(availableNow=True) if available_now else writer).start()
