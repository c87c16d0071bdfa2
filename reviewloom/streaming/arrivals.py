"""Review files scored as they arrive."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import replace

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle, TimerValues

from reviewloom.functions.names import data_file, file_name
from reviewloom.operators.clean import RELAXED, STRICT, Profile, clean_reviews, profile_of
from reviewloom.operators.skew import spread_join
from reviewloom.operators.workset import arrival_status, pending_files
from reviewloom.plans.score import score_late_reviews, score_reviews
from reviewloom.session import ship_package
from reviewloom.sources.files import RAW_REVIEW, WITH_HEADER, list_files, read_by_header, whole_files
from reviewloom.sources.sinks import _CSV_OUT

BATCH = "batch_id"
#: Files in a batch; only their names pass through the driver.
MAX_FILES = 1000
#: What is said of a file that is asked for.
READY, PENDING, OVERDUE = "ready", "pending", "overdue"
EXPECTED, ARRIVED = "expected", "arrived"
_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_FILE = "path string, modificationTime timestamp, length bigint, content binary"


@contextmanager
def state_store(spark: SparkSession) -> Iterator[None]:
    """The state store that keyed processors need, for the queries started within; they keep the setting."""
    before = spark.conf.get(_STORE, None)
    spark.conf.set(_STORE, _ROCKS)
    try:
        yield
    finally:
        spark.conf.set(_STORE, before) if before is not None else spark.conf.unset(_STORE)


def file_stream(spark: SparkSession, landing: str, max_files: int = MAX_FILES, glob: str = "*.csv") -> DataFrame:
    """``path, source_file`` of the files that are moved into a folder; nothing of them is read.

    Spark lists no file of no bytes, which would hold nothing to read either. A large file may be moved in as a folder
    of parts, see ``whole_files``: it comes whole, in the batch of its first part, whatever batch lists the others.
    Each part counts as one of ``max_files``. Below a pattern of folders no files in parts are looked for.

    A stream of rows has one header for all files. Given this stream, ``stream_reviews`` and
    ``stream_late_reviews`` read each file of a batch by its own header.
    """
    files = (spark.readStream.format("binaryFile").schema(_FILE).option("pathGlobFilter", glob)
             .option("maxFilesPerTrigger", max_files))
    if re.search(r"[\[\]{}*?]", landing):
        return files.load(landing).select("path", file_name("_metadata.file_name").alias("source_file"))
    return whole_files(files.option("recursiveFileLookup", True).load(landing), landing)


def _rows_of(batch: DataFrame, batch_id: int, set_aside: str | None,
             wanted: DataFrame | None = None) -> DataFrame:
    """The reviews of a batch, of the ``wanted`` files only: its rows, or those of the files that it names.

    Files that cannot be read by their header go to the table ``set_aside``, with the reason, or fail the batch.
    """
    if "path" not in batch.columns:
        return batch if wanted is None else spread_join(batch, wanted, ["source_file"], "left_semi")
    files = batch if wanted is None else batch.join(wanted, "source_file", "left_semi")
    paths = [r[0] for r in files.select("path").collect()]  # ``max_files`` of them at most
    if not paths:
        return batch.sparkSession.createDataFrame(
            [], T.StructType([*RAW_REVIEW, T.StructField("source_file", T.StringType())]))
    rows, lacking = read_by_header(batch.sparkSession, paths)
    if set_aside is not None:
        lacking.write.mode("overwrite").parquet(f"{set_aside}/{BATCH}={batch_id}")
    elif (first := lacking.first()) is not None:
        raise ValueError(f"{first['source_file']}: {first['reason']}")
    return rows


def review_stream(spark: SparkSession, landing: str, max_files: int | None = None) -> DataFrame:
    """Raw reviews with their ``source_file`` from a folder that files are moved into.

    The source reads a path once, so a file must be complete when it appears.
    """
    reader = spark.readStream.schema(RAW_REVIEW).options(**WITH_HEADER)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    rows = reader.csv(landing)
    return rows.select(*RAW_REVIEW.names, file_name("_metadata.file_name").alias("source_file"))


def _start(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str,
           available_now: bool) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def stream_reviews(stream: DataFrame, sink: str, checkpoint: str, profile: Profile | str = STRICT,
                   scope: tuple[str, ...] = ("source_file",), order_by: tuple[str, ...] = (),
                   available_now: bool = False, set_aside: str | None = None) -> StreamingQuery:
    """Score each arriving file by itself and write Parquet below ``sink``.

    ``stream`` holds raw reviews (``review_stream``) or the files themselves (``file_stream``). Files whose
    header lacks a column fail the stream, or go to the table ``set_aside``: ``source_file, reason``.
    A file always lies within one micro-batch, so scoping by file needs no state between batches.
    Each batch owns the folder ``batch_id=n`` and replaces it, so a batch that is run again after
    a failure leaves no copies.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        scored = score_reviews(_rows_of(batch, batch_id, set_aside), scope, profile, order_by)
        scored.write.mode("overwrite").parquet(f"{sink}/{BATCH}={batch_id}")

    return _start(stream, write, checkpoint, available_now)


def stream_late_reviews(stream: DataFrame, sink: str, checkpoint: str,
                        pending: DataFrame | None = None, profile: Profile | str = RELAXED,
                        available_now: bool = False, landing: str | None = None,
                        status: str | None = None, set_aside: str | None = None) -> StreamingQuery:
    """Score files that were missing at first and write CSV below ``sink``.

    ``stream`` and ``set_aside`` are those of ``stream_reviews``. ``pending`` restricts the stream to those
    manifest entries: other files are not opened, or their rows go before anything is cleaned or shuffled. It is read again for each batch, so it should be a landed table
    rather than a live listing. With ``status``, each batch also leaves there, below
    ``batch_id=n``, which of the pending files the ``landing`` folder holds by then.
    """
    if status is not None and (pending is None or landing is None):
        raise ValueError("a status needs the pending files and the landing folder")

    def write(batch: DataFrame, batch_id: int) -> None:
        wanted = None
        if pending is not None:
            wanted = pending.select(data_file("filename").alias("source_file")).distinct()
        rows = _rows_of(batch, batch_id, set_aside, wanted)
        late = score_late_reviews(rows, ("source_file",), profile)
        late.write.mode("overwrite").options(header=True, **_CSV_OUT).csv(
            f"{sink}/{BATCH}={batch_id}")
        if status is not None:
            seen = list_files(batch.sparkSession, landing, in_parts=True)
            arrival_status(pending, seen).write.mode("overwrite").parquet(f"{status}/{BATCH}={batch_id}")

    return _start(stream, write, checkpoint, available_now)


class _Expectation(StatefulProcessor):
    """What is known of one file: when it is overdue, and what has been said of it last."""

    def __init__(self, patience: float):
        self.patience = patience

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.said = handle.getValueState("said", "status string")

    def _say(self, key, status: str, timer: TimerValues) -> Iterator[pd.DataFrame]:
        self.said.update((status,))
        yield pd.DataFrame({"source_file": [key[0]], "status": [status],
                            "at": [pd.Timestamp(timer.getCurrentProcessingTimeInMs(), unit="ms")]})

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        kinds = {kind for batch in rows for kind in batch["kind"]}
        before = self.said.get()[0] if self.said.exists() else None
        if before == READY:
            return
        if ARRIVED in kinds:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            # a file that nobody asked for stays unsaid until somebody does
            if EXPECTED in kinds or before is not None and before != ARRIVED:
                yield from self._say(key, READY, timerValues)
            else:
                self.said.update((ARRIVED,))
        elif before is None:
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + round(self.patience * 1000))
            yield from self._say(key, PENDING, timerValues)
        elif before == ARRIVED:
            yield from self._say(key, READY, timerValues)

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.said.exists() and self.said.get()[0] == PENDING:
            yield from self._say(key, OVERDUE, timerValues)

    def close(self) -> None:
        pass


def track_arrivals(spark: SparkSession, expected: DataFrame, landing: str, sink: str, checkpoint: str,
                   patience: float, every: str = "1 second", max_files: int = MAX_FILES) -> StreamingQuery:
    """Follow the files of a stream of manifest rows (``filename``) until each is ready or overdue.

    Below ``sink`` a row ``source_file, status, at`` tells of every change: ``pending`` when a file is asked for and
    not there, ``ready`` when it is, ``overdue`` when it has not come ``patience`` seconds after it was asked
    for. An overdue file that comes after all is ready then. Each file is a key with its own state and timer,
    kept in the checkpoint, so a restart goes on with the deadlines it had. Files that are not asked for are noted, in
    case they will be, and not told of.
    """
    ship_package(spark)
    asked = expected.select(data_file("filename").alias("source_file"), F.lit(EXPECTED).alias("kind"))
    come = file_stream(spark, landing, max_files).select("source_file", F.lit(ARRIVED).alias("kind"))
    told = asked.unionByName(come).groupBy("source_file").transformWithStateInPandas(
        _Expectation(patience), "source_file string, status string, at timestamp", "append", "ProcessingTime")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{sink}/{BATCH}={batch_id}")

    with state_store(spark):
        return (told.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
                .outputMode("append").trigger(processingTime=every).start())


def last_status(spark: SparkSession, sink: str) -> DataFrame:
    """``source_file, status, at`` as ``track_arrivals`` told it last; the later of two changes at one time."""
    rows = spark.read.schema(f"source_file string, status string, at timestamp, {BATCH} bigint").parquet(sink)
    last = F.max(F.struct(BATCH, "at", (F.col("status") != PENDING).alias("later"), "status"))
    return rows.groupBy("source_file").agg(last.alias("last")).select("source_file", "last.status", "last.at")


def await_decided(query: StreamingQuery, manifest: DataFrame, sink: str, poll: float = 1.0) -> DataFrame:
    """Wait until every file of ``manifest`` is ready or overdue, stop the query and return the last status.

    The wait ends, since a file that does not come is overdue at its deadline. Between two looks nothing runs.
    """
    spark = manifest.sparkSession
    while query.isActive:
        seen = len(query.recentProgress) and query.lastProgress["batchId"] > 0
        if seen:
            decided = last_status(spark, sink).filter(F.col("status") != PENDING)
            if pending_files(manifest, decided.withColumnRenamed("source_file", "filename")).isEmpty():
                query.stop()
                break
        query.awaitTermination(poll)
    if query.exception() is not None:
        raise query.exception()
    return last_status(spark, sink)


def dedup_arrivals(stream: DataFrame, seen_at: str, within: str, scope: Sequence[str] = (),
                   text: str = "comments") -> DataFrame:
    """The first row of each text within a scope that may span files, batches and restarts.

    A text is known for ``within`` after the time ``seen_at`` of its first row, for example of the file it came in;
    copies that come later count as new, so that the state stays bounded. The state holds the scope and a digest of
    the text. Which copy within one batch stays is left open; null texts are one text.
    """
    marked = stream.withColumn("__digest", F.sha2(F.coalesce(text, F.lit("")), 256)).withColumn(
        "__none", F.col(text).isNull())
    return (marked.withWatermark(seen_at, within)
            .dropDuplicatesWithinWatermark([*scope, "__digest", "__none"]).drop("__digest", "__none"))


def stream_distinct_reviews(stream: DataFrame, sink: str, checkpoint: str, seen_at: str, within: str,
                            profile: Profile | str = STRICT, scope: Sequence[str] = (),
                            available_now: bool = False) -> StreamingQuery:
    """Clean reviews as they arrive, each text once per scope, whatever file or batch its copies come in.

    ``stream`` holds raw reviews and the time ``seen_at``; see ``dedup_arrivals`` for ``within``. Below ``sink``
    each batch owns a folder.
    """
    rules = replace(profile_of(profile), dedup=False)
    distinct = dedup_arrivals(clean_reviews(stream, rules), seen_at, within, scope)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{sink}/{BATCH}={batch_id}")

    with state_store(stream.sparkSession):
        return _start(distinct, write, checkpoint, available_now)
