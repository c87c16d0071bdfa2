"""Summaries from an outside text function, and joining them back."""

from __future__ import annotations

from collections.abc import Awaitable, Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.functions.review import parse_summary
from reviewloom.operators.skew import spread_join
from reviewloom.session import fresh_path

#: Fixed value: calls that one process has open at a time.
IN_FLIGHT = 10


def call_text_function(df: DataFrame, fn: Callable[[str], str | None] | Callable[[str], Awaitable[str | None]],
                       request: str, keys: Sequence[str], retries: int = 3, backoff: float = 1.0,
                       max_parallel: int | None = None, seed: int | None = None,
                       on_error: str = "null", in_flight: int | None = None) -> DataFrame:
    """One call of ``fn`` per row; adds ``response, error, attempts`` to the keys.

    A failing call is tried ``retries`` times with waits of ``backoff * (2^k + U(0,1))`` seconds.
    When all fail, the row carries the error and the job goes on, or ends with ``on_error="fail"``.

    ``fn`` may be a plain function, which is called in threads, or a coroutine function, whose calls share one event
    loop. A task has at most ``in_flight`` calls open at a time, waits between attempts included, and gives the
    answers in the order of its rows; ``IN_FLIGHT`` unless said otherwise. ``max_parallel`` bounds the calls of the
    whole job: as many tasks as fit, which by itself means tasks with one call each. Spark may run a task again
    after losing an executor, so ``fn`` must bear being asked twice.
    """
    if retries < 1:
        raise ValueError("retries must be at least 1")
    if in_flight is None:
        in_flight = IN_FLIGHT if max_parallel is None else 1
    if in_flight < 1 or max_parallel is not None and max_parallel < in_flight:
        raise ValueError("in_flight must be at least 1, and max_parallel at least that")
    rows = df.select(*keys, F.col(request).alias("__request"))
    if max_parallel is not None:
        rows = rows.repartition(max_parallel // in_flight, *keys)
    schema = rows.select(*keys, F.lit("").alias("response"), F.lit("").alias("error"),
                         F.lit(0).alias("attempts")).schema
    names, answers_of = list(keys), _caller(fn, retries, backoff, seed, on_error == "fail")

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = batch[names].reset_index(drop=True)
            out[["response", "error", "attempts"]] = pd.DataFrame(
                answers_of(batch["__request"].tolist(), in_flight),
                columns=["response", "error", "attempts"], index=out.index)
            yield out

    return rows.mapInPandas(ask, _nullable(schema))


def _caller(fn: Callable, retries: int, backoff: float, seed: int | None, fail: bool):
    """``answers_of(requests, limit)``: a response, error and number of attempts for each request, in their order.

    It is made of functions that travel with the task, so the workers need nothing of this package.
    """
    def answers_of(requests: list, limit: int) -> list[tuple[str | None, str | None, int]]:
        import asyncio
        import inspect
        import random
        import time
        from concurrent.futures import ThreadPoolExecutor

        def wait(request, attempt: int) -> float:
            jitter = random.Random() if seed is None else random.Random(f"{seed} {attempt} {request}")
            return backoff * (2 ** (attempt - 1) + jitter.uniform(0, 1))

        def outcome(response, error, attempt: int):
            if response is None and error is None:
                error = "no response"
            return response, error, attempt

        def last(answer):
            if fail and answer[0] is None:
                raise RuntimeError(answer[1])
            return answer

        def in_thread(request):
            for attempt in range(1, retries + 1):
                try:
                    answer = outcome(fn(request), None, attempt)
                except Exception as e:
                    answer = outcome(None, f"{type(e).__name__}: {e}", attempt)
                if answer[0] is not None:
                    break
                if attempt < retries:
                    time.sleep(wait(request, attempt))
            return last(answer)

        async def in_loop(request, places: asyncio.Semaphore):
            async with places:
                for attempt in range(1, retries + 1):
                    try:
                        answer = outcome(await fn(request), None, attempt)
                    except Exception as e:
                        answer = outcome(None, f"{type(e).__name__}: {e}", attempt)
                    if answer[0] is not None:
                        break
                    if attempt < retries:
                        await asyncio.sleep(wait(request, attempt))
                return last(answer)

        async def all_in_loop():
            places = asyncio.Semaphore(limit)
            async with asyncio.TaskGroup() as group:  # the first failure ends the others
                calls = [group.create_task(in_loop(r, places)) for r in requests]
            return [c.result() for c in calls]

        if inspect.iscoroutinefunction(fn):
            try:
                return asyncio.run(all_in_loop())
            except ExceptionGroup as e:
                raise e.exceptions[0]
        with ThreadPoolExecutor(limit) as pool:
            calls = [pool.submit(in_thread, r) for r in requests]
            try:
                return [c.result() for c in calls]
            except BaseException:
                pool.shutdown(wait=False, cancel_futures=True)
                raise
    return answers_of


def _nullable(schema):
    from pyspark.sql import types as T
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])


def summarize(df: DataFrame, fn: Callable[[str], str], request: str = "payload",
              keys: Sequence[str] = ("product_name",), on_error: str = "null",
              **call_options) -> DataFrame:
    """Summaries per payload: keys, ``summary``, ``echoed_name``, ``error``, ``attempts``.

    The keys are our own, so a service that changes the product name loses nothing; the name it
    echoed is reported beside them. ``on_error="fail"`` fails the job on the first bad answer,
    ``"null"`` keeps the row with a null summary and the error.
    """
    if on_error not in ("null", "fail"):
        raise ValueError(f"on_error must be 'null' or 'fail', not {on_error!r}")
    answered = call_text_function(df, fn, request, keys, on_error=on_error, **call_options)
    return read_answers(answered, keys, on_error)


def read_answers(answered: DataFrame, keys: Sequence[str], on_error: str = "null") -> DataFrame:
    """Summaries from the answers of ``call_text_function``, as ``summarize`` gives them."""
    parsed = answered.withColumn("__parsed", parse_summary("response"))
    error = F.coalesce(F.col("error"),
                       F.when(~F.col("__parsed.is_valid"), F.lit("invalid response")))
    found = parsed.select(*keys, F.col("__parsed.summary").alias("summary"),
                          F.col("__parsed.product_name").alias("echoed_name"),
                          error.alias("error"), "attempts")
    if on_error == "fail":
        # a filter, which no choice of columns can prune
        found = found.filter(F.when(F.col("error").isNull(), True).otherwise(
            F.raise_error(F.col("error")).cast("boolean")))
    return found


def answers_in_slices(df: DataFrame, fn: Callable[[str], str], request: str, path: str,
                      calls_per_slice: int = 10_000, max_parallel: int | None = None,
                      **call_options) -> DataFrame:
    """Answers to all distinct requests, landed below ``path`` slice by slice.

    ``request_hash, response, error, attempts``, one row per distinct request. A job that died goes on
    where it stopped when it is given the same ``path``: requests answered there without an error are
    not asked again. A lost task repeats its own calls of one slice at most. A slice has about
    ``calls_per_slice`` requests, and each request is read once.
    """
    spark = df.sparkSession
    kind = "request_hash string, response string, error string, attempts int, slice int"
    asked = df.select(F.col(request).alias("request")).filter("request IS NOT NULL").distinct().withColumn(
        "request_hash", F.sha2("request", 256))
    spark.createDataFrame([], kind).write.mode("append").parquet(path)
    known = spark.read.schema(kind).parquet(path).filter("error IS NULL").select("request_hash")
    # each task deals its rows to the slices in turn, and a slice is a folder that is read once
    tasks = spark.sparkContext.defaultParallelism
    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    per_task = max(1, calls_per_slice // tasks)
    todo = fresh_path(spark, "requests")
    asked.join(known, "request_hash", "left_anti").repartition(tasks, "request_hash").withColumn(
        "slice", F.call_function("div", place, F.lit(per_task)).cast("int")).write.partitionBy("slice").parquet(todo)
    requests = spark.read.schema("request string, request_hash string, slice int").parquet(todo)
    last = requests.agg(F.max("slice")).first()[0]
    for i in range(0 if last is None else last + 1):
        answered = call_text_function(requests.filter(F.col("slice") == i), fn, "request", ["request_hash"],
                                      max_parallel=max_parallel, **call_options)
        answered.withColumn("slice", F.lit(i)).write.mode("append").parquet(path)
    every = spark.read.schema(kind).parquet(path)
    # an earlier failure gives way to a later answer
    best = every.groupBy("request_hash").agg(F.min(F.struct(
        F.col("error").isNotNull().alias("failed"), "attempts", "response", "error")).alias("a"))
    return best.select("request_hash", "a.response", "a.error", "a.attempts")


def summarize_in_slices(df: DataFrame, fn: Callable[[str], str], request: str, keys: Sequence[str],
                        path: str, on_error: str = "null", **call_options) -> DataFrame:
    """``summarize`` with calls that can be resumed; see ``answers_in_slices``."""
    if on_error not in ("null", "fail"):
        raise ValueError(f"on_error must be 'null' or 'fail', not {on_error!r}")
    answers = answers_in_slices(df, fn, request, path, on_error=on_error, **call_options)
    rows = df.select(*keys, F.sha2(request, 256).alias("request_hash"))
    return read_answers(rows.join(answers, "request_hash"), keys, on_error)


def attach_summary(df: DataFrame, summaries: DataFrame, scope: Sequence[str] = (),
                   rows_per_split: int | None = None) -> DataFrame:
    """Rows with their product's summary, null where there is none.

    Summaries given in parts, by ``part``, meet rows that carry theirs.
    """
    keys = [*scope, "name", *(["part"] if "part" in summaries.columns else [])]
    if "part" in keys and "part" not in df.columns:
        raise ValueError("summaries in parts need rows with their part; combine them first")
    return spread_join(df, summaries.select(*keys, "summary"), keys, "left",
                       rows_per_split=rows_per_split)
