"""An index of documents by id, as a Spark data source whose writes can be repeated.

``spark.dataSource.register(DocumentIndex)`` makes it the format ``document_index``. Tasks write their documents aside,
and the driver publishes what the successful tasks report, all at once: a write that fails leaves nothing, and a
write that runs again replaces its documents, because a document's id is made of its content. The target is pluggable:
``FileTarget`` keeps a folder that all executors share; a search service's bulk interface can stand behind the
same five methods.
"""

from __future__ import annotations

import importlib
import json
import os
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from reviewloom.session import ship_package

FORMAT = "document_index"
ID, BULK = "doc_key", 500
_DOCS, _COMMITS = "documents", "commits"


class FileTarget:
    """Documents as JSON lines in a shared folder; only files that a commit names are part of the index."""

    def __init__(self, path: str):
        self.path = path

    def open(self, write: str) -> str:
        """Where one task attempt of a write puts its documents."""
        folder = os.path.join(self.path, _DOCS, write)
        os.makedirs(folder, exist_ok=True)
        return os.path.join(folder, f"{uuid.uuid4().hex}.json")

    def bulk(self, place: str, documents: list[dict]) -> None:
        with open(place, "a", encoding="utf-8") as file:
            file.writelines(json.dumps(d, ensure_ascii=False) + "\n" for d in documents)
            file.flush()
            os.fsync(file.fileno())

    def publish(self, write: str, places: list[str]) -> None:
        folder = os.path.join(self.path, _COMMITS)
        os.makedirs(folder, exist_ok=True)
        number = max([int(n.split("-")[0]) for n in os.listdir(folder) if n[:1].isdigit()], default=0) + 1
        names = [os.path.relpath(p, os.path.join(self.path, _DOCS)) for p in places]
        staged = os.path.join(folder, f".{write}")
        with open(staged, "w", encoding="utf-8") as file:
            file.writelines(json.dumps({"file": n, "number": number}) + "\n" for n in names)
        os.rename(staged, os.path.join(folder, f"{number:012d}-{write}.json"))  # seen whole or not at all

    def discard(self, places: list[str]) -> None:
        for place in places:
            if os.path.exists(place):
                os.remove(place)


@dataclass
class _Written(WriterCommitMessage):
    place: str | None
    documents: int


class _Writer(DataSourceWriter):
    def __init__(self, options: dict[str, str], schema: StructType):
        self.names = schema.names
        if ID not in self.names:
            raise ValueError(f"documents need their id in {ID}")
        self.options, self.bulk_size = dict(options), int(options.get("bulk", BULK))
        self.write_id = uuid.uuid4().hex

    def _target(self):
        module, _, name = self.options.get("target", f"{__name__}:FileTarget").partition(":")
        return getattr(importlib.import_module(module), name)(self.options["path"])

    def write(self, iterator: Iterator) -> _Written:
        target, place, held, total = self._target(), None, [], 0
        for row in iterator:
            held.append(dict(zip(self.names, row)))
            total += 1
            if len(held) == self.bulk_size:
                place = place or target.open(self.write_id)
                target.bulk(place, held)
                held = []
        if held:
            place = place or target.open(self.write_id)
            target.bulk(place, held)
        return _Written(place, total)

    def commit(self, messages: list[_Written | None]) -> None:
        self._target().publish(self.write_id, [m.place for m in messages if m and m.place])

    def abort(self, messages: list[_Written | None]) -> None:
        self._target().discard([m.place for m in messages if m and m.place])


class DocumentIndex(DataSource):
    """The format ``document_index``: options ``path``, ``bulk`` (documents in a request), ``target`` (module:class)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return f"{ID} string"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return _Writer(self.options, schema)


def document_key(*columns: str) -> Column:
    """An id made of these columns' values; nulls and texts with any separator in them stay apart."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


def upsert_documents(df: DataFrame, path: str, ids: Sequence[str], **options: str) -> None:
    """Put each row into the index below ``path`` under the id that its ``ids`` columns make.

    A row replaces the document of the same id, so ``ids`` must tell the rows of ``df`` apart; of rows that they
    do not, one stays. A failed write leaves the index as it was, and can be repeated.
    """
    spark = df.sparkSession
    ship_package(spark)
    spark.dataSource.register(DocumentIndex)
    df.withColumn(ID, document_key(*ids)).write.format(FORMAT).mode("append").options(path=path, **options).save()


def read_documents(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """The index below ``path``: each document once, as the last write that holds its id left it.

    ``schema`` is that of the rows given to ``upsert_documents``. An index that nothing was written to is an error.
    """
    kind = spark.createDataFrame([], schema).schema if isinstance(schema, str) else schema
    commits = spark.read.schema("file string, number bigint").json(os.path.join(path, _COMMITS))
    stored = spark.read.schema(StructType([*kind.fields]).add(ID, "string")).option(
        "recursiveFileLookup", True).json(os.path.join(path, _DOCS))
    of_file = F.regexp_extract("_metadata.file_path", "([^/]+/[^/]+)$", 1)
    # files that no commit names are what failed attempts left
    known = stored.select("*", of_file.alias("file")).join(commits, "file")
    last = Window.partitionBy(ID).orderBy(F.desc("number"), "file")
    return known.withColumn("__place", F.row_number().over(last)).filter("__place = 1").select(*kind.names)
