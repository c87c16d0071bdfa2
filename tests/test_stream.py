import json
import os
import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from checks import queries
from reviewloom.plans.job import follow_pending_files, index_ready_files, ingest_pages
from reviewloom.operators.workset import cap_pages
from reviewloom.sources.files import read_manifest, read_reviews
from reviewloom.sources.ratings import page_size
from reviewloom.streaming.arrivals import (await_decided, file_stream, last_status, review_stream,
                                           stream_distinct_reviews, stream_late_reviews, stream_reviews,
                                           track_arrivals)
from reviewloom.streaming.pages import ingest_page_stream
from tests.test_enrich import echo
from tests.test_files import write_reviews

TEN = "một hai ba bốn năm sáu bảy tám chín mười"


def drop_in(landing, name, rows):
    """Files appear whole: written elsewhere, then moved in."""
    staged = landing.parent / f"staged-{name}"
    write_reviews(staged, rows)
    os.rename(staged, landing / name)


@pytest.fixture
def landing(tmp_path):
    path = tmp_path / "landing"
    path.mkdir()
    return path


def test_two_waves_and_a_restart(spark, tmp_path, landing):
    sink, progress = str(tmp_path / "sink"), str(tmp_path / "progress")

    def run():
        stream = review_stream(spark, str(landing), max_files=1)
        stream_reviews(stream, sink, progress, available_now=True).awaitTermination()
        return sorted((r.source_file, r.name, r.rating, r.comments)
                      for r in spark.read.parquet(sink).collect())

    drop_in(landing, "1.csv", [("5", TEN, "p"), ("3", TEN + " x", "p"), ("1", TEN, "q")])
    drop_in(landing, "2.csv", [("2", TEN, "p")])
    first = [("1.csv", "p", 4.0, TEN), ("1.csv", "p", 4.0, TEN + " x"), ("2.csv", "p", 2.0, TEN)]
    assert run() == first
    drop_in(landing, "3.csv", [("1", TEN, "z"), ("1", "short", "z")])
    assert run() == first + [("3.csv", "z", 1.0, TEN)]
    assert run() == first + [("3.csv", "z", 1.0, TEN)]


def test_a_batch_that_runs_again_replaces_itself(spark, tmp_path, landing):
    sink, progress = tmp_path / "sink", tmp_path / "progress"
    drop_in(landing, "1.csv", [("5", TEN, "p")])

    def run():
        stream_reviews(review_stream(spark, str(landing)), str(sink), str(progress),
                       available_now=True).awaitTermination()
        return spark.read.parquet(str(sink)).count()

    assert run() == 1
    # as if the job had died after writing and before noting that the batch was done
    os.rename(progress / "commits" / "0", tmp_path / "gone")
    crc = progress / "commits" / ".0.crc"
    if crc.exists():
        os.rename(crc, tmp_path / "gone.crc")
    assert run() == 1


def test_late_files_use_the_looser_rules(spark, tmp_path, landing):
    drop_in(landing, "1_2.csv", [("5", "ngon", "p"), ("4", "ngon", "p"), ("4", "toolongtoken", "p")])
    drop_in(landing, "9_9.csv", [("1", "not asked for", "p")])
    pending = spark.createDataFrame([("1_2",), ("never",)], "filename string")
    sink = str(tmp_path / "late")
    stream_late_reviews(review_stream(spark, str(landing)), sink, str(tmp_path / "progress"),
                        pending, available_now=True).awaitTermination()
    got = spark.read.csv(sink, header=True)
    assert sorted((r.source_file, r.name, r.average_rating, r.cleaned_comment)
                  for r in got.collect()) == [("1_2.csv", "p", "4.5", "ngon")] * 2


def test_whole_job(spark, tmp_path, landing):
    (tmp_path / "list.csv").write_text("1_2\nmissing\n3_4.csv\nnever\n1_2.csv\n")
    drop_in(landing, "1_2.csv", [("5", TEN + " a", "p"), ("4", TEN + " b", "p"), ("1", TEN, "q")])
    drop_in(landing, "3_4.csv", [("n/a", TEN, "r"), ("3", TEN + ' "c"', "r")])
    drop_in(landing, "0_0.csv", [("5", TEN, "not in the manifest")])
    manifest = read_manifest(spark, str(tmp_path / "list.csv"), has_header=False)
    index = str(tmp_path / "index")

    pending = index_ready_files(spark, manifest, str(landing), echo("good"), index)

    assert sorted(r.filename for r in pending.collect()) == ["missing", "never"]
    got = {(r.index_name, r.source_file, r.name, r.rating, r.summary)
           for r in spark.read.parquet(index).collect()}
    assert got == {("comment_index_76", "1_2.csv", "p", 4.5, "good"),
                   ("comment_index_76", "1_2.csv", "q", 1.0, None),
                   ("comment_index_80", "1_2.csv", "p", 4.5, "good"),
                   ("comment_index_80", "1_2.csv", "q", 1.0, None),
                   ("comment_index_78", "3_4.csv", "r", 3.0, "good")}

    assert spark.read.parquet(index).count() == 3 + 2 + 3

    late, progress = str(tmp_path / "late"), str(tmp_path / "late-progress")
    drop_in(landing, "missing.csv", [("2", "short text", "p")])
    follow_pending_files(spark, pending, str(landing), late, progress, available_now=True, max_files=2,
                         status=str(tmp_path / "status")).awaitTermination()
    last = spark.read.parquet(str(tmp_path / "status")).orderBy("batch_id")
    assert {(r.filename, r.status) for r in last.collect()} == {("missing", "ready"), ("never", "pending")}
    assert last.select("batch_id").distinct().count() == 2
    rows = spark.read.csv(late, header=True).collect()
    assert [(r.source_file, r.average_rating, r.cleaned_comment) for r in rows] == [
        ("missing.csv", "2.0", "short text")]


def test_odd_names_through_the_whole_job(spark, tmp_path, landing):
    """Each file is indexed once, under its own number, or is pending."""
    names = ["a b.csv", "100%.csv", "a+b.csv", "café ü.csv"]
    for i, name in enumerate(names):
        drop_in(landing, name, [("5", f"{TEN} {i}", f"p{i}")])
    manifest = spark.createDataFrame([(n, i) for i, n in enumerate([*names, "late one"])],
                                     "filename string, pos long")
    index = str(tmp_path / "index")
    pending = index_ready_files(spark, manifest, str(landing), echo("good"), index)
    assert [r.filename for r in pending.collect()] == ["late one"]
    got = sorted((r.index_name, r.source_file, r.name) for r in spark.read.parquet(index).collect())
    assert got == [(f"comment_index_{76 + i}", n, f"p{i}") for i, n in enumerate(names)]
    late = str(tmp_path / "late")
    drop_in(landing, "late one.csv", [("2", "short text", "p")])
    follow_pending_files(spark, pending, str(landing), late, str(tmp_path / "progress"),
                         available_now=True).awaitTermination()
    assert [r.source_file for r in spark.read.csv(late, header=True).collect()] == ["late one.csv"]


def test_unlisted_files_are_neither_landed_nor_scored(spark, tmp_path, landing, monkeypatch):
    drop_in(landing, "1_2.csv", [("5", TEN, "p")])
    drop_in(landing, "0_0.csv", [("5", f"{TEN} {i}", "other") for i in range(50)])
    seen = []
    import reviewloom.plans.enrich as plan
    real = plan.land

    def counted(df, name):
        out = real(df, name)
        if name == "cleaned":
            seen.append(out.count())
        return out
    monkeypatch.setattr(plan, "land", counted)
    manifest = spark.createDataFrame([("1_2", 0)], "filename string, pos long")
    index_ready_files(spark, manifest, str(landing), echo("good"), str(tmp_path / "index"))
    assert seen == [1]


def test_the_job_over_a_landed_table(spark, tmp_path):
    pages = spark.createDataFrame([
        (1, page([(1, 2, 5, TEN + " a", "p"), (1, 2, 3, TEN + " b", "p"), (3, 4, 4, TEN, "q")])),
        (0, page([(1, 2, 1, TEN + " c", "p"), (3, None, 4, TEN, "no shop")]))], "page_no int, page string")
    landed, listed = str(tmp_path / "landed"), str(tmp_path / "list")
    ingest_pages(pages, "page", landed, listed, ["page_no"], max_reviews=2)
    manifest = read_manifest(spark, listed, has_header=False)
    assert [r.filename for r in manifest.orderBy("pos").collect()] == ["1_2.csv", "3_4.csv"]
    index = str(tmp_path / "index")
    pending = index_ready_files(spark, manifest, landed, echo("good"), index,
                                read_options={"fmt": "parquet"})
    assert pending.count() == 0
    got = {(r.index_name, r.name, r.rating, r.comments) for r in spark.read.parquet(index).collect()}
    assert got == {("comment_index_76", "p", 3.0, TEN + " c"), ("comment_index_76", "p", 3.0, TEN + " a"),
                   ("comment_index_77", "q", 4.0, TEN)}


def test_many_products_share_folders_and_are_replaced_alone(spark, tmp_path):
    landed, listed = str(tmp_path / "landed"), str(tmp_path / "list")

    def ingest(ids, comment):
        rows = [(0, page([(i, 1, 5, f"{comment} {i}", "p")])) for i in ids]
        ingest_pages(spark.createDataFrame(rows, "page_no int, page string"), "page", landed, listed, ["page_no"])
        return {r.source_file: r.comment for r in read_reviews(spark, landed, fmt="parquet").collect()}
    assert ingest(range(200), "old") == {f"{i}_1.csv": f"old {i}" for i in range(200)}
    assert len([f for f in os.listdir(landed) if "=" in f]) <= 64
    now = ingest(range(100, 210), "new")
    assert now == {f"{i}_1.csv": f"{'old' if i < 100 else 'new'} {i}" for i in range(210)}


def page(ratings):
    return json.dumps({"data": {"ratings": [
        {"itemid": i, "shopid": s, "rating_star": r, "comment": c, "product_items": [{"name": n}]}
        for i, s, r, c, n in ratings]}})


def drop_text(landing, name, text):
    (landing.parent / f"staged-{name}").write_text(text, encoding="utf-8")
    os.rename(landing.parent / f"staged-{name}", landing / name)


def test_each_file_by_its_own_header(spark, tmp_path, landing):
    sink, progress, aside = (str(tmp_path / n) for n in ("sink", "progress", "aside"))

    def run():
        stream_reviews(file_stream(spark, str(landing), max_files=2), sink, progress, available_now=True,
                       set_aside=aside).awaitTermination()
        return (sorted((r.source_file, r.name, r.rating, r.comments) for r in spark.read.parquet(sink).collect()),
                sorted((r.source_file, r.reason) for r in spark.read.parquet(aside).collect()))

    drop_text(landing, "a.csv", f"rating_star,comment,name\n5,{TEN},p\n3,{TEN} x,p\n")
    drop_text(landing, "b [1].csv", f'name,when,rating_star,comment\nq,today,4,"{TEN}, y"\n')
    drop_text(landing, "c.csv", f"name,comment\nq,{TEN}\n")
    drop_text(landing, "other.txt", f"rating_star,comment,name\n5,{TEN},p\n")
    rows = [("a.csv", "p", 4.0, TEN), ("a.csv", "p", 4.0, TEN + " x"), ("b [1].csv", "q", 4.0, TEN + " y")]
    lacking = [("c.csv", "no column rating_star")]
    assert run() == (rows, lacking)
    drop_text(landing, "d.csv", f"COMMENT,Name,Rating_Star\n{TEN} z,r,2\n")
    drop_text(landing, "e.csv", "\n\n")
    drop_text(landing, "empty.csv", "")  # a file of no bytes is nothing that Spark would list
    drop_text(landing, "f.csv", "rating_star,comment,name\n")
    drop_text(landing, "g.csv", "x\n1\n")
    rows += [("d.csv", "r", 2.0, TEN + " z")]
    lacking += [("e.csv", "no header"), ("g.csv", "no column rating_star, comment, name")]
    assert run() == (rows, lacking)
    assert run() == (rows, lacking)


def test_a_file_without_a_column_fails_unless_set_aside(spark, tmp_path, landing):
    drop_text(landing, "c.csv", "name,comment\nq,text\n")
    query = stream_reviews(file_stream(spark, str(landing)), str(tmp_path / "sink"), str(tmp_path / "progress"),
                           available_now=True)
    with pytest.raises(Exception, match="c.csv: no column rating_star"):
        query.awaitTermination()


def test_late_files_by_their_own_header_and_only_those_waited_for(spark, tmp_path, landing):
    drop_text(landing, "1_2.csv", "name,comment,rating_star\np,ngon,5\np,ngon,4\n")
    drop_text(landing, "9_9.csv", "no header that anyone could read\n")
    pending = spark.createDataFrame([("1_2",), ("never",)], "filename string")
    sink, aside = str(tmp_path / "late"), str(tmp_path / "aside")
    follow_pending_files(spark, pending, str(landing), sink, str(tmp_path / "progress"), available_now=True,
                         set_aside=aside).awaitTermination()
    assert [(r.source_file, r.average_rating, r.cleaned_comment) for r in spark.read.csv(
        sink, header=True).collect()] == [("1_2.csv", "4.5", "ngon")] * 2
    assert spark.read.parquet(aside).count() == 0


def test_a_file_that_never_comes_is_overdue(spark, tmp_path, landing):
    """Two waves, a restart that keeps the deadlines, a file nobody asked for, and an end."""
    listed = tmp_path / "listed"
    listed.mkdir()
    sink, progress = str(tmp_path / "told"), str(tmp_path / "progress")
    manifest = spark.createDataFrame([("1_2",), ("3_4.csv",), ("never",), ("1_2.csv",)], "filename string")

    def start():
        expected = spark.readStream.schema("filename string").csv(str(listed))
        return track_arrivals(spark, expected, str(landing), sink, progress, patience=20, every="0 seconds")

    def wait_for(want):
        """Batches go on as long as a timer may fire, so there is no moment at which all is done."""
        end = time.monotonic() + 90
        while time.monotonic() < end and query.isActive:
            if os.path.isdir(sink) and {r.source_file: r.status for r in last_status(spark, sink).collect()} == want:
                break
            time.sleep(0.2)
        query.stop()
        assert {r.source_file: r.status for r in last_status(spark, sink).collect()} == want

    drop_text(landing, "1_2.csv", "x\n")
    drop_text(landing, "9_9.csv", "x\n")
    drop_text(listed, "list.csv", "1_2\n3_4.csv\nnever\n1_2.csv\n")
    query = start()
    wait_for({"1_2.csv": "ready", "3_4.csv": "pending", "never.csv": "pending"})
    drop_text(landing, "3_4.csv", "x\n")
    query = start()
    found = await_decided(query, manifest, sink, poll=0.2)
    assert not query.isActive
    assert {r.source_file: r.status for r in found.collect()} == {
        "1_2.csv": "ready", "3_4.csv": "ready", "never.csv": "overdue"}
    # late after all, and one asked for after it came
    drop_text(landing, "never.csv", "x\n")
    drop_text(listed, "more.csv", "9_9\n")
    query = start()
    wait_for({"1_2.csv": "ready", "3_4.csv": "ready", "never.csv": "ready", "9_9.csv": "ready"})
    told = spark.read.parquet(sink).orderBy("at").collect()
    assert [r.status for r in told if r.source_file == "never.csv"] == ["pending", "overdue", "ready"]
    assert [r.status for r in told if r.source_file == "1_2.csv"] == ["ready"]


def test_pages_become_files_of_whole_pages(spark, tmp_path):
    """Pages in any order over three runs: ends by an empty page and by the limit, gaps, repeats, late pages."""
    waves, landed, listed, progress = (str(tmp_path / n) for n in ("pages", "landed", "listed", "progress"))
    schema = "itemid bigint, shopid bigint, page_no int, page string"

    def of(product, number, *texts):
        return product, 0, number, page([(product, 0, 5, t, "p") for t in texts])

    runs = [[of(1, 2, "e"), of(1, 0, "a", "b"), of(2, 0, "a"), of(3, 1, "b"), of(4, 0)],
            [of(1, 1, "c", "d"), of(1, 1, "again"), of(2, 1, "b"), (2, 0, 2, "no json"), of(3, 2, "c")],
            [of(1, 3, "f"), of(1, 0, "late"), of(2, 3, "late"), of(5, 0, "a", "b", "c", "d", "e", "f")]]
    for rows in runs + [None]:
        if rows:
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(waves)
        stream = spark.readStream.schema(schema).parquet(waves)
        ingest_page_stream(stream, landed, listed, progress, max_reviews=4, available_now=True).awaitTermination()
    got = sorted((r.source_file, r.page_no, r.page_row, r.comment) for r in spark.read.parquet(landed).collect())
    assert got == [("1_0.csv", 0, 0, "a"), ("1_0.csv", 0, 1, "b"), ("1_0.csv", 1, 0, "c"), ("1_0.csv", 1, 1, "d"),
                   ("2_0.csv", 0, 0, "a"), ("2_0.csv", 1, 0, "b")] + [
        ("5_0.csv", 0, i, t) for i, t in enumerate("abcdef")]
    assert sorted(r.filename for r in spark.read.parquet(listed).collect()) == [
        "1_0.csv", "2_0.csv", "4_0.csv", "5_0.csv"]
    # the batch form agrees, where it knows all pages
    pages = spark.createDataFrame(sum(runs, []), schema).dropDuplicates(["itemid", "page_no"])
    kept = cap_pages(pages.withColumn("n", page_size("page")), "n", 4)
    assert sorted((r.itemid, r.page_no) for r in kept.collect()) == [(1, 0), (1, 1), (2, 0), (2, 1), (5, 0)]


def test_copies_in_two_batches_and_a_restart_leave_one(spark, tmp_path):
    waves, sink, progress = (str(tmp_path / n) for n in ("reviews", "sink", "progress"))
    schema = "file string, name string, comment string, rating_star string, seen timestamp"
    runs = [[("a", "p", TEN, "5", 1), ("a", "p", TEN, "5", 1)], [("b", "q", TEN + "!", "1", 2), ("b", "q", TEN + " x", "1", 2)],
            [("c", "p", TEN, "5", 3), ("c", None, TEN + " y", "5", 3), ("c", "p", TEN + " x", "4", 3)]]
    for rows in runs:
        spark.createDataFrame([(*r[:-1], datetime(2026, 1, r[-1])) for r in rows], schema).coalesce(1).write.mode(
            "append").parquet(waves)
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(waves)
        stream_distinct_reviews(stream, sink, progress, "seen", "10 days", available_now=True).awaitTermination()
    assert sorted((r.file, r.comments) for r in spark.read.parquet(sink).collect()) == [("a", TEN), ("b", TEN + " x")]


def documents(spark, folder, parts):
    """A table of ten-word sentences in two languages, as ``parts`` files below ``documents.parquet``."""
    rows = [(i, "en" if i % 2 else "vi", "p", f"{TEN.replace('chín', 'x' * (i % 5 + 1))}.{TEN}") for i in range(80)]
    spark.createDataFrame(rows, "doc_id long, lang string, source string, text string").repartition(
        parts).write.parquet(f"{folder}/documents.parquet")


@pytest.mark.parametrize("name", ["stream_reviews", "stream_late_reviews"])
def test_documents_stream_from_a_folder_of_parts_as_from_one_file(spark, tmp_path, name):
    documents(spark, tmp_path / "parts", 3)
    whole = tmp_path / "whole"
    whole.mkdir()
    staged = tmp_path / "staged"
    spark.read.parquet(str(tmp_path / "parts/documents.parquet")).coalesce(1).write.parquet(str(staged))
    os.rename(next(staged.glob("part-*.parquet")), whole / "documents.parquet")
    got = [sorted(map(str, queries.QUERIES[name](spark, str(tmp_path / d)).collect())) for d in ("parts", "whole")]
    assert got[0] == got[1] and got[0]


def test_no_task_writes_or_reads_a_whole_wave(spark, tmp_path, monkeypatch):
    documents(spark, tmp_path, 4)
    paths = {}
    monkeypatch.setattr(queries, "fresh_path", lambda _, n: paths.setdefault(n, str(tmp_path / n)))
    monkeypatch.setattr(queries, "land", lambda df, _: df.repartition(4))
    rows = queries.QUERIES["stream_distinct_reviews"](spark, str(tmp_path)).collect()
    assert len(set(rows)) == len(rows) == 12
    assert len([f for f in os.listdir(paths["reviews"]) if f.startswith("part-")]) > 4  # of four waves
    assert len([f for f in os.listdir(paths["distinct"]) if f.startswith("batch_id=")]) >= 4


def test_a_file_in_parts_comes_whole_and_no_task_writes_or_reads_all_of_it(spark, tmp_path, landing):
    """Parts go to several batches, but their file to one; a part without a column sets its file aside."""
    sink, progress, aside, status = (str(tmp_path / n) for n in ("sink", "progress", "aside", "status"))

    def drop_parts(name, *frames):
        staged = tmp_path / f"staged-{len(list(tmp_path.iterdir()))}"
        for frame in frames:
            frame.write.mode("append").csv(str(staged), header=True)
        os.rename(staged, landing / name)

    rows = spark.range(60, numPartitions=6).select(
        F.col("id").alias("rating_star"), F.lit("p").alias("name"), F.concat(F.lit(TEN + " "), "id").alias("comment"))
    drop_parts("in parts [1].csv", rows)
    drop_parts("bad.csv", rows.select("comment", "name"))
    drop_text(landing, "part-00001-x.csv", f"comment,rating_star,name\n{TEN},5,q\n")
    (landing / "deeper").mkdir()
    (landing / "deeper" / "c.csv").write_text("not listed\n")
    stream_reviews(file_stream(spark, str(landing), max_files=2), sink, progress, available_now=True,
                   set_aside=aside).awaitTermination()
    got = spark.read.parquet(sink).groupBy("source_file", "batch_id").agg(
        F.count("*").alias("n"), F.avg("rating").alias("rating")).collect()
    assert sorted((r.source_file, r.n, r.rating) for r in got) == [
        ("in parts [1].csv", 60, 29.5), ("part-00001-x.csv", 1, 5.0)]
    assert [(r.source_file, r.reason) for r in spark.read.parquet(aside).collect()] == [
        ("bad.csv", "no column rating_star")]
    late = str(tmp_path / "late")
    pending = spark.createDataFrame([("in parts [1]",), ("never",)], "filename string")
    follow_pending_files(spark, pending, str(landing), late, str(tmp_path / "progress-2"), available_now=True,
                         status=status).awaitTermination()
    assert spark.read.csv(late, header=True).count() == 60
    assert {(r.filename, r.status) for r in spark.read.parquet(status).collect()} == {
        ("in parts [1]", "ready"), ("never", "pending")}


def test_the_landing_of_the_queries_has_no_file_of_one_task(spark, tmp_path):
    docs = spark.range(4000).select(
        F.col("id").alias("doc_id"), F.concat(F.lit(TEN + " "), "id").alias("text"), F.lit("en").alias("lang"),
        F.lit("s").alias("source"), F.lit(10).alias("n_chars"))
    docs.repartition(4).write.parquet(str(tmp_path / "documents.parquet"))
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", 1 << 30)
    try:
        folder = queries._csv_landing(spark, str(tmp_path))
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", before)
    names = {r.source_file for r in spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
             .select(F.regexp_extract("path", "([^/]+)/[^/]+$", 1).alias("source_file"), "path").collect()}
    assert names == {"lang en.csv", "broken.csv"}
    for name in names:
        lines = spark.read.csv(f"{folder}/{name}", header=True)
        assert lines.count() == 4000 and len(lines.inputFiles()) > 1
