import os
import shutil

import pytest

from reviewloom.sources.landing import compact, landed_files, read_landed, replace_files

KIND = "name string, comment string, source_file string"


def _rows(spark, **files):
    rows = [("p", c, f"{name}.csv") for name, comments in files.items() for c in comments]
    return spark.createDataFrame(rows, KIND)


def _read(spark, path, **options):
    found = {}
    for r in read_landed(spark, path, KIND, **options).collect():
        found.setdefault(r.source_file.removesuffix(".csv"), []).append(r.comment)
    return {k: sorted(v) for k, v in found.items()}


def _names(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "filename string")


def test_files_are_replaced_as_a_whole(spark, tmp_path):
    path = str(tmp_path / "landed")
    replace_files(_rows(spark, a=["1", "2"], b=["3"], c=["4"]), path)
    replace_files(_rows(spark, b=["5", "6"], d=["7"]), path)
    want = {"a": ["1", "2"], "b": ["5", "6"], "c": ["4"], "d": ["7"]}
    assert _read(spark, path) == want
    assert _read(spark, path, only=_names(spark, "a", "d.csv", "never")) == {"a": ["1", "2"], "d": ["7"]}
    # a file without rows is empty, not what it was
    replace_files(_rows(spark, a=["8"]), path, _names(spark, "a", "c"))
    assert _read(spark, path) == {"a": ["8"], "b": ["5", "6"], "d": ["7"]}
    assert {r.filename for r in landed_files(spark, path).collect()} == {"a.csv", "b.csv", "c.csv", "d.csv"}
    compact(spark, path, KIND)
    assert _read(spark, path) == {"a": ["8"], "b": ["5", "6"], "d": ["7"]}
    assert landed_files(spark, path).select("version").distinct().count() == 1
    folders = [n for n in os.listdir(tmp_path / "landed" / "data") if not n.startswith(".")]
    assert len(folders) == 4, "a folder per write, not per file"


def test_a_reader_keeps_what_it_has_begun_with(spark, tmp_path):
    path = str(tmp_path / "landed")
    replace_files(_rows(spark, a=["1"], b=["2"]), path)
    begun = read_landed(spark, path, KIND)
    replace_files(_rows(spark, a=["3", "4"]), path)
    assert sorted(r.comment for r in begun.collect()) == ["1", "2"]
    assert _read(spark, path) == {"a": ["3", "4"], "b": ["2"]}


def test_a_write_that_fails_is_not_seen(spark, tmp_path):
    path = str(tmp_path / "landed")
    replace_files(_rows(spark, a=["1"]), path)

    def fail(batches):
        yield from batches
        raise RuntimeError("lost")
    rows = _rows(spark, a=["2"], b=["3"])
    with pytest.raises(Exception, match="lost"):
        replace_files(rows.mapInPandas(fail, rows.schema), path)
    assert _read(spark, path) == {"a": ["1"]}
    # a version whose driver died before the commit
    shutil.copytree(tmp_path / "landed" / "data", tmp_path / "copy")
    first = next(n for n in os.listdir(tmp_path / "copy") if n.startswith("version="))
    os.rename(tmp_path / "copy" / first, tmp_path / "landed" / "data" / "version=dead")
    assert _read(spark, path) == {"a": ["1"]}
    replace_files(rows, path)
    assert _read(spark, path) == {"a": ["2"], "b": ["3"]}


def test_two_writers_take_two_numbers(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor
    path = str(tmp_path / "landed")
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda i: replace_files(_rows(spark, **{f"f{i}": [str(i)]}), path), range(6)))
    assert _read(spark, path) == {f"f{i}": [str(i)] for i in range(6)}
    assert len([n for n in os.listdir(tmp_path / "landed" / "commits") if n.startswith("number=")]) == 6


def test_nothing_to_replace(spark, tmp_path):
    path = str(tmp_path / "landed")
    replace_files(_rows(spark, a=["1"]), path)
    replace_files(_rows(spark), path)
    assert _read(spark, path) == {"a": ["1"]}
