import json
import os

import pytest

from reviewloom.operators.enrich import (attach_summary, call_text_function, summarize,
                                         summarize_in_slices)
from reviewloom.plans.enrich import enrich_reviews
from tests.conftest import executed_plan

TEN = "một hai ba bốn năm sáu bảy tám chín mười"
PAYLOAD = "product_name string, payload string"


def echo(summary="fine"):
    def answer(text):
        import json
        name = json.loads(text)["product_name"]
        return json.dumps({"product_name": name, "summary": summary})
    return answer


def failing_until(path, good_after):
    """Counts calls in a file, as tasks run in other processes; succeeds after some failures."""
    def answer(text):
        import json
        with open(path, "a") as f:
            f.write("x\n")
        with open(path) as f:
            calls = len(f.readlines())
        if calls <= good_after:
            raise TimeoutError(f"call {calls}")
        return json.dumps({"product_name": "p", "summary": "late"})
    return answer


def one(spark, payload='{"product_name":"p"}'):
    return spark.createDataFrame([("p", payload)], PAYLOAD).coalesce(1)


@pytest.mark.parametrize("failures,summary,attempts", [(0, "late", 1), (2, "late", 3), (9, None, 3)])
def test_retries(spark, tmp_path, failures, summary, attempts):
    calls = tmp_path / "calls"
    got = summarize(one(spark), failing_until(str(calls), failures), backoff=0.01, seed=1).collect()
    assert len(got) == 1
    row = got[0]
    assert (row.summary, row.attempts) == (summary, attempts)
    assert (row.error is None) == (summary is not None)
    assert len(calls.read_text().split()) == attempts
    if failures == 9:
        assert row.error == "TimeoutError: call 3"


def test_answers_that_do_not_parse(spark):
    def answer(text):
        return text
    df = spark.createDataFrame([("a", "no json"), ("b", '{"product_name":"B","summary":"s"}')], PAYLOAD)
    got = {r.product_name: (r.summary, r.echoed_name, r.error)
           for r in summarize(df, answer).collect()}
    assert got == {"a": (None, None, "invalid response"), "b": ("s", "B", None)}
    with pytest.raises(Exception, match="invalid response"):
        summarize(df, answer, on_error="fail").collect()


def test_no_answer_is_an_error(spark):
    row = summarize(one(spark), lambda text: None, backoff=0.0).first()
    assert (row.summary, row.error, row.attempts) == (None, "no response", 3)


def test_bad_options(spark):
    with pytest.raises(ValueError):
        summarize(one(spark), echo(), on_error="ignore")
    with pytest.raises(ValueError):
        call_text_function(one(spark), echo(), "payload", ["product_name"], retries=0)


def test_calls_in_flight_are_bounded(spark):
    df = spark.createDataFrame([(f"p{i}", json.dumps({"product_name": f"p{i}"})) for i in range(50)],
                               PAYLOAD).repartition(20)
    out = summarize(df, echo(), max_parallel=3)
    assert out.rdd.getNumPartitions() == 3 and out.filter("summary = 'fine'").count() == 50


def test_a_lost_worker_costs_a_repeat_but_no_row(spark, tmp_path):
    marker = str(tmp_path / "crashed")

    def answer(text):
        import json
        import os
        name = json.loads(text)["product_name"]
        if name == "p7" and not os.path.exists(marker):
            open(marker, "w").close()
            os._exit(1)
        return json.dumps({"product_name": name, "summary": name})

    df = spark.createDataFrame([(f"p{i}", json.dumps({"product_name": f"p{i}"})) for i in range(20)],
                               PAYLOAD).repartition(4)
    got = summarize(df, answer).collect()
    assert os.path.exists(marker)
    assert sorted(r.summary for r in got) == sorted(f"p{i}" for i in range(20))


def test_attach_summary_leaves_the_rest_null(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "name string, i int")
    found = spark.createDataFrame([("a", "s")], "name string, summary string")
    for split in (None, 1):
        got = sorted((r.i, r.summary) for r in
                     attach_summary(rows, found, rows_per_split=split).collect())
        assert got == [(1, "s"), (2, "s"), (3, None)]


def raw(spark):
    rows = [("f1", "5", f"{TEN} {c}", p) for p, n in (("áo", 5), ("bàn", 2)) for c in
            [f"{p} {i}" for i in range(n)]]
    rows += [("f2", "4", f"{TEN} x", "zzz"), ("f2", "2", f"{TEN} y", "zzz")]
    return spark.createDataFrame(rows, "file string, rating_star string, comment string, name string")


def test_only_the_first_product_is_summarised(spark):
    got = enrich_reviews(raw(spark), echo(), ["file"]).collect()
    assert len(got) == 9
    # names order by code points: "bàn" comes before "áo"
    assert {(r.file, r.name, r.rating, r.summary) for r in got} == {
        ("f1", "bàn", 5.0, "fine"), ("f1", "áo", 5.0, None), ("f2", "zzz", 3.0, "fine")}


@pytest.mark.parametrize("request_", ["payload", "prompt"])
def test_all_products_in_parts_with_one_call_each(spark, tmp_path, request_):
    calls = str(tmp_path / "calls")

    def answer(text):
        import json
        with open(calls, "a") as f:
            f.write("x\n")
        return json.dumps({"product_name": "other", "summary": str(text.count("một"))})

    got = enrich_reviews(raw(spark), answer, ["file"], products="all", request=request_,
                         part_size=2, rows_per_split=1).collect()
    # of five comments three parts, of their summaries two, then one; the other products are whole
    assert len(got) == 9 and len(open(calls).readlines()) == (3 + 2 + 1) + 1 + 1
    by_product = {(r.file, r.name): {x.summary for x in got if (x.file, x.name) == (r.file, r.name)}
                  for r in got}
    assert all(len(s) == 1 and None not in s for s in by_product.values())
    if request_ == "payload":
        assert by_product[("f1", "áo")] == {"0"} and by_product[("f1", "bàn")] == {"2"}


def test_any_number_of_comments_gives_one_summary(spark):
    """Parts are summed up again until one is left, whatever the number of levels."""
    def answer(text):
        import json
        p = json.loads(text)
        known = [int(c["text"]) if c["text"].isdigit() else 1 for c in p["comments"]]
        return json.dumps({"product_name": p["product_name"], "summary": str(sum(known))})

    rows = [("5", f"{TEN} {n} {i}", f"p{n}") for n in (1, 3, 4, 9, 10, 28) for i in range(n)]
    df = spark.createDataFrame(rows, "rating_star string, comment string, name string")
    got = enrich_reviews(df, answer, products="all", part_size=3).collect()
    assert len(got) == len(rows)
    assert {(r.name, r.summary) for r in got} == {(f"p{n}", str(n)) for n in (1, 3, 4, 9, 10, 28)}
    assert {(r.error, r.attempts) for r in got} == {(None, 1)}


def test_failures_reach_the_rows(spark):
    def answer(text):
        import json
        p = json.loads(text)
        if p["product_name"] == "bad" or "one part" in text:
            raise ConnectionError("down")
        return json.dumps({"product_name": "x", "summary": "s"})

    rows = [("5", f"{TEN} {n} {i}", n) for n in ("bad", "good") for i in range(3)]
    rows += [("5", f"{TEN} {w}", "half") for w in ("one part", "two", "three")]
    df = spark.createDataFrame(rows, "rating_star string, comment string, name string")
    got = enrich_reviews(df, answer, products="all", part_size=1 + 1, retries=2, backoff=0.0).collect()
    assert {(r.name, r.summary, r.error, r.attempts) for r in got} == {
        ("bad", None, "ConnectionError: down", 2), ("good", "s", None, 1),
        ("half", "s", "ConnectionError: down", 2)}


def test_a_failing_job_cannot_be_pruned(spark):
    df = spark.createDataFrame([(f"p{i}", "x") for i in range(4)], PAYLOAD)

    def down(text):
        raise ConnectionError("down")
    for run in (lambda x: x.count(), lambda x: x.select("product_name").collect()):
        with pytest.raises(Exception, match="ConnectionError: down"):
            run(summarize(df, down, on_error="fail", retries=1))
        with pytest.raises(Exception, match="invalid response"):
            run(summarize(df, lambda text: text, on_error="fail"))


def test_answered_requests_are_not_asked_again(spark, tmp_path):
    calls, up = str(tmp_path / "calls"), tmp_path / "up"

    def answer(text):
        import json
        import os
        with open(calls, "a") as f:
            f.write(text + "\n")
        if text in ("p3", "p4") and not os.path.exists(str(up)):
            raise ConnectionError("down")
        return json.dumps({"product_name": text, "summary": text})

    df = spark.createDataFrame([(f"p{i % 6}-{i}", f"p{i % 6}") for i in range(12)], PAYLOAD)

    def run():
        return {r.product_name: (r.summary, r.error) for r in summarize_in_slices(
            df, answer, "payload", ["product_name"], str(tmp_path / "answers"), retries=1,
            calls_per_slice=2).collect()}
    first = run()
    assert sorted(open(calls).read().split()) == [f"p{i}" for i in range(6)], "equal requests are one"
    assert first["p3-9"] == (None, "ConnectionError: down") and first["p2-8"] == ("p2", None)
    up.write_text("")
    assert all(v == (k.split("-")[0], None) for k, v in run().items())
    assert sorted(open(calls).read().split()[6:]) == ["p3", "p4"]


def test_no_more_calls_in_flight_than_allowed(spark, tmp_path):
    log = str(tmp_path / "log")

    def answer(text):
        import json
        import time
        with open(log, "a") as f:
            f.write("1\n")
        time.sleep(0.05)
        with open(log, "a") as f:
            f.write("-1\n")
        return json.dumps({"product_name": text, "summary": text})

    df = spark.createDataFrame([(f"p{i}", f"p{i}") for i in range(24)], PAYLOAD).repartition(12)
    assert summarize(df, answer, max_parallel=2).count() == 24
    running, most = 0, 0
    for step in open(log).read().split():
        running += int(step)
        most = max(most, running)
    assert 1 <= most <= 2


def test_summaries_in_parts_meet_their_rows(spark):
    rows = spark.createDataFrame([("a", 0, 1), ("a", 1, 2)], "name string, part int, i int")
    found = spark.createDataFrame([("a", 0, "s"), ("a", 1, "t")], "name string, part int, summary string")
    assert sorted((r.i, r.summary) for r in attach_summary(rows, found).collect()) == [(1, "s"), (2, "t")]
    with pytest.raises(ValueError):
        attach_summary(rows.drop("part"), found)


def test_copies_of_a_text_are_kept_apart_without_dedup(spark):
    df = spark.createDataFrame([("5", "ngon", "p")] * 7, "rating_star string, comment string, name string")
    got = enrich_reviews(df.repartition(3), echo(), profile="relaxed", part_size=3,
                         rows_per_split=2).collect()
    assert [tuple(r) for r in got] == [("p", 5.0, "ngon", "fine", None, 1)] * 7


def test_a_refused_review_is_not_asked_about(spark, tmp_path):
    calls = str(tmp_path / "calls")

    def answer(text):
        import json
        with open(calls, "a") as f:
            f.write("x\n")
        return json.dumps({"product_name": "p", "summary": "s"})

    df = spark.createDataFrame([("0", TEN, "bad"), ("5", TEN + " x", "good")],
                               "rating_star string, comment string, name string")
    got = enrich_reviews(df, answer, products="all", request="prompt").collect()
    assert sorted((r.name, r.summary) for r in got) == [("bad", None), ("good", "s")]
    assert len(open(calls).readlines()) == 1


def test_unknown_choices(spark):
    with pytest.raises(ValueError):
        enrich_reviews(raw(spark), echo(), products="some")
    with pytest.raises(ValueError):
        enrich_reviews(raw(spark), echo(), request="xml")


def test_nothing_in_nothing_out(spark):
    assert enrich_reviews(raw(spark).limit(0), echo(), ["file"]).count() == 0


def _most_at_once(log):
    running, most = 0, 0
    for step in open(log).read().split():
        running += int(step)
        most = max(most, running)
    assert running == 0
    return most


def _slow(log, later=False):
    """A call that notes when it begins and ends; ``later`` makes it a coroutine."""
    def answer(text):
        import time
        with open(log, "a") as f:
            f.write("1\n")
        time.sleep(0.1 if int(text) % 3 else 0.3)
        with open(log, "a") as f:
            f.write("-1\n")
        return f"answer {text}"

    async def answer_later(text):
        import asyncio
        with open(log, "a") as f:
            f.write("1\n")
        await asyncio.sleep(0.1 if int(text) % 3 else 0.3)
        with open(log, "a") as f:
            f.write("-1\n")
        return f"answer {text}"
    return answer_later if later else answer


@pytest.mark.parametrize("later", [False, True])
@pytest.mark.parametrize("options,most", [({}, 10), ({"in_flight": 4}, 4), ({"max_parallel": 6, "in_flight": 6}, 6)])
def test_so_many_calls_of_one_task_are_open(spark, tmp_path, later, options, most):
    log = str(tmp_path / "log")
    df = spark.createDataFrame([(i, str(i)) for i in range(40)], "i int, text string").coalesce(1)
    rows = call_text_function(df, _slow(log, later), "text", ["i"], **options).collect()
    assert [r.response for r in rows] == [f"answer {r.i}" for r in rows], "each answer stands by its request"
    if "max_parallel" not in options:
        assert [r.i for r in rows] == list(range(40)), "in the order of the rows"
    assert _most_at_once(log) == most


@pytest.mark.parametrize("later", [False, True])
def test_failures_among_open_calls(spark, later):
    def answer(text):
        if text.endswith("3"):
            raise ValueError(f"no {text}")
        return None if text.endswith("7") else text

    async def answer_later(text):
        return answer(text)
    fn = answer_later if later else answer
    df = spark.createDataFrame([(i, str(i)) for i in range(30)], "i int, text string").coalesce(1)
    rows = call_text_function(df, fn, "text", ["i"], retries=2, backoff=0.0).collect()
    for r in rows:
        want = ((None, f"ValueError: no {r.i}", 2) if r.i % 10 == 3 else
                (None, "no response", 2) if r.i % 10 == 7 else (str(r.i), None, 1))
        assert (r.response, r.error, r.attempts) == want
    with pytest.raises(Exception, match="no 3"):
        call_text_function(df, fn, "text", ["i"], retries=1, on_error="fail").collect()


def test_bounds_that_cannot_hold(spark):
    for options in ({"in_flight": 0}, {"max_parallel": 3, "in_flight": 4}):
        with pytest.raises(ValueError):
            call_text_function(one(spark), echo(), "payload", ["product_name"], **options)


def test_each_request_is_read_once(spark, tmp_path):
    """Requests lie in one folder per slice, and a slice reads its own folder only."""
    import reviewloom.operators.enrich as module
    read = []
    real = module.call_text_function

    def counted(df, *args, **kwargs):
        read.append(executed_plan(df))
        return real(df, *args, **kwargs)
    df = spark.createDataFrame([(f"p{i}", f"p{i}") for i in range(60)], PAYLOAD)
    module.call_text_function = counted
    try:
        found = summarize_in_slices(df, lambda t: json.dumps({"product_name": t, "summary": t}), "payload",
                                    ["product_name"], str(tmp_path / "answers"), calls_per_slice=12)
    finally:
        module.call_text_function = real
    assert found.filter("summary = product_name").count() == 60
    assert len(read) >= 4
    for i, plan in enumerate(read):
        assert "PartitionFilters: [isnotnull(slice#" in plan and f"= {i})]" in plan and "PushedFilters: []" in plan
