import random

from reviewloom.llm import lengths


def _report(llm, values, block=4):
    df = llm.createDataFrame([(v,) for v in values], "n_tokens bigint")
    return lengths.length_report(lengths.length_histogram(df), block)


def test_report_agrees_with_plain_sums(llm):
    rng = random.Random(6)
    values = [rng.randrange(0, 60) for _ in range(500)] + [0, 0, 1000]
    rows = _report(llm, values + [None]).collect()
    assert sorted(r["length"] for r in rows) == sorted(set(values))
    for r in rows:
        at = r["length"]
        assert r["n_docs"] == values.count(at)
        assert r["docs_up_to"] == sum(v <= at for v in values)
        assert r["tokens_up_to"] == sum(v for v in values if v <= at)
        assert r["docs_longer"] == sum(v > at for v in values)
        assert r["tokens_longer"] == sum(v for v in values if v > at)
        assert r["tokens_kept"] == sum(min(v, at) for v in values)
        assert (r["total_docs"], r["total_tokens"]) == (len(values), sum(values))


def test_any_limit_and_quantile(llm):
    values = [3, 3, 10, 40]
    report = _report(llm, values)
    limits = llm.createDataFrame([(0,), (2,), (3,), (7,), (10,), (25,), (99,), (None,), (7,)], "limit bigint")
    got = [tuple(r) for r in lengths.answer_limits(report, limits).collect()]
    want = [(x, sum(v > x for v in values), sum(min(v, x) for v in values)) for x in (0, 2, 3, 7, 10, 25, 99, 7)]
    assert sorted(got, key=str) == sorted(want + [(None, None, None)], key=str)
    assert report.agg(lengths.quantile(report, 0.5).alias("m")).first()["m"] == 3
    assert report.agg(lengths.quantile(report, 0.5, "tokens").alias("m")).first()["m"] == 40


def test_empty(llm):
    report = _report(llm, [])
    assert report.count() == 0
    limits = llm.createDataFrame([(5,)], "limit bigint")
    assert [tuple(r) for r in lengths.answer_limits(report, limits).collect()] == [(5, None, None)]


def test_query_counts_every_token(llm):
    import base64
    import public_tokenizers
    import tiktoken
    from reviewloom.llm.queries import QUERIES, RANK_FILE
    sf = "/root/testdata/sf0.001"
    with open(RANK_FILE, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    encoder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    values = [len(encoder.encode_ordinary(r["text"] or "")) for r in
              llm.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    got = {r["length"]: r for r in QUERIES["op6_token_counts"](llm, sf).collect()}
    assert {n: r["n_docs"] for n, r in got.items()} == {v: values.count(v) for v in values}
    assert all(r["tokens_kept"] == sum(min(v, n) for v in values) for n, r in got.items())
