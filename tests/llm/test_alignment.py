import hashlib
import json
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from reviewloom.llm import alignment

A = alignment.ByteLevel, public_tokenizers.path("byte_bpe_50k.json")
B = alignment.Pieces, public_tokenizers.path("piece_bpe_32k.model")

TEXTS = ["The cat sat on the mat.", "The cat sat on the mat.", None, "", " ", "a  b\n\nc\t d", "▁x", "x ▁ y",
         "<s> <unk> <0x41> <|endoftext|>", "éé ﬁn 中文字符 ไทย 😀😀", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa" * 20,
         "internationalisation of hyper-parameters, e.g. 12345.678", "\x00\x01 odd", "中" * 300,
         "word " * 3000, "The the THE the. The cat!"]


def _plain(texts):
    a = Tokenizer.from_file(A[1])
    a.encode_special_tokens = True
    b = SentencePieceProcessor(model_file=B[1])
    # the usual table from bytes to visible characters
    shown = [c for c in range(256) if 33 <= c <= 126 or 161 <= c <= 172 or c >= 174]
    chars = {chr(c): c for c in shown} | {chr(256 + i): c for i, c in enumerate(
        c for c in range(256) if c not in shown)}

    def bytes_a(i):
        return bytes(chars[c] for c in a.id_to_token(i))

    def bytes_b(i):
        piece = b.id_to_piece(i)
        return bytes([int(piece[3:-1], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()

    links, found = [], []
    for text in texts:
        groups = []
        if text:
            of_a, of_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
            whole = (" " + text).encode()
            if b"".join(map(bytes_a, of_a)) == whole == b"".join(map(bytes_b, of_b)):
                end, i, j, left, right = [0, 0], 0, 0, [], []
                while i < len(of_a) or j < len(of_b):
                    if end[0] <= end[1] and i < len(of_a):
                        left.append(of_a[i])
                        end[0] += len(bytes_a(of_a[i]))
                        i += 1
                    else:
                        right.append(of_b[j])
                        end[1] += len(bytes_b(of_b[j]))
                        j += 1
                    if end[0] == end[1]:
                        groups.append((left, right))
                        left, right = [], []
        links.append(Counter((x, y) for ga, gb in groups for x in ga for y in gb))
        text_of = ";".join(f"{','.join(map(str, ga))}|{','.join(map(str, gb))}" for ga, gb in groups)
        found.append([sum(len(g) for g, _ in groups), sum(len(g) for _, g in groups), len(groups),
                      sum(links[-1].values()), hashlib.sha256(text_of.encode()).hexdigest() if groups else ""])
    count = Counter(pair for of_doc in links for pair in of_doc)
    most = defaultdict(int)
    for (x, _), n in count.items():
        most[x] = max(most[x], n)
    return [(n_a, n_b, n_groups, n_links,
             sum(t for (x, y), t in of_doc.items() if count[x, y] == most[x]),
             sum(t * count[pair] for pair, t in of_doc.items()), digest)
            for (n_a, n_b, n_groups, n_links, digest), of_doc in zip(found, links)], count, most


@pytest.mark.parametrize("limit", [10**6, 0])
def test_equals_plain_alignment(documents, limit):
    docs = documents(list(enumerate(TEXTS))).repartition(3).withColumn("pairs", F.lit("x")).withColumn("row", F.lit(0))
    rows, pairs = alignment.align(docs, A, B, broadcast_pairs=limit)
    want, count, most = _plain(TEXTS)
    assert rows.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert {r[0]: tuple(r)[1:] for r in rows.collect()} == dict(enumerate(want))
    assert {(r.a, r.b): (r.n_docs, r.best) for r in pairs.collect()} == {
        (x, y): (n, n == most[x]) for (x, y), n in count.items()}


def test_small_memory_and_slices_change_nothing(documents, monkeypatch):
    # in this process: the workers would not see the changed limits
    side_a, side_b = alignment._loaded(*A), alignment._loaded(*B)
    monkeypatch.setattr(alignment, "_LINKS", 5)
    windows = alignment.Windows(side_a[1], side_b[1])
    found = alignment._align(TEXTS, side_a, side_b, windows)
    doc, pairs, times = alignment._link_counts([d[2] for d in found], windows)
    got = [Counter() for _ in TEXTS]
    for d, p, t in zip(doc.tolist(), pairs.tolist(), times.tolist()):
        got[d][divmod(p, len(side_b[0].pieces))] += t
    want, _, _ = _plain(TEXTS)
    assert [sum(c.values()) for c in got] == [w[3] for w in want]
    assert len(windows.text) < sum(len(d[2]) for d in found)


def test_null_and_equal_ids_and_no_rows(documents):
    rows, _ = alignment.align(documents([(None, "one two"), (1, "one two"), (1, "one two")]), A, B)
    found = rows.collect()
    want, _, _ = _plain(["one two"] * 3)
    assert sorted((r.doc_id or 0) for r in found) == [0, 1, 1]
    assert {tuple(r)[1:] for r in found} == {want[0]}
    rows, pairs = alignment.align(documents([]), A, B)
    assert rows.count() == 0 and pairs.count() == 0
    rows, pairs = alignment.align(documents([(1, None), (2, "")]), A, B)
    assert {tuple(r)[1:] for r in rows.collect()} == {(0, 0, 0, 0, 0, 0, "")} and pairs.count() == 0


def test_both_ways_to_encode_agree(tmp_path):
    """The merges replayed by rank equal the library that the file is written for."""
    own = Tokenizer.from_file(A[1])
    own.encode_special_tokens = True
    fast = alignment._loaded(*A)[0]
    rng = random.Random(11)
    marks = "aeéßñ中ไ😀tThe 'sll'RE \t\n\r\x0b\u00a0\u2003\u200d0123.,;-_<|>" + "endoftext"
    texts = ["".join(rng.choices(marks, k=rng.randrange(1, 80))) for _ in range(4000)]
    texts += ["ab" * 5000, "abab aba " * 500, "a" * 20_000, " " * 9000, "<|endoftext|>", " <|endoftext|>x"]
    want = [e.ids for e in own.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]
    assert fast.encode(texts) == want
    # a file that adds a space itself is left to its library
    with open(A[1], encoding="utf-8") as file:
        model = json.load(file)
    model["pre_tokenizer"]["add_prefix_space"] = True
    (tmp_path / "other.json").write_text(json.dumps(model), encoding="utf-8")
    other = alignment.ByteLevel(str(tmp_path / "other.json"))
    assert other.pieces == fast.pieces and other.encode(texts[:50]) == want[:50]
