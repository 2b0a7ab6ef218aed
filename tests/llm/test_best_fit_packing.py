import random
from collections import Counter
from itertools import product
from zlib import crc32

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from quartergrid.llm.best_fit_packing import cut, fullest, pack_documents, place, plan

from .cases import awkward, docs


def test_cut():
    assert cut(5, 8) == [(0, 5)] and cut(8, 8) == [(0, 8)]
    assert cut(9, 8) == [(0, 1), (1, 8)] and cut(16, 8) == [(0, 8), (8, 8)]
    assert cut(21, 8) == [(0, 5), (5, 8), (13, 8)]


def test_fullest_is_best_possible():
    rng = random.Random(1)
    for _ in range(200):
        counts = np.zeros(13, np.int64)
        for length in rng.sample(range(1, 13), 4):
            counts[length] = rng.randrange(1, 4)
        room = rng.randrange(0, 13)
        got = fullest(counts, room)
        assert all(0 < n <= counts[length] for length, n in got.items())
        sums = {sum(i * n for i, n in enumerate(some)) for some in product(*(range(int(c) + 1) for c in counts))}
        assert sum(length * n for length, n in got.items()) == max(s for s in sums if s <= room)


def check_sequences(rows, capacity):
    bins = {}
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_place_uses_every_piece_once_and_few_bins(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice([3, 5, 7, 64, 50, 51, 33, 31])) for i in range(4000)]
    df = spark.createDataFrame(rows, "k long, length long").repartition(5)
    got = place(df, 64, "k").collect()
    assert sorted((r["k"], r["length"]) for r in got) == sorted(rows)
    assert check_sequences(got, 64) <= 1.02 * max(
        -(-sum(x[1] for x in rows) // 64), sum(x[1] > 32 for x in rows))


def test_plan_of_nothing():
    assert len(plan({}, 16).key) == 0


def test_ids_equal_the_tokenizers_library(spark):
    source = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r[0]: r[1] for r in source.select("doc_id", "text").collect()}
    texts[10**6] = "<|endoftext|> emoji 😀 　 don't 1234 \r\n\n  x"
    got = pack_documents(docs(spark, list(texts.items())), 1024).collect()
    model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    model.encode_special_tokens = True
    want = {}
    for doc_id, text in texts.items():
        ids = np.array([*model.encode(text, add_special_tokens=False).ids, 2], "<u4")
        for k, (start, length) in enumerate(cut(len(ids), 1024)):
            want[doc_id, k] = (start, length, crc32(ids[start : start + length].tobytes()))
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in got} == want
    assert all(crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] for r in got)
    check_sequences(got, 1024)


def test_awkward_rows(spark):
    got = pack_documents(awkward(spark), 64).collect()
    seen = Counter(r["doc_id"] for r in got if r["piece"] == 0)
    assert seen == {1: 1, 2: 1, 3: 1, 4: 2, 5: 1, 6: 1, None: 2}
    assert [r["ids"] for r in got if r["doc_id"] in (1, 2)] == [[2], [2]]
    check_sequences(got, 64)
    assert pack_documents(awkward(spark).filter("false")).count() == 0


def test_query_and_pipeline_find_added_tokens_like_an_unchanged_tokenizer(spark, tmp_path):
    import corpus_pipeline

    from quartergrid.llm.queries import QUERIES

    texts = ["a <|endoftext|> b", "<|endoftext|><|endoftext|>", " <|endoftext|>\n x <|endoftext", "é 😀 <|endoftext|>1234", "a b"]
    table = docs(spark, texts)
    table.write.parquet(f"{tmp_path}/documents.parquet")
    model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = [np.array([*model.encode(t, add_special_tokens=False).ids, 2], "<u4") for t in texts]
    want = {i: (len(x), crc32(x.tobytes())) for i, x in enumerate(ids)}
    for got in (QUERIES["op8_best_fit_packing"](spark, str(tmp_path)), corpus_pipeline.best_fit_packing(spark, table, "")):
        assert {r["doc_id"]: (r["length"], r["ids_crc32"]) for r in got.collect()} == want
