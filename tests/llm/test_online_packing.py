import random
from collections import Counter
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from quartergrid.llm.online_packing import Levels, Piece, filled_up, level, pack_online, packed, powers_of_two

from .cases import awkward, docs


def ids_of(size, begin=0):
    return np.arange(begin, begin + size, dtype="<u4")


def windows_by_brute_force(sizes, capacity):
    """Levels of the open windows after each size, by trying every level."""
    held = []
    for size in sizes:
        tries = []
        for at in {0, *held}:
            if at + size > capacity:
                continue
            after = list(held)
            if at:
                after.remove(at)
            if at + size < capacity:
                after.append(at + size)
            tries.append((sum(n * n for n in Counter(after).values()), -at, after))
        held = min(tries)[2]
        yield sorted(held)


def test_each_piece_goes_where_the_sum_of_squares_is_least():
    rng = random.Random(1)
    for _ in range(20):
        sizes = [rng.choice([1, 2, 3, 5, 8, 13, 15]) for _ in range(120)]
        levels = Levels(16)
        for size, want in zip(sizes, windows_by_brute_force(sizes, 16)):
            levels.put(Piece(0, size, 0, ids_of(size)))
            assert sorted(level(w) for w in levels.windows[0] + [w for x in levels.windows[1:] for w in x]) == want
            assert levels.counts.tolist() == [want.count(h) if h else 0 for h in range(17)]


def check_pieces(rows, capacity):
    """Gapless sequences without padding, and documents covered once."""
    sequences, parts = {}, {}
    for doc, tokens, start, ids, sequence, offset in rows:
        sequences.setdefault(sequence, []).append((offset, len(ids)))
        parts.setdefault((doc, tokens), []).append((start, list(ids)))
    for held in sequences.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at and length
            at += length
        assert at <= capacity and at.bit_count() == 1
    for (_, tokens), held in parts.items():
        assert sum(len(ids) for _, ids in held) % tokens == 0
    return parts


def as_rows(windows):
    for number, window in enumerate(windows):
        offset = 0
        for p in window:
            yield p.doc_id, p.doc_tokens, p.start, p.ids, number, offset
            offset += len(p.ids)


@pytest.mark.parametrize("most_open", [2, 5, 4096])
def test_stream_is_packed_without_padding(most_open):
    rng = random.Random(most_open)
    sizes = [rng.choice([1, 3, 7, 31, 33, 50, 64, 65, 128, 200, 640]) for _ in range(700)]
    documents = ((i, ids_of(n, i * 1000)) for i, n in enumerate(sizes))
    parts = check_pieces(as_rows(packed(documents, 64, most_open)), 64)
    for (i, n), held in parts.items():
        assert np.concatenate([np.array(x) for _, x in sorted(held)]).tolist() == ids_of(n, i * 1000).tolist()
    assert len(parts) == len(sizes)


def test_few_short_documents_are_cut():
    rng = random.Random(4)
    sizes = [rng.randrange(1, 64) for _ in range(5000)]
    whole = Counter(p.doc_id for w in packed(((i, ids_of(n)) for i, n in enumerate(sizes)), 64, 4096) for p in w)
    assert sum(n > 1 for n in whole.values()) < 100  # of 5,000


def test_sizes_that_fit_nowhere_cut_one_document_a_window():
    windows = list(packed(((i, ids_of(40)) for i in range(64)), 64, 16))
    assert sum(level(w) for w in windows) == 64 * 40 and len(windows) == 40
    assert sum(len(w) for w in windows) <= 64 + len(windows)


def test_rest_and_powers_of_two():
    full, rest = filled_up([[Piece(1, 5, 0, ids_of(5))], [Piece(2, 3, 0, ids_of(3))], [Piece(3, 1, 0, ids_of(1))]], 8)
    assert [level(w) for w in full] == [8] and level(rest) == 1
    assert filled_up([], 8) == ([], []) and powers_of_two([]) == []
    assert [level(w) for w in powers_of_two([Piece(1, 6, 0, ids_of(6)), Piece(2, 7, 0, ids_of(7))])] == [8, 4, 1]


def test_ids_equal_the_tokenizers_library(spark):
    source = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r[0]: r[1] for r in source.select("doc_id", "text").collect()}
    texts[10**6] = "a <|endoftext|> emoji \U0001F600 don't 1234 \r\n\n  x"
    got = pack_online(docs(spark, list(texts.items())), added=True).collect()
    model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {i: [*model.encode(t or "", add_special_tokens=False).ids, 0] for i, t in texts.items()}
    found = {}
    for r in got:
        assert crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] and r["length"] == len(r["ids"])
        assert r["doc_tokens"] == len(want[r["doc_id"]])
        found.setdefault(r["doc_id"], []).append((r["start"], r["ids"]))
    for i, held in found.items():
        assert [x for _, ids in sorted(held) for x in ids] == want[i]
    assert len(found) == len(want)
    check_pieces([(r["doc_id"], r["doc_tokens"], r["start"], r["ids"], r["sequence_id"], r["offset"]) for r in got], 1024)


def test_awkward_rows(spark):
    got = pack_online(awkward(spark), 64).collect()
    seen = Counter(r["doc_id"] for r in got if r["start"] == 0)
    assert seen == {1: 1, 2: 1, 3: 1, 4: 2, 5: 1, 6: 1, None: 2}
    assert [r["ids"] for r in got if r["doc_id"] in (1, 2)] == [[0], [0]]
    check_pieces([(None, 1, 0, r["ids"], r["sequence_id"], r["offset"]) for r in got], 64)
    assert pack_online(awkward(spark).filter("false")).count() == 0
    with pytest.raises(ValueError):
        pack_online(awkward(spark), 1000)
