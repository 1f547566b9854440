"""Ids against the plain tokenizer, bounds against exhaustive packing, and whole packings."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tablewright.llm import packing
from tablewright.llm.vocabulary import ChunkTokenizer

PATH = public_tokenizers.path("byte_bpe_50k.json")


def awkward(rng):
    return "".join(
        rng.choice([" ", "  ", "\n", "\t", "a", "Über", "don't", "'s", "12", "!!", " ", "\x1c",
                    "　", "<|endoftext|>", "word", "日本", "é", "\r", "\x85"])
        for _ in range(rng.randrange(14))
    )


def test_chunks_encode_like_whole_texts():
    tokenizer, ours, rng = Tokenizer.from_file(PATH), ChunkTokenizer(PATH), random.Random(1)
    for _ in range(5000):
        text = awkward(rng)
        assert ours.encode(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def fewest(lengths, limit):
    best = len(lengths)

    def place(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(lengths):
            best = len(rooms)
            return
        for r in set(rooms):
            if r >= lengths[i]:
                rest = list(rooms)
                rest.remove(r)
                place(i + 1, [*rest, r - lengths[i]])
        place(i + 1, [*rooms, limit - lengths[i]])

    place(0, [])
    return best


@pytest.mark.parametrize("seed", range(40))
def test_bounds_and_best_fit(seed):
    rng = random.Random(seed)
    limit = rng.choice([10, 24])
    lengths = np.array([rng.randrange(1, limit + 1) for _ in range(rng.randrange(1, 9))])
    exact = fewest(sorted(lengths.tolist(), reverse=True), limit)
    assert packing.lower_bound(np.bincount(lengths, minlength=limit + 1), limit) <= exact
    sequence, room = packing.best_fit_decreasing(lengths, limit)
    used = np.bincount(sequence, lengths, len(room))
    assert (room == limit - used).all() and (room >= 0).all()
    assert len(room) >= exact


@pytest.mark.parametrize("limit", [64, 1024])
def test_documents(spark, made_documents, limit):
    docs = made_documents(2, n=120)
    tokenizer = Tokenizer.from_file(PATH)
    out = packing.packed(packing.pieces(docs, PATH, limit), limit).collect()
    ids = {}
    for r in docs.collect():
        ids.setdefault(r.doc_id, []).append([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 2])
    by_doc, by_sequence = {}, {}
    for r in out:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert by_doc.keys() == ids.keys()
    for doc, rows in by_doc.items():
        one = ids[doc][0]
        for r in rows:
            part = one[r.start : r.start + r.length]
            assert len(part) == r.length <= limit
            assert r.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
            assert len(one) > limit or r.length == len(one)
            assert r.piece == 0 or r.length == limit
        assert sum(r.length for r in rows) == len(one) * len(ids[doc])
    for rows in by_sequence.values():
        rows.sort(key=lambda r: r.offset)
        ends = np.cumsum([r.length for r in rows])
        assert [r.offset for r in rows] == [0, *ends[:-1]] and ends[-1] <= limit
    total = sum(r.length for r in out)
    assert len(by_sequence) <= -(-total // limit) * 1.05 + 1


@pytest.mark.parametrize("partitions", ["3", "200"])
def test_as_few_as_one_pool_whatever_the_partitions(spark, partitions, monkeypatch):
    rng = np.random.default_rng(4)
    lengths = np.concatenate([rng.integers(1, 1024, 900), rng.integers(300, 420, 500), [1024] * 40])
    rows = spark.createDataFrame([(i, 0, int(n)) for i, n in enumerate(lengths)], "doc_id long, piece int, length long")
    _, room = packing.best_fit_decreasing(lengths[lengths < 1024], 1024)
    bound = packing.lower_bound(np.bincount(lengths, minlength=1025), 1024)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        out = packing.packed(rows).collect()
        assert len({r.sequence_id for r in out}) == len(room) + 40
        assert {r.bound for r in out} == {bound}
        assert {(r.pool_sequences, r.pool_bound) for r in out if r.length < 1024} == {(len(room), bound - 40)}
        monkeypatch.setattr(packing, "POOL", 100)  # pools, and an exchange between them
        out = packing.packed(rows).collect()
        assert bound <= len({r.sequence_id for r in out}) <= 1.02 * (len(room) + 40)
        used = {}
        for r in out:
            used[r.sequence_id] = used.get(r.sequence_id, 0) + r.length
        assert max(used.values()) <= 1024 and sum(used.values()) == lengths.sum()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_empty_table(made_documents):
    pieces = packing.pieces(made_documents().filter("false"), PATH)
    assert packing.packed(pieces).collect() == []
