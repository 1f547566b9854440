"""Fingerprints, links and classes against brute force."""

import random
import re

import pytest
import xxhash

from tablewright.llm import simhash


def brute_print(text, shingle=4):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + shingle]).encode(), 42) for i in range(n)]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > n)


def brute_classes(rows, distance=4):
    prints = [p for _, p in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance:
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted(((d, p, least.get(find(i))) for i, (d, p) in enumerate(rows)), key=repr)


def test_documents(spark, made_documents):
    docs = made_documents(3)
    out = simhash.near_duplicates(docs).collect()
    found = sorted(((r.doc_id, r.fingerprint % 2**64, r.component_id) for r in out), key=repr)
    expected = brute_classes([(r.doc_id, brute_print(r.text)) for r in docs.collect()])
    assert found == expected


@pytest.mark.parametrize("distance, part", [(4, 50_000), (3, 40), (4, 25), (6, 50_000)])
def test_random_fingerprints(spark, monkeypatch, distance, part):
    monkeypatch.setattr(simhash, "PART", part)
    rng = random.Random(distance)
    prints = {rng.getrandbits(64) for _ in range(300)}
    for base in [0, 2**64 - 1, *list(prints)[:5]]:
        p = base
        for _ in range(60):
            prints.add(p)
            p = base if rng.random() < 0.3 else p
            for _ in range(rng.randrange(1, 6)):
                p ^= 1 << rng.randrange(64)
    signed = [(p - 2**64 if p >= 2**63 else p,) for p in prints]
    nodes = spark.createDataFrame(signed, "fingerprint long")
    links = [(r.u % 2**64, r.v % 2**64) for r in simhash.links(nodes, distance).collect()]
    assert all((u ^ v).bit_count() <= distance for u, v in links)
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for u, v in links:
        root[find(u)] = find(v)
    expected = {d: c for d, _, c in brute_classes([(p, p) for p in prints], distance)}
    least = {}
    for p in prints:
        least[find(p)] = min(least.get(find(p), p), p)
    assert {p: least[find(p)] for p in prints} == expected


def test_a_dense_group_gives_few_links(spark):
    """All pairs of 780 fingerprints would be 300,000 links."""
    prints = [(1 << a) + (1 << b) for a in range(40) for b in range(a)]
    nodes = spark.createDataFrame([(p,) for p in prints], "fingerprint long")
    assert simhash.links(nodes).count() <= 50 * len(prints)


def test_empty_table(spark, made_documents):
    assert simhash.near_duplicates(made_documents().filter("false")).collect() == []
