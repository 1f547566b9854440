"""Linked shingle sets against brute force."""

import glob
import random

import numpy as np
import pytest

from tablewright.llm import jaccard


def sets_of(rows, shingle):
    out = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        n = min(shingle, len(w))
        out.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set())
    return out


def brute(rows, shingle=3, percent=90):
    sets, root = sets_of(rows, shingle), list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            same = len(a & sets[j])
            if same and 100 * same >= percent * (len(a) + len(sets[j]) - same):
                root[top(i)] = top(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[top(i)] = min(d, least.get(top(i), d))
    return sorted(((d, len(s), least.get(top(i))) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=repr)


def near_copies(rng, n, words, most):
    """Texts that differ from one base, and from one another, in a few words each."""
    base = [f"b{rng.randrange(10_000)}" for _ in range(words)]
    out = []
    for _ in range(n):
        text = list(base)
        for _ in range(rng.randrange(most + 1)):
            at = rng.randrange(len(text))
            text[at : at + rng.randrange(2)] = [f"x{rng.randrange(10**6)}" for _ in range(rng.randrange(2))]
        out.append(" ".join(text))
    return out


@pytest.mark.parametrize("small", [False, True])
@pytest.mark.parametrize("percent", [90, 70])
def test_agrees_with_brute_force(spark, made_documents, monkeypatch, small, percent):
    """Large families of near copies around the threshold, common passages, copies, short texts."""
    if small:
        for name, value in {"LIST": 8, "PAIRS": 3, "FEW": 1}.items():
            monkeypatch.setattr(jaccard, name, value)
    sizes = {"part": 5, "hubs": 1} if small else {}
    rng = random.Random(percent + small)
    texts = near_copies(rng, 70, 120, 4) + near_copies(rng, 60, 60, 2) + near_copies(rng, 50, 300, 14)
    texts += ["a b", "A b", "a", "b a", "a b c", "a b c d"] + ["to be or not " * 9] * 3
    rows = [(5000 + i, t) for i, t in enumerate(texts)]
    rows += [(r.doc_id, r.text) for r in made_documents(percent, unique=True).collect()]
    rng.shuffle(rows)
    found = jaccard.classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(7), 3, percent, **sizes)
    assert sorted(map(tuple, found.collect()), key=repr) == brute(rows, 3, percent)


def test_empty_and_clashing(spark, made_documents):
    docs = made_documents().select("doc_id", "text")
    assert jaccard.classes(docs.filter("false")).collect() == []
    odd = docs.limit(20).selectExpr("doc_id", "text", "'a' AS id", "'b' AS n", "1 AS z", "2 AS token")
    assert jaccard.classes(odd).columns == ["doc_id", "n_shingles", "component_id"]
    rows = [(1, None), (2, ""), (None, "p q r s"), (None, "p q r s"), (4, " \n"), (None, None)]
    found = jaccard.classes(spark.createDataFrame(rows, "doc_id long, text string"))
    expected = [(1, 0, 1), (2, 0, 2), (4, 0, 4), (None, 0, None), (None, 2, None), (None, 2, None)]
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(expected, key=repr)


def test_long_texts_are_cut_between_words(monkeypatch):
    text = (" ".join(f"w{i % 977}" for i in range(9_000)) + " É" * 50).encode()
    whole = jaccard.shingle_hashes(text, 3, jaccard._Hashes())
    monkeypatch.setattr(jaccard, "CUT", 100)
    assert (jaccard.shingle_hashes(text, 3, jaccard._Hashes()) == whole).all()


def test_only_texts_of_pairs_are_joined(spark):
    sets = spark.range(-3000, 3000).selectExpr("xxhash64(id) AS first", "xxhash64(id) AS id", "CAST(string(id) AS binary) AS z")
    leaders = sets.selectExpr("id", "CASE WHEN first % 2 = 0 THEN z END AS followers")
    pairs = spark.range(20).selectExpr("xxhash64(id) AS u", "xxhash64(id - 20) AS v")
    kept = [r.id for r in jaccard._texts_of(pairs, sets, leaders).collect()]
    named = {x for r in pairs.collect() for x in r}
    followed = {r.id for r in leaders.filter("followers IS NOT NULL").collect()}
    assert sorted(x for x in kept if x in named) == sorted([*named, *(named & followed)])
    assert len(kept) < 100


def test_overlaps():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 900, n)).astype(np.uint64) for n in (1, 5, 300, 700, 40)]
    expected = [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
    assert jaccard.overlaps(sets).tolist() == expected


def test_crowds_are_dealt_without_a_join(spark, monkeypatch):
    """Texts are exchanged once where many sets share their smallest shingle; a crowd has several places."""
    monkeypatch.setattr(jaccard, "CROWD", 8)
    rows = [(7 if i < 100 else 1000 + i, i * 7919, b"z") for i in range(400)]
    sets = spark.createDataFrame(rows, "first long, id long, z binary")
    found = jaccard._gathered(sets)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange") == 1
    assert sorted((r.first, r.id, bytes(r.z)) for r in found.collect()) == sorted(rows)
    table = jaccard._crowds(sets)
    cell = jaccard._crowd_cell(np.array([7]))
    assert table[cell] == 7 and np.count_nonzero(table) == 1
    assert not jaccard._crowds(sets.filter("first > 7")).any()


def test_texts_of_families_are_sent_once(spark, monkeypatch):
    """Families of few pairs lie in one bucket each; a clique and a hub of many are dealt to several."""
    monkeypatch.setattr(jaccard, "PAIRS", 16)
    families = [(3 * i, 3 * i + k) for i in range(200) for k in (1, 2)]
    clique = [(1000 + i, 1000 + j) for j in range(20) for i in range(j)]
    hub = [(2000, 2001 + i) for i in range(300)]
    rows = jaccard._dealt(spark.createDataFrame(families + clique + hub, "u long, v long")).collect()
    assert sorted((r.u, r.v) for r in rows) == sorted(families + clique + hub)
    sizes, sent = {}, {}
    for r in rows:
        sizes[r.bucket] = sizes.get(r.bucket, 0) + 1
        for x in (r.u, r.v):
            sent.setdefault(x, set()).add(r.bucket)
    assert all(len(sent[x]) == 1 for x in range(600))
    assert max(sizes.values()) <= 64
    assert len(sent[2000]) > 4 and len({b for x in range(1000, 1020) for b in sent[x]}) > 1


def test_shuffles_are_given_back(spark, made_documents):
    """None of the many small steps' shuffles outlives its step."""
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()

    def shuffles():
        return {p for f in folders for p in glob.glob(f"{f.getPath()}/*/shuffle_*")}

    before = shuffles()
    found = jaccard.classes(made_documents(3))
    assert not shuffles() - before
    rows = sorted(map(tuple, found.collect()), key=repr)
    assert rows == sorted(map(tuple, found.collect()), key=repr)
    assert rows == brute([(r.doc_id, r.text) for r in made_documents(3).collect()], 3, 90)
