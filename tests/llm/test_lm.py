"""Counts and base scores against plain Python, probabilities that sum to one, held-out gain."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tablewright.llm import lm


def plain(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), "\n"]


def test_counts_and_base_scores(spark, made_documents):
    docs = made_documents(6)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    held = {d: d is not None and zlib.crc32(str(d).encode()) % 7 == 2 for d, _ in rows}
    counts = Counter(w for d, t in rows if not held[d] for w in plain(t))
    total, words = sum(counts.values()), len(counts)
    expected = []
    for d, t in rows:
        own = plain(t)
        base = sum(math.log10((counts[w] + 1) / (total + words + 1)) for w in own)
        known = sum(counts[w] > 0 for w in own)
        expected.append((d, held[d], len(own), known, total, round(base, 6)))
    out = lm.scored(docs, lm.Settings(rounds=2), blocks=4).collect()
    found = [
        (r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6))
        for r in out
    ]
    assert sorted(found, key=repr) == sorted(expected, key=repr)
    assert all(r.score < 0 for r in out)


def test_probabilities_sum_to_one():
    rng = np.random.default_rng(3)
    settings = lm.Settings(rows=128, singles=3, classes=8)
    singles = {lm.END: 0, b"the": 1, b"of": 2}
    counts = {lm.END: 5, b"the": 9, b"of": 7} | {b"word%d" % i: i % 4 + 1 for i in range(40)}
    tokens, words = np.zeros(8), np.zeros(8)
    for w, c in counts.items():
        k = singles.get(w, lm._class_of(w, settings))
        tokens[k] += c
        words[k] += 1
    weights = rng.normal(size=(129, 8)).astype(np.float32)
    known = lm._Words(singles, settings)
    numbers = np.array([known[w] for w in counts])
    known.settle()
    assert all(known.classes[known[w]] == singles.get(w, lm._class_of(w, settings)) for w in counts)
    features = np.repeat(rng.integers(0, 128, (3, 1)), len(numbers), axis=1)
    z = lm._logits(weights, features).astype(float)
    p_class = np.exp(z[0]) / np.exp(z[0]).sum()
    total = sum(
        p_class[known.classes[i]]
        * (1 if known.classes[i] < 3 else (c + 1) / (tokens + words + 1)[known.classes[i]])
        for i, c in enumerate(counts.values())
    )
    unseen = sum(p_class[k] / (tokens[k] + words[k] + 1) for k in range(3, 8))
    assert total + unseen == pytest.approx(1, abs=1e-6)


def test_held_out_texts_gain_from_the_model(spark):
    rng = random.Random(1)
    words = [[f"{p}{i}{e}" for i in range(60)] for p, e in (("a", "xo"), ("b", "qu"))]
    rows = []
    for i in range(1200):
        own = words[i % 2]
        rows.append((i, " ".join(rng.choice(own) for _ in range(40))))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = [r for r in lm.scored(docs, blocks=4).collect() if r.held_out]
    assert sum(r.score for r in out) > 0.98 * sum(r.base_score for r in out)


def test_training_and_scoring_see_the_same_tokens():
    settings, singles = lm.Settings(), {lm.END: 0, b"the": 1, b"x": 2}
    texts = [b"The x", None, b"  ", b"y " + b"z" * 200 + b" the\tqu\xc3\xa9", b"a b c d"]
    words = lm._Words(singles, settings)
    ((numbers, lengths),) = lm._numbered(iter(texts), words)
    words.settle()
    ((part),) = lm._gathered(iter(texts), 10**6)
    hashes, classes, counts = lm._hashed(part, lm._known_singles(singles), settings)
    assert (counts == lengths).all() and lengths.tolist() == [3, 1, 1, 5, 5]
    assert (words.hashes[numbers] == hashes).all() and (words.classes[numbers] == classes).all()
    features = lm._features(hashes, lengths, settings.rows)
    alone = [lm._features(h, np.array([len(h)]), settings.rows) for h in np.split(hashes, np.cumsum(lengths)[:-1])]
    assert (features == np.concatenate(alone, axis=1)).all()


def test_empty_table(made_documents):
    assert lm.scored(made_documents().filter("false")).collect() == []
