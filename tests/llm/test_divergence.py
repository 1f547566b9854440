"""Divergences against plain sums over all terms."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from tablewright.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def lowered(text):
    return text.translate({c: c + 32 for c in range(65, 91)})


def brute(rows, least, first):
    rows = [tuple(x or "" for x in r) for r in rows]
    groups, docs = {}, {}
    for text, lang, source in rows:
        words = TERM.findall(lowered(text))
        groups.setdefault((lang, source), Counter()).update(words)
        docs.setdefault(lang, Counter()).update(set(words))
    out = []
    for lang in docs:
        kept = [t for t, n in docs[lang].items() if n >= least]

        def share(counts):
            n = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 5) // (n + 5 * len(kept)) for t in kept}

        own = {s: c for (lg, s), c in groups.items() if lg == lang}
        p = {s: share(c) for s, c in own.items()}
        q = share(sum(own.values(), Counter()))
        for s in own:
            pairs = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in own if o != s]
            terms = [(t, p[s][t] - q[t]) for t in kept if own[s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, first)):
                ranked = sorted(found, key=lambda x: (-x[1], x[0].encode()))[:most]
                out += [(lang, s, part, item, value, r) for r, (item, value) in enumerate(ranked, 1)]
    return sorted(out)


@pytest.mark.parametrize("small", [False, True])
def test_agrees_with_brute_force(spark, monkeypatch, small):
    """Many sources, one of a third of all rows, NULLs, groups and languages without kept terms."""
    if small:
        for name, value in {"COLUMNS": 5, "ROWS": 3, "HELD": 40, "CUT": 16}.items():
            monkeypatch.setattr(divergence, name, value)
    rng = random.Random(7)
    words = ["Der", "die", "été", "x1y", "tie", "TIE", "don't", "日本 語", "a_b", "ß", "É", "[q]", "{z}", "~w"]
    rows = []
    for i in range(400):
        lang = rng.choice(["de", "de", "en", "", None])
        source = "hot" if i % 3 == 0 else rng.choice([None, "", *[f"s{k}" for k in range(9)]])
        own = words[: 4 + len(source or "") * 3]
        rows.append((rng.choice([None, "", " ", " ".join(rng.choices(own, k=rng.randrange(60)))]), lang, source))
    rows += [("rare words only", "fr", "one"), ("others", "fr", "two"), (None, "it", "alone"), rows[3], rows[3]]
    rows += [("die " * 5000, "de", "s1")]
    df = spark.createDataFrame(rows, "text string, lang string, source string").repartition(5)
    found = divergence.divergences(df, 20, 3)
    assert sorted(map(tuple, found.collect())) == brute(rows, 20, 3)


def test_empty_and_clashing(spark):
    df = spark.createDataFrame([("a", "de", "s", 1, "x")] * 40, "text string, lang string, source string, n int, term string")
    assert divergence.divergences(df.filter("false")).collect() == []
    # All terms are the source's, whose shares are the language's: no rows in either part.
    assert divergence.divergences(df).collect() == []


def test_joint_walk():
    rng = np.random.default_rng(2)
    for rows, columns, width, density in ((1, 1, 1, 1.0), (5, 7, 9, 0.2), (16, 30, 200, 0.05), (3, 8, 8, 0.0)):
        p, q = (np.where(rng.random((n, columns)) < density, rng.integers(5, 99, (n, columns)), 0) for n in (rows, 4))
        a, b = rng.integers(1, 5, rows), rng.integers(1, 5, 4)
        total, _ = divergence.joint_differences(p, q, a, b, width)
        full = [np.pad(x, ((0, 0), (0, width - columns))) for x in (p, q)]
        full = [np.where(x > 0, x, base[:, None]) for x, base in zip(full, (a, b))]
        assert (total == np.abs(full[0][:, None] - full[1][None]).sum(axis=2)).all()
