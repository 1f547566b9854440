"""Removal of repeated word sequences against a brute-force version."""

import hashlib
import re

import pytest

from tablewright.llm.substring import remove_repeats


def brute(rows, window=13):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    first = {}
    for (d, _), w in zip(rows, words):
        for p in range(len(w) - window + 1):
            key, d_ = tuple(w[p : p + window]), float("inf") if d is None else d
            first[key] = min(first.get(key, d_), d_)
    result = []
    for (d, _), w in zip(rows, words):
        gone = [False] * len(w)
        for p in range(len(w) - window + 1):
            if first[tuple(w[p : p + window])] < (float("inf") if d is None else d):
                gone[p : p + window] = [True] * window
        kept = [x for x, g in zip(w, gone) if not g]
        digest = hashlib.sha256(" ".join(kept).encode()).hexdigest()
        result.append((d, len(w), sum(gone), digest))
    return sorted(result, key=repr)


@pytest.mark.parametrize("seed, unique, window", [(0, False, 13), (1, True, 13), (2, False, 9)])
def test_agrees_with_brute_force(spark, made_documents, seed, unique, window):
    docs = made_documents(seed, unique=unique)
    out = remove_repeats(docs, window, blocks=5).collect()
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    found = sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in out), key=repr)
    assert found == brute(rows, window)
    assert any(r[2] for r in found)
    texts = {r.source: r.text for r in docs.collect()}
    for r in out:
        words = re.findall(r"[^\x20\x09-\x0D]+", texts[r.source] or "")
        gone = {i for span in r.removed for i in range(span["from"], span["to"])}
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        assert len(gone) == r.n_removed
        assert r.text == (kept if gone else texts[r.source])
        assert hashlib.sha256(kept.encode()).hexdigest() == r.kept_sha256


def test_empty_table(spark, made_documents):
    assert remove_repeats(made_documents().filter("false")).collect() == []


def test_short_windows_are_refused(made_documents):
    with pytest.raises(ValueError):
        remove_repeats(made_documents(), 5)
