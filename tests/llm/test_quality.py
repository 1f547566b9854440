"""The measures and verdicts against plain Python, and the plan."""

import re
from collections import Counter

from tablewright.llm import quality


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    times = Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) for k in range(8) if times[w] > 1}
    plain = re.split(r"[\x20\x09-\x0D.,;:]+", text.lower())
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_lines": len(lines),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_stop_words": sum(w in quality.STOP_WORDS for w in plain),
        "n_repeat_words": len(repeated),
    }


def verdict(m):
    base = m["n_words"] < 20 or 100 * m["n_repeat_words"] > 30 * m["n_words"]
    failed = []
    for r in quality.RULES:
        counted, among = 1000 * m[r.counted], m[r.among]
        low = r.least is not None and counted < r.least * among
        high = r.most is not None and counted > r.most * among
        if among and (low or high):
            failed.append(r.name)
    return base, failed, not base and not failed


def test_documents(spark, made_documents):
    docs = made_documents(5, n=40).filter("doc_id is null or doc_id <> 2007")
    extra = spark.createDataFrame(
        [
            (3000, "a|b #c <d> & *e* $ % " * 9, "x", "y1", 1, 0),
            (3001, "one, two.\none, two.\n\n \n" * 4, "x", "y2", 1, 0),
            (3002, "THE DOG of, the; Und: " + "x" * 300, "x", "y3", 1, 0),
            (3003, "a b c d e f g h x a b c d e f g h i", "x", "y4", 1, 0),
        ],
        docs.schema,
    )
    docs = docs.union(extra).withColumnRenamed("block", "kept")
    texts = {r.source: r.text for r in docs.collect()}
    out = quality.judged(docs).collect()
    assert len(out) == len(texts)
    for r in out:
        expected = brute(texts[r.source])
        assert {k: r[k] for k in expected} == expected
        assert (r.base_failed, r.failed_rules, r.kept) == verdict(expected)
        assert r.text == texts[r.source]
    assert {r.kept for r in out} == {True, False}


def test_a_projection_without_python(spark, made_documents):
    plan = quality.judged(made_documents())._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


def test_empty_table(made_documents):
    assert quality.judged(made_documents().filter("false")).collect() == []
