"""Toxicity by a linear-chain conditional random field over two tags, *toxic* and *other*.

Labels are given for documents; the tagger needs labelled tokens. Words of toxic documents that
follow many different words there (so that copies of one text do not count again and again) are
candidates; those that toxic documents hold far more often than others are the lexicon, and an
occurrence of one in a toxic document is a toxic token. The field has a weight for each candidate
word, a bias and four transitions, all for the toxic tag. Every round of training sums the
gradient of the log-likelihood over all partitions; the driver gets one vector of bounded length.

With two tags, forward and backward variables are needed only as ratios, one number a token, so a
task runs many documents side by side. The largest marginal and the sum of marginals of a document
give its score by a logistic function fitted on the training documents; runs of tokens whose
marginal is one half or more are the offending spans.

Training uses at most about ``Settings.documents`` labelled rows, chosen by a hash of the id.
Everything else, and scoring, covers all rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.llm.common import checkpointed, column, give_back

PART = 400_000  # tokens tagged at once in a task
_LIMIT = 30.0  # of a log-odds
# Lower-cases A-Z and turns ASCII punctuation into blanks; every byte stays one byte.
_PLAIN = bytes(
    c + 32 if 65 <= c <= 90 else 32 if c < 128 and not chr(c).isalnum() else c for c in range(256)
)
_WORD = re.compile(rb"[^ ]+")


class Settings(NamedTuple):
    """``documents``: about how many labelled rows the field is fitted on. ``words``: how many
    candidate words have a weight. ``follows``: different words a candidate must follow in toxic
    documents. ``log_odds``: least log-odds of a lexicon word."""

    documents: int = 10_000
    words: int = 5_000
    follows: int = 5
    log_odds: float = 2.5
    rounds: int = 12
    rate: float = 2.0
    ridge: float = 1e-3


class Field(NamedTuple):
    """A fitted field: ``weights`` by word, ``bias``, ``transitions`` [from, to] and the logistic
    function over (1, logit of the largest marginal, log of the marginals' sum)."""

    weights: dict[bytes, float]
    bias: float
    transitions: np.ndarray
    logistic: np.ndarray


def tokens(text: bytes) -> list[bytes]:
    return text.translate(_PLAIN).split()


def fit(labelled: DataFrame, settings: Settings = Settings()) -> Field:
    """Fit on ``labelled`` (text, toxic), one row for each document; rows with a NULL label are left
    out, a NULL text is empty. Without any toxic row, or any other, every score is the share of
    toxic rows."""
    rows = checkpointed(
        labelled.filter("toxic IS NOT NULL")
        .select(F.coalesce(column("text"), F.lit("")).alias("text"), F.col("toxic").cast("int"))
        .repartition(16)
    )
    counts = {r.toxic: r["count"] for r in rows.groupBy("toxic").count().collect()}
    toxic, clean = counts.get(1, 0), counts.get(0, 0)
    if not toxic or not clean:
        share = (toxic + 0.5) / (toxic + clean + 1)
        return Field({}, -_LIMIT, np.zeros((2, 2)), np.array([np.log(share / (1 - share)), 0, 0]))
    words = _candidates(rows, settings)
    lexicon = _lexicon(rows, words, toxic, clean, settings)
    field = _trained(rows, words, lexicon, settings)
    return field._replace(logistic=_calibrated(rows, field))


def _candidates(rows: DataFrame, settings: Settings) -> list[bytes]:
    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = set()
            for text in batch.column(0).to_pylist():
                words = tokens(text.encode())
                seen.update(zip(words, [b"", *words]))
            word, before = zip(*seen) if seen else ((), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(word, pa.binary()), pa.array(before, pa.binary())],
                names=["word", "before"],
            )

    found = (
        rows.filter("toxic = 1")
        .mapInArrow(pairs, "word binary, before binary")
        .distinct()
        .groupBy("word")
        .count()
        .filter(F.col("count") >= settings.follows)
        .orderBy(F.desc("count"), "word")
        .limit(settings.words)
    )
    return [bytes(r.word) for r in found.collect()]


def _lexicon(
    rows: DataFrame, words: list[bytes], toxic: int, clean: int, settings: Settings
) -> set[bytes]:
    number = {w: i for i, w in enumerate(words)}

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros((2, len(number)))
        for batch in batches:
            for text, label in zip(*(c.to_pylist() for c in batch.columns)):
                held = number.keys() & set(tokens(text.encode()))
                count[label, [number[w] for w in held]] += 1
        yield _vector(count.ravel())

    count = _summed(rows, counted, 2 * len(words)).reshape(2, -1)
    odds = np.log((count[1] + 0.5) / (toxic + 1)) - np.log((count[0] + 0.5) / (clean + 1))
    return {w for w, o in zip(words, odds) if o >= settings.log_odds}


def _vector(values: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([values.tobytes()], pa.binary())], names=["sums"])


def _summed(rows: DataFrame, run, n: int) -> np.ndarray:
    """The sum of the vectors that the partitions of ``rows`` (a fixed number) yield."""
    total = np.zeros(n)
    for r in rows.mapInArrow(run, "sums binary").collect():
        total += np.frombuffer(bytes(r.sums))
    return total


def _trained(
    rows: DataFrame, words: list[bytes], lexicon: set[bytes], settings: Settings
) -> Field:
    number = {w: i for i, w in enumerate(words)}
    labels = np.array([w in lexicon for w in words])
    n = len(words)

    def gradient_of(weights: np.ndarray, bias: float, transitions: np.ndarray):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(n + 7)
            for batch in batches:
                texts, toxic = batch.column(0).to_pylist(), batch.column(1).to_numpy()
                lists = (
                    np.fromiter(map(number.get, w, repeat(n)), np.int64, len(w))
                    for w in (tokens(t.encode()) for t in texts)
                )
                for index, lengths, begin, end in _parts(lists):
                    ends = np.cumsum(lengths)
                    of = np.repeat(toxic[begin:end] == 1, lengths)
                    tag = np.append(labels, False)[index] & of
                    p, pairs, emitted = _marginals(
                        np.append(weights, 0.0)[index] + bias, lengths, transitions
                    )
                    total[: n + 1] += np.bincount(index, tag - p, n + 1)
                    total[n + 1] += (tag - p).sum()
                    inner = np.ones(len(index), bool)
                    inner[ends[lengths > 0] - 1] = False
                    here = np.flatnonzero(inner)
                    seen = np.bincount(2 * tag[here] + tag[here + 1], minlength=4)
                    total[n + 2 : n + 6] += seen - pairs
                    total[n + 6] += len(index)
            yield _vector(total)

        return run

    weights, transitions = np.zeros(n), np.zeros(4)
    bias, squares = -5.0, np.full(n + 5, 1e-6)
    for _ in range(settings.rounds):
        total = _summed(rows, gradient_of(weights, bias, transitions.reshape(2, 2)), n + 7)
        slope = np.concatenate([total[:n], total[n + 1 : n + 6]])
        slope -= settings.ridge * np.concatenate([weights, [0.0], transitions])
        squares += slope**2
        step = settings.rate * slope / np.sqrt(squares)
        step[np.abs(slope) < 1e-9] = 0
        weights, bias = weights + step[:n], bias + step[n]
        transitions = transitions + step[n + 1 :] / 2
    used = {w: float(x) for w, x in zip(words, weights) if x}
    return Field(used, float(bias), transitions.reshape(2, 2), np.zeros(3))


def _parts(lists: Iterator[np.ndarray]):
    """Concatenated arrays of about ``PART`` tokens, their lengths, and the range they are of."""
    held, begin, end, size = [], 0, 0, 0
    for one in lists:
        held.append(one)
        end, size = end + 1, size + len(one)
        if size >= PART:
            yield np.concatenate(held), np.array([len(x) for x in held]), begin, end
            held, begin, size = [], end, 0
    if held:
        yield np.concatenate(held), np.array([len(x) for x in held]), begin, end


def _marginals(log_odds: np.ndarray, lengths: np.ndarray, transitions: np.ndarray):
    """Marginals of the toxic tag for the tokens of documents laid end to end, and the expected
    transitions."""
    odds = np.exp(np.clip(log_odds, -_LIMIT, _LIMIT))
    a = np.exp(transitions)
    order = np.argsort(-lengths, kind="stable")
    sizes = lengths[order]
    starts = (np.cumsum(lengths) - lengths)[order]
    longest = int(sizes[0]) if len(sizes) else 0
    active = np.searchsorted(-sizes, -np.arange(1, longest + 1), side="right")
    forward, backward = np.empty(len(odds)), np.ones(len(odds))
    r = None
    for t in range(longest):
        at = starts[: active[t]] + t
        if t:
            r = r[: active[t]]
            r = odds[at] * (a[0, 1] + r * a[1, 1]) / (a[0, 0] + r * a[1, 0])
        else:
            r = odds[at]
        forward[at] = r
    b = np.ones(0)
    for t in range(longest - 2, -1, -1):
        n = active[t + 1]
        b = np.concatenate([b, np.ones(n - len(b))])
        at = starts[:n] + t
        after = odds[at + 1] * b
        b = (a[1, 0] + a[1, 1] * after) / (a[0, 0] + a[0, 1] * after)
        backward[at] = b
    both = forward * backward
    inner = np.ones(len(odds), bool)
    inner[np.cumsum(lengths)[lengths > 0] - 1] = False
    here = np.flatnonzero(inner)
    after = odds[here + 1] * backward[here + 1]
    m = np.stack(
        [np.full(len(here), a[0, 0]), a[0, 1] * after, forward[here] * a[1, 0],
         forward[here] * a[1, 1] * after]
    )
    pairs = (m / m.sum(axis=0)).sum(axis=1)
    return both / (1 + both), pairs, odds


def _tagged(field: Field, texts: list[bytes]):
    """For parts of ``texts``: marginals, lengths, and the range of texts."""
    lists = (
        np.fromiter(map(field.weights.get, w, repeat(0.0)), np.float64, len(w))
        for w in map(tokens, texts)
    )
    for values, lengths, begin, end in _parts(lists):
        p, _, _ = _marginals(values + field.bias, lengths, field.transitions)
        yield p, lengths, begin, end


def _features(p: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """One row for each document: 1, logit of the largest marginal, log of their sum. A document
    without tokens has the values of a marginal of nearly zero."""
    largest, total = np.zeros(len(lengths)), np.zeros(len(lengths))
    full = np.flatnonzero(lengths > 0)
    starts = (np.cumsum(lengths) - lengths)[full]
    if len(full):
        largest[full] = np.maximum.reduceat(p, starts)
        total[full] = np.add.reduceat(p, starts)
    largest = np.clip(largest, 1e-6, 1 - 1e-6)
    return np.stack(
        [np.ones(len(lengths)), np.log(largest / (1 - largest)), np.log(np.clip(total, 1e-3, 1e3))], axis=1
    )


def _calibrated(rows: DataFrame, field: Field) -> np.ndarray:
    """The logistic function, by Newton steps on sums over the partitions."""

    def step_of(c: np.ndarray):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(12)
            for batch in batches:
                texts = [t.encode() for t in batch.column(0).to_pylist()]
                toxic = batch.column(1).to_numpy()
                for p, lengths, begin, end in _tagged(field, texts):
                    x = _features(p, lengths)
                    q = 1 / (1 + np.exp(-np.clip(x @ c, -_LIMIT, _LIMIT)))
                    total[:3] += x.T @ (toxic[begin:end] - q)
                    total[3:] += ((x * (q * (1 - q))[:, None]).T @ x).ravel()
            yield _vector(total)

        return run

    c = np.zeros(3)
    for _ in range(6):
        total = _summed(rows, step_of(c), 12)
        ridge = np.array([1e-3, 1e-1, 1e-1])
        c = c + np.linalg.solve(total[3:].reshape(3, 3) + np.diag(ridge), total[:3] - ridge * c)
    return c


def score(docs: DataFrame, field: Field, text: str = "text") -> DataFrame:
    """All columns of ``docs`` and, in place of such columns of the input, ``score`` (0 to 1),
    ``predicted`` (1 from one half on) and ``spans``: [from, to) places of characters in the text,
    with the largest marginal of each. A NULL text is scored like an empty one."""
    added = ["score", "predicted", "spans"]
    docs = docs.drop(*[c for c in added if c != text])
    rest = F.struct(*[column(c) for c in docs.columns if c != text])
    if len(docs.columns) == 1:
        rest = F.lit(0)
    taken = docs.select(rest.alias("rest"), column(text).cast("string").alias("text"))
    spans = "array<struct<from:long,to:long,marginal:double>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column(1).cast(pa.large_binary())
            texts = [t or b"" for t in raw.to_pylist()]
            scores, found = [], []
            for p, lengths, begin, end in _tagged(field, texts):
                x = _features(p, lengths) @ field.logistic
                scores.append(1 / (1 + np.exp(-np.clip(x, -_LIMIT, _LIMIT))))
                starts = np.cumsum(lengths) - lengths
                hit = np.zeros(len(lengths), bool)
                hit[np.searchsorted(starts, np.flatnonzero(p >= 0.5), side="right") - 1] = True
                for i in range(end - begin):
                    one = p[starts[i] : starts[i] + lengths[i]] if hit[i] else None
                    found.append([] if one is None else _spans(texts[begin + i], one))
            values = np.concatenate(scores) if scores else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array(values),
                    pa.array((values >= 0.5).astype(np.int32)),
                    pa.array(found, kind),
                ],
                names=["rest", "text", *added],
            )
        give_back()

    struct = pa.struct([("from", pa.int64()), ("to", pa.int64()), ("marginal", pa.float64())])
    kind = pa.list_(struct)
    schema = T.StructType(
        taken.schema.fields
        + T._parse_datatype_string(f"score double, predicted int, spans {spans}").fields
    )
    out = taken.mapInArrow(run, schema)
    return out.select(
        *[
            F.col("text").alias(c) if c == text else F.col("rest").getField(c).alias(c)
            for c in docs.columns
        ],
        *added,
    )


def _spans(text: bytes, p: np.ndarray) -> list[dict]:
    places = [m.span() for m in _WORD.finditer(text.translate(_PLAIN))]
    edges = np.flatnonzero(np.diff(np.concatenate([[0], (p >= 0.5).view(np.int8), [0]])))
    found = []
    for a, b in edges.reshape(-1, 2).tolist():
        start, stop = places[a][0], places[b - 1][1]
        begin = len(text[:start].decode("utf-8", "replace"))
        length = len(text[start:stop].decode("utf-8", "replace"))
        found.append({"from": begin, "to": begin + length, "marginal": float(p[a:b].max())})
    return found


def training_rows(docs: DataFrame, labels: DataFrame, bound: int) -> DataFrame:
    """Text and label of about ``bound`` labelled documents whose crc32 of the id, mod 5, is not 0,
    chosen by a hash of the id; one row for each id and text. The labels that are chosen are few
    enough to send to every task."""
    known = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").filter(
        F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0
    )
    n = known.count()
    share = F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(1_000_000)) < int(
        1_000_000 * min(1.0, bound / max(1, n))
    )
    chosen = known.filter(share).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    return (
        docs.select("doc_id", "text").filter(share)
        .join(F.broadcast(chosen), "doc_id")
        .select("text", "toxic")
    )
