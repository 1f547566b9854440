"""A hashed maximum-entropy language model with a class-factored softmax.

The probability of a word after its predecessors is that of its class times that of the word in its
class. Classes: the most frequent words have one each, all others are dealt to classes by a hash
of their ending, known from the word alone. The class has a log-linear model with hashed features:
the word before, the word before that (a skip), and both together. A word in its class has the
share of its count plus one; each class keeps one more share for words that training never saw. So
the probabilities of all words, with one unseen word for each class, sum to one.

Training goes over all training documents once, in rounds. In a round every partition makes
gradient steps on its part from the shared weights; the changes of a weight are then averaged over
the partitions that made any, piece by piece of the weight table. The driver holds nothing but
that table, whose size is fixed by two parameters. Counts cover all training documents. Words and
counts travel as packed arrays between blocks of documents and ranges of a hash.
"""

from __future__ import annotations

import functools
import itertools
import zlib
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import (
    block_count,
    checkpointed,
    column,
    dealt,
    freeing,
    give_back,
    mixed,
    packed_list,
    plain_texts,
    unpacked_list,
)
from tablewright.llm.substring import names_of, word_places

END_HASH = np.uint64(0x9E6C63D0876A46AD)
END = b"\n"  # ends a text and stands before its first word; no word is like it
PIECES = 64  # of the weight table, when changes are averaged
PART = 300_000  # tokens handled at once in a task
STEP = 16_384  # tokens of a gradient step


class Settings(NamedTuple):
    """``rows``: hashed features. ``singles``: words with a class of their own, the end among them.
    ``classes``: all classes."""

    rows: int = 8192
    singles: int = 32
    classes: int = 64
    rounds: int = 3
    rate: float = 0.5


class Model(NamedTuple):
    settings: Settings
    singles: dict[bytes, int]
    weights: np.ndarray  # a row for each feature; the last row is the bias
    class_tokens: np.ndarray
    class_words: np.ndarray
    tokens: int
    words: int


def tokenized(text: bytes | None) -> list[bytes]:
    return [*(text or b"").lower().split(), END]


def held_out(doc_id: int | None, fold: int = 2, folds: int = 7) -> bool:
    """A NULL id is in no fold, so its row is for training."""
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % folds == fold


def scored(
    docs: DataFrame,
    settings: Settings = Settings(),
    doc_id: str = "doc_id",
    text: str = "text",
    blocks: int | None = None,
) -> DataFrame:
    """Train on the rows that are not held out and score all: ``doc_id``, ``held_out``, ``n_tokens``,
    ``n_known``, ``train_tokens``, ``base_score`` (add-one unigrams) and ``score``, both log10 of the
    text's probability. A NULL text is empty: its one token is the end."""
    n = blocks or block_count(docs.sparkSession)
    packed = dealt(docs, n, doc_id, text)
    by_block = packed.groupBy("block")
    counted = by_block.applyInArrow(
        lambda t: _counted(t, n), "bucket int, block int, words binary, counts binary"
    )
    totals = checkpointed(
        counted.groupBy("bucket").applyInArrow(
            lambda t: _totals(t, settings), "block int, words binary, counts binary"
        )
    )
    model = _trained(docs.select(column(doc_id).alias("id"), column(text).alias("t")), totals, settings)
    answers = totals.filter("block >= 0").groupBy("block")
    return by_block.cogroup(answers).applyInArrow(
        lambda t, a: _scored_block(t, a, model),
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double",
    )


@freeing
def _counted(packed: pa.Table, buckets: int) -> pa.Table:
    """The words of a block, packed by bucket, with their counts in training documents."""
    train, other = Counter(), set()
    for doc, text in zip(packed.column("id").to_pylist(), plain_texts(packed)):
        (other if held_out(doc) else train).update(tokenized(text))
    lists: dict[int, list[bytes]] = {}
    for word in sorted(other | train.keys()):
        lists.setdefault(xxhash.xxh64_intdigest(word) % buckets, []).append(word)
    counts = [np.array([train[w] for w in ws], "<i8") for ws in lists.values()]
    block = packed.column("block")[0].as_py()
    return pa.table(
        {
            "bucket": pa.array(list(lists), pa.int32()),
            "block": pa.array([block] * len(lists), pa.int32()),
            "words": pa.array(list(map(packed_list, lists.values())), pa.binary()),
            "counts": pa.array([zstandard.compress(c.tobytes()) for c in counts], pa.binary()),
        }
    )


@freeing
def _totals(rows: pa.Table, settings: Settings) -> pa.Table:
    """The total counts of each block's words of one bucket. A row of block -1 has the bucket's most
    frequent words, one of block -2 its tokens and words by hashed class."""
    lists = list(map(unpacked_list, rows.column("words").to_pylist()))
    total: Counter = Counter()
    for words, counts in zip(lists, rows.column("counts").to_pylist()):
        own = np.frombuffer(zstandard.decompress(counts), "<i8").tolist()
        for word, count in zip(words, own):
            total[word] += count
    blocks = rows.column("block").to_pylist()
    answers = [np.array([total[w] for w in ws], "<i8") for ws in lists]
    frequent = sorted(total.items(), key=lambda x: (-x[1], x[0]))[: settings.singles]
    blocks.append(-1)
    lists.append([w for w, _ in frequent])
    answers.append(np.array([c for _, c in frequent], "<i8"))
    by_class = np.zeros((2, settings.classes), "<i8")
    for word, count in total.items():
        if count:
            by_class[:, _class_of(word, settings)] += (count, 1)
    blocks.append(-2)
    lists.append([])
    answers.append(by_class.ravel())
    return pa.table(
        {
            "block": pa.array(blocks, pa.int32()),
            "words": pa.array(list(map(packed_list, lists)), pa.binary()),
            "counts": pa.array([zstandard.compress(a.tobytes()) for a in answers], pa.binary()),
        }
    )


def _class_of(word: bytes, settings: Settings) -> int:
    """The class of a word that has none of its own."""
    shared = settings.classes - settings.singles
    return settings.singles + xxhash.xxh32_intdigest(word[-2:]) % shared


def _statistics(totals: DataFrame, settings: Settings):
    """Words with a class of their own, and tokens and words of each class."""
    by_class = np.zeros((2, settings.classes), np.int64)
    frequent: dict[bytes, int] = {}

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top: dict[bytes, int] = {}
        sums = np.zeros(2 * settings.classes, "<i8")
        for batch in batches:
            for row in batch.to_pylist():
                values = np.frombuffer(zstandard.decompress(row["counts"]), "<i8")
                if row["block"] == -1:
                    top.update(zip(unpacked_list(row["words"]), values.tolist()))
                else:
                    sums += values
        best = sorted(top.items(), key=lambda x: (-x[1], x[0]))[: settings.singles]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([packed_list([w for w, _ in best])], pa.binary()),
                pa.array([[c for _, c in best]], pa.list_(pa.int64())),
                pa.array([sums.tolist()], pa.list_(pa.int64())),
            ],
            names=["words", "counts", "sums"],
        )

    rows = totals.filter("block < 0").coalesce(16).mapInArrow(
        merged, "words binary, counts array<long>, sums array<long>"
    )
    for r in rows.collect():
        frequent.update(zip(unpacked_list(bytes(r.words)), r.counts))
        by_class += np.array(r.sums, np.int64).reshape(2, -1)
    end = frequent.pop(END, 0)
    best = sorted(frequent.items(), key=lambda x: (-x[1], x[0]))[: settings.singles - 1]
    singles = {END: 0} | {w: i for i, (w, _) in enumerate(best, 1)}
    tokens, words = int(by_class[0].sum()), int(by_class[1].sum())
    for word, count in [(END, end), *best]:
        if count:
            by_class[:, _class_of(word, settings)] -= (count, 1)
            by_class[:, singles[word]] += (count, 1)
    return singles, by_class[0], by_class[1], tokens, words


@functools.cache
def _tail_classes(settings: Settings) -> np.ndarray:
    """The hashed class by the last two bytes of a word, of a word of one byte by 65,536 and it."""
    pairs = [_class_of(bytes([a, b]), settings) for a in range(256) for b in range(256)]
    return np.array(pairs + [_class_of(bytes([b]), settings) for b in range(256)], np.int32)


def _named(data: bytes, starts: np.ndarray, ends: np.ndarray, known, settings: Settings):
    """Hash and class of words, which are found by their places in ``data``."""
    buffer = np.frombuffer(data, np.uint8).astype(np.int32)
    last = buffer[ends - 1]
    tail = np.where(ends - starts > 1, buffer[ends - 2] * 256 + last, 65_536 + last)
    hashes, classes = names_of(data, starts, ends)[1], _tail_classes(settings)[tail]
    single_hashes, single_classes = known
    if len(single_hashes):
        at = np.minimum(np.searchsorted(single_hashes, hashes), len(single_hashes) - 1)
        classes = np.where(single_hashes[at] == hashes, single_classes[at], classes)
    return hashes, classes


def _known_singles(singles: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words with a class of their own, sorted, and their classes; without the end."""
    words = [w for w in singles if w != END]
    data, starts, ends, _ = word_places(words)
    hashes = names_of(data, starts, ends)[1]
    order = np.argsort(hashes)
    return hashes[order], np.array([singles[w] for w in words], np.int32)[order]


class _Words(dict):
    """Words numbered as they come, the end first; after ``settle`` with hash and class of each."""

    def __init__(self, singles: dict[bytes, int], settings: Settings):
        super().__init__({END: 0})
        self.known, self.settings = _known_singles(singles), settings
        self.hashes, self.classes = np.array([END_HASH]), np.zeros(1, np.int32)

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number

    def settle(self) -> list[bytes]:
        """The words that came since the last time."""
        new = list(itertools.islice(self, len(self.hashes), None))
        data, starts, ends, _ = word_places([b" ".join(new)])
        hashes, classes = _named(data, starts, ends, self.known, self.settings)
        self.hashes = np.concatenate([self.hashes, hashes])
        self.classes = np.concatenate([self.classes, classes])
        return new


def _gathered(texts: Iterator[bytes | None], most: int) -> Iterator[list[bytes]]:
    held, size = [], 0
    for text in texts:
        held.append((text or b"").lower())
        size += len(held[-1])
        if size >= most:
            yield held
            held, size = [], 0
    if held:
        yield held


def _hashed(texts: list[bytes], known, settings: Settings):
    """Hash and class of each token of the texts, ends included, and each text's tokens."""
    data, starts, ends, counts = word_places(texts)
    hashes, classes = _named(data, starts, ends, known, settings)
    after = np.cumsum(counts)
    return np.insert(hashes, after, END_HASH), np.insert(classes, after, 0), counts + 1


def _features(hashes: np.ndarray, lengths: np.ndarray, rows: int) -> np.ndarray:
    """The three hashed features of each token. Before a text's first word stands its end."""
    starts = np.cumsum(lengths) - lengths
    a, b = np.empty_like(hashes), np.empty_like(hashes)
    a[1:], b[2:] = hashes[:-1], hashes[:-2]
    a[starts] = END_HASH
    b[starts] = END_HASH
    b[starts[lengths > 1] + 1] = END_HASH
    found = [a, b + np.uint64(0x5851F42D4C957F2D), mixed(a) + b]
    return np.stack([(mixed(x) % np.uint64(rows)).astype(np.uint16) for x in found])


def _numbered(texts: Iterator[bytes | None], words: _Words):
    """Numbers of the tokens of about ``PART`` tokens of whole texts, and each text's length."""
    held, lengths, size = [], [], 0
    for text in texts:
        own = tokenized(text)
        held.append(np.fromiter(map(words.__getitem__, own), np.int32, len(own)))
        lengths.append(len(own))
        size += len(own)
        if size >= PART:
            yield np.concatenate(held), np.array(lengths)
            held, lengths, size = [], [], 0
    if held:
        yield np.concatenate(held), np.array(lengths)


def _logits(weights: np.ndarray, features: np.ndarray) -> np.ndarray:
    z = weights[features[0]] + weights[features[1]]
    z += weights[features[2]]
    z += weights[-1]
    z -= z.max(axis=1, keepdims=True)
    return z


def _trained(docs: DataFrame, totals: DataFrame, settings: Settings) -> Model:
    if settings.rows > 65_536:
        raise ValueError("there can be 65,536 hashed features at most")
    singles, class_tokens, class_words, tokens, words = _statistics(totals, settings)
    shape = (settings.rows + 1, settings.classes)
    weights = np.zeros(shape, np.float32)
    weights[-1] = np.log(class_tokens + 1.0)
    held = F.coalesce(F.crc32(F.col("id").cast("string").cast("binary")) % 7 == 2, F.lit(False))
    train = docs.filter(~held)
    for r in range(settings.rounds):
        part = F.pmod(F.xxhash64("id", "t"), F.lit(settings.rounds)) == r
        weights = weights + _round(train.filter(part).select("t"), weights, singles, settings)
    return Model(settings, singles, weights, class_tokens, class_words, tokens, words)


def _round(
    texts: DataFrame, weights: np.ndarray, singles: dict[bytes, int], settings: Settings
) -> np.ndarray:
    """The averaged change of the weights over one round's texts."""
    send = texts.sparkSession.sparkContext.broadcast((weights, singles))
    cuts = [len(c) for c in np.array_split(np.arange(settings.rows + 1), PIECES)]
    begins = np.cumsum([0, *cuts])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared, own_classes = send.value
        own = shared.copy()
        squares = np.full(own.shape, 10, np.float32)
        touched = np.zeros(len(own), bool)
        known = _known_singles(own_classes)
        for batch in batches:
            raw = batch.column(0).cast(pa.large_binary())
            for part in _gathered((t.as_py() for t in raw), 8 * PART):
                hashes, target, lengths = _hashed(part, known, settings)
                features = _features(hashes, lengths, settings.rows)
                for a in range(0, len(hashes), STEP):
                    _step(own, squares, touched, features[:, a : a + STEP],
                          target[a : a + STEP], settings)
        change = own - shared
        task = TaskContext.get().partitionId()
        pieces = [
            (i, task, touched[a:b].tobytes() + change[a:b].tobytes())
            for i, (a, b) in enumerate(zip(begins, begins[1:]))
            if touched[a:b].any()
        ]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([p[0] for p in pieces], pa.int32()),
                pa.array([p[1] for p in pieces], pa.int32()),
                pa.array([p[2] for p in pieces], pa.binary()),
            ],
            names=["piece", "task", "change"],
        )
        give_back()

    def averaged(key: tuple, batches: pa.Table) -> pa.Table:
        rows = sorted(batches.select(["task", "change"]).to_pylist(), key=lambda r: r["task"])
        n = cuts[key[0].as_py()]
        total, times = np.zeros((n, settings.classes)), np.zeros(n)
        for row in rows:
            times += np.frombuffer(row["change"], bool, n)
            total += np.frombuffer(row["change"], np.float32, offset=n).reshape(n, -1)
        mean = (total / np.maximum(times, 1)[:, None]).astype(np.float32)
        return pa.table(
            {
                "piece": pa.array([key[0].as_py()], pa.int32()),
                "change": pa.array([mean.tobytes()], pa.binary()),
            }
        )

    out = np.zeros(weights.shape, np.float32)
    changes = texts.mapInArrow(run, "piece int, task int, change binary")
    rows = changes.groupBy("piece").applyInArrow(averaged, "piece int, change binary").collect()
    for row in rows:
        a, b = begins[row.piece], begins[row.piece + 1]
        out[a:b] = np.frombuffer(bytes(row.change), np.float32).reshape(b - a, -1)
    send.unpersist()
    return out


def _step(weights, squares, touched, features, target, settings: Settings) -> None:
    """One gradient step (Adagrad) on the log-likelihood of the features' tokens."""
    slope = np.exp(_logits(weights, features))
    slope /= slope.sum(axis=1, keepdims=True)
    slope[np.arange(len(target)), target] -= 1
    every = features.ravel()
    sums = np.empty_like(weights)
    for k, of_class in enumerate(np.ascontiguousarray(slope.T, np.float64)):
        sums[:-1, k] = np.bincount(every, np.tile(of_class, len(features)), len(weights) - 1)
    sums[-1] = slope.sum(axis=0)
    squares += sums * sums
    weights -= settings.rate * sums / np.sqrt(squares)
    touched[every] = True
    touched[-1] = True


@freeing
def _scored_block(packed: pa.Table, answers: pa.Table, model: Model) -> pa.Table:
    settings = model.settings
    counts: dict[bytes, int] = {}
    for row in answers.to_pylist():
        own = np.frombuffer(zstandard.decompress(row["counts"]), "<i8").tolist()
        counts.update(zip(unpacked_list(row["words"]), own))
    words = _Words(model.singles, settings)
    spread = model.class_tokens + model.class_words + 1.0
    spread[: settings.singles] = 0
    out: list[list] = [[], [], [], []]
    denominator = model.tokens + model.words + 1
    count = np.array([counts.get(END, 0)], np.int64)
    for numbers, lengths in _numbered(plain_texts(packed), words):
        new = words.settle()
        count = np.append(count, np.array([counts.get(w, 0) for w in new], np.int64))
        classes = words.classes
        inside = np.where(
            classes < settings.singles,
            0.0,
            np.log(count + 1.0) - np.log(np.maximum(spread[classes], 1.0)),
        )
        base = np.log10((count + 1.0) / denominator)
        features = _features(words.hashes[numbers], lengths, settings.rows)
        target = classes[numbers]
        own = np.empty(len(numbers))
        for a in range(0, len(numbers), STEP):
            z = _logits(model.weights, features[:, a : a + STEP])
            t = target[a : a + STEP]
            own[a : a + STEP] = z[np.arange(len(t)), t] - np.log(np.exp(z).sum(axis=1))
        starts = np.cumsum(lengths) - lengths
        out[0].append(lengths)
        out[1].append(np.add.reduceat((count > 0)[numbers].astype(np.int64), starts))
        out[2].append(np.add.reduceat(base[numbers], starts))
        out[3].append(np.add.reduceat((own + inside[numbers]) / np.log(10), starts))
    ids = packed.column("id").to_pylist()
    lengths, n_known, base, score = (np.concatenate(o) if o else np.zeros(0) for o in out)
    return pa.table(
        {
            "doc_id": pa.array(ids, pa.int64()),
            "held_out": pa.array(list(map(held_out, ids)), pa.bool_()),
            "n_tokens": pa.array(lengths, pa.int64()),
            "n_known": pa.array(n_known, pa.int64()),
            "train_tokens": pa.array([model.tokens] * len(ids), pa.int64()),
            "base_score": pa.array(base, pa.float64()),
            "score": pa.array(score, pa.float64()),
        }
    )
