"""Removal of word sequences that an earlier document already holds, by recompression.

Words are named by 128-bit hashes. Rounds of recompression join neighbouring names: a name whose
hash bit says *left* joins a following *right* one, and the pair gets a name derived from both.
Which names join depends on the nearest words only, so equal passages get equal symbols except
next to their ends: after two rounds a symbol has four words at most, and where one begins
follows from the two words before and the two words after. Hence every window of 13 words has a
symbol that begins at its third to sixth word and is placed by the window alone, and the eight
words from there, named together (the high-level symbol), lie inside the window.

Spark then takes two global rounds. The first compares the high-level symbols of all documents;
windows without a symbol that recurs cannot recur. The second compares the 128-bit names of the
remaining windows and finds the smallest document of each. Names travel as packed arrays, one
row for each block of documents and range of names; duplicates are merged inside a block first,
so a passage of a million documents is one name per block. Answers are bitmaps.

Runs of one word need no rule of their own: equal names never join one another, so a run stays a
run of equal symbols, merged when names are made distinct.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.llm.common import (
    NO_ID,
    SPACES,
    block_count,
    bucket_edges,
    dealt,
    freeing,
    mixed,
    plain_texts,
    planes,
    unplaned,
)

ROUNDS = 2
SYMBOL = 2**ROUNDS  # most words of a symbol
CONTEXT = 2  # words before and after a place that settle whether a symbol begins there
PART = 300_000  # words handled at once in a task
SEGMENT = 1 << 19  # bytes handled at once in a task
LONG = 64  # bytes of a word beyond which its name is made in another way
_MULTIPLY = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)

_NAMES = "bucket int, block int, names binary"
_BITS = "block int, kind int, bucket int, bits binary"


def remove_repeats(
    docs: DataFrame,
    window: int = 13,
    doc_id: str = "doc_id",
    text: str = "text",
    blocks: int | None = None,
) -> DataFrame:
    """All columns of ``docs`` with each text cut down to the words it keeps.

    A word goes if a window of ``window`` words covers it whose sequence also starts in a document
    with a smaller id. A text that loses no word stays as it is, otherwise its words are joined
    by one space. Added columns, after dropping such names of the input: ``n_words``,
    ``n_removed``, ``kept_sha256`` (of the kept words joined by one space) and ``removed``, an
    array of [from, to) word ranges.

    A NULL text has no words and stays NULL. A NULL id counts as larger than all others. Rows of
    the same id are one document for the comparison: neither removes words of the other.
    """
    if window < 2 * CONTEXT + SYMBOL:
        raise ValueError(f"a window needs {2 * CONTEXT + SYMBOL} words or more")
    added = ["n_words", "n_removed", "kept_sha256", "removed"]
    docs = docs.drop(*[c for c in added if c not in (doc_id, text)])
    n = blocks or block_count(docs.sparkSession)
    packed = dealt(docs, n, doc_id, text, rest=True)
    by_block = packed.groupBy("block")

    symbols = by_block.applyInArrow(lambda t: _symbol_names(t, window, n), _NAMES)
    recurring = symbols.groupBy("bucket").applyInArrow(lambda t: _recurring(t), _BITS)
    names = (
        by_block.cogroup(recurring.groupBy("block"))
        .applyInArrow(lambda t, bits: _window_names(t, bits, window, n), _NAMES + ", ids binary")
    )
    earlier = names.groupBy("bucket").applyInArrow(lambda t: _earlier(t), _BITS)
    out = T.StructType(
        [f for f in docs.schema if f.name != text]
        + [T.StructField(text, T.StringType())]
        + T._parse_datatype_string(
            "n_words long, n_removed long, kept_sha256 string, "
            "removed array<struct<from:long,to:long>>"
        ).fields
    )
    both = recurring.union(earlier).groupBy("block")
    cut = by_block.cogroup(both).applyInArrow(lambda t, bits: _cut(t, bits, window, n, out), out)
    return cut.select(*[F.col(f"`{c}`") for c in [*docs.columns, *added]])


class _Block:
    """The names of a block's words, laid end to end, and the documents' places among them."""

    def __init__(self, packed: pa.Table):
        lengths, high, low = [], [], []
        for texts in _gathered(plain_texts(packed)):
            for values, found in zip((lengths, high, low), _word_names(texts)):
                values.append(found)
        self.lengths, self.high, self.low = map(np.concatenate, (lengths, high, low))
        self.ends = np.cumsum(self.lengths)
        self.ids = np.array(
            [NO_ID if i is None else i for i in packed.column("id").to_pylist()], np.int64
        )

    def parts(self) -> Iterator[tuple[slice, np.ndarray, int, int]]:
        """For whole documents of about ``PART`` words: their words, the end of each word's document
        among them, and the documents' range."""
        begin = at = 0
        while begin < len(self.lengths):
            end = max(begin + 1, int(np.searchsorted(self.ends, at + PART)))
            until = int(self.ends[end - 1])
            lengths = self.lengths[begin:end]
            yield slice(at, until), np.repeat(np.cumsum(lengths), lengths), begin, end
            begin, at = end, until


def _gathered(texts: Iterator[bytes | None]) -> Iterator[list[bytes]]:
    held, size = [], 0
    for text in texts:
        held.append(text or b"")
        size += len(held[-1])
        if size >= SEGMENT // 2:
            yield held
            held, size = [], 0
    if held:
        yield held


def _powers(base: int) -> np.ndarray:
    values = np.full(SEGMENT + 1, base, np.uint64)
    values[0] = 1
    return np.cumprod(values, dtype=np.uint64)


@functools.cache
def _tables():
    """White space by byte; for each half of a name a random value by byte, the powers of a base
    and of its inverse."""
    space = np.zeros(256, bool)
    space[list(SPACES.encode())] = True
    rng = np.random.default_rng(20)
    halves = []
    for base in _MULTIPLY.tolist():
        values = rng.integers(0, 2**64, 256, np.uint64)
        halves.append((values, _powers(base), _powers(pow(base, -1, 2**64))))
    return space, halves


def word_places(texts: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """The texts laid end to end, where their words start and end, and the number of each text's."""
    space, _ = _tables()
    data = b"\n".join([*texts, b""])
    blank = np.concatenate([[True], space[np.frombuffer(data, np.uint8)]])
    starts = np.flatnonzero(blank[:-1] & ~blank[1:])
    ends = np.flatnonzero(~blank[:-1] & blank[1:])
    places = np.cumsum([0, *(len(t) + 1 for t in texts)])
    return data, starts, ends, np.diff(np.searchsorted(starts, places))


def _word_names(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The number of words of each text, and both halves of the name of each word."""
    data, starts, ends, counts = word_places(texts)
    return counts, *names_of(data, starts, ends)


def names_of(data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Both halves of the names of words: polynomials of their bytes, from sums over all bytes up to
    their ends, or another hash for a long word."""
    _, halves = _tables()
    buffer = np.frombuffer(data, np.uint8)
    names = np.zeros((2, len(starts)), np.uint64)
    sizes, a = ends - starts, 0
    while a < len(starts):
        begin = starts[a]
        b = max(a + 1, int(np.searchsorted(ends, begin + SEGMENT, side="right")))
        part = buffer[begin : min(ends[b - 1], begin + SEGMENT)]
        s = starts[a:b] - begin
        e = np.minimum(ends[a:b] - begin, len(part))
        for half, (values, powers, inverse) in zip(names, halves):
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(values[part] * powers[: len(part)], out=sums[1:])
            half[a:b] = mixed((sums[e] - sums[s]) * inverse[s])
        a = b
    for i in np.flatnonzero(sizes > LONG):
        digest = xxhash.xxh3_128_digest(data[starts[i] : ends[i]])
        names[:, i] = np.frombuffer(digest, ">u8")
    return names


def _grams(names: np.ndarray, k: int, by: np.uint64) -> np.ndarray:
    """A name for the k words from each place on."""
    n = max(0, len(names) - k + 1)
    total = np.zeros(n, np.uint64)
    for i in range(k):
        total = total * by + names[i : i + n]
    return mixed(total)


def _begins(names: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where the symbols of the last round begin."""
    places = np.arange(len(names))
    for r in range(ROUNDS):
        right = mixed(names + np.uint64(2 * r + 1)) >> np.uint64(63) == 1
        second = np.zeros(len(names), bool)
        second[1:] = right[1:] & ~right[:-1] & (ends[places[1:]] == ends[places[:-1]])
        first = np.flatnonzero(~second)
        joins = np.append(second[1:], False)[first]
        following = names[np.minimum(first + 1, len(names) - 1)]
        names = np.where(joins, mixed(names[first] * _MULTIPLY[0] + following), names[first])
        places = places[first]
    return places


def _symbols(block: _Block, window: int):
    """For each part: its words, their document ends, and the places and names of its
    high-level symbols."""
    k = window - CONTEXT - SYMBOL + 1
    for words, ends, begin, end in block.parts():
        if len(ends) < window:
            yield words, ends, np.zeros(0, int), np.zeros(0, np.uint64), begin, end
            continue
        low = block.low[words]
        places = _begins(low, ends)
        places = places[places + k <= ends[places]]
        yield words, ends, places, _grams(low, k, _MULTIPLY[0])[places], begin, end


@freeing
def _symbol_names(packed: pa.Table, window: int, buckets: int) -> pa.Table:
    block = _Block(packed)
    names = [s[3] for s in _symbols(block, window)]
    return _by_bucket(packed, np.unique(np.concatenate(names)), buckets)


def _by_bucket(packed: pa.Table, names: np.ndarray, buckets: int, **more: np.ndarray) -> pa.Table:
    """One row for each bucket; ``names`` are sorted by their first 64 bits."""
    first = names if names.ndim == 1 else names[:, 0].copy()
    edges = bucket_edges(first, buckets)
    full = np.flatnonzero(edges[1:] > edges[:-1])
    cuts = [(edges[i], edges[i + 1]) for i in full]
    columns = {
        "bucket": pa.array(full, pa.int32()),
        "block": pa.array([packed.column("block")[0].as_py()] * len(full), pa.int32()),
        "names": pa.array([_wide(names[a:b]) for a, b in cuts], pa.binary()),
    }
    for name, values in more.items():
        columns[name] = pa.array([planes(values[a:b]) for a, b in cuts], pa.binary())
    return pa.table(columns)


def _wide(names: np.ndarray) -> bytes:
    if names.ndim == 1:
        return planes(names)
    return b"".join(planes(names[:, i].copy()) for i in range(names.shape[1]))


@freeing
def _recurring(rows: pa.Table) -> pa.Table:
    """For each block's names of one bucket, which of them another block has as well."""
    lists = [unplaned(b, np.uint64) for b in rows.column("names").to_pylist()]
    every = np.concatenate(lists)
    order = np.argsort(every)
    same = every[order[1:]] == every[order[:-1]]
    twice = np.zeros(len(every), bool)
    twice[order[1:]] = same
    twice[order[:-1]] |= same
    return _answers(rows, 0, np.split(twice, np.cumsum([len(x) for x in lists])[:-1]))


def _answers(rows: pa.Table, kind: int, bits: list[np.ndarray]) -> pa.Table:
    return pa.table(
        {
            "block": rows.column("block"),
            "kind": pa.array([kind] * len(rows), pa.int32()),
            "bucket": rows.column("bucket"),
            "bits": pa.array([np.packbits(b).tobytes() for b in bits], pa.binary()),
        }
    )


def _told(bits: pa.Table, kind: int, first: np.ndarray, buckets: int) -> np.ndarray:
    """The answers of one kind, in the order of the block's sorted names."""
    edges, answer = bucket_edges(first, buckets), np.zeros(len(first), bool)
    columns = (bits.column(c).to_pylist() for c in ("kind", "bucket", "bits"))
    for of, bucket, packed in zip(*columns):
        if of == kind:
            a, b = edges[bucket], edges[bucket + 1]
            answer[a:b] = np.unpackbits(np.frombuffer(packed, np.uint8), count=b - a) == 1
    return answer


class _Windows:
    """The windows of a block that may recur: document, place, and number among the distinct
    names, which are sorted; ``least`` is a name's smallest id in the block."""

    def __init__(self, block: _Block, bits: pa.Table, window: int, buckets: int):
        parts = list(_symbols(block, window))
        found = np.concatenate([p[3] for p in parts])
        symbols, number, counts = np.unique(found, return_inverse=True, return_counts=True)
        recurs = ((counts > 1) | _told(bits, 0, symbols, buckets))[number]
        recurs = np.split(recurs, np.cumsum([len(p[3]) for p in parts])[:-1])
        part, place, high, low, ids = [], [], [], [], []
        for i, (words, ends, places, _, begin, end) in enumerate(parts):
            marked = np.zeros(len(ends), bool)
            hits = places[recurs[i]]
            for offset in range(CONTEXT, CONTEXT + SYMBOL):
                marked[hits[hits >= offset] - offset] = True
            p = np.flatnonzero(marked)
            p = p[p + window <= ends[p]]
            if len(p):
                of = np.repeat(block.ids[begin:end], block.lengths[begin:end])
                part.append(np.full(len(p), i))
                place.append(p)
                ids.append(of[p])
                high.append(_grams(block.high[words], window, _MULTIPLY[1])[p])
                low.append(_grams(block.low[words], window, _MULTIPLY[0])[p])
        joined = lambda x, kind: np.concatenate(x) if x else np.zeros(0, kind)
        self.part, self.place = joined(part, np.int64), joined(place, np.int64)
        self.ids = joined(ids, np.int64)
        high, low = joined(high, np.uint64), joined(low, np.uint64)
        order = np.lexsort((self.ids, low, high))
        high, low, sorted_ids = high[order], low[order], self.ids[order]
        new = np.ones(len(order), bool)
        new[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
        self.names = np.stack([high[new], low[new]], axis=1)
        self.least = sorted_ids[new]
        self.number = np.empty(len(order), np.int64)
        self.number[order] = np.cumsum(new) - 1


@freeing
def _window_names(packed: pa.Table, bits: pa.Table, window: int, buckets: int) -> pa.Table:
    if not len(packed):
        return _by_nothing()
    found = _Windows(_Block(packed), bits, window, buckets)
    return _by_bucket(packed, found.names, buckets, ids=found.least)


def _by_nothing() -> pa.Table:
    return pa.table(
        {
            "bucket": pa.array([], pa.int32()),
            "block": pa.array([], pa.int32()),
            "names": pa.array([], pa.binary()),
            "ids": pa.array([], pa.binary()),
        }
    )


@freeing
def _earlier(rows: pa.Table) -> pa.Table:
    """For each block's windows of one bucket, whether a smaller id has them elsewhere."""
    ids = [unplaned(b, np.int64) for b in rows.column("ids").to_pylist()]
    names = [np.frombuffer(b, np.uint8) for b in rows.column("names").to_pylist()]
    high = np.concatenate([unplaned(b[: len(b) // 2].tobytes(), np.uint64) for b in names])
    low = np.concatenate([unplaned(b[len(b) // 2 :].tobytes(), np.uint64) for b in names])
    every = np.concatenate(ids)
    order = np.lexsort((every, low, high))
    new = np.ones(len(order), bool)
    h, m = high[order], low[order]
    new[1:] = (h[1:] != h[:-1]) | (m[1:] != m[:-1])
    earlier = np.empty(len(order), bool)
    earlier[order] = every[order][new][np.cumsum(new) - 1] < every[order]
    cuts = np.cumsum([len(i) for i in ids])[:-1]
    return _answers(rows, 1, np.split(earlier, cuts))


@freeing
def _cut(
    packed: pa.Table, bits: pa.Table, window: int, buckets: int, schema: T.StructType
) -> pa.Table:
    from pyspark.sql.pandas.types import to_arrow_schema

    target = to_arrow_schema(schema)
    if not len(packed):
        return target.empty_table()
    block = _Block(packed)
    found = _Windows(block, bits, window, buckets)
    earlier = _told(bits, 1, found.names[:, 0].copy(), buckets)
    gone = earlier[found.number] | (found.ids > found.least[found.number])
    removed: dict[int, np.ndarray] = {}
    for i, (_, ends, begin, end) in enumerate(block.parts()):
        at = found.place[gone & (found.part == i)]
        if len(at):
            step = np.zeros(len(ends) + 1, np.int64)
            np.add.at(step, at, 1)
            np.add.at(step, at + window, -1)
            covered = np.cumsum(step)[:-1] > 0
            starts = np.cumsum(block.lengths[begin:end])[:-1]
            for d, mask in enumerate(np.split(covered, starts), begin):
                if mask.any():
                    removed[d] = mask
    texts, digests, counts, ranges = [], [], [], []
    for d, text in enumerate(plain_texts(packed)):
        words, spans = (text or b"").split(), []
        if d in removed:
            mask = removed[d]
            text = b" ".join(itertools.compress(words, ~mask))
            kept = text
            edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.view(np.int8), [0]])))
            spans = [{"from": a, "to": b} for a, b in edge.reshape(-1, 2).tolist()]
        else:
            kept = b" ".join(words)
        texts.append(None if text is None else text.decode())
        digests.append(hashlib.sha256(kept).hexdigest())
        counts.append(int(removed[d].sum()) if d in removed else 0)
        ranges.append(spans)
    rest = packed.column("rest").combine_chunks()
    columns = [rest.field(f.name) for f in schema[: rest.type.num_fields]]
    added = [texts, block.lengths, counts, digests, ranges]
    columns += [pa.array(v, f.type) for v, f in zip(added, list(target)[rest.type.num_fields :])]
    return pa.Table.from_arrays(
        [c.cast(f.type) if c.type != f.type else c for c, f in zip(columns, target)],
        schema=target,
    )
