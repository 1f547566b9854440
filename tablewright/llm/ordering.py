"""Training order: every sequence gets a slot by a keyed permutation, and shards hold the slots.

Sequences are numbered densely in the order of their texts' keys. Texts are sorted before they are cut,
so that a sequence's number follows from how many lie before its part of the table; a table of one row
for each part tells these. The numbered ids are kept once, compressed. A Feistel network over the next even
number of bits permutes the numbers; one that leaves the range goes through again (cycle-walking)
until it is inside, which makes a permutation of exactly the numbers in use. It needs no table:
any slot's sequence, and any sequence's slot, can be computed from the key.

Slots are cut into shards of equally many. A shard is one file of records of equal size, in the
order of slots: record i of a shard begins at i times that size, so a reader goes through a shard
in one sweep and resumes at any slot. Spark's text writer lays the records out, each ended by a
line feed that belongs to the record; it writes to any file system and commits whole files only. Shards are
written in a few passes, each of which exchanges the records of its own shards only, so that the disk
never holds all records twice.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm.common import checkpointed, column, give_back, mixed, releasing_shuffles
from tablewright.llm.vocabulary import ChunkTokenizer

ROUNDS = 6
GATHERED = 1_000_000  # ids handled at once in a task, or one text's
PASSES = 4  # in which shards are written
_PACKS = "part int, before long, n long, z binary"
_COLUMNS = {"a": "<i8", "b": "<i8", "piece": "<i4", "used": "<i4"}


class Layout(NamedTuple):
    """``length`` ids a sequence, ``per_shard`` sequences a shard; ids have two bytes, or four."""

    length: int = 128
    per_shard: int = 16_384
    wide: bool = False
    pad: int = 0

    @property
    def kind(self) -> np.dtype:
        id_type = "<u4" if self.wide else "<u2"
        return np.dtype(
            [("slot", "<i8"), ("key", "<i8", 2), ("piece", "<i4"), ("used", "<i4"),
             ("ids", id_type, self.length), ("end", "u1")]
        )


def permuted(numbers: np.ndarray, n: int, key: int) -> np.ndarray:
    """The slots of ``numbers`` (from 0 to n - 1) under the permutation of ``key``."""
    return _walked(numbers, n, _round_keys(key))


def numbers_of(slots: np.ndarray, n: int, key: int) -> np.ndarray:
    """The numbers of ``slots``: the inverse of ``permuted``."""
    return _walked(slots, n, _round_keys(key)[::-1], inverse=True)


def _round_keys(key: int) -> np.ndarray:
    seeds = np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return mixed(seeds + np.uint64(key % 2**64))


def _walked(values: np.ndarray, n: int, keys: np.ndarray, inverse: bool = False) -> np.ndarray:
    half = np.uint64(max(1, -(-(max(n, 2) - 1).bit_length() // 2)))
    mask = (np.uint64(1) << half) - np.uint64(1)
    out = np.array(values, np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> half, out[todo] & mask
        for k in keys:
            if inverse:
                left, right = right ^ (mixed(left + k) & mask), left
            else:
                left, right = right, left ^ (mixed(right + k) & mask)
        out[todo] = (left << half) | right
        todo = todo[out[todo] >= np.uint64(n)]
    return out.astype(np.int64)


def sequences(
    rows: DataFrame,
    vocabulary: str,
    layout: Layout = Layout(),
    keys: tuple[str, str] = ("conv_id", "turn"),
    text: str = "text",
    end: int = 50256,
) -> DataFrame:
    """Each text's ids and ``end``, cut into sequences in the order of the keys, as compressed packs: ``part``
    of the table, how many of its sequences lie ``before``, ``n`` and ``z``. ``unpacked`` gives a row for each
    sequence. A NULL text is empty, a NULL key is -1. Texts of one key are ordered by their hashes; copies
    may be dealt to several parts, since any order of theirs gives the same sequences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = ChunkTokenizer.of(vocabulary).encode_at_once
        part, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            a, b = (c.to_numpy() for c in batch.columns[:2])
            held, size, first = [], 0, 0
            for i, value in enumerate(batch.column(2)):
                held.append(np.append(encode(value.as_py() or ""), np.uint32(end)))
                size += len(held[-1])
                if size >= GATHERED or i == len(batch) - 1:
                    n, z = _packed(a[first : i + 1], b[first : i + 1], held, layout)
                    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.binary()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([v], k) for v, k in zip((part, before, n, z), kinds)],
                        names=["part", "before", "n", "z"],
                    )
                    before += n
                    held, size, first = [], 0, i + 1
        ChunkTokenizer.of(vocabulary).forget()
        give_back()

    key = [F.coalesce(column(k).cast("long"), F.lit(-1)) for k in keys]
    taken = rows.select(
        key[0].alias("a"),
        key[1].alias("b"),
        column(text).alias("text"),
        F.xxhash64(column(text)).alias("hash"),
        F.monotonically_increasing_id().alias("row"),
    )
    order = ["a", "b", "hash", "row"]
    ranged = taken.repartitionByRange(*order).sortWithinPartitions(*order)
    return ranged.select("a", "b", "text").mapInArrow(run, _PACKS)


def _packed(
    a: np.ndarray, b: np.ndarray, texts: list[np.ndarray], layout: Layout
) -> tuple[int, bytes]:
    """How many sequences some texts' ids make, and these compressed, column by column."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    joined = np.concatenate(texts)
    id_type = layout.kind["ids"].base
    if joined.max() > np.iinfo(id_type).max:
        raise ValueError("an id needs more than two bytes; set wide")
    counts = -(-lengths // layout.length)
    begins = np.cumsum(counts) - counts
    n = int(counts.sum())
    ids = np.full(n * layout.length, layout.pad, id_type)
    shift = begins * layout.length - (np.cumsum(lengths) - lengths)
    ids[np.arange(len(joined)) + np.repeat(shift, lengths)] = joined
    piece = np.arange(n) - np.repeat(begins, counts)
    used = np.minimum(np.repeat(lengths, counts) - piece * layout.length, layout.length)
    columns = [np.repeat(a, counts), np.repeat(b, counts), piece, used]
    data = [c.astype(kind).tobytes() for c, kind in zip(columns, _COLUMNS.values())]
    return n, zstandard.compress(b"".join([*data, ids.tobytes()]), 3)


def _plain(n: int, z: bytes) -> dict[str, np.ndarray]:
    """The columns of a pack of ``n`` sequences; ``ids`` has a row of bytes for each."""
    data, at, columns = zstandard.decompress(z), 0, {}
    for name, kind in _COLUMNS.items():
        columns[name] = np.frombuffer(data, kind, n, at)
        at += columns[name].nbytes
    return columns | {"ids": np.frombuffer(data, np.uint8, offset=at).reshape(n, -1)}


def unpacked(packs: DataFrame) -> DataFrame:
    """A row for each sequence: ``a``, ``b`` (the keys), ``piece``, ``used`` and ``ids`` (bytes, padded)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n, z in zip(batch.column(0).to_pylist(), batch.column(1)):
                x = _plain(n, z.as_py())
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(x[c]) for c in _COLUMNS), _binary(x["ids"])], names=list(x)
                )

    return packs.select("n", "z").mapInArrow(run, "a long, b long, piece int, used int, ids binary")


def _binary(rows: np.ndarray) -> pa.Array:
    """One value for each row of bytes."""
    n, size = rows.shape
    ends = np.arange(0, (n + 1) * size, size, dtype=np.int32)
    data = np.ascontiguousarray(rows)
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(ends), pa.py_buffer(data)])


def materialised(
    sequences: DataFrame, folder: str, key: int, layout: Layout = Layout()
) -> DataFrame:
    """Write the shards of packs to ``folder`` and return one row for each record as it is read back from
    them: ``a``, ``b``, ``piece``, ``used``, ``slot``, ``shard``, ``offset`` (bytes) and ``ids_crc32``."""
    spark = sequences.sparkSession
    with releasing_shuffles(spark):
        packs = checkpointed(sequences.select("part", "before", "n", "z"))
        counted = packs.groupBy("part").agg(
            F.sum("n").alias("n"), F.max(F.col("before") + F.col("n")).alias("end")
        )
        starts, n = {}, 0
        for r in sorted(counted.collect(), key=lambda r: r.part):
            if r.n != r.end:
                raise ValueError("packs are missing or repeated")
            starts[r.part], n = n, n + r.n
        shards = -(-n // layout.per_shard)
        ends = [shards * k // PASSES for k in range(PASSES + 1)]
        for begin, end in zip(ends, ends[1:]):
            if begin < end:
                _written(packs, begin, end, starts, n, key, layout, folder)
    return read(spark, folder, layout) if n else _nothing(spark)


def _written(
    packs: DataFrame,
    begin: int,
    end: int,
    starts: dict[int, int],
    n: int,
    key: int,
    layout: Layout,
    folder: str,
) -> None:
    """Write the shards from ``begin`` to before ``end``."""

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *of, packs_ = batch.columns
            for part, before, size, z in zip(*(c.to_pylist() for c in of), packs_):
                at = starts[part] + before
                slots = permuted(np.arange(at, at + size), n, key)
                own = np.flatnonzero((slots >= begin * layout.per_shard) & (slots < end * layout.per_shard))
                if not len(own):
                    continue
                x = {c: v[own] for c, v in _plain(size, z.as_py()).items()}
                rows = np.zeros(len(own), layout.kind)
                rows["slot"], rows["key"] = slots[own], np.stack([x["a"], x["b"]], axis=1)
                rows["piece"], rows["used"] = x["piece"], x["used"]
                rows["ids"], rows["end"] = x["ids"].view(layout.kind["ids"].base), ord("\n")
                data = rows.view(np.uint8).reshape(len(rows), -1)[:, :-1]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows["slot"]), _binary(data)], names=["slot", "record"]
                )
        give_back()

    placed = (
        packs.mapInArrow(records, "slot long, record binary")
        .withColumn("shard", F.expr(f"slot DIV {layout.per_shard}"))
    )
    (
        placed.repartition(end - begin, "shard")
        .sortWithinPartitions("shard", "slot")
        .select(F.col("record").cast("string").alias("value"), "shard")
        .write.mode("error" if begin == 0 else "append")
        .partitionBy("shard")
        .text(folder)
    )


_ROWS = (
    "a long, b long, piece int, used int, slot long, shard long, offset long, ids_crc32 long"
)


def _nothing(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], _ROWS)


def read(spark: SparkSession, folder: str, layout: Layout = Layout(), start: int = 0) -> DataFrame:
    """The records of the shards from slot ``start`` on; shards before it are not opened."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    files = files.select(F.col("shard").cast("long").alias("shard"), "content").filter(
        F.col("shard") >= start // layout.per_shard
    )
    kind = layout.kind

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = content.as_py()
                rows = np.frombuffer(data, kind)
                place = np.arange(len(rows), dtype=np.int64)
                from_ = max(0, start - shard * layout.per_shard)
                rows, place = rows[from_:], place[from_:]
                ids = place * kind.itemsize + kind.fields["ids"][1]
                until = ids + rows["used"].astype(np.int64) * kind["ids"].base.itemsize
                view = memoryview(data)
                crc = [zlib.crc32(view[x:y]) for x, y in zip(ids.tolist(), until.tolist())]
                columns = [
                    rows["key"][:, 0], rows["key"][:, 1], rows["piece"], rows["used"], rows["slot"],
                    np.full(len(rows), shard), place * kind.itemsize, np.array(crc, np.int64),
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.ascontiguousarray(c)) for c in columns],
                    names=[c.split()[0] for c in _ROWS.split(", ")],
                )

    return files.mapInArrow(run, _ROWS)
