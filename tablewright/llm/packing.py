"""Packing of tokenised documents into sequences: best-fit decreasing, certified by lower bounds.

Pieces are dealt to pools of bounded size, as many as the pieces fill and one where they fit it, so
that the result does not depend on the session's partitions. Each pool packs by best-fit decreasing
and compares its number of sequences with lower bounds from dual feasible functions: functions u of
a length with sum(u) <= 1 for every set of lengths that fits one sequence, so that the sum over all
pieces, rounded up, is a number no packing can beat. A pool that meets its bound is certified.
While all pools together miss the bound over all pieces, every sequence that is not full gives its
pieces to an exchange, also those of certified pools, and ever fewer pools (never larger than a
bound) pack them again. Rounds go on until one pool is left, nothing has a gap, a round no longer
saves a sequence, or the whole packing meets the bound over all pieces. Only ids and lengths of
pieces travel. The bounds come with the result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import checkpointed, column, give_back
from tablewright.llm.vocabulary import LARGE, MEMORY, ChunkTokenizer

POOL = 50_000  # pieces of a pool, about


def pieces(
    docs: DataFrame,
    vocabulary: str,
    limit: int = 1024,
    end: int = 2,
    doc_id: str = "doc_id",
    text: str = "text",
    ids: bool = False,
    remember: bool = False,
) -> DataFrame:
    """The pieces of every document: ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32`` and,
    if asked for, ``ids`` (little-endian unsigned 32-bit).

    A document's ids are those of ``tokenizers`` with the vocabulary file, without special tokens,
    then ``end``. One of more than ``limit`` ids is cut so that only the first piece may be shorter
    than ``limit``. A NULL text is empty: its one piece is the end. ``remember`` lets workers keep
    more of the words they have encoded, and from task to task: up to some 300 MB each, which saves
    time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = ChunkTokenizer.of(vocabulary, LARGE if remember else MEMORY)
        encode = tokenizer.encode
        for batch in batches:
            columns: list[list] = [[], [], [], [], [], []]
            for doc, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = encode(value.as_py() or "")
                found = np.append(found, np.uint32(end)).astype("<u4")
                n = len(found)
                cuts = [0, *range(n % limit or limit, n + 1, limit)] if n > limit else [0, n]
                for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    data = found[a:b].tobytes()
                    row = (doc, k, a, b - a, zlib.crc32(data), data if ids else None)
                    for values, v in zip(columns, row):
                        values.append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(columns, kinds)], names=names
            )
        if not remember:
            tokenizer.forget()
        give_back()

    names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    taken = docs.select(column(doc_id).cast("long").alias("doc_id"), column(text).alias("text"))
    out = taken.mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary"
    )
    return out if ids else out.drop("ids")


def best_fit_decreasing(lengths: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """The sequence of each piece, and the room left in each sequence. Works on sequences by the
    room they have, so a piece costs one search among at most ``limit`` rooms."""
    by_room: list[list[int]] = [[] for _ in range(limit + 1)]
    rooms = 0  # bit r is set if a sequence has room r
    sequence, room = np.empty(len(lengths), np.int64), []
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        fitting = rooms >> n
        if fitting:
            r = n + (fitting & -fitting).bit_length() - 1
            s = by_room[r].pop()
            if not by_room[r]:
                rooms &= ~(1 << r)
        else:
            r, s = limit, len(room)
            room.append(limit)
        sequence[i] = s
        room[s] = r - n
        by_room[r - n].append(s)
        rooms |= 1 << (r - n)
    return sequence, np.array(room, np.int64)


def lower_bound(counts: np.ndarray, limit: int) -> int:
    """A number of sequences that no packing can beat; ``counts`` [n] is how many pieces have
    length n. The maximum over two families of dual feasible functions: the one that lifts
    lengths above limit - t to a whole and drops those below t (Martello and Toth), and the
    rounding functions floor((k + 1) x) / k (Fekete and Schepers)."""
    n = np.arange(limit + 1, dtype=np.int64)
    total = int((counts * n).sum())
    best = -(-total // limit)
    below = np.cumsum(counts * n)
    above = np.cumsum(counts[::-1])[::-1]
    for t in range(1, limit // 2 + 1):
        inner = int(below[limit - t] - below[t - 1])
        whole = int(above[limit - t + 1])
        best = max(best, whole + -(-inner // limit))
    for k in range(1, 101):
        scaled = (k + 1) * n
        value = np.where(scaled % limit == 0, n * k, (scaled // limit) * limit)
        sum_k = int((value * counts).sum())
        best = max(best, -(-sum_k // (k * limit)))
    return best


def packed(pieces: DataFrame, limit: int = 1024) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``, the place in the sequence; a sequence is filled
    without gaps from 0, in the order of document and piece. Further ``bound``, a number of sequences
    that no packing of all pieces can beat, and ``pool_sequences`` and ``pool_bound``, the number and
    the bound of the pool that packed the sequence last (1 and 1 for a piece that fills one).

    Rows of the same document and piece, from repeated ids, are packed as pieces of their own.
    """
    added = ("sequence_id", "offset", "bound", "pool_sequences", "pool_bound")
    names = [c for c in pieces.columns if c not in added]
    pieces = checkpointed(pieces.select(*names).withColumn("row", F.monotonically_increasing_id()))
    sizes = pieces.select("row", F.col("length").cast("int").alias("length"))
    full = sizes.filter(F.col("length") >= limit)
    n_full = full.count()
    placed = full.selectExpr("row", "row AS first", "1L AS pool_sequences", "1L AS pool_bound")
    left = sizes.filter(F.col("length") < limit)
    counts = np.zeros(limit + 1, np.int64)
    for r in left.groupBy("length").count().collect():
        counts[r["length"]] = r["count"]
    bound, n = lower_bound(counts, limit), int(counts.sum())
    pools, closed, opened = max(1, -(-n // POOL)), 0, None
    kept = ["row", "first", "pool_sequences", "pool_bound"]
    before = None
    while n:
        key = F.pmod(F.xxhash64("row", F.lit(pools)), F.lit(pools))
        run = left.select(key.alias("pool"), "row", "length").groupBy("pool")
        out = checkpointed(run.applyInArrow(lambda t: _packed_pool(t, limit), _POOLED))
        state = out.agg(
            F.count_if("again").alias("pieces"),
            F.count_if(F.col("again") & F.col("opens")).alias("open"),
            F.count_if("opens").alias("sequences"),
        ).first()
        last = (
            pools == 1
            or not state.pieces
            or closed + state.sequences <= bound
            or (opened is not None and state.sequences >= opened)
        )
        if opened is not None and state.sequences > opened:
            placed = placed.union(before)
            break
        placed = placed.union((out if last else out.filter("NOT again")).select(*kept))
        if last:
            break
        before = out.filter("again").select(*kept)
        left = out.filter("again").select("row", "length")
        closed, opened = closed + state.sequences - state.open, state.open
        n, pools = state.pieces, max(pools // 4, -(-state.pieces // POOL), 1)
    order = F.expr(
        "sum(length) OVER (PARTITION BY sequence_id ORDER BY doc_id, piece, row"
        " ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - length"
    )
    return (
        pieces.join(placed, "row")
        .withColumnRenamed("first", "sequence_id")
        .withColumns({"offset": order, "bound": F.lit(bound + n_full).cast("long")})
        .select(*names, *added)
    )


#: ``first``: the row of the sequence's first piece, which names the sequence; ``opens``: whether the
#: row is that one; ``again``: whether the sequence has a gap and is packed again.
_POOLED = (
    "row long, length int, first long, opens boolean, again boolean,"
    " pool_sequences long, pool_bound long"
)


def _packed_pool(rows: pa.Table, limit: int) -> pa.Table:
    row = rows.column("row").to_numpy()
    lengths = rows.column("length").to_numpy()
    order = np.argsort(row)
    row, lengths = row[order], lengths[order]
    sequence, room = best_fit_decreasing(lengths, limit)
    counts = np.bincount(lengths, minlength=limit + 1)
    bound = lower_bound(counts, limit)
    by_sequence = np.argsort(sequence, kind="stable")
    starts = np.searchsorted(sequence[by_sequence], np.arange(len(room)))
    first = row[by_sequence[starts]]
    again = room > 0
    return pa.table(
        {
            "row": row,
            "length": lengths.astype(np.int32),
            "first": first[sequence],
            "opens": first[sequence] == row,
            "again": again[sequence],
            "pool_sequences": np.full(len(row), len(room)),
            "pool_bound": np.full(len(row), bound),
        }
    )
