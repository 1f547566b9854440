"""Hard negatives of anchors, scored exactly with subset-sum tables (the Four Russians' method).

Components are whole numbers. A candidate is packed into bit planes: plane ``b`` holds bit ``b`` (in
two's complement) of each component, eight dimensions a byte. For a group of eight dimensions
and a block of anchors, a table has the sum of the anchor's components over each of the 256 subsets
of the group. The inner product is then read, not multiplied: plane by plane from the highest,
whose weight is negative, the sum so far is doubled and the table rows that the candidate's bytes
name are added. All of it is integer arithmetic.

Candidates are dealt to shards and anchors to blocks, both of bounded size; a task scores one shard
against one block. Candidates travel as packed planes, some seven times smaller than their
components. Positives come from candidates of the anchor's label, so these are dealt by label (a
hot label to more shards); negatives from all others, within bounds that the positives set.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablewright.llm.common import checkpointed, column, give_back

SHARD = 32_768  # candidates of a shard, about
BLOCK = 1_024  # anchors of a block, about
AT_ONCE = 128  # anchors whose tables lie in memory together
CHUNK = 2_048  # candidates scored together
_FOUND = "anchor long, anchor_id long, positive_id long, positive_score long, id long, score long"


def whole_vectors(
    vectors: DataFrame,
    scale: int = 256,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """``vec_id``, ``label`` and ``v``, floor(scale x) of every component as longs. Rows with a NULL id or
    label, a NULL vector, or a NULL or non-finite component are left out; empty vectors stay."""
    x = column(embedding).cast("array<double>")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    known = column(vec_id).isNotNull() & column(label).isNotNull() & finite
    return vectors.filter(known).select(
        column(vec_id).cast("long").alias("vec_id"),
        column(label).cast("long").alias("label"),
        F.transform(x, lambda c: F.floor(c * scale)).alias("v"),
    )


def hard_negatives(
    vectors: DataFrame,
    anchors: DataFrame,
    positives: int = 5,
    negatives: int = 5,
    least_percent: int = 80,
    most_percent: int = 100,
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.

    Both inputs have ``vec_id``, ``label`` and whole ``v``. An anchor's positives are the first rows of
    its label, by falling inner product and rising id; rows of the anchor's own id are none. A
    positive's negatives are the first rows of other labels whose score, in percent of the positive's,
    is from ``least_percent`` to ``most_percent`` (both products compared as they are, so a negative
    positive score has none). Fewer where there are fewer; vectors of another length than the anchor's
    are no candidates. Repeated rows of ``vectors`` count each; repeated equal anchors are one, and an
    id with several vectors or labels is an anchor for each of them.

    Raises where components take more than 31 bits or a score might exceed 63.
    """
    vectors, anchors = checkpointed(vectors), checkpointed(anchors.distinct())
    planes = _planes(vectors, anchors)
    packed = vectors.withColumn("n", F.size("v")).mapInArrow(
        lambda rows: _packed(rows, planes), "id long, label long, n int, z binary"
    )
    asked = anchors.select(
        F.xxhash64("vec_id", "label", "v").alias("anchor"), F.col("vec_id").alias("anchor_id"), "label", "v",
        F.size("v").alias("n"),
    )

    # Each label's candidates and anchors in as many shards and blocks as they fill.
    own = {
        "shards": vectors.groupBy("label").agg(F.ceil(F.count("*") / SHARD).cast("int").alias("shards")),
        "blocks": anchors.groupBy("label").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")),
    }
    both = checkpointed(own["shards"].join(own["blocks"], "label"))
    key = ["label", "n", "shard", "block"]
    found = _against(packed.join(both, "label"), asked.join(both, "label"), key, _task(planes, positives, None))
    best = Window.partitionBy("anchor").orderBy(F.desc("score"), "id")
    ranked = found.withColumn("r", F.row_number().over(best)).filter(F.col("r") <= positives)
    chosen = checkpointed(ranked.select("anchor", F.struct("score", "id").alias("p")))
    wanted = chosen.groupBy("anchor").agg(F.sort_array(F.collect_list("p")).alias("p"))  # few: ``positives``

    shards = max(1, -(-vectors.count() // SHARD))
    blocks = max(1, -(-anchors.count() // BLOCK))
    dealt = [df.withColumns({"shards": F.lit(shards), "blocks": F.lit(blocks)}) for df in (packed, asked)]
    found = _against(
        dealt[0], dealt[1].join(wanted, "anchor"), ["n", "shard", "block"],
        _task(planes, negatives, (least_percent, most_percent)),
    )
    first = Window.partitionBy("anchor", "positive_id", "positive_score", "copy").orderBy(F.desc("score"), "id")
    return (
        found.withColumn("rank", F.row_number().over(first))
        .filter(F.col("rank") <= negatives)
        .select(
            "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
            F.col("score").alias("negative_score"),
        )
    )


def _planes(vectors: DataFrame, anchors: DataFrame) -> int:
    """Bits of the candidates' components, sign included."""
    size = F.greatest(F.array_max("v"), -F.array_min("v") - 1)
    c = vectors.agg(F.max(size), F.max(F.size("v"))).first()
    a = anchors.agg(F.max(size)).first()
    bits, other, n = int(c[0] or 0).bit_length() + 1, int(a[0] or 0).bit_length(), int(c[1] or 0)
    if bits > 32 or bits + other + n.bit_length() > 62:
        raise ValueError("components are too large for exact scores of 63 bits")
    return bits


def _packed(rows: Iterator[pa.RecordBatch], planes: int) -> Iterator[pa.RecordBatch]:
    for batch in rows:
        sizes = batch.column("n").to_numpy()
        flat = batch.column("v").flatten().to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes)
        z = np.empty(len(sizes), object)
        for n in np.unique(sizes):
            own = np.flatnonzero(sizes == n)
            v = flat[(ends[own] - n)[:, None] + np.arange(n)]
            shifts = np.arange(planes - 1, -1, -1)
            bits = (v[:, None, :] >> shifts[None, :, None] & 1).astype(bool)
            packed = np.packbits(bits, axis=2, bitorder="little").reshape(len(own), -1)
            z[own] = [x.tobytes() for x in packed]
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id"), batch.column("label"), batch.column("n"), pa.array(z, pa.binary())],
            names=["id", "label", "n", "z"],
        )
    give_back()


def _against(candidates: DataFrame, anchors: DataFrame, key: list[str], task: Callable) -> DataFrame:
    """``task`` for each shard of candidates and block of anchors."""
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    shard = F.expr("CAST(pmod(xxhash64(id, 1), shards) AS int)")
    c = candidates.withColumn("shard", shard).withColumn("block", every("blocks"))
    block = F.expr("CAST(pmod(anchor, blocks) AS int)")
    a = anchors.withColumn("block", block).withColumn("shard", every("shards"))
    kind = _FOUND + ", copy int"
    rows = [df.drop("shards", "blocks") for df in (c, a)]
    return rows[0].groupBy(*key).cogroup(rows[1].groupBy(*key)).applyInArrow(task, kind)


def tables_of(anchors: np.ndarray) -> np.ndarray:
    """For each group of eight dimensions and each subset of it, the anchors' sums: shape (groups, 256,
    anchors)."""
    n, d = anchors.shape
    groups = -(-d // 8)
    padded = np.zeros((groups * 8, n), anchors.dtype)
    padded[:d] = anchors.T
    parts = padded.reshape(groups, 8, n)
    out = np.zeros((groups, 256, n), anchors.dtype)
    for i in range(8):
        out[:, 1 << i : 2 << i] = out[:, : 1 << i] + parts[:, i : i + 1]
    return out


def scores(tables: np.ndarray, packed: np.ndarray) -> np.ndarray:
    """Inner products of candidates, packed as (candidates, planes, groups), with the tables' anchors."""
    total = np.zeros((len(packed), tables.shape[2]), tables.dtype)
    part = np.empty_like(total)
    for plane in range(packed.shape[1]):
        if plane == 1:
            np.negative(total, out=total)  # the highest plane is the sign's
        if plane:
            np.left_shift(total, 1, out=total)
        for group in range(packed.shape[2]):
            np.take(tables[group], packed[:, plane, group], axis=0, out=part)
            total += part
    return -total if packed.shape[1] == 1 else total


def _task(planes: int, k: int, percent: tuple[int, int] | None):
    """Scores a shard against a block: the first k of the anchor's label, or, within ``percent`` of each
    positive, of other labels."""

    def run(candidates: pa.Table, anchors: pa.Table) -> pa.Table:
        begins = range(0, len(anchors), AT_ONCE) if len(candidates) else ()
        found = [_of_block(candidates, anchors.slice(at, AT_ONCE), planes, k, percent) for at in begins]
        names = ("anchor", "anchor_id", "positive_id", "positive_score", "id", "score", "copy")
        columns = [np.concatenate(x) for x in zip(*found)] if found else [np.zeros(0, np.int64)] * 7
        kinds = [pa.int64()] * 6 + [pa.int32()]
        return pa.table({n: pa.array(x, t) for n, x, t in zip(names, columns, kinds)})

    return run


def _of_block(candidates: pa.Table, anchors: pa.Table, planes: int, k: int, percent) -> list[np.ndarray]:
    n = anchors.column("n")[0].as_py()
    q = anchors.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(anchors), n)
    largest = int(np.abs(q).sum(axis=1).max(initial=0)) << planes
    tables = tables_of(q.astype(np.int32 if largest < 2**31 else np.int64))
    raw = np.frombuffer(b"".join(candidates.column("z").to_pylist()), np.uint8)
    packed = raw.reshape(len(candidates), planes, -1) if n else np.zeros((len(candidates), planes, 0), np.uint8)
    ids, labels = candidates.column("id").to_numpy(), candidates.column("label").to_numpy()
    key, own_id, own_label = (anchors.column(c).to_numpy() for c in ("anchor", "anchor_id", "label"))
    if percent is None:
        slot = np.arange(len(key))
        positive = np.zeros((len(key), 3), np.int64)
    else:
        given = [
            (i, p["score"], p["id"], copy)
            for i, ps in enumerate(anchors.column("p").to_pylist()) for copy, p in enumerate(ps)
        ]
        slot = np.array([g[0] for g in given], np.int64)
        positive = np.array([g[1:] for g in given], np.int64).reshape(-1, 3)
    at = best = hit_ids = np.zeros(0, np.int64)
    kth = np.full(len(slot), np.iinfo(np.int64).min)
    for begin in range(0, len(ids), CHUNK):
        s = scores(tables, packed[begin : begin + CHUNK]).T.astype(np.int64)[slot]
        here, there = ids[begin : begin + CHUNK], labels[begin : begin + CHUNK]
        good = s >= kth[:, None]
        if percent is None:
            good &= here[None, :] != own_id[:, None]
        else:
            good &= there[None, :] != own_label[slot][:, None]
            bound = positive[:, :1]
            good &= (100 * s <= percent[1] * bound) & (100 * s >= percent[0] * bound)
        new, where = np.nonzero(good)
        at, best = np.concatenate([at, new]), np.concatenate([best, s[new, where]])
        hit_ids = np.concatenate([hit_ids, here[where]])
        order = np.lexsort((hit_ids, -best, at))
        order = order[np.arange(len(order)) - np.searchsorted(at[order], at[order]) < k]
        at, best, hit_ids = at[order], best[order], hit_ids[order]
        full = np.bincount(at, minlength=len(slot)) >= k
        last = np.searchsorted(at, np.arange(len(slot)), side="right") - 1
        kth[full] = best[last[full]]
    anchor = slot[at]
    return [key[anchor], own_id[anchor], positive[at, 1], positive[at, 0], hit_ids, best, positive[at, 2]]
