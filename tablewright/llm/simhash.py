"""Near-duplicates by SimHash fingerprints, with candidates filtered by the pigeonring principle.

A 64-bit fingerprint is a ring of ``distance + 1`` segments. If two fingerprints differ in at most
``distance`` bits, there is a segment from which on every chain of ``l`` consecutive segments
differs in at most ``l * distance / (distance + 1)`` bits, rounded down: in none for the first
segment, one for the first two, and so on (Qin and Xiao, 2018). So the first segment is equal, and
one half of the second is. Spark groups fingerprints by place, first segment and half; inside
a group the longer chains are tested one after the other, and the whole distance last.

Only distinct fingerprints take part, so exact copies are one node. A group with very many of them
is dealt to pairs of parts, each of bounded size. Inside a large part the links found form a
spanning forest of the part's links: a visited fingerprint is compared with those that are not
yet reached, so a dense group costs little more than one comparison each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.llm.common import checkpointed, column, components, give_back

BITS = 64
SHORT = 32  # groups up to this many fingerprints are compared in whole
PART = 50_000  # most fingerprints of a part of a group
_SEED = 42


def fingerprint(words: list[bytes], shingle: int) -> int:
    """Bits that more than half of the shingles' hashes have; zero for no words."""
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, _SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate([[0], ends[:-1]])
    n = len(words) - shingle + 1
    whole, digest = memoryview(joined), xxhash.xxh64_intdigest
    cuts = zip(starts[:n].tolist(), (ends[shingle - 1 :] - 1).tolist())
    hashes = np.fromiter((digest(whole[a:b], _SEED) for a, b in cuts), np.uint64, n)
    counts = np.zeros(BITS, np.int64)
    for begin in range(0, n, 65_536):
        part = hashes[begin : begin + 65_536].astype(">u8").view(np.uint8)
        counts += np.unpackbits(part).reshape(-1, BITS).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big")


def fingerprints(
    docs: DataFrame, shingle: int = 4, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id`` and ``fingerprint`` (the 64 bits as a long) of every row. Texts are lower-cased in
    A-Z; a NULL text has no words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), _prints(batch.column(1), shingle)], names=["doc_id", "fingerprint"]
            )
        give_back()

    taken = docs.select(column(doc_id).cast("long").alias("doc_id"), column(text).alias("text"))
    return taken.mapInArrow(run, "doc_id long, fingerprint long")


def fingerprinted(docs: DataFrame, shingle: int = 4, text: str = "text") -> DataFrame:
    """All columns of ``docs`` and ``fingerprint``, as ``fingerprints`` has it."""
    names, at = docs.columns, docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, _prints(batch.column(at), shingle)], names=[*names, "fingerprint"]
            )
        give_back()

    kind = T.StructType([*docs.schema.fields, T.StructField("fingerprint", T.LongType())])
    return docs.mapInArrow(run, kind)


def _prints(texts: pa.Array, shingle: int) -> pa.Array:
    words = ((t.as_py() or b"").lower().split() for t in texts.cast(pa.large_binary()))
    return pa.array(np.array([fingerprint(w, shingle) for w in words], np.uint64).view(np.int64))


def near_duplicates(
    docs: DataFrame,
    shingle: int = 4,
    distance: int = 4,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row for each document: ``doc_id``, ``fingerprint`` (long) and ``component_id``, the smallest
    id that can be reached over fingerprints at most ``distance`` bits apart.

    Empty and NULL texts have the fingerprint zero and are linked like any other. A row without an
    id keeps its NULL and is in the component of its fingerprint; a component of such rows only
    has a NULL id.
    """
    marked = checkpointed(fingerprints(docs, shingle, doc_id, text))
    nodes = marked.groupBy("fingerprint").agg(F.min("doc_id").alias("least"))
    roots = components(links(nodes.select("fingerprint"), distance))
    rooted = nodes.join(roots, F.col("fingerprint") == F.col("node"), "left").select(
        "fingerprint", "least", F.coalesce("root", "fingerprint").alias("root")
    )
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = rooted.join(smallest, "root").select("fingerprint", "component_id")
    return marked.join(classes, "fingerprint").select("doc_id", "fingerprint", "component_id")


def links(nodes: DataFrame, distance: int = 4) -> DataFrame:
    """Links (u, v) between distinct fingerprints of ``nodes``, enough to connect all that are
    linked by chains of at most ``distance`` bits a step."""
    segments = distance + 1
    bounds = [BITS * i // segments for i in range(segments + 1)]
    if distance < 1 or distance > 20:
        raise ValueError("the distance must be from 1 to 20")

    def bits(a: int, b: int):
        """The bits from a to b, b not included."""
        return F.shiftrightunsigned("fingerprint", a).bitwiseAND(F.lit((1 << (b - a)) - 1))

    keys = []
    for i in range(segments):
        a, b = bounds[i], bounds[i + 1]
        c, d = bounds[(i + 1) % segments], bounds[(i + 1) % segments + 1]
        for half, (e, f) in enumerate(((c, (c + d) // 2), ((c + d) // 2, d))):
            value = F.shiftleft(bits(a, b), f - e).bitwiseOR(bits(e, f))
            keys.append(F.struct(F.lit(2 * i + half).alias("place"), value.alias("value")))
    rows = nodes.select("fingerprint", F.inline(F.array(*keys)))
    large = rows.groupBy("place", "value").count().filter(F.col("count") > PART)
    if large.isEmpty():
        dealt = rows.select("*", F.lit(0).alias("a"), F.lit(0).alias("b"))
    else:
        parts = F.ceil(F.coalesce("count", F.lit(1)) / PART).cast("int")
        own = F.pmod(F.xxhash64("fingerprint"), "parts").cast("int")
        dealt = (
            rows.join(large, ["place", "value"], "left")
            .withColumn("parts", parts)
            .withColumn("own", own)
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
            .select(
                "fingerprint",
                "place",
                "value",
                F.least("own", "other").alias("a"),
                F.greatest("own", "other").alias("b"),
            )
        )
    group = ["place", "value", "a", "b"]
    run = dealt.repartition(*group).sortWithinPartitions(*group)
    return run.mapInArrow(lambda batches: _linked(batches, bounds, distance), "u long, v long")


def _linked(
    batches: Iterator[pa.RecordBatch], bounds: list[int], distance: int
) -> Iterator[pa.RecordBatch]:
    """Links of each group of rows with equal place, value and parts, which come together."""
    rest = None
    for batch in batches:
        columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in batch.schema.names]
        if rest is not None:
            columns = [np.concatenate(x) for x in zip(rest, columns)]
        changes = np.flatnonzero(
            np.any([c[1:] != c[:-1] for c in columns[1:]], axis=0)
        )
        last = changes[-1] + 1 if len(changes) else 0
        rest = [c[last:] for c in columns]
        if last:
            yield _of_groups([c[:last] for c in columns], bounds, distance)
    if rest is not None and len(rest[0]):
        yield _of_groups(rest, bounds, distance)
    give_back()


def _of_groups(columns: list[np.ndarray], bounds: list[int], distance: int) -> pa.RecordBatch:
    prints, place = columns[0].view(np.uint64), columns[1]
    new = np.ones(len(prints), bool)
    new[1:] = np.any([c[1:] != c[:-1] for c in columns[1:]], axis=0)
    starts = np.flatnonzero(new)
    sizes = np.diff(np.append(starts, len(prints)))
    size = np.repeat(sizes, sizes)
    until = np.repeat(starts + sizes, sizes)
    masks = _chains(bounds)
    us, vs = [], []
    short = np.flatnonzero(size <= SHORT)
    for step in range(1, SHORT):
        short = short[short + step < until[short]]
        if not len(short):
            break
        u, v = prints[short], prints[short + step]
        near = _near(u ^ v, place[short] // 2, masks, distance)
        us.append(u[near])
        vs.append(v[near])
    for begin, n in zip(starts[sizes > SHORT], sizes[sizes > SHORT]):
        own = masks[place[begin] // 2]
        left = np.unique(prints[begin : begin + n])
        reached: list[np.uint64] = []
        while len(left):
            if reached:
                at = reached.pop()
            else:
                at, left = left[0], left[1:]
            near = _near_one(left ^ at, own, distance)
            if near.any():
                us.append(np.full(int(near.sum()), at))
                vs.append(left[near])
                reached.extend(left[near])
                left = left[~near]
    u = np.concatenate(us) if us else np.zeros(0, np.uint64)
    v = np.concatenate(vs) if vs else np.zeros(0, np.uint64)
    return pa.RecordBatch.from_arrays(
        [pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], names=["u", "v"]
    )


def _chains(bounds: list[int]) -> np.ndarray:
    """For each first segment, the masks of the chains of 1, 2, ... segments from it."""
    segments = len(bounds) - 1
    masks = [((1 << (bounds[i + 1] - bounds[i])) - 1) << bounds[i] for i in range(segments)]
    return np.array(
        [
            [sum(masks[(i + j) % segments] for j in range(n)) for n in range(1, segments + 1)]
            for i in range(segments)
        ],
        np.uint64,
    )


def _near(differs: np.ndarray, first: np.ndarray, masks: np.ndarray, distance: int) -> np.ndarray:
    """Which differences pass every chain from their first segment; the last chain is the ring."""
    alive = np.arange(len(differs))
    for i in range(masks.shape[1]):
        budget = (i + 1) * distance // (distance + 1)
        chain = differs[alive] & masks[first[alive], i]
        alive = alive[np.bitwise_count(chain) <= budget]
    passed = np.zeros(len(differs), bool)
    passed[alive] = True
    return passed


def _near_one(differs: np.ndarray, masks: np.ndarray, distance: int) -> np.ndarray:
    return _near(differs, np.zeros(len(differs), np.int64), masks[None, :], distance)
