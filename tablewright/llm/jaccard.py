"""Documents linked by the Jaccard similarity of their shingle sets, with set relations to skip work.

Only distinct sets take part. They are dealt by the smallest hash of their shingles, so that highly
similar ones mostly meet. There a set within half the distance of an earlier one, its *leader*, becomes
a follower and is kept as the few shingles it lacks and has beyond the leader; by the triangle
inequality all followers of a leader are linked. So only leaders are indexed, with a threshold that
allows for the followers' distance, and a follower's answers are derived from its leader's: the overlap
of two leaders, less and more what the differences hit.

The index lists, for each shingle of a leader's prefix, the leaders that have it. Shingles are in one
global order, rare ones first (by bounded counts over all documents), so frequent ones hardly enter a
prefix. A list is sorted by set size and position; sets of one size are a block. For a probe, blocks
outside the size bounds are skipped, so is the rest of a block from the first position on at which too
few shingles remain, and so are lists whose sets are connected already. Leaders that are known to be
connected never form candidates: first a few leaders of each two groups in a list are tried, then, with
the groups found, all pairs of the lists where some were left out. Candidates whose parities (of the
shingles in each of 1,024 hashed cells) differ in more cells than the sets may in shingles are dropped;
the others are verified on whole sets.

Shingles and sets are named by hashes of 58 and 64 bits; unlike ones share a name with a chance of about
n^2 / 2^59 and n^2 / 2^65 for n of them in a pair of texts, and in the corpus.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import (
    checkpointed,
    column,
    components,
    give_back,
    mixed,
    releasing_shuffles,
)

BUCKETS = 1 << 20  # hashed counts that order shingles; the table of their magnitudes is 1 MB
PIECES = 16
PART = 128  # sets compared in whole, besides hubs
HUBS = 8  # leaders that a long run of similar sets is compared with
PART_SHINGLES = 1 << 20  # shingles of sets compared in whole, about
CROWD = 1_024  # sets with one smallest shingle that are dealt together, about
LIST = 50_000  # longest list that is not dealt to pairs of parts
FEW = 2  # candidates of two groups in a list that are tried before all are
PAIRS = 1_024  # candidates verified together
CUT = 1 << 22  # bytes of a text cut into words at once
REMEMBERED = 400_000  # words whose hashes a task remembers
WANTED = 1 << 23  # bits that tell which lists hold a leader still to be joined
SKETCH = 1024  # bits of the parities that bound how far two sets differ
_ROW = (
    "kind int, id long, leader long, n int, followed int, head array<long>, sketch array<long>,"
    " followers binary"
)
_LEADER, _LINK = 0, 1


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_hashes(text: bytes | None, shingle: int, known: _Hashes) -> np.ndarray:
    """Hashes of the distinct shingles of a text, sorted; none without words."""
    words = []
    begin, text = 0, text or b""
    while begin < len(text):
        end = begin + CUT
        while end < len(text) and text[end] not in b" \t\n\x0b\x0c\r":
            end += 1
        cut = text[begin:end].lower().split()
        words.append(np.fromiter(map(known.__getitem__, cut), np.uint64, len(cut)))
        begin = end
    h = np.concatenate(words) if words else np.zeros(0, np.uint64)
    if not len(h):
        return h
    size = min(shingle, len(h))
    n = len(h) - size + 1
    out = np.full(n, size, np.uint64)
    for i in range(size):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + h[i : i + n])
    return np.unique(out)


def named(hashes: np.ndarray) -> int:
    """The name of a set, as a signed long."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(hashes.tobytes())).view(np.int64))


def ordered(hashes: np.ndarray, magnitude: np.ndarray) -> np.ndarray:
    """Names of shingles, rare ones first; the upper six bits tell the magnitude of the count."""
    m = magnitude[(hashes & np.uint64(len(magnitude) - 1)).astype(np.int64)].astype(np.uint64)
    return np.sort((m << np.uint64(58)) | (hashes >> np.uint64(6)))


class Threshold:
    """Jaccard similarities as whole numbers: ``percent`` for a link. Followers are within half its
    distance; a pair of leaders may be farther apart by that for each side that has followers."""

    def __init__(self, percent: int):
        self.percent = percent

    def linked(self, overlap, n, m):
        return 100 * overlap >= self.percent * (n + m - overlap)

    def follows(self, overlap, n, m):
        return 200 * overlap >= (100 + self.percent) * (n + m - overlap)

    def least(self, followed, n, m):
        """The least overlap of leaders of which ``followed`` (0, 1, 2) have followers."""
        j = 2 * self.percent - (100 - self.percent) * followed  # of 200
        return -(-j * (n + m) // (200 + j))

    def head(self, followed: int, n: int) -> int:
        """Shingles of the prefix of a set, whatever the other set's size and followers."""
        j = 2 * self.percent - (100 - self.percent) * (followed + 1)
        return n - (-(-j * n // 200)) + 1


def classes(
    docs: DataFrame,
    shingle: int = 3,
    percent: int = 90,
    doc_id: str = "doc_id",
    text: str = "text",
    part: int = PART,
    hubs: int = HUBS,
) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id``, the smallest id reachable by links, for every row.

    Texts are lower-cased in A-Z. A set has the distinct shingles of ``shingle`` words; with fewer
    words, the whole sequence is the only one. Rows are linked where the overlap of their sets is at
    least ``percent`` of the union. A NULL text, or one without words, has an empty set and is linked
    with nothing. Repeated rows are linked rows; a row without an id keeps its NULL and is in the
    component of its set, whose id is NULL where no row has one. Long texts are cut into words
    piece by piece; a set takes 8 bytes a shingle. ``part`` sets are compared in whole at once, and with
    ``hubs`` earlier leaders; neither changes the result.
    """
    if not 60 <= percent < 100:
        raise ValueError("the percentage must be from 60 to 99")
    with releasing_shuffles(docs.sparkSession):
        marks, roots = _connected(docs, shingle, Threshold(percent), doc_id, text, part, hubs)
    nodes = marks.filter("id IS NOT NULL").groupBy("id").agg(F.min("doc_id").alias("least"))
    rooted = nodes.join(roots, F.col("id") == F.col("node"), "left").select(
        "id", "least", F.coalesce("root", "id").alias("root")
    )
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named_ = rooted.join(smallest, "root").select("id", "component_id")
    return marks.filter("id IS NOT NULL").join(named_, "id").select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id"
    ).union(marks.filter("id IS NULL").selectExpr("doc_id", "n AS n_shingles", "doc_id AS component_id"))


def _connected(
    docs: DataFrame, shingle: int, limit: Threshold, doc_id: str, text: str, part: int, hubs: int
) -> tuple[DataFrame, DataFrame]:
    """``doc_id``, size ``n`` and set ``id`` of each row, and the ``root`` of each linked set. Its many small
    steps each end in a checkpoint or in a few rows."""
    taken = docs.select(column(doc_id).cast("long").alias("doc_id"), column(text).cast("string").alias("text"))
    seen = checkpointed(
        taken.mapInArrow(
            lambda b: _marked(b, shingle),
            "doc_id long, n long, id long, first long, z binary, piece int, counts binary",
        )
    )
    marks = seen.filter("piece IS NULL").select("doc_id", "n", "id")
    sets = seen.filter("z IS NOT NULL").select("first", "id", "z")
    # A table of ``BUCKETS`` bytes, whatever the corpus.
    magnitudes = _magnitudes(seen)
    told = docs.sparkSession.sparkContext.broadcast(magnitudes)
    # A list cannot be longer than its shingle's count.
    long_ = int(magnitudes.max()) >= LIST.bit_length()

    near = _gathered(sets)
    rows = checkpointed(near.mapInArrow(lambda b: _clustered(b, shingle, limit, told, part, hubs), _ROW))
    leaders = rows.filter(f"kind = {_LEADER}")
    links = rows.filter(f"kind = {_LINK}").selectExpr("id AS u", "leader AS v")

    def bits_of(shingles: DataFrame):
        return docs.sparkSession.sparkContext.broadcast(_bits(shingles))  # ``WANTED`` bits

    # What a prefix has for the sake of followers concerns lists of leaders that have some.
    bits = bits_of(leaders.filter("followed = 1").select("head"))
    some = leaders.withColumn("comp", F.col("leader"))
    some = some.mapInArrow(lambda b: _masked(b, bits, limit), some.schema)
    tried = checkpointed(_candidates(some, limit, FEW, long_))

    def linked(candidates: DataFrame) -> DataFrame:
        pairs = checkpointed(_near_enough(candidates.distinct(), leaders, limit))
        return checkpointed(_verified(pairs, sets, leaders, shingle, limit, told))

    roots = components(links.union(linked(tried.filter("v IS NOT NULL"))))
    left_out = tried.filter("v IS NULL").select(F.array("u").alias("head"))
    if not left_out.isEmpty():
        more = bits_of(left_out)
        rest = some.mapInArrow(lambda b: _masked(b, more), some.schema)
        rest = rest.drop("comp").join(roots, F.col("id") == F.col("node"), "left").select(
            *leaders.columns, F.coalesce("root", "id").alias("comp")
        )
        found = linked(_candidates(rest, limit, None, long_))
        if not found.isEmpty():
            roots = components(roots.selectExpr("node AS u", "root AS v").union(found))
    return marks, roots


def _marked(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    """Id, set size and set name of each row; the smallest shingle and the compressed text too, mostly
    once for the copies in a task; at the end the task's hashed counts of shingles."""
    known, counts, seen = _Hashes(), np.zeros(BUCKETS, np.uint32), set()
    squeeze = zstandard.ZstdCompressor(level=3).compress
    kinds = [pa.int64()] * 4 + [pa.binary(), pa.int32(), pa.binary()]
    names = ["doc_id", "n", "id", "first", "z", "piece", "counts"]

    def rows(*columns) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    for batch in batches:
        out, held = [], [np.zeros(0, np.int64)]
        for doc_id, t in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.large_binary())):
            t = t.as_py()
            h = shingle_hashes(t, shingle, known)
            held.append((h & np.uint64(BUCKETS - 1)).astype(np.int64))
            name = named(h) if len(h) else None
            first = z = None
            if name is not None and name not in seen:
                if len(seen) >= REMEMBERED:
                    seen.clear()
                seen.add(name)
                first, z = int(h[:1].view(np.int64)[0]), squeeze(t)
            out.append((doc_id, len(h), name, first, z, None, None))
        np.add.at(counts, np.concatenate(held), np.uint32(1))
        yield rows(*zip(*out)) if out else rows(*[[]] * 7)
    z = [zstandard.compress(x.astype(np.uint64).tobytes()) for x in np.split(counts, PIECES)]
    yield rows(*[[None] * PIECES] * 5, range(PIECES), z)
    give_back()


def _magnitudes(seen: DataFrame) -> np.ndarray:
    """Bit lengths of the hashed counts of all tasks, which are added up in two steps, row by row."""

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for piece, z in zip(batch.column(0).to_pylist(), batch.column(1)):
                part = np.frombuffer(zstandard.decompress(z.as_py()), np.uint64)
                sums[piece] = sums[piece] + part if piece in sums else part.copy()
        if sums:
            z = [zstandard.compress(x.tobytes()) for x in sums.values()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums), pa.int32()), pa.array(z, pa.binary())], names=["piece", "counts"]
            )

    kind = "piece int, counts binary"
    parts = seen.filter("piece IS NOT NULL").select("piece", "counts")
    first = parts.repartition("piece", F.pmod(F.xxhash64("counts"), F.lit(64))).mapInArrow(added, kind)
    sums = {
        r.piece: np.frombuffer(zstandard.decompress(bytes(r.counts)), np.uint64)
        for r in first.repartition(PIECES, "piece").mapInArrow(added, kind).collect()
    }
    counts = np.concatenate([sums.get(i, np.zeros(BUCKETS // PIECES, np.uint64)) for i in range(PIECES)])
    return np.frexp(counts.astype(np.float64))[1].astype(np.uint8)


def _bits(shingles: DataFrame) -> np.ndarray:
    """Bits, by hash, of all shingles in an array column."""

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(WANTED, bool)
        for batch in batches:
            bits[_cell(batch.column(0).flatten().to_numpy())] = True
        if bits.any():
            yield of(np.packbits(bits))

    def either(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(WANTED // 8, np.uint8)
        for batch in batches:
            for z in batch.column(0):
                bits |= np.frombuffer(zstandard.decompress(z.as_py()), np.uint8)
        if bits.any():
            yield of(bits)

    def of(bits: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([zstandard.compress(bits.tobytes())], pa.binary())], names=["z"])

    parts = shingles.mapInArrow(marked, "z binary").repartition(32, F.xxhash64("z")).mapInArrow(either, "z binary")
    rows = parts.repartition(1).mapInArrow(either, "z binary").collect()  # a megabyte of each part
    return np.frombuffer(zstandard.decompress(bytes(rows[0].z)), np.uint8) if rows else np.zeros(WANTED // 8, np.uint8)


def _cell(names: np.ndarray) -> np.ndarray:
    return (names.view(np.uint64) % np.uint64(WANTED)).astype(np.int64)


def _masked(batches: Iterator[pa.RecordBatch], told, limit: Threshold | None = None) -> Iterator[pa.RecordBatch]:
    """Leaders whose head keeps the shingles of ``told`` and, with ``limit``, those of the prefix that
    leaders without followers need among themselves; others become NULL, in their places."""
    bits = np.unpackbits(told.value).astype(bool)
    for batch in batches:
        at = batch.schema.get_field_index("head")
        head = batch.column(at)
        flat = head.flatten()
        known = flat.is_valid().to_numpy(zero_copy_only=False)
        flat = flat.fill_null(0).to_numpy()
        lengths = head.value_lengths().to_numpy()
        ends = np.concatenate([[0], np.cumsum(lengths)])
        kept = bits[_cell(flat)]
        if limit:
            short = limit.head(-1, batch.column("n").to_numpy().astype(np.int64))
            kept |= np.arange(len(flat)) - np.repeat(ends[:-1], lengths) < np.repeat(short, lengths)
        kept &= known
        hits = np.concatenate([[0], np.cumsum(kept)])
        columns = list(batch.columns)
        columns[at] = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, mask=~kept))
        masked = pa.RecordBatch.from_arrays(columns, names=batch.schema.names)
        yield masked.filter(pa.array(hits[ends[1:]] > hits[ends[:-1]]))


def _gathered(sets: DataFrame) -> DataFrame:
    """Sets with one smallest shingle side by side; a crowd of them is dealt to several places. These
    are told by a table of crowds, so that texts are exchanged once, whatever crowds there are."""
    told = sets.sparkSession.sparkContext.broadcast(_crowds(sets))  # a byte for each of ``BUCKETS``

    def salted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = told.value[_crowd_cell(batch.column(0).to_numpy())].astype(np.int64)
            places = np.maximum(1, (np.int64(1) << bits) // CROWD).astype(np.uint64)
            salt = mixed(batch.column(1).to_numpy().view(np.uint64)) % places
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(salt.astype(np.int64))], names=[*batch.schema.names, "salt"]
            )
        give_back()

    dealt = sets.mapInArrow(salted, "first long, id long, z binary, salt long")
    return dealt.repartition("first", "salt").sortWithinPartitions("first", "salt", "id").drop("salt")


def _crowds(sets: DataFrame) -> np.ndarray:
    """Bit lengths, by hash, of the numbers of sets that share their smallest shingle with more than
    ``CROWD``; zero elsewhere."""

    def of(table: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([zstandard.compress(table.tobytes())], pa.binary())], names=["z"])

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(BUCKETS, np.uint8)
        for batch in batches:
            bits = np.frexp(batch.column(1).to_numpy().astype(np.float64))[1].astype(np.uint8)
            np.maximum.at(table, _crowd_cell(batch.column(0).to_numpy()), bits)
        if table.any():
            yield of(table)

    def largest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(BUCKETS, np.uint8)
        for batch in batches:
            for z in batch.column(0):
                np.maximum(table, np.frombuffer(zstandard.decompress(z.as_py()), np.uint8), out=table)
        if table.any():
            yield of(table)

    crowds = sets.groupBy("first").count().filter(F.col("count") > CROWD)
    parts = crowds.mapInArrow(marked, "z binary").repartition(32, F.xxhash64("z")).mapInArrow(largest, "z binary")
    rows = parts.repartition(1).mapInArrow(largest, "z binary").collect()  # a megabyte of each part
    return np.frombuffer(zstandard.decompress(bytes(rows[0].z)), np.uint8) if rows else np.zeros(BUCKETS, np.uint8)


def _crowd_cell(firsts: np.ndarray) -> np.ndarray:
    return (mixed(firsts.view(np.uint64)) & np.uint64(BUCKETS - 1)).astype(np.int64)


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all pairs of sets."""
    found = np.zeros((len(sets), len(sets)), np.int64)
    np.fill_diagonal(found, [len(s) for s in sets])
    flat = np.concatenate(sets)
    who = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(flat, kind="stable")
    flat, who = flat[order], who[order]
    new = np.ones(len(flat), bool)
    new[1:] = flat[1:] != flat[:-1]
    at = np.cumsum(new) - 1
    shared = np.bincount(at)[at] > 1
    at, who = at[shared], who[shared]
    if not len(at):
        return found
    at = np.cumsum(np.append(True, at[1:] != at[:-1])) - 1
    total = np.zeros(found.shape, np.float32)
    for begin in range(0, int(at[-1]) + 1, 4096):  # columns of a 0/1 matrix, some at a time
        own = slice(*np.searchsorted(at, [begin, begin + 4096]))
        bits = np.zeros((len(sets), 4096), np.float32)
        bits[who[own], at[own] - begin] = 1
        total += bits @ bits.T
    np.copyto(found, total.astype(np.int64), where=~np.eye(len(sets), dtype=bool))
    return found


def _clustered(
    batches: Iterator[pa.RecordBatch], shingle: int, limit: Threshold, told, most: int, most_hubs: int
) -> Iterator[pa.RecordBatch]:
    """Leaders with their followers, and links, of runs of sets with one smallest shingle. A leader's
    ``leader`` is the one that stands for its connected group."""
    known, magnitude = _Hashes(), told.value
    plain = zstandard.ZstdDecompressor().decompress
    part: list[tuple[int, np.ndarray]] = []
    hubs: list[tuple[int, np.ndarray, int]] = []  # id, set, group
    run, size, out = None, 0, []

    def close() -> None:
        nonlocal size
        if part:
            new = _grouped(part, hubs, limit, out)
            hubs[:] = (hubs + new)[-most_hubs:]
            part.clear()
        size = 0

    for batch in batches:
        for first, name, z in zip(*(batch.column(i) for i in range(3))):
            first, name = first.as_py(), name.as_py()
            if first != run:
                close()
                hubs.clear()
                run = first
            if part and part[-1][0] == name:
                continue
            z = z.as_py()
            s = ordered(shingle_hashes(plain(z), shingle, known), magnitude)
            part.append((name, s))
            size += len(s)
            if len(part) >= most or size >= PART_SHINGLES:
                close()
        if len(out) >= 256:
            yield _rows(out)
            out.clear()
    close()
    yield _rows(out)
    give_back()


def _rows(out: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*out)) if out else [[]] * 8
    longs = pa.list_(pa.int64())
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), longs, longs, pa.binary()]
    names = ["kind", "id", "leader", "n", "followed", "head", "sketch", "followers"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def _grouped(part, hubs, limit: Threshold, out: list[tuple]) -> list[tuple[int, np.ndarray, int]]:
    """Adds the rows of a part to ``out``; the leaders that stand for its new groups are the result."""
    sets = [s for _, s in part] + [s for _, s, _ in hubs]
    n = np.array([len(s) for s in sets])
    if len(sets) == 1:
        same = np.array([[n[0]]])
    else:
        same = overlaps(sets)
    leaders: list[int] = []
    followers: dict[int, list[int]] = {}
    for i in range(len(part)):
        for leader in leaders:
            if limit.follows(same[i, leader], n[i], n[leader]):
                followers.setdefault(leader, []).append(i)
                break
        else:
            leaders.append(i)
    # Connected groups of leaders and hubs; a hub's group is known.
    group = {i: part[i][0] for i in leaders} | {len(part) + k: g for k, (_, _, g) in enumerate(hubs)}
    nodes = [*range(len(part), len(sets)), *leaders]
    root = {i: i for i in nodes}

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for at, i in enumerate(leaders):
        for j in nodes[: len(hubs) + at]:
            if limit.linked(same[i, j], n[i], n[j]):
                a, b = top(i), top(j)
                if a != b:
                    if b < len(part) <= a:
                        a, b = b, a
                    if a >= len(part):  # two hubs' groups meet
                        out.append((_LINK, group[a], group[b], None, None, None, None, None))
                    root[a] = b
    new = []
    for i in leaders:
        name, s = part[i]
        stands = group[top(i)]
        if stands == name:
            new.append((name, s, name))
        else:
            out.append((_LINK, name, stands, None, None, None, None, None))
        own = followers.get(i, [])
        out += [(_LINK, part[f][0], name, None, None, None, None, None) for f in own]
        packed = [np.array([len(own)], np.int64)]
        for f in own:
            x = part[f][1]
            lacks, more = np.setdiff1d(s, x, True), np.setdiff1d(x, s, True)
            packed += [np.array([len(x), len(lacks), len(more)]), lacks.view(np.int64), more.view(np.int64)]
        followed = int(bool(own))
        head = s[: limit.head(followed, len(s))].view(np.int64)
        cells = np.bincount((s & np.uint64(SKETCH - 1)).astype(np.int64), minlength=SKETCH) & 1
        sketch = np.packbits(cells.astype(np.uint8)).view(np.int64)
        packed = np.concatenate(packed).tobytes() if own else None
        out.append((_LEADER, name, stands, len(s), followed, head, sketch, packed))
    return new


def _candidates(leaders: DataFrame, limit: Threshold, few: int | None, long_: bool) -> DataFrame:
    """Pairs (u, v) of leaders of different ``comp`` that may be near enough. With ``few``, no more of two
    groups in a list, and a row (shingle, NULL) for each list where that left some out."""
    lists = leaders.select(
        "id", "n", "followed", "comp", "head", F.posexplode("head").alias("pos", "token")
    ).filter("token IS NOT NULL").select(
        "token",
        # Size, position and flag in one number, which sorts by size and position.
        F.expr("shiftleft(CAST(n AS bigint), 33) + shiftleft(CAST(pos AS bigint), 1) + followed").alias("what"),
        "id",
        "comp",
        # The shingle before, or what no other leader has.
        F.expr("CASE WHEN pos > 0 THEN coalesce(element_at(head, pos), id) ELSE id END").alias("before"),
    )
    dealt = lists.withColumns({"a": F.lit(0), "b": F.lit(0)})
    if long_:
        # The name tells the magnitude of the shingle's count.
        longest = (
            lists.filter(F.shiftrightunsigned("token", 58) >= LIST.bit_length())
            .groupBy("token").count().filter(F.col("count") > LIST)
        )
        if not longest.isEmpty():
            dealt = (
                lists.join(longest, "token", "left")
                .withColumn("parts", F.ceil(F.coalesce("count", F.lit(1)) / LIST).cast("int"))
                .withColumn("own", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
                .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
                .withColumns({"a": F.least("own", "other"), "b": F.greatest("own", "other")})
                .drop("count", "parts", "own", "other")
            )
    order = ["token", "a", "b"]
    run = dealt.repartition(*order).sortWithinPartitions(*order, "what", "id")
    return run.mapInArrow(lambda b: _paired(b, limit, few), "u long, v long")


def _paired(
    batches: Iterator[pa.RecordBatch], limit: Threshold, few: int | None
) -> Iterator[pa.RecordBatch]:
    rest, names = None, ["token", "a", "b", "what", "id", "comp", "before"]
    for batch in batches:
        columns = [batch.column(c).to_numpy() for c in names]
        if rest is not None:
            columns = [np.concatenate(x) for x in zip(rest, columns)]
        ends = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns[:3]], axis=0))
        last = ends[-1] + 1 if len(ends) else 0
        rest = [c[last:] for c in columns]
        if last:
            yield from _of_lists(dict(zip(names, (c[:last] for c in columns))), limit, few)
    if rest is not None and len(rest[0]):
        yield from _of_lists(dict(zip(names, rest)), limit, few)
    give_back()


def _of_lists(
    x: dict[str, np.ndarray], limit: Threshold, few: int | None
) -> Iterator[pa.RecordBatch]:
    """Candidates of whole lists, each sorted by size and position."""
    new = np.ones(len(x["id"]), bool)
    new[1:] = np.any([x[c][1:] != x[c][:-1] for c in ("token", "a", "b")], axis=0)
    starts = np.flatnonzero(new)
    lengths = np.diff(np.append(starts, len(new)))
    # Skip lists of one set, and those that are connected already.
    useful = np.minimum.reduceat(x["comp"], starts) != np.maximum.reduceat(x["comp"], starts)
    keep = np.repeat(useful, lengths)
    x = {c: x[c][keep] for c in ("token", "what", "id", "comp", "before")}
    if not useful.any():
        return
    x |= {"n": x["what"] >> 33, "pos": x["what"] >> 1 & (1 << 32) - 1, "followed": x["what"] & 1}
    which = np.repeat(np.arange(int(useful.sum())), lengths[useful])
    n, pos = x["n"], x["pos"]
    size = len(n)
    new = np.ones(size, bool)
    new[1:] = (which[1:] != which[:-1]) | (n[1:] != n[:-1])
    block = np.cumsum(new) - 1
    begins = np.flatnonzero(new)
    ends = np.append(begins[1:], size)
    block_list, block_n = which[begins], n[begins]
    placed = (block << 32) | pos
    # The blocks of each probe: its own and larger ones within the size bound.
    j = 2 * limit.percent - 2 * (100 - limit.percent)
    largest = n * 200 // j
    reach = np.searchsorted((block_list << 32) | block_n, (which << 32) | largest, side="right")
    fan = reach - block
    for first, last in _slices(fan, 1 << 20):
        probe = np.repeat(np.arange(first, last), fan[first:last])
        to = block[probe] + _steps(fan[first:last])
        least = limit.least(x["followed"][probe] + 1, n[probe], block_n[to])
        good = pos[probe] <= n[probe] - least
        probe, to, least = probe[good], to[good], least[good]
        until = np.searchsorted(placed, (to << 32) | np.maximum(block_n[to] - least, -1), side="right")
        until = np.where(block_n[to] < least, begins[to], np.minimum(until, ends[to]))
        since = np.maximum(begins[to], probe + 1)
        count = np.maximum(until - since, 0)
        for one, two in _slices(count, 1 << 20):
            u = np.repeat(probe[one:two], count[one:two])
            v = np.repeat(since[one:two], count[one:two]) + _steps(count[one:two])
            good = x["comp"][u] != x["comp"][v]
            # Where the shingles before are the same, an earlier list has the pair.
            good &= x["before"][u] != x["before"][v]
            u, v = u[good], v[good]
            least = limit.least(x["followed"][u] + x["followed"][v], n[u], n[v])
            good = (pos[u] <= n[u] - least) & (pos[v] <= n[v] - least)
            u, v = u[good], v[good]
            if few:
                groups = [f(x["comp"][u], x["comp"][v]) for f in (np.minimum, np.maximum)]
                order = np.lexsort((*groups, which[u]))
                new = np.ones(len(order), bool)
                new[1:] = np.any([k[order][1:] != k[order][:-1] for k in (*groups, which[u])], axis=0)
                begun = np.flatnonzero(new)
                rank = np.arange(len(order)) - np.repeat(begun, np.diff(np.append(begun, len(order))))
                over = np.unique(x["token"][u[order[rank >= few]]])
                if len(over):
                    none = pa.nulls(len(over), pa.int64())
                    yield pa.RecordBatch.from_arrays([pa.array(over), none], names=["u", "v"])
                u, v = u[order[rank < few]], v[order[rank < few]]
            a, b = x["id"][u], x["id"][v]
            pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)
            if pairs.shape[1]:
                yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["u", "v"])


def _steps(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... up to each count, one after the other."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)


def _slices(counts: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of entries whose counts add up to about ``most``."""
    ends, begin = np.cumsum(counts), 0
    while begin < len(counts):
        done = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, done + most, side="right")))
        yield begin, end
        begin = end


def _near_enough(pairs: DataFrame, leaders: DataFrame, limit: Threshold) -> DataFrame:
    """Pairs whose parities differ in no more cells than the sets may in shingles."""
    of = leaders.select("id", "n", "followed", "sketch")
    told = pairs
    for end in ("u", "v"):
        told = told.join(of.select(*[F.col(c).alias(f"{c}_{end}") for c in of.columns]), F.col(end) == F.col(f"id_{end}"))
    apart = "aggregate(zip_with(sketch_u, sketch_v, (x, y) -> bit_count(x ^ y)), 0, (s, x) -> s + x)"
    j = f"({2 * limit.percent}L - {100 - limit.percent}L * (followed_u + followed_v))"
    least = f"(({j} * (n_u + n_v) + 199 + {j}) div (200 + {j}))"
    return told.filter(f"{apart} <= n_u + n_v - 2 * {least}").select("u", "v").distinct()


def _dealt(pairs: DataFrame) -> DataFrame:
    """Pairs with a ``bucket``, by families: the least leader that either end is paired with. So most texts
    are sent to one bucket, however many pairs there are. A family of many pairs is dealt by a part of
    either end; a bucket that got more than its share, as that of a hub may, is dealt once more."""
    buckets = 4 * pairs.count() // PAIRS + 1
    ends = pairs.union(pairs.selectExpr("v AS u", "u AS v"))
    least = ends.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("least")).select("u", "least")
    families = pairs.join(least, "u").join(least.selectExpr("u AS v", "least AS other"), "v").select(
        "u", "v", F.least("least", "other").alias("family")
    )
    large = families.groupBy("family").count().filter(F.col("count") > PAIRS)
    parts = f"CAST(ceil(sqrt(count / {PAIRS})) AS bigint)"
    cut = families.join(large, "family", "left").selectExpr(
        "u",
        "v",
        f"CASE WHEN count IS NULL THEN pmod(xxhash64(family), {buckets}L) ELSE"
        f" xxhash64(family, pmod(xxhash64(u), {parts}), pmod(xxhash64(v), {parts})) END AS bucket",
    )
    full = cut.groupBy("bucket").count().filter(F.col("count") > 4 * PAIRS)
    if full.isEmpty():
        return cut.select("u", "v", "bucket")
    again = f"pmod(xxhash64(u, v), ceil(coalesce(count, 1L) / {2 * PAIRS}))"
    return cut.join(full, "bucket", "left").selectExpr("u", "v", f"xxhash64(bucket, {again}) AS bucket")


def _verified(
    pairs: DataFrame, sets: DataFrame, leaders: DataFrame, shingle: int, limit: Threshold, told
) -> DataFrame:
    """The pairs of leaders that are linked, or have followers that are."""
    dealt = _dealt(pairs)
    wanted = dealt.select((F.col("bucket") + 0).alias("bucket"), F.explode(F.array("u", "v")).alias("id")).distinct()
    held = _texts_of(pairs, sets, leaders).join(wanted, "id")
    return (
        dealt.groupBy("bucket").cogroup(held.groupBy("bucket"))
        .applyInArrow(lambda p, t: _linked(p, t, shingle, limit, told), "u long, v long")
    )


def _texts_of(pairs: DataFrame, sets: DataFrame, leaders: DataFrame) -> DataFrame:
    """Texts and followers of the sets in ``pairs``, found by bits of their names (and few others), so that
    the join after it need not exchange the corpus."""
    told = pairs.sparkSession.sparkContext.broadcast(_bits(pairs.select(F.array("u", "v"))))
    texts = sets.selectExpr("id", "z", "CAST(NULL AS binary) AS followers")
    follow = leaders.filter("followers IS NOT NULL").selectExpr("id", "CAST(NULL AS binary) AS z", "followers")
    rows = texts.union(follow)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(told.value).astype(bool)
        for batch in batches:
            yield batch.filter(pa.array(bits[_cell(batch.column(0).to_numpy())]))
        give_back()

    return rows.mapInArrow(kept, rows.schema)


def _linked(pairs: pa.Table, texts: pa.Table, shingle: int, limit: Threshold, told) -> pa.Table:
    known, plain = _Hashes(), zstandard.ZstdDecompressor().decompress
    rows: dict[int, list[int]] = {}
    for at, name in enumerate(texts.column("id").to_pylist()):
        rows.setdefault(name, []).append(at)

    @functools.lru_cache(maxsize=256)
    def whole(name: int) -> np.ndarray:
        z = next(z for at in rows[name] if (z := texts.column("z")[at].as_py()) is not None)
        return ordered(shingle_hashes(plain(z), shingle, known), told.value)

    def members(name: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """Size and differences of the leader itself and of its followers."""
        none = np.zeros(0, np.uint64)
        out = [(len(whole(name)), none, none)]
        for at in rows[name]:
            packed = texts.column("followers")[at].as_py()
            flat = np.frombuffer(packed, np.uint64) if packed else np.zeros(1, np.uint64)
            place = 1
            for _ in range(int(flat[0])):
                n, lacks, more = (int(x) for x in flat[place : place + 3])
                place += 3 + lacks + more
                out.append((n, flat[place - lacks - more : place - more], flat[place - more : place]))
        return out

    found = []
    for u, v in sorted(zip(pairs.column("u").to_pylist(), pairs.column("v").to_pylist())):
        a, b = whole(u), whole(v)
        same = len(np.intersect1d(a, b, True))
        one, two = members(u), members(v)
        if limit.linked(same, len(a), len(b)) or _some_linked(same, a, b, one, two, limit):
            found.append((u, v))
    us, vs = zip(*found) if found else ([], [])
    give_back()
    return pa.table({"u": pa.array(us, pa.int64()), "v": pa.array(vs, pa.int64())})


def _some_linked(same: int, a, b, one, two, limit: Threshold) -> bool:
    """Whether a member of one leader is linked with one of the other, from the leaders' overlap."""

    def common(s: np.ndarray, t: np.ndarray) -> int:
        return len(np.intersect1d(s, t, True)) if len(s) and len(t) else 0

    if len(one) == len(two) == 1 or same < limit.least((len(one) > 1) + (len(two) > 1), len(a), len(b)):
        return False
    for n, lacks, more in one:
        with_b = same - common(lacks, b) + common(more, b)
        for m, lacks_2, more_2 in two:
            if not limit.linked(with_b + len(more_2), n, m):
                continue  # not even if all that is more were common
            in_first = lambda s: common(s, a) - common(s, lacks) + common(s, more)  # noqa: B023, E731
            if limit.linked(with_b - in_first(lacks_2) + in_first(more_2), n, m):
                return True
    return False
