"""What several operators share: dealing documents to blocks, packed arrays, components."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the white space that separates words, as characters.
SPACES = " \t\n\x0b\x0c\r"
NO_ID = np.iinfo(np.int64).max  # stands for a NULL id inside tasks: larger than any other


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ready_to_checkpoint(spark: SparkSession) -> None:
    """Use the folder of ``spark.checkpoint.dir``; only where that is unset, as in tests, one in
    the warehouse."""
    if not spark.conf.get("spark.checkpoint.dir", None) and not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(
            spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
        )


def shared_folder(spark: SparkSession, name: str) -> str:
    """A folder of this name and of a new one in it, below ``spark.checkpoint.dir`` or, where that is
    unset, as in tests, below the warehouse."""
    top = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{top.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with a copy in the shared checkpoint folder."""
    ready_to_checkpoint(df.sparkSession)
    return df.checkpoint()


@contextlib.contextmanager
def releasing_shuffles(spark: SparkSession) -> Iterator[None]:
    """Frames that are made meanwhile give their shuffle files back as soon as they have run, instead of when
    the driver happens to collect garbage. For steps that end in a checkpoint, a written file or a few rows;
    a frame that is run twice makes its shuffles twice."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def block_count(spark: SparkSession) -> int:
    """Blocks to deal a corpus to: the session's shuffle partitions, which are sized so that one
    partition fits a task."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def column(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def dealt(
    docs: DataFrame,
    blocks: int | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    rest: bool = False,
) -> DataFrame:
    """Documents compressed and dealt to blocks: ``block``, ``id``, ``z`` (zstd; NULL for a NULL
    text) and, if asked for, ``rest``, a struct of all columns but the text.

    The block follows from id and text alone, so a lost task finds the same rows again. Plans
    that use the result several times share its one shuffle.
    """
    n = blocks or block_count(docs.sparkSession)
    block = F.pmod(F.xxhash64(column(doc_id), column(text)), F.lit(n)).cast("int").alias("block")
    taken = [block, column(doc_id).cast("long").alias("id"), column(text).cast("string").alias("t")]
    if rest:
        taken.append(F.struct(*[column(c) for c in docs.columns if c != text]).alias("rest"))
    taken = docs.select(*taken)
    fields = [f if f.name != "t" else T.StructField("z", T.BinaryType()) for f in taken.schema]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            texts = batch.column(2).cast(pa.large_binary())
            z = pa.array([None if t is None else squeeze(t) for t in texts.to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], z, *batch.columns[3:]],
                names=["block", "id", "z", *batch.schema.names[3:]],
            )
        give_back()

    return taken.mapInArrow(pack, T.StructType(fields)).repartition(n, "block")


def plain_texts(packed: pa.Table) -> Iterator[bytes | None]:
    """The texts of a block, one after the other."""
    plain = zstandard.ZstdDecompressor().decompress
    for chunk in packed.column("z").chunks:
        for z in chunk:
            yield None if not z.is_valid else plain(z.as_py())


def planes(values: np.ndarray) -> bytes:
    """The bytes of an array, all first bytes first, which lets sorted values compress."""
    return np.ascontiguousarray(
        values.view(np.uint8).reshape(len(values), values.itemsize).T
    ).tobytes()


def unplaned(data: bytes, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    raw = np.frombuffer(data, np.uint8).reshape(size, -1)
    return np.ascontiguousarray(raw.T).view(dtype).ravel()


def give_back() -> None:
    """Hand unused memory of Arrow and of the C library back to the system. Workers outlive their
    tasks, and what the allocators hold counts against the executor all the while."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def freeing(function):
    """``function``, after which unused memory is handed back."""

    @functools.wraps(function)
    def run(*args):
        try:
            return function(*args)
        finally:
            give_back()

    return run


def packed_list(words: list[bytes]) -> bytes:
    lengths = np.fromiter(map(len, words), "<u4", len(words))
    head = len(words).to_bytes(8, "little")
    return zstandard.compress(head + lengths.tobytes() + b"".join(words))


def unpacked_list(data: bytes) -> list[bytes]:
    plain = zstandard.decompress(data)
    n = int.from_bytes(plain[:8], "little")
    ends = np.cumsum(np.frombuffer(plain, "<u4", n, 8), dtype=np.int64) + 8 + 4 * n
    starts = [8 + 4 * n, *ends[:-1].tolist()]
    return [plain[a:b] for a, b in zip(starts, ends.tolist())]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def bucket_edges(names: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket of sorted 64-bit names begins; a bucket is a range of names."""
    of = ((names >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    return np.searchsorted(of, np.arange(buckets + 1, dtype=np.uint64))


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """Connected components of ``links`` (u, v): each linked ``node`` with ``root``, the smallest
    node it can reach.

    Alternates large-star and small-star steps (Kiveris et al., 2014) until the links no longer
    change; each round is cut off with a checkpoint. A round handles every link a fixed number
    of times, and minima are taken before shuffling, so a hub of many links is no bottleneck.
    """
    both = links.select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    ).filter("u <> v")
    links = checkpointed(both.distinct())
    seen = None
    for _ in range(most_rounds):
        links = checkpointed(_small_star(_large_star(links)))
        state = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            return links.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        seen = state
    raise RuntimeError(f"components have not settled in {most_rounds} rounds")


def _large_star(links: DataFrame) -> DataFrame:
    ways = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = ways.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (
        ways.join(least, "u")
        .filter("v > u")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.withColumnRenamed("m", "v")).filter("u <> v").distinct()
