"""Reading, creating and overwriting catalog tables."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable, Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.functions.text import quoted
from tablewright.functions.types import declared_columns

# Schema of a source and of a target that name none.
SOURCE_SCHEMA = "bronze"
TARGET_SCHEMA = "silver"
# Formats whose tables are plain folders of files.
FILE_FORMATS = ("parquet", "orc", "avro", "csv", "json", "text")
# Whether tables that are created enter each partition in the catalog.
_TRACKED = "spark.sql.hive.manageFilesourcePartitions"


def table_name(name: str, schema: str | None = None, catalog: str | None = None) -> str:
    """Quoted ``[catalog.][schema.]name``; the session's catalog is used if none is given."""
    if not name:
        raise ValueError("table name is missing")
    if catalog and not schema:
        raise ValueError(f"catalog {catalog!r} is given without a schema")
    return ".".join(quoted(part) for part in (catalog, schema, name) if part)


def read_table(
    spark: SparkSession, name: str, schema: str | None = SOURCE_SCHEMA, catalog: str | None = None
) -> DataFrame:
    """The table ``name``. ``schema=None`` means the session's current schema.

    As in Spark SQL, a file format may stand for the schema and a path for the
    name: ``read_table(spark, "/data/orders", schema="parquet")``.
    """
    return spark.table(table_name(name, schema, catalog))


def ensure_table(
    spark: SparkSession,
    name: str,
    columns: Iterable,
    schema: str | None = TARGET_SCHEMA,
    catalog: str | None = None,
    fmt: str = "parquet",
    location: str | None = None,
    partitioned_by: Sequence[str] = (),
) -> str:
    """Create the schema and the table from declared columns where absent.

    Returns the qualified name, to be handed to ``load_overwrite``. An existing
    table is left as it is. ``location`` makes the table external. Partitions of a table of
    files are found by its folder and not entered in the catalog one by one, so that a load
    changes all of them by one statement.
    """
    fields = ", ".join(f"{quoted(c.name)} {c.spark_type}" for c in declared_columns(columns))
    full_name = table_name(name, schema, catalog)
    if schema:
        owner = ".".join(quoted(part) for part in (catalog, schema) if part)
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {owner}")
    place = f" LOCATION '{_literal(location)}'" if location else ""
    parts = f" PARTITIONED BY ({', '.join(map(quoted, partitioned_by))})" if partitioned_by else ""
    create = f"CREATE TABLE IF NOT EXISTS {full_name} ({fields}) USING {fmt}{parts}{place}"
    before = spark.conf.get(_TRACKED)
    spark.conf.set(_TRACKED, "false")
    try:
        spark.sql(create)
    finally:
        spark.conf.set(_TRACKED, before)
    return full_name


def load_overwrite(df: DataFrame, full_name: str) -> None:
    """Replace the whole content of an existing table with ``df``, and nothing but the content.

    ``full_name`` is a qualified name as returned by ``ensure_table``. Format, location in use,
    partitioning and types are the table's; columns are matched by name and cast to its types,
    and both sides must have the same. Rows are exchanged once the write has succeeded: a load
    that fails leaves the old ones. ``df`` may read the table itself.

    A table of files gets its new files in a folder of their own beside the old ones and is then
    pointed at it by one statement, which changes all partitions at once; the old files are
    removed last. So readers see either the old rows or the new. Only where the catalog holds each
    partition by itself (not so for tables made by ``ensure_table``) do partitions follow one
    another: new ones in one statement, those that stay one by one, those that go in one
    statement at the end; if one of these fails, what was changed is changed back. Tables of
    other formats take the overwrite of their own, which has to be atomic.
    """
    spark = df.sparkSession
    table = spark.table(full_name)
    names = table.columns
    given = {c.lower(): c for c in df.columns}
    if len(given) != len(df.columns) or given.keys() != {c.lower() for c in names}:
        raise ValueError(f"the load has columns {df.columns}, the table {names}")
    rows = df.select(
        *[
            F.col(quoted(given[f.name.lower()])).cast(f.dataType).alias(f.name)
            for f in table.schema
        ]
    )
    described = json.loads(spark.sql(f"DESCRIBE TABLE EXTENDED {full_name} AS JSON").first()[0])
    if described.get("provider", "").lower() not in FILE_FORMATS:
        rows.writeTo(full_name).overwrite(F.lit(True))
        return
    partitions = described.get("partition_columns") or []
    tracked = partitions and described.get("partition_provider", "").lower() == "catalog"
    old = described["location"].rstrip("/")
    new = f"{re.sub('__load_[0-9a-f]{32}$', '', old)}__load_{uuid.uuid4().hex}"
    writer = rows.write.format(described["provider"])
    writer = writer.options(**(described.get("storage_properties") or {}))
    try:
        writer.partitionBy(*partitions).save(new) if partitions else writer.save(new)
        steps = [(_placed(full_name, new), _placed(full_name, old))]
        if tracked:
            first, last = _partition_steps(spark, full_name, old, new, len(partitions))
            steps = [*first, *steps, *last]
        _all_or_none(spark, steps)
    except BaseException:
        spark.catalog.refreshTable(full_name)
        _remove(spark, new)
        raise
    spark.catalog.refreshTable(full_name)
    _remove(spark, old)


def _all_or_none(spark: SparkSession, steps: Sequence[tuple[str, str | None]]) -> None:
    """Run statements; if one fails, run the reverse of those before it, the last one first."""
    done = []
    try:
        for statement, reverse in steps:
            spark.sql(statement)
            done.insert(0, reverse)
    except BaseException:
        for reverse in filter(None, done):
            spark.sql(reverse)
        raise


def _placed(full_name: str, folder: str, partition: str = "") -> str:
    return f"ALTER TABLE {full_name} {partition} SET LOCATION '{_literal(folder)}'"


def _partition_steps(
    spark: SparkSession, full_name: str, old: str, new: str, depth: int
) -> tuple[list[tuple[str, str | None]], list[tuple[str, str | None]]]:
    """Statements, each with its reverse, that turn the catalog's partitions into those of ``new``,
    and the last one, which drops those that go, files included, and has none."""
    had = {r[0] for r in spark.sql(f"SHOW PARTITIONS {full_name}").collect()}
    now = _folders(spark, new, depth)
    # Loads leave every partition in the table's folder; elsewhere the catalog has to be asked.
    loaded = set(_folders(spark, old, depth)) if re.search("__load_[0-9a-f]{32}$", old) else set()

    def spec(path: str) -> str:
        values = []
        for part in path.split("/"):
            name, _, value = part.partition("=")
            value = unquote(value)
            null = value == "__HIVE_DEFAULT_PARTITION__"
            values.append(f"{quoted(name)} = " + ("NULL" if null else f"'{_literal(value)}'"))
        return f"PARTITION ({', '.join(values)})"

    def place(path: str) -> str:
        if path in loaded:
            return f"{old}/{path}"
        rows = spark.sql(f"DESCRIBE TABLE EXTENDED {full_name} {spec(path)}").collect()
        return next(r.data_type for r in rows if r.col_name == "Location")

    added = [p for p in now if p not in had]
    steps = []
    if added:
        listed = " ".join(f"{spec(p)} LOCATION '{_literal(f'{new}/{p}')}'" for p in added)
        gone = ", ".join(map(spec, added))
        steps.append((f"ALTER TABLE {full_name} ADD {listed}", f"ALTER TABLE {full_name} DROP {gone}"))
    steps += [
        (_placed(full_name, f"{new}/{p}", spec(p)), _placed(full_name, place(p), spec(p)))
        for p in now
        if p in had
    ]
    if had - set(now):
        gone = ", ".join(map(spec, sorted(had - set(now))))
        return steps, [(f"ALTER TABLE {full_name} DROP {gone}", None)]
    return steps, []


def _folders(spark: SparkSession, top: str, depth: int) -> list[str]:
    """Paths of the partitions below ``top``, relative to it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(top)
    system = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    found = [("", path)]
    for _ in range(depth):
        found = [
            (f"{name}/{s.getPath().getName()}".lstrip("/"), s.getPath())
            for name, folder in found
            for s in system.listStatus(folder)
            if s.isDirectory() and "=" in s.getPath().getName()
        ]
    return sorted(name for name, _ in found)


def _remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def _literal(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")
