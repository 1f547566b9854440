"""Key-based comparison of an expected and an actual table.

Keys are compared null-safely: NULL equals NULL. Values are compared by their
trimmed text, NULL equal only to NULL, so that representation differences in
padding do not count. With ``compare="typed"`` the values themselves are compared
(INT 10 equals DOUBLE 10.0), strings still trimmed: in the common type of both sides
where that type holds either without loss, else by a text of the exact value. A
floating-point number stands for the shortest decimal that reads back as it. Keys of
unlike types are compared like that as well.

Where a key occurs several times, each expected row is compared with each actual
row of that key. Those pairs are counted and never formed: equal rows are first
counted per side, and a key with ``e`` expected and ``a`` actual rows has
``e * a - sum(e_v * a_v)`` mismatched pairs over its distinct rows ``v``. Nothing is
joined, both aggregations merge on the map side, and a key that holds a third of
all rows is spread over the cluster by its values first.

Digests. What travels by key is not the compared values but a digest of them, two 64-bit
hashes with unlike seeds, which is 16 bytes however wide a row is. Counts need nothing
else; where values are asked for, they are read again for the keys whose digests differ
and compared exactly. Two rows of one key that differ count as equal with a chance of
2^-128, so a key with n distinct rows is misjudged with one of about n^2 / 2^129, and n
keys of two distinct rows each with one of n / 2^128: below 10^-24 for 10^14 rows. The
hashes are not cryptographic and no guard against values made to collide. ``exact=True``
sends the values themselves. Digests are not used where they would be no shorter (one or
two numbers) and leave out columns of nested or collated types, which travel as they are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions.text import quoted
from tablewright.operators.aggregates import group_keys

# Products of two row counts do not fit a BIGINT.
_COUNT = "decimal(19,0)"
_PAIRS = "decimal(38,0)"
# Types of which two values are equal just when their texts are.
_SAME_AS_TEXT = (T.DecimalType, T.DateType, T.TimestampNTZType, T.BooleanType)
_DATED = (T.DateType, T.TimestampType, T.TimestampNTZType)


def compare_schema(expected: DataFrame, actual: DataFrame) -> bool:
    """Whether both have the same column names in the same order."""
    return expected.columns == actual.columns


def compare_counts(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """One row: the row count of each side and PASS or FAIL."""
    return _row_counts(expected, actual).selectExpr(
        "e AS expected_row_count",
        "a AS actual_row_count",
        f"{_pass_if('e = a')} AS row_count_validation",
    )


def missing_keys(expected: DataFrame, actual: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Distinct expected keys that no actual row has."""
    return _one_sided(expected, actual, keys)


def extra_keys(expected: DataFrame, actual: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Distinct actual keys that no expected row has."""
    return _one_sided(actual, expected, keys)


def duplicate_keys(df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows as ``key_rows``."""
    keys = _required_keys(keys, df)
    grouped = df.groupBy(*map(quoted, keys)).agg(F.count("*").alias("key_rows"))
    return grouped.filter("key_rows > 1")


def mismatches(
    expected: DataFrame,
    actual: DataFrame,
    keys: str | Sequence[str],
    compare: str = "text",
    exact: bool = False,
) -> DataFrame:
    """Keys on both sides with differing values.

    One row per key: its columns, ``expected_rows``, ``actual_rows`` and
    ``mismatched_pairs``. The pairs of all keys add up to the ``mismatched_rows``
    of ``report``.
    """
    keys = _comparable(expected, actual, keys)
    rows = _Compared(expected, actual, keys, compare, exact)
    return rows.per_key().filter("pairs > 0").select(
        *_keys_back(expected, keys),
        F.col("e").alias("expected_rows"),
        F.col("a").alias("actual_rows"),
        F.col("pairs").alias("mismatched_pairs"),
    )


def mismatch_rows(
    expected: DataFrame,
    actual: DataFrame,
    keys: str | Sequence[str],
    compare: str = "text",
    exact: bool = False,
) -> DataFrame:
    """The differing rows themselves, for the keys of ``mismatches``.

    One row per key and distinct compared values, with the number of rows on each
    side as ``expected_rows`` and ``actual_rows``. Strings are trimmed, and values of
    types that are compared by their text are given as text.
    """
    keys = _comparable(expected, actual, keys)
    values = [c for c in expected.columns if c not in keys]
    rows = _Compared(expected, actual, keys, compare, exact)
    suspect = rows.per_key().filter("pairs > 0")
    # Grouped values are at hand in the exact mode; after digests they are read again.
    found = rows.of_keys(rows.tally() if exact else rows.rows, suspect)
    if not exact:
        found = found.groupBy(*rows.ks, *rows.vs).agg(*_sums())
    return found.select(
        *_keys_back(expected, keys),
        *[F.col(v).alias(c) for v, c in zip(rows.vs, values)],
        F.col("e").alias("expected_rows"),
        F.col("a").alias("actual_rows"),
    )


def mismatches_by_column(
    expected: DataFrame,
    actual: DataFrame,
    keys: str | Sequence[str],
    compare: str = "text",
    exact: bool = False,
) -> DataFrame:
    """Per compared column, the number of pairs in which it differs.

    Rows: ``column_name``, ``mismatched_pairs``; columns without a difference have 0.
    A first pass finds the mismatched keys, a second reads their rows only. Keys with one
    distinct row on each side become one row with the values of both and are compared there;
    distinct rows of other keys stay apart in the same grouping and are taken to cells.
    """
    keys = _comparable(expected, actual, keys)
    values = [c for c in expected.columns if c not in keys]
    if not values:
        raise ValueError("there is no column besides the keys to compare")
    rows = _Compared(expected, actual, keys, compare, exact)
    several = "n_e > 1 OR n_a > 1 AS several"
    suspect = rows.per_key(["n_e", "n_a"]).filter("pairs > 0").selectExpr(*rows.ks, several)
    found = rows.of_keys(rows.rows, suspect, ["several"])
    # What tells distinct rows of a key apart is no matter where each side has one.
    apart = [f"CASE WHEN several THEN {c} END AS c{i}" for i, c in enumerate(rows.contents)]
    grouped = (
        found.selectExpr("*", *apart)
        .groupBy(*rows.ks, "several", *_numbered("c", len(apart)))
        .agg(
            *_sums(),
            *[
                F.expr(f"first({v}) FILTER (WHERE {side} > 0) AS {v}_{side}")
                for v in rows.vs
                for side in "ea"
            ],
        )
    )
    # Conditions on counts stay above the grouping, so that both parts share its exchange.
    ordinary = grouped.filter("CASE WHEN e + a > 0 THEN NOT several END")
    product = f"CAST(e AS {_COUNT}) * CAST(a AS {_COUNT})"
    sums = ordinary.agg(
        *[F.expr(f"sum({product}) FILTER (WHERE NOT {v}_e <=> {v}_a) AS {v}") for v in rows.vs]
    )
    sums = sums.select(
        F.posexplode(F.array(*[F.coalesce(v, F.lit(0)).cast(_PAIRS) for v in rows.vs])).alias(
            "column_no", "pairs"
        )
    )
    texts = [_cell(rows.rows, v, f"CASE WHEN e > 0 THEN {v}_e ELSE {v}_a END") for v in rows.vs]
    cells = grouped.filter("CASE WHEN e + a > 0 THEN several END").selectExpr(
        *rows.ks, "e", "a", f"posexplode(array({', '.join(texts)})) AS (column_no, cell)"
    )
    per_cell = cells.groupBy(*rows.ks, "column_no", "cell").agg(*_sums())
    found = (
        per_cell.groupBy(*rows.ks, "column_no")
        .agg(*_sums(), F.expr(f"sum({product}) AS equal"))
        .selectExpr("column_no", f"CAST({product} - equal AS {_PAIRS}) AS pairs")
    )
    # The ordinary keys give a row for each column, so those without a difference are there too.
    totals = sums.unionAll(found).groupBy("column_no").agg(F.sum("pairs").alias("pairs"))
    return totals.select(
        F.lit(values)[F.col("column_no")].alias("column_name"),
        F.col("pairs").cast(_PAIRS).alias("mismatched_pairs"),
    )


def report(
    expected: DataFrame | None,
    actual: DataFrame | None,
    keys: str | Sequence[str] | None,
    compare: str = "text",
    exact: bool = False,
) -> DataFrame:
    """The whole reconciliation as one row, from one pass over each table.

    Statuses are PASS, FAIL or SKIPPED: ``schema_validation`` (ordered column
    names), ``row_count_validation``, ``data_validation`` (missing, extra and
    mismatched rows) and ``overall_status``. Data that cannot be compared because
    the schemas differ is SKIPPED and fails overall; absent keys or inputs fail.
    Duplicate keys are a warning only. ``errors`` and ``warnings`` are text arrays, and so
    are ``expected_columns`` and ``actual_columns``, NULL for an absent table.
    """
    if expected is None or actual is None:
        name = "expected" if expected is None else "actual"
        nothing = SparkSession.active().range(1).select()
        columns = [df if df is None else df.columns for df in (expected, actual)]
        return _report_row(nothing, False, "FAIL", [f"there is no {name} table"], columns)
    columns = [expected.columns, actual.columns]
    keys = group_keys(keys)
    errors = []
    same = compare_schema(expected, actual)
    if not same:
        errors.append(f"columns differ: expected {expected.columns}, actual {actual.columns}")
    absent = {
        name: [k for k in keys if k not in df.columns]
        for name, df in (("expected", expected), ("actual", actual))
    }
    errors += [f"the {name} table lacks the keys {lost}" for name, lost in absent.items() if lost]
    if not keys:
        errors.append("no keys are given")
    if not keys or any(absent.values()):
        return _report_row(_row_counts(expected, actual), same, "FAIL", errors, columns)
    if not same:
        return _report_row(_row_counts(expected, actual), same, "SKIPPED", errors, columns)
    totals = _totals(_Compared(expected, actual, keys, compare, exact).tally(), len(keys))
    return _report_row(totals, same, None, errors, columns)


def _report_row(
    totals: DataFrame, same: bool, data: str | None, errors: list, columns: list
) -> DataFrame:
    """The report on counts; ``data`` is the data verdict where nothing was compared."""
    have = totals.columns
    schema = "PASS" if same else "FAIL"
    if "e" in have:
        counts = _pass_if("e = a")
        text = "concat('row counts differ: expected ', e, ', actual ', a)"
        uneven = f"CASE WHEN e <> a THEN {text} END"
    else:
        schema, counts, uneven = "SKIPPED", "'SKIPPED'", "CAST(NULL AS string)"
    if data is None:
        data = _pass_if("missing = 0 AND extra = 0 AND mismatched = 0")
        twice = "twice_e > 0 OR twice_a > 0"
    else:
        data, twice = f"'{data}'", "false"

    def number(name: str, alias: str, kind: str = "bigint") -> Column:
        return F.expr(f"CAST({name if name in have else 'NULL'} AS {kind}) AS {alias}")

    overall = _pass_if(f"'{schema}' = 'PASS' AND {counts} = 'PASS' AND {data} = 'PASS'")
    known = F.array(*map(F.lit, errors), F.expr(uneven))
    return totals.select(
        F.expr(f"'{schema}' AS schema_validation"),
        F.expr(f"{counts} AS row_count_validation"),
        F.expr(f"{data} AS data_validation"),
        F.expr(f"{overall} AS overall_status"),
        number("e", "expected_row_count"),
        number("a", "actual_row_count"),
        number("missing", "missing_rows"),
        number("extra", "extra_rows"),
        number("mismatched", "mismatched_rows", _PAIRS),
        number("twice_e", "duplicate_expected_keys"),
        number("twice_a", "duplicate_actual_keys"),
        F.array_compact(known).alias("errors"),
        F.expr(
            f"array_compact(array(CASE WHEN {twice} THEN 'some keys occur more than once' END))"
            " AS warnings"
        ),
        *[
            F.lit(names).cast("array<string>").alias(f"{side}_columns")
            for side, names in zip(("expected", "actual"), columns)
        ],
    )


def _row_counts(expected: DataFrame, actual: DataFrame) -> DataFrame:
    return _tagged(expected.select(), actual.select()).agg(*_side_totals())


def _pass_if(condition: str) -> str:
    return f"CASE WHEN {condition} THEN 'PASS' ELSE 'FAIL' END"


def _sums() -> list[Column]:
    return [F.sum("e").alias("e"), F.sum("a").alias("a")]


def _side_totals() -> list[Column]:
    return [F.expr("coalesce(sum(e), 0L) AS e"), F.expr("coalesce(sum(a), 0L) AS a")]


def _numbered(prefix: str, n: int) -> list[str]:
    return [f"{prefix}{i}" for i in range(n)]


def _cell(rows: DataFrame, value: str, at: str) -> str:
    """The compared value ``at`` as text; equal texts mean equal values."""
    instant = isinstance(rows.schema[value].dataType, T.TimestampType)
    return f"string(unix_micros({at}))" if instant else f"string({at})"


def _required_keys(keys, *tables: DataFrame) -> list[str]:
    keys = group_keys(keys)
    if not keys:
        raise ValueError("no keys are given")
    for df in tables:
        absent = [k for k in keys if k not in df.columns]
        if absent:
            raise ValueError(f"keys {absent} are not among the columns {df.columns}")
    return keys


def _comparable(expected: DataFrame, actual: DataFrame, keys) -> list[str]:
    keys = _required_keys(keys, expected, actual)
    if not compare_schema(expected, actual):
        raise ValueError(f"columns differ: expected {expected.columns}, actual {actual.columns}")
    return keys


def _tagged(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Both tables one above the other, with ``e`` = 1 or ``a`` = 1 telling the side."""
    return expected.selectExpr("*", "1L AS e", "0L AS a").unionAll(
        actual.selectExpr("*", "0L AS e", "1L AS a")
    )


def _one_sided(having: DataFrame, lacking: DataFrame, keys) -> DataFrame:
    keys = _required_keys(keys, having, lacking)
    ks = _numbered("k", len(keys))
    exprs = _key_exprs(having, lacking, keys)

    def named(df: DataFrame, side: int) -> DataFrame:
        return df.selectExpr(*[f"{pair[side]} AS {n}" for pair, n in zip(exprs, ks)])

    # Whether a key occurs is all that matters, so one flag per side is enough.
    seen = _tagged(named(having, 0), named(lacking, 1)).groupBy(*ks).agg(F.max("a").alias("a"))
    return seen.filter("a = 0").select(*_keys_back(having, keys))


def _keys_back(table: DataFrame, keys: Sequence[str]) -> list[Column]:
    """Key columns under their names and, after the union, in the types of ``table``."""
    return [
        F.col(f"k{i}").cast(table.schema[key].dataType).alias(key) for i, key in enumerate(keys)
    ]


class _Compared:
    """Both tables one above the other as they are compared: keys ``k0..``, values ``v0..`` and
    the side; ``contents`` are the columns that tell the distinct rows of a key apart."""

    def __init__(self, expected, actual, keys: Sequence[str], compare: str, exact: bool):
        if compare not in ("text", "typed"):
            raise ValueError(f"compare must be 'text' or 'typed', not {compare!r}")
        values = [c for c in expected.columns if c not in keys]
        key_exprs = _key_exprs(expected, actual, keys)
        value_exprs = [
            _compared(c, expected.schema[c].dataType, actual.schema[c].dataType, compare)
            for c in values
        ]
        self.ks, self.vs = _numbered("k", len(keys)), _numbered("v", len(values))

        def named(df: DataFrame, side: int) -> DataFrame:
            return df.selectExpr(
                *[f"{pair[side]} AS {k}" for pair, k in zip(key_exprs, self.ks)],
                *[f"{pair[side]} AS {v}" for pair, v in zip(value_exprs, self.vs)],
            )

        self.rows = _tagged(named(expected, 0), named(actual, 1))
        digested = [] if exact else _digested({v: self.rows.schema[v].dataType for v in self.vs})
        if digested:
            # NULLs do not count in the hashes, so each value says whether it is one.
            parts = ", ".join(f"{v}, {v} IS NULL" for v in digested)
            seeds = {"d0": 1, "d1": 2}
            self.rows = self.rows.selectExpr(
                "*", *[f"xxhash64({seed}, {parts}) AS {d}" for d, seed in seeds.items()]
            )
            self.contents = [*seeds, *[v for v in self.vs if v not in digested]]
        else:
            self.contents = self.vs

    def tally(self) -> DataFrame:
        """Per key and distinct contents, the row counts ``e`` and ``a``."""
        return self.rows.groupBy(*self.ks, *self.contents).agg(*_sums())

    def per_key(self, distinct: Sequence[str] = ()) -> DataFrame:
        return _per_key(self.tally(), len(self.ks), distinct)

    def of_keys(self, rows: DataFrame, keys: DataFrame, more: Sequence[str] = ()) -> DataFrame:
        """The ``rows`` whose key is among ``keys``, with what ``more`` names there.

        Joined on a hash besides the keys, so that the grouped keys are exchanged once
        more and adaptive execution can split a hot key on the side of the rows.
        """
        hashed = f"xxhash64({', '.join(self.ks)}) AS h"
        wanted = keys.selectExpr(*self.ks, *more, hashed).alias("wanted")
        rows = rows.selectExpr("*", hashed).alias("rows")
        condition = " AND ".join(
            ["rows.h = wanted.h", *[f"rows.{k} <=> wanted.{k}" for k in self.ks]]
        )
        if not more:
            return rows.join(wanted, F.expr(condition), "left_semi").drop("h")
        return rows.join(wanted, F.expr(condition)).selectExpr(
            *[f"rows.{c}" for c in rows.columns if c != "h"], *[f"wanted.{c}" for c in more]
        )


def _digested(kinds: dict[str, T.DataType]) -> list[str]:
    """The values that go into a digest: those of plain types, where that makes rows shorter."""
    plain = {v: t for v, t in kinds.items() if _plain(t)}
    fixed = not any(isinstance(t, (T.StringType, T.BinaryType)) for t in plain.values())
    return [] if not plain or fixed and len(plain) <= 2 else list(plain)


def _plain(kind: T.DataType) -> bool:
    """Whether equal values of the type have equal hashes, and unlike ones hardly ever."""
    dated = isinstance(kind, (T.BooleanType, T.BinaryType, *_DATED))
    return dated or isinstance(kind, T.NumericType) or kind == T.StringType()


def _compared(column: str, one: T.DataType, other: T.DataType, compare: str) -> tuple[str, str]:
    """What stands for a value of either side: equal just when the values count as equal."""
    name = quoted(column)
    if one == other and isinstance(one, _SAME_AS_TEXT):
        return name, name
    if isinstance(one, T.IntegralType) and isinstance(other, T.IntegralType):
        return name, name
    if compare == "typed":
        numeric = isinstance(one, T.NumericType) and isinstance(other, T.NumericType)
        dated = isinstance(one, _DATED) and isinstance(other, _DATED)
        if numeric and one != other:
            return _numbers(name, one, other)
        if dated and {type(one), type(other)} == {T.TimestampType, T.TimestampNTZType}:
            return _instant(name, one), _instant(name, other)
        if numeric or dated or (one == other and not isinstance(one, T.StringType)):
            return name, name
    return f"trim(string({name}))", f"trim(string({name}))"


def _key_exprs(one: DataFrame, other: DataFrame, keys: Sequence[str]) -> list[tuple[str, str]]:
    """What stands for the keys of either side; it can be cast back to the type it came from."""
    exprs = []
    for key in keys:
        a, b, name = one.schema[key].dataType, other.schema[key].dataType, quoted(key)
        if isinstance(a, T.NumericType) and isinstance(b, T.NumericType) and a != b:
            exprs.append(_numbers(name, a, b))
        elif {type(a), type(b)} == {T.TimestampType, T.TimestampNTZType}:
            raise ValueError(f"key {key!r} is an instant on one side and a local time on the other")
        else:
            exprs.append((name, name))
    return exprs


def _numbers(name: str, one: T.DataType, other: T.DataType) -> tuple[str, str]:
    """Two numbers of unlike types: as they are where the type that Spark gives both holds them."""
    digits = [_digits(t) for t in (one, other)]
    floats = [isinstance(t, (T.FloatType, T.DoubleType)) for t in (one, other)]
    if all(floats) or all(isinstance(t, T.IntegralType) for t in (one, other)):
        return name, name
    if not any(floats):
        whole, scale = (max(d[i] for d in digits) for i in (0, 1))
        if whole + scale <= 38:
            kind = f"decimal({whole + scale},{scale})"
            return f"CAST({name} AS {kind})", f"CAST({name} AS {kind})"
    return _exact_text(name), _exact_text(name)


def _digits(kind: T.DataType) -> tuple[int, int]:
    """Most digits before and after the point; of no use for floating-point types."""
    if isinstance(kind, T.DecimalType):
        return kind.precision - kind.scale, kind.scale
    # Digits of the integral types.
    return {"tinyint": 3, "smallint": 5, "int": 10}.get(kind.simpleString(), 19), 0


def _exact_text(name: str) -> str:
    """A number as plain decimal text, without exponent, needless zeros or a sign on zero."""
    text = f"upper(string({name}))"
    exponent = f"coalesce(try_cast(nullif(split_part({text}, 'E', 2), '') AS int), 0)"
    mantissa = f"ltrim('-', split_part({text}, 'E', 1))"
    fraction = f"split_part({mantissa}, '.', 2)"
    sign = f"CASE WHEN {text} LIKE '-%' THEN '-' ELSE '' END"
    # d: all digits; p: how many of them stand before the point.
    parts = (
        f"named_struct('s', {sign}, 'd', concat(split_part({mantissa}, '.', 1), {fraction}), "
        f"'p', length(split_part({mantissa}, '.', 1)) + {exponent})"
    )
    padded = (
        "named_struct('s', x.s, 'd', concat(repeat('0', greatest(0, 1 - x.p)), x.d, "
        "repeat('0', greatest(0, x.p - length(x.d)))), 'p', greatest(1, x.p))"
    )
    whole = "coalesce(nullif(ltrim('0', left(x.d, x.p)), ''), '0')"
    rest = "rtrim('0', substr(x.d, x.p + 1))"
    plain = (
        f"CASE WHEN ltrim('0', x.d) = '' THEN '0' WHEN {rest} = '' THEN concat(x.s, {whole}) "
        f"ELSE concat(x.s, {whole}, '.', {rest}) END"
    )
    number = (
        f"transform(transform(array({parts}), x -> {padded}), x -> {plain})[0]"
    )
    return f"CASE WHEN {text} RLIKE '^-?[0-9]' THEN {number} ELSE {text} END"


def _instant(name: str, kind: T.DataType) -> str:
    """An instant as text; a local time that the session's time zone skips is none."""
    if isinstance(kind, T.TimestampType):
        return f"string(unix_micros({name}))"
    at = f"CAST({name} AS timestamp)"
    skipped = f"concat('local ', string({name}))"
    return (
        f"CASE WHEN CAST({at} AS timestamp_ntz) = {name} THEN string(unix_micros({at})) "
        f"WHEN {name} IS NOT NULL THEN {skipped} END"
    )


def _per_key(tally: DataFrame, n_keys: int, distinct: Sequence[str] = ()) -> DataFrame:
    """Per key: rows of each side and pairs of differing rows. ``distinct`` may name ``n_e`` and
    ``n_a``, the distinct rows of each side."""
    counts = [F.expr(f"count_if({c[-1]} > 0) AS {c}") for c in distinct]
    product = f"CAST(e AS {_COUNT}) * CAST(a AS {_COUNT})"
    grouped = tally.groupBy(*_numbered("k", n_keys)).agg(
        *_sums(), F.expr(f"sum({product}) AS equal"), *counts
    )
    return grouped.selectExpr("*", f"CAST({product} - equal AS {_PAIRS}) AS pairs")


def _totals(tally: DataFrame, n_keys: int) -> DataFrame:
    return _per_key(tally, n_keys).agg(
        *_side_totals(),
        F.expr("count_if(a = 0) AS missing"),
        F.expr("count_if(e = 0) AS extra"),
        F.expr(f"CAST(coalesce(sum(pairs), 0) AS {_PAIRS}) AS mismatched"),
        F.expr("count_if(e > 1) AS twice_e"),
        F.expr("count_if(a > 1) AS twice_a"),
    )
