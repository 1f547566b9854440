"""Joins and lookups with named output columns.

Skew. Adaptive execution splits a hot key on either side of an inner join and on
the streamed side of an outer, semi or anti join, as long as both sides reach the
join through an exchange of their own. Two things here keep that true or fill the gap:

* A side that was grouped or joined by the same keys before would enter the join
  without an exchange. Comparing a hash of the keys as well gives both sides one
  (``_matchable``). Semi and anti joins always do so, since their inner side is
  reduced to distinct keys first; other joins do where ``hot`` is given.
* An outer join cannot split the side it does not stream. Where ``hot`` names such a
  side, the join becomes the union of an inner join and of anti joins padded with
  NULLs, all of which can be split.

``hot="auto"`` finds such sides: one pass over the keys keeps a sketch of frequent items, which
tasks merge, and a side is hot where its most frequent key has ``HOT_ROWS`` rows or more and at
least twice what a shuffle partition should get. FULL joins, whose sides adaptive execution
never splits, do so by themselves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions.text import quoted
from tablewright.operators.columns import distinct_names

# Accepted join names -> Spark join types. A cross join always comes
# with a condition, which makes it an inner join.
JOIN_TYPES = {
    "INNER": "inner",
    "NORMAL": "inner",
    "NORMAL JOIN": "inner",
    "CONNECTED": "inner",
    "LEFT": "left",
    "LEFT OUTER": "left",
    "MASTER": "left",
    "DETAIL": "left",
    "RIGHT": "right",
    "RIGHT OUTER": "right",
    "FULL": "full",
    "FULL OUTER": "full",
    "OUTER": "full",
    "CROSS": "inner",
    "LEFT SEMI": "left_semi",
    "SEMI": "left_semi",
    "LEFT ANTI": "left_anti",
    "ANTI": "left_anti",
}
# Key types whose hash is the same for all values that compare equal.
_HASHABLE = (
    T.DecimalType,
    T.DateType,
    T.TimestampType,
    T.TimestampNTZType,
    T.BooleanType,
    T.BinaryType,
)
_HASH = "__key_hash"
# A key is hot from so many rows on.
HOT_ROWS = 1_000_000
_TRACKED_KEYS = 10_000  # of a task's sketch of frequent keys

Pair = tuple[str, str]
Output = str | tuple[str, str] | tuple[str, str, str]


def join_type(how: str | None) -> str:
    """Spark join type of a join name, in any case, with or without ``_``, spaces and JOIN."""
    name = str(how or "INNER").replace("_", " ").upper().strip().removesuffix(" JOIN")
    try:
        return {k.replace(" ", ""): kind for k, kind in JOIN_TYPES.items()}["".join(name.split())]
    except KeyError:
        raise ValueError(f"unknown join type {how!r}; known: {sorted(JOIN_TYPES)}") from None


def join(
    left: DataFrame,
    right: DataFrame,
    on: Pair | Sequence[Pair] | str | Column,
    how: str = "INNER",
    select: Sequence[Output] | None = None,
    hot: str | None = None,
    names: tuple[str, str] = ("left", "right"),
    all_pairs: bool = False,
    colocated: bool = False,
) -> DataFrame:
    """Join two frames and keep named columns.

    ``on`` is one ``(left column, right column)`` tuple or a list of them, compared
    for equality; or a Column or SQL text that calls the sides ``left.`` and
    ``right.``, or whatever ``names`` says. A condition from which Spark can take no
    equality makes it compare every row with every row, and LEFT, FULL and ANTI then
    send one whole side to every task, whatever its size. That raises unless
    ``all_pairs`` asks for it.

    ``select`` lists the output: ``"column"``, ``("column", "name")`` or
    ``("left" | "right", "column", "name")``; without a side the left input is
    looked at first. By default all columns are kept, which must then differ.

    ``hot`` is ``"left"``, ``"right"`` or ``"both"``: a side on which one key may
    hold a large share of the rows. It changes the plan, not the result, see the
    module text, and needs key pairs. ``"auto"`` looks for such keys at once, in one
    aggregation of each side's keys; ``"none"`` keeps FULL joins from doing so.

    ``colocated`` says that both sides of a semi or anti join are bucketed or partitioned
    by the keys: Spark then joins them where they are. A hot key stays in its partition.
    """
    kind = join_type(how)
    pairs = _pairs(on)
    if hot not in (None, "none", "auto", "left", "right", "both"):
        raise ValueError(f"hot must be 'left', 'right', 'both', 'auto' or 'none', not {hot!r}")
    if hot not in (None, "none") and pairs is None:
        raise ValueError("hot needs the join condition as key pairs")
    outputs = _outputs(left, right, select, kind)
    if pairs is None:
        condition = F.expr(on) if isinstance(on, str) else on
        if not all_pairs and not _has_equality(left, right, condition, kind, names):
            raise ValueError(
                "the condition contains no equality between the sides, so every row would be "
                "compared with every row, and in LEFT, FULL and ANTI one whole side sent to "
                "every task; all_pairs=True asks for that, and range_join does without it where "
                "a value of one side lies between two of the other"
            )
        return _plain(left, right, condition, kind, outputs, names)
    _check_keys(left, right, pairs)
    if kind in ("left_semi", "left_anti") and not colocated:
        return _existence(left, right, pairs, kind, outputs)
    if hot == "auto" or hot is None and kind == "full":
        hot = _hot_sides(left, right, pairs, kind)
    if hot in (None, "none"):
        return _plain(left, right, _equal(pairs), kind, outputs)
    streamed = {"inner": ("left", "right", "both"), "left": ("left",), "right": ("right",)}
    if hot in streamed.get(kind, ()):
        return _plain(*_matchable(left, right, pairs), kind, outputs)
    return _outer_in_parts(left, right, pairs, kind, outputs)


def lookup(
    df: DataFrame,
    reference: DataFrame,
    on: Pair | Sequence[Pair] | str | Column,
    returns: Sequence[str | Pair],
    how: str = "LEFT",
    hot: str | None = None,
    names: tuple[str, str] = ("left", "right"),
    all_pairs: bool = False,
) -> DataFrame:
    """Add columns of a reference table to each row.

    ``returns`` lists the reference columns to add, each a name or a
    ``(column, name)`` pair. Rows without a match get NULLs; a row with several
    matches is returned once for each. Whether the reference is broadcast is left
    to Spark, which decides by its size.
    """
    if not returns:
        raise ValueError("lookup returns no column")
    added = [("right", r, r) if isinstance(r, str) else ("right", *r) for r in returns]
    kept = [("left", c, c) for c in df.columns]
    return join(df, reference, on, how, kept + added, hot, names, all_pairs)


def _pairs(on) -> list[Pair] | None:
    """Key pairs, or None where ``on`` is a condition."""
    if isinstance(on, Column):
        return None
    if isinstance(on, str):
        if on.strip():
            return None
    elif on:
        if isinstance(on, tuple) and len(on) == 2 and all(isinstance(c, str) for c in on):
            return [on]
        if any(isinstance(pair, str) or len(pair) != 2 for pair in on):
            raise ValueError(f"join keys must be (left, right) pairs, not {on!r}")
        return [tuple(pair) for pair in on]
    raise ValueError("join has no condition")


def _has_equality(left, right, condition: Column, kind: str, names) -> bool:
    """Whether Spark can take a key from the condition. Asked of Spark's own optimizer."""
    joined = left.alias(names[0]).join(right.alias(names[1]), condition, kind)
    plan = joined._jdf.queryExecution().optimizedPlan()
    while plan.nodeName() != "Join":
        if plan.children().size() != 1:
            return True
        plan = plan.children().apply(0)
    planning = joined.sparkSession._jvm.org.apache.spark.sql.catalyst.planning
    return planning.ExtractEquiJoinKeys.unapply(plan).isDefined()


def _equal(pairs: Sequence[Pair]) -> Column:
    return F.expr(" AND ".join(f"left.{quoted(l)} = right.{quoted(r)}" for l, r in pairs))


def _outputs(left, right, select, kind) -> list[tuple[str, str, str]]:
    if kind in ("left_semi", "left_anti"):
        sides = [("left", left)]
    else:
        sides = [("left", left), ("right", right)]
    if select is None:
        result = [(side, c, c) for side, df in sides for c in df.columns]
    else:
        result = [_output(entry, sides) for entry in select]
        if not result:
            raise ValueError("join keeps no column")
    distinct_names([name for _, _, name in result])
    return result


def _output(entry: Output, sides) -> tuple[str, str, str]:
    if isinstance(entry, str):
        entry = (entry, entry)
    if len(entry) == 3:
        wanted, column, name = entry
        sides = [(side, df) for side, df in sides if side == wanted]
    else:
        column, name = entry
    for side, df in sides:
        if column.lower() in (c.lower() for c in df.columns):
            return side, column, name
    raise ValueError(f"join output {entry!r} is in neither of the inputs it may come from")


def _check_keys(left: DataFrame, right: DataFrame, pairs: Sequence[Pair]) -> None:
    for side, df, names in (
        ("left", left, [l for l, _ in pairs]),
        ("right", right, [r for _, r in pairs]),
    ):
        have = {c.lower() for c in df.columns}
        absent = [name for name in names if name.lower() not in have]
        if absent:
            raise ValueError(f"join keys are absent from the {side} input: {absent}")


def _plain(left, right, condition, kind, outputs, names=("left", "right")) -> DataFrame:
    called = dict(zip(("left", "right"), names))
    joined = left.alias(names[0]).join(right.alias(names[1]), condition, kind)
    return joined.selectExpr(
        *[f"{quoted(called[s])}.{quoted(c)} AS {quoted(name)}" for s, c, name in outputs]
    )


def _existence(left, right, pairs, kind, outputs) -> DataFrame:
    keys = right.select(*[quoted(r) for _, r in pairs]).distinct()
    return _plain(*_matchable(left, keys, pairs), kind, outputs)


def _matchable(left, right, pairs) -> tuple[DataFrame, DataFrame, Column]:
    """Both sides with a hash of their keys, and the condition that compares it too.

    The hash adds nothing to the result. It makes Spark exchange both sides next to
    each other even where one is already grouped by the keys, so that adaptive
    execution sees both sizes and can split a hot key. Where a value may have
    different hashes on the two sides they are left as they are.
    """
    hashed = [_hash_inputs(l, _type(left, l), r, _type(right, r)) for l, r in pairs]
    if not all(hashed):
        return left, right, _equal(pairs)

    def with_hash(df: DataFrame, inputs) -> DataFrame:
        return df.selectExpr("*", f"xxhash64({', '.join(inputs)}) AS {_HASH}")

    left = with_hash(left, [l for l, _ in hashed])
    right = with_hash(right, [r for _, r in hashed])
    return left, right, _equal([*pairs, (_HASH, _HASH)])


def _hash_inputs(left: str, left_type, right: str, right_type) -> tuple[str, str] | None:
    if isinstance(left_type, T.IntegralType) and isinstance(right_type, T.IntegralType):
        return f"bigint({quoted(left)})", f"bigint({quoted(right)})"
    if left_type == right_type and (
        isinstance(left_type, _HASHABLE) or left_type == T.StringType()
    ):
        return quoted(left), quoted(right)
    return None


def _type(df: DataFrame, name: str) -> T.DataType:
    return df.schema[_actual(df, name)].dataType


def _actual(df: DataFrame, name: str) -> str:
    return next(c for c in df.columns if c.lower() == name.lower())


def _hot_sides(left, right, pairs, kind) -> str | None:
    """Which sides have a key that is hot, of those that a plain join could not split."""
    sides = {"left": (left, [l for l, _ in pairs]), "right": (right, [r for _, r in pairs])}
    looked = {"left": ("right",), "right": ("left",)}.get(kind, ("left", "right"))
    hot = []
    for side in looked:
        df, keys = sides[side]
        known = df.dropna(subset=[_actual(df, k) for k in keys])  # rows without a key join nothing
        hashed = f"xxhash64({', '.join(map(quoted, keys))})"
        found = known.selectExpr(f"{hashed} AS h").selectExpr(
            "count(*) AS n", f"approx_top_k(h, 1, {_TRACKED_KEYS}) AS top"
        ).first()
        parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        most = found.top[0]["count"] if found.top else 0
        if most >= max(HOT_ROWS, 2 * found.n / parts):
            hot.append(side)
    return "both" if len(hot) == 2 else hot[0] if hot else None


def _outer_in_parts(left, right, pairs, kind, outputs) -> DataFrame:
    """An outer join as the union of its matched rows and of its unmatched ones.

    Rows with a NULL in their keys match nothing and skip the join. What is left of
    each side enters its inner and its anti join through the same exchange, so Spark
    shuffles it once.
    """
    swapped = [(r, l) for l, r in pairs]
    left, left_null = _split_null_keys(left, pairs)
    right, right_null = _split_null_keys(right, swapped)
    result = _plain(*_matchable(left, right, pairs), "inner", outputs)
    if kind in ("left", "full"):
        alone = _unmatched("left", left, left_null, right, pairs, outputs)
        result = result.unionAll(alone)
    if kind in ("right", "full"):
        alone = _unmatched("right", right, right_null, left, swapped, outputs)
        result = result.unionAll(alone)
    return result


def _split_null_keys(df: DataFrame, pairs) -> tuple[DataFrame, DataFrame]:
    keys = [quoted(key) for key, _ in pairs]
    return (
        df.filter(" AND ".join(f"{key} IS NOT NULL" for key in keys)),
        df.filter(" OR ".join(f"{key} IS NULL" for key in keys)),
    )


def _unmatched(side, df, df_null, other, pairs, outputs) -> DataFrame:
    """Rows of one side without a match, with NULL for the columns of the other side."""
    # A key stands in where the output keeps no column of this side.
    needed = list(dict.fromkeys(c for s, c, _ in outputs if s == side)) or [pairs[0][0]]
    alone = _existence(df, other, pairs, "left_anti", [("left", c, c) for c in needed])
    return alone.unionAll(df_null.select(*map(quoted, needed))).select(
        *[
            (F.col(quoted(c)) if s == side else F.lit(None).cast(_type(other, c))).alias(name)
            for s, c, name in outputs
        ]
    )
