"""Joins on ``low <= x AND x < high`` without comparing every row with every row.

Values are cut into leaf bins: between quantiles of the points, each piece into equally wide ones,
so that busy stretches have narrow bins, but none much narrower than the shorter quarter of the
intervals. ``FAN`` neighbouring bins form a bin of the next level, up to the length of the longest.
An interval goes to the largest bins that together cover the leaves it meets, at most some 30 of a level
and mostly one or two in all; a point goes to its bin of every level. A point in an interval lies
in exactly one of the interval's bins, so equality on the bin finds each pair once, and the
condition itself decides in the leaves at the ends. Long and open-ended intervals cost few bins.

The join is an equality join: Spark sorts or hashes it, and adaptive execution splits a bin that
holds a large share of the rows on either side. Whether a row matches depends on its compared
columns alone, so outer, semi and anti joins look up distinct compared values that have a match.

Few rows may make many pairs, which Spark cannot see from their bytes. Where a join has more than
``TASK`` candidates, the rows of a bin are dealt on either side to parts of some ``CELL`` rows, each
part meets each of the other side's, and the pairs of parts are dealt to as many tasks as the
candidates need. Rows are copied for that at most ``1 / CELL`` times for each pair that they are in.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions.text import quoted
from tablewright.operators.joins import (
    Output,
    Pair,
    _check_keys,
    _existence,
    _hash_inputs,
    _outputs,
    _pairs,
    _plain,
    _type,
    join_type,
)

FAN = 16
KNOTS = 64  # stretches between quantiles
BIN = 256  # points of a leaf bin, about
CELL = 1024  # rows of a side that are compared with as many of the other in one place, about
TASK = 1 << 22  # candidates of a task, about
TASKS = 20_000  # tasks of a join, at most; beyond, they get longer
_LEVEL, _NODE = "__level", "__node"
_LEFT_PART, _RIGHT_PART = "__left_part", "__right_part"


def range_join(
    left: DataFrame,
    right: DataFrame,
    point: tuple[str, str],
    interval: tuple[str, str],
    how: str = "INNER",
    select: Sequence[Output] | None = None,
    equal: Pair | Sequence[Pair] | None = None,
    bounds: str = "[)",
) -> DataFrame:
    """Join rows whose ``point`` lies in the ``interval`` of the other side.

    ``point`` is ``("left" | "right", column)``, ``interval`` the low and high column of the other
    side. ``bounds`` says which ends belong to it: ``[)``, ``[]``, ``(]`` or ``()``. ``equal`` adds key
    pairs that must be equal. ``how`` and ``select`` are those of ``join``, results those of Spark's
    join on the same condition: a NULL in it matches nothing, an interval that ends before it
    begins holds nothing, NaN is larger than any number.

    Numbers of any types, dates, and timestamps of one type are compared. The number of points,
    their least, largest and ``KNOTS`` approximate quantiles, and the number, a quantile and the
    largest of the intervals' lengths in bins, are computed at once, in one aggregation of each side.
    Where both sides together could make more than ``16 * TASK`` pairs, candidates are counted by bin, once
    for the pairs and once for each side looked up. All else is lazy. This steers the plan only, never the
    result. Rows that are alike in all columns used stay in one part.
    """
    kind = join_type(how)
    if bounds not in ("[)", "[]", "(]", "()"):
        raise ValueError(f"bounds must be '[)', '[]', '(]' or '()', not {bounds!r}")
    side, x = point
    if side not in ("left", "right"):
        raise ValueError(f"the point is in 'left' or 'right', not {side!r}")
    other = "right" if side == "left" else "left"
    frames = {"left": left, "right": right}
    low, high = interval
    for df, names in ((frames[side], [x]), (frames[other], [low, high])):
        absent = [c for c in names if c.lower() not in map(str.lower, df.columns)]
        if absent:
            raise ValueError(f"columns {absent} are not among {df.columns}")
    pairs = _pairs(equal) if equal else []
    if pairs is None:
        raise ValueError("equal must be key pairs")
    _check_keys(left, right, pairs)
    outputs = _outputs(left, right, select, kind)
    position = _position(
        [_type(frames[side], x), _type(frames[other], low), _type(frames[other], high)]
    )
    grid = _Grid(frames[side], x, position)
    grid.fit(frames[other], low, high)

    def condition(called: dict[str, str], cells: list[str]) -> Column:
        """The join's condition, with the sides under the names of ``called``."""
        one, two = called[side], called[other]
        parts = [
            *[f"{one}.{c} = {two}.{c}" for c in cells],
            f"{two}.{quoted(low)} {'<=' if bounds[0] == '[' else '<'} {one}.{quoted(x)}",
            f"{one}.{quoted(x)} {'<=' if bounds[1] == ']' else '<'} {two}.{quoted(high)}",
            *[f"{called['left']}.{quoted(l)} = {called['right']}.{quoted(r)}" for l, r in pairs],
        ]
        return F.expr(" AND ".join(parts))

    binned = {side: lambda df: grid.points(df, x), other: lambda df: grid.intervals(df, low, high)}

    compared = {
        s: list(dict.fromkeys([*([x] if s == side else [low, high]), *[p[s == "right"] for p in pairs]]))
        for s in ("left", "right")
    }

    def met(rows: dict[str, DataFrame], first: str, how: str, outputs: list) -> DataFrame:
        """Spark's join of both sides with their bins, ``first`` being its left one."""
        second = "right" if first == "left" else "left"
        sides = {s: binned[s](df) for s, df in rows.items()}
        cells = [_LEVEL, _NODE]
        if grid.n * grid.m > 16 * TASK:
            used = {s: list(dict.fromkeys([*compared[s], *(c for of, c, _ in outputs if of == s)])) for s in sides}
            sides, cells = _dealt(sides, used, pairs, cells)
        on = condition({first: "left", second: "right"}, cells)
        kept = [("left" if s == first else "right", c, name) for s, c, name in outputs]
        return _plain(sides[first], sides[second], on, how, kept)

    def matched(s: str) -> DataFrame:
        """Distinct compared values of a side that have a match on the other."""
        # Spark's semi join keeps its left input, so this side is the left one here.
        rows = {of: frames[of].select(*map(quoted, compared[of])).distinct() for of in frames}
        return met(rows, s, "left_semi", [(s, c, c) for c in compared[s]]).distinct()

    def inner() -> DataFrame:
        return met(frames, "left", "inner", outputs)

    if kind == "inner":
        return inner()
    if kind in ("left_semi", "left_anti"):
        return _existence(left, matched("left"), [(c, c) for c in compared["left"]], kind, outputs)
    result = inner()
    for s in ("left", "right"):
        if kind not in (s, "full"):
            continue
        needed = list(dict.fromkeys(c for of, c, _ in outputs if of == s)) or [compared[s][0]]
        alone = _existence(
            frames[s], matched(s), [(c, c) for c in compared[s]], "left_anti", [("left", c, c) for c in needed]
        )
        result = result.unionAll(
            alone.select(
                *[
                    (F.col(quoted(c)) if of == s else F.lit(None).cast(_type(frames[of], c))).alias(name)
                    for of, c, name in outputs
                ]
            )
        )
    return result


def _dealt(
    sides: dict[str, DataFrame], used: dict[str, list[str]], pairs: Sequence[Pair], cells: list[str]
) -> tuple[dict[str, DataFrame], list[str]]:
    """Both sides with the parts of their bins, dealt to tasks by the number of candidates, and what
    must be equal; as they are where candidates are few."""
    named = {"left": [l for l, _ in pairs], "right": [r for _, r in pairs]}
    keys = [f"__key_{i}" for i in range(len(pairs))]
    count = {s: f"__{s}_rows" for s in sides}

    def keyed(s: str) -> list[str]:
        return [f"{quoted(c)} AS {k}" for c, k in zip(named[s], keys)]

    found = {
        s: df.selectExpr(*cells, *keyed(s)).groupBy(*cells, *keys).agg(F.count("*").alias(count[s]))
        for s, df in sides.items()
    }
    equal = F.expr(" AND ".join(f"l.{c} = r.{c}" for c in [*cells, *keys]))

    def counted(s: str) -> DataFrame:
        """The bins of both sides, with the keys as side ``s`` has them."""
        kept = [f"{s[0]}.{c} AS __of_{c}" for c in [*cells, *keys]]
        return found["left"].alias("l").join(found["right"].alias("r"), equal).selectExpr(*kept, *count.values())

    product = " * ".join(f"CAST({c} AS double)" for c in count.values())
    total = counted("left").selectExpr(f"sum({product})").first()[0] or 0
    if total <= TASK:
        return sides, cells
    tasks = math.ceil(min(TASKS, total / TASK))
    parts = [_LEFT_PART, _RIGHT_PART]
    hashed = [_hash_inputs(l, _type(sides["left"], l), r, _type(sides["right"], r)) for l, r in pairs]
    out = {}
    for s, df in sides.items():
        away = "right" if s == "left" else "left"
        one, two = (parts[of == "right"] for of in (s, away))
        kept = [quoted(c) for c in used[s]]
        whole = [quoted(c) for c in used[s] if not _has_map(_type(df, c))]
        number = {of: f"CAST(ceil({count[of]} / {CELL}) AS int)" for of in count}
        on = " AND ".join(
            [f"{c} = __of_{c}" for c in cells] + [f"{quoted(c)} = __of_{k}" for c, k in zip(named[s], keys)]
        )
        own = f"pmod(xxhash64({', '.join(whole)}), {number[s]}) AS {one}"
        dealt = df.selectExpr(*kept, *cells).join(counted(s), F.expr(on)).selectExpr(
            *kept, *cells, own, f"explode(sequence(0, {number[away]} - 1)) AS {two}"
        )
        # By number, since adaptive execution would merge partitions of few bytes.
        if all(hashed):
            dealt = dealt.repartition(
                tasks, *map(F.expr, [*cells, *parts, *(h[s == "right"] for h in hashed)])
            )
        out[s] = dealt
    return out, [*cells, *parts]


def _has_map(kind: T.DataType) -> bool:
    """Whether Spark cannot hash values of this type."""
    return "map<" in kind.simpleString() or "variant" in kind.simpleString()


def _position(kinds: Sequence[T.DataType]) -> str:
    """SQL, with a place for a column, of a double that never falls where the value rises."""
    if all(isinstance(k, T.NumericType) for k in kinds):
        return "CAST(%s AS double)"
    if len(set(kinds)) == 1:
        if isinstance(kinds[0], T.DateType):
            return "CAST(unix_date(%s) AS double)"
        if isinstance(kinds[0], T.TimestampType):
            return "CAST(unix_micros(%s) AS double)"
        if isinstance(kinds[0], T.TimestampNTZType):
            return "CAST(timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01', %s) AS double)"
    raise ValueError(
        "a range is of numbers, of dates or of timestamps of one type, not of "
        + ", ".join(k.simpleString() for k in kinds)
    )


class _Grid:
    """Leaf bins and their levels, from the points."""

    def __init__(self, points: DataFrame, x: str, position: str):
        self.position = position
        at = position % quoted(x)
        # NaN and the infinities would leave no room between quantiles.
        finite = f"CASE WHEN abs({at}) < double('infinity') THEN {at} END"
        steps = ", ".join(f"{i / KNOTS!r}D" for i in range(1, KNOTS))
        found = points.selectExpr(f"{finite} AS x", f"{at} AS y").selectExpr(
            "count(x) AS n", "count(y) AS all", "min(x) AS least", "max(x) AS most", "min(y) AS first", "max(y) AS last",
            f"percentile_approx(x, array({steps}), 1000) AS knots",
        ).first()
        self.first, self.last = found["first"], found["last"]
        self.n, self.m = found["all"], 0  # points and intervals
        ends = [v for v in (found.least, found.most) if v is not None]
        self.knots = sorted({*ends, *(found.knots or [])})
        pieces = max(1, len(self.knots) - 1)
        self.levels = max(0, math.ceil(math.log(max(1, found.n / BIN / pieces), FAN)))
        self.parts = FAN**self.levels
        self.top = self.levels + math.ceil(math.log(pieces, FAN)) if pieces > 1 else self.levels

    def fit(self, intervals: DataFrame, low: str, high: str) -> None:
        """Make bins as wide as the shorter intervals, and leave out levels above the longest."""
        span = self._met(intervals, low, high).selectExpr("__to - __from + 1L AS span")
        found = span.selectExpr(
            "count(*) AS m", "percentile_approx(span, 0.25D, 1000) AS short", "max(span) AS longest"
        ).first()
        self.m = found.m
        if found.longest is None:
            self.top = 0
            return
        coarser = min(self.levels, _power(found.short))
        self.levels -= coarser
        self.parts = FAN**self.levels
        self.top = min(self.top - coarser, _power(found.longest // FAN**coarser + 2))

    def leaf(self, value: str) -> str:
        """The leaf bin of a value; those beyond the points lie in the outermost."""
        if len(self.knots) < 2:
            return "0L"
        at = f"least(greatest({self.position % value}, {self.knots[0]!r}D), {self.knots[-1]!r}D)"

        def piece(first: int, last: int) -> str:
            if last - first == 1:
                low, width = self.knots[first], self.knots[last] - self.knots[first]
                part = f"CAST(floor(({at} - {low!r}D) / {width!r}D * {self.parts}D) AS bigint)"
                return f"{first * self.parts}L + least({self.parts - 1}L, {part})"
            middle = (first + last) // 2
            return (
                f"CASE WHEN {at} < {self.knots[middle]!r}D THEN {piece(first, middle)}"
                f" ELSE {piece(middle, last)} END"
            )

        return f"CASE WHEN {value} IS NOT NULL THEN {piece(0, len(self.knots) - 1)} END"

    def points(self, df: DataFrame, x: str) -> DataFrame:
        bins = ", ".join(f"struct({i} AS level, __leaf div {FAN**i}L AS node)" for i in range(self.top + 1))
        leaves = df.filter(f"{quoted(x)} IS NOT NULL").selectExpr("*", f"{self.leaf(quoted(x))} AS __leaf")
        return self._exploded(leaves, f"array({bins})", ["__leaf"])

    def _met(self, df: DataFrame, low: str, high: str) -> DataFrame:
        """The intervals that meet the points' range, with their first and last leaf."""
        low, high = quoted(low), quoted(high)
        ends = [f"{low} <= {high}", f"{self.position % low} IS NOT NULL"]
        if self.first is None:
            ends = ["false"]
        else:  # beyond all points there is nothing to find
            ends += [
                f"{self.position % high} >= {_double(self.first)}",
                f"{self.position % low} <= {_double(self.last)}",
            ]
        return df.filter(" AND ".join(ends)).selectExpr(
            "*", f"{self.leaf(low)} AS __from", f"{self.leaf(high)} AS __to"
        )

    def intervals(self, df: DataFrame, low: str, high: str) -> DataFrame:
        met = self._met(df, low, high)
        levels = []
        for i in range(self.top + 1):
            a, z = _covered(i)
            if i < self.top:
                inner_a, inner_z = _covered(i + 1)
                inside = f"{inner_a} < {inner_z}"
                runs = [
                    f"CASE WHEN {inside} THEN {_run(a, f'{inner_a} * {FAN}L')} ELSE {_run(a, z)} END",
                    f"CASE WHEN {inside} THEN {_run(f'{inner_z} * {FAN}L', z)} ELSE {_NOTHING} END",
                ]
            else:
                runs = [_run(a, z)]
            levels += [f"transform({run}, n -> struct({i} AS level, n AS node))" for run in runs]
        return self._exploded(met, f"flatten(array({', '.join(levels)}))", ["__from", "__to"])

    def _exploded(self, df: DataFrame, bins: str, gone: Sequence[str]) -> DataFrame:
        kept = [quoted(c) for c in df.columns if c not in gone]
        return df.selectExpr(*kept, f"inline({bins}) AS ({_LEVEL}, {_NODE})")


def _power(n: int) -> int:
    """The largest power of ``FAN`` that does not exceed ``n``, by its exponent."""
    power = 0
    while FAN ** (power + 1) <= n:
        power += 1
    return power


_NOTHING = "CAST(array() AS array<bigint>)"


def _covered(level: int) -> tuple[str, str]:
    """First bin of a level that lies within the leaves met, and the one after the last."""
    size = FAN**level
    return f"((__from + {size - 1}L) div {size}L)", f"((__to + 1L) div {size}L)"


def _run(first: str, end: str) -> str:
    return f"CASE WHEN {first} < {end} THEN sequence({first}, {end} - 1L) ELSE {_NOTHING} END"


def _double(value: float) -> str:
    if math.isfinite(value):
        return f"double('{value!r}')"
    return "double('NaN')" if math.isnan(value) else f"double('{'-' if value < 0 else ''}infinity')"
