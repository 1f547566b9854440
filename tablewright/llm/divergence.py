"""How far the sources of a language stand apart, by exact rescaled term shares.

One map counts terms; a term that a language keeps has a share in each of the language's groups,
also where it never occurs. Groups by terms make a matrix of counts that is mostly zero. It is cut
into tiles of at most ``COLUMNS`` terms (by a hash) and, on the other axis, two blocks of ``ROWS``
groups each. In a tile each block is a quadtree (a k2-tree with k = 2): one level of bits for each
halving, a bit telling whether a quadrant of groups by terms has any count. Both trees are walked
together from the root. Where both quadrants are all zero, every pair of their groups has the same
difference in each of the quadrant's terms, that of their shares of an absent term, so the number
of terms is noted and the walk ends; only leaves that are nonzero on either side are looked up.
Where one side alone is zero, its children are known to be.

Sums of tiles are sums of longs. A tile holds bounded counts, however frequent a term or large
a group is, since counts are added up by group and term before they are dealt to tiles.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablewright.llm.common import checkpointed, column, give_back

COLUMNS = 256  # terms of a tile, about
ROWS = 64  # groups of a block, about
HELD = 400_000  # counts that a task holds before it passes them on
CUT = 1 << 22  # bytes of a text that are cut into words at once
SHARE = 1_000_000_000
SMOOTH = 5

# Bytes of terms: A-Z lower-cased, a-z and all of non-ASCII characters; others separate.
_TERMS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)


def divergences(
    docs: DataFrame,
    least_docs: int = 30,
    first_terms: int = 50,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
) -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value``, ``rank``, in two parts.

    A group is a pair of language and source that occurs; NULLs there and in the text count as
    empty. Terms are runs of ASCII letters, lower-cased, and non-ASCII characters; a language keeps
    those in ``least_docs`` or more of its rows (repeated rows and ids count as often as they
    occur). A kept term with ``count`` occurrences among the ``N`` of all ``V`` kept terms has the
    share 1 + floor(10^9 (count + 5) / (N + 5 V)), in whole numbers throughout.

    Part ``pair``: ``item`` is each other source of the language, ``value`` the sum of the absolute
    differences of shares over all kept terms (0 without any), largest first. Part ``term``:
    ``item`` is a term of the group whose share exceeds the language's, ``value`` by how much, the
    first ``first_terms``. Equal values go by the UTF-8 bytes of the item. A language of one
    source has no pairs; without rows there is no result.
    """
    group = [F.coalesce(column(c).cast("string"), F.lit("")) for c in (lang, source)]
    taken = docs.select(
        group[0].alias("lang"), group[1].alias("source"), column(text).cast("string").alias("text")
    )
    counted = taken.mapInArrow(_counts, "lang string, source string, term string, n long, d long")
    cells = checkpointed(
        counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("d").alias("d"))
    )
    terms = (
        cells.filter("term IS NOT NULL").groupBy("lang", "term")
        .agg(F.sum("d").alias("d"), F.sum("n").alias("in_lang"), F.count("*").alias("holders"))
        .filter(F.col("d") >= least_docs)
    )
    kept = checkpointed(
        cells.drop("d").join(terms.drop("d"), ["lang", "term"])
        .withColumnRenamed("n", "count")
    )
    sized = kept.groupBy("lang", "source").agg(F.sum("count").alias("n"))
    groups = cells.groupBy("lang", "source").count().drop("count").join(sized, ["lang", "source"], "left")
    known = kept.groupBy("lang", "term").agg(F.max("in_lang").alias("n"))
    langs = (
        groups.groupBy("lang").agg(F.count("*").alias("sources"))
        .join(known.groupBy("lang").agg(F.count("*").alias("v"), F.sum("n").alias("in_all")), "lang", "left")
        .select(
            "lang",
            F.coalesce("v", F.lit(0)).alias("v"),
            F.coalesce("in_all", F.lit(0)).alias("in_all"),
            F.greatest(F.ceil(F.col("v") / COLUMNS), F.lit(1)).cast("int").alias("strips"),
            F.ceil(F.col("sources") / ROWS).cast("int").alias("blocks"),
        )
    )
    block = F.expr("CAST(pmod(xxhash64(source), blocks) AS int)")
    strip = F.expr("CAST(pmod(xxhash64(term), strips) AS int)")
    share = (  # of a count in all of n, over v terms
        f"1L + (CAST({SHARE} AS decimal(10,0)) * CAST(%s + {SMOOTH} AS decimal(20,0)))"
        f" div CAST(%s + {SMOOTH} * v AS decimal(20,0))"
    )
    whole = groups.join(langs, "lang").withColumn("block", block).selectExpr(
        "*",
        f"CASE WHEN v > 0 THEN {share % (0, 'coalesce(n, 0)')} ELSE 0L END AS base",
        f"CASE WHEN v > 0 THEN {share % (0, 'in_all')} ELSE 0L END AS lang_base",
    )
    widths = known.join(langs, "lang").groupBy("lang", strip.alias("strip")).agg(F.count("*").alias("width"))
    edges = (
        whole.withColumn("strip", F.explode(F.sequence(F.lit(0), F.col("strips") - 1)))
        .join(widths, ["lang", "strip"], "left")
        .selectExpr(
            "lang", "strip", "block", "blocks", "source", "CAST(NULL AS string) AS term",
            "base AS p", "lang_base AS q", "coalesce(width, 0L) AS extent",
        )
    )
    inner = (
        kept.join(whole.select("lang", "source", "n", "in_all", "v", "strips", "blocks", "block"), ["lang", "source"])
        .withColumn("strip", strip)
        .selectExpr(
            "lang", "strip", "block", "blocks", "source", "term",
            f"{share % ('count', 'n')} AS p", f"{share % ('in_lang', 'in_all')} AS q",
            "holders AS extent",
        )
    )
    dealt = (
        edges.unionAll(inner)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("a", F.least("block", "other"))
        .withColumn("b", F.greatest("block", "other"))
        .drop("blocks", "other")
    )
    found = dealt.groupBy("lang", "strip", "a", "b").applyInArrow(
        lambda tile: _tile(tile, first_terms),
        "lang string, source string, part string, item string, value long",
    )
    summed = found.groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    return summed.withColumn("rank", F.row_number().over(order)).filter(
        (F.col("part") == "pair") | (F.col("rank") <= first_terms)
    )


def _words(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, a bounded number of bytes at a time."""
    begin = 0
    while begin < len(text):
        end = begin + CUT
        if end < len(text):
            while end < len(text) and _TERMS[text[end]] != 0x20:
                end += 1
        yield text[begin:end].translate(_TERMS).split()
        begin = end


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences ``n`` of terms, and ``d`` rows that have them, by group; sums of many rows are one
    row. Each group has a row without a term as well."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    size = 0

    def passed_on() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, d) in held.items():
            terms = [None, *[t.decode("utf-8", "replace") for t in n]]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(terms)), pa.array([source] * len(terms)),
                    pa.array(terms, pa.string()),
                    pa.array([0, *n.values()], pa.int64()), pa.array([0, *[d[t] for t in n]], pa.int64()),
                ],
                names=["lang", "source", "term", "n", "d"],
            )

    for batch in batches:
        langs, sources = (batch.column(i).to_pylist() for i in (0, 1))
        texts = batch.column(2).cast(pa.large_binary())
        for lang, source, text in zip(langs, sources, texts):
            n, d = held.setdefault((lang, source), (Counter(), Counter()))
            before, own = len(n), set()
            for words in _words(text.as_py() or b""):
                n.update(words)
                own.update(words)
            d.update(own)
            size += len(n) - before
            if size > HELD:
                yield from passed_on()
                held, size = {}, 0
    yield from passed_on()
    held.clear()
    give_back()


class Quadtree:
    """Bits of the quadrants of a matrix of ``present`` counts, level by level from the leaves, whose
    sides are one group and one term, to the root."""

    def __init__(self, present: np.ndarray, depth: int):
        side = 1 << depth
        leaves = np.zeros((side, side), bool)
        leaves[: present.shape[0], : present.shape[1]] = present
        self.levels = [leaves]
        while len(self.levels) <= depth:
            last = self.levels[-1]
            half = len(last) // 2
            self.levels.append(last.reshape(half, 2, half, 2).any(axis=(1, 3)))


def joint_differences(
    p: np.ndarray, q: np.ndarray, base_p: np.ndarray, base_q: np.ndarray, width: int, same: bool = False
) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray, np.ndarray]]]:
    """Sums of |p - q| over ``width`` terms for each row of ``p`` and of ``q``; zero entries stand for
    absent terms, whose shares are ``base_p`` and ``base_q``. Also the leaves that were visited, as
    arrays of rows of p, rows of q and terms. With ``same``, rows of q go before those of p."""
    depth = int(max(len(p), len(q), p.shape[1], width, 1) - 1).bit_length()
    one, two = Quadtree(p > 0, depth), Quadtree(q > 0, depth)
    side = 1 << depth
    zero_terms = np.zeros((side, side), np.int64)
    a = b = c = np.zeros(1, np.int64)
    for level in range(depth, -1, -1):
        in_a, in_b = one.levels[level][a, c], two.levels[level][b, c]
        empty = ~(in_a | in_b)
        if empty.any():  # priced at once: so many terms in which the pairs differ by their bases
            terms = np.clip(width - (c[empty] << level), 0, 1 << level)
            n = side >> level
            noted = np.bincount(a[empty] * n + b[empty], terms, n * n).astype(np.int64).reshape(n, n)
            zero_terms += np.kron(noted, np.ones((1 << level, 1 << level), np.int64))
        a, b, c = a[~empty], b[~empty], c[~empty]
        if level:
            child = np.arange(8)
            a, b, c = (
                (x[:, None] * 2 + (child >> i & 1)).ravel() for i, x in enumerate((a, b, c))
            )
            n = 1 << (level - 1)
            inside = (a * n < len(p)) & (b * n < len(q)) & (c * n < width)
            if same:
                inside &= a >= b
            a, b, c = a[inside], b[inside], c[inside]
    if same:
        apart = a != b
        a, b, c = a[apart], b[apart], c[apart]
    value = np.abs(np.where(p[a, c] > 0, p[a, c], base_p[a]) - np.where(q[b, c] > 0, q[b, c], base_q[b]))
    total = zero_terms[: len(p), : len(q)] * np.abs(base_p[:, None] - base_q[None, :])
    np.add.at(total, (a, b), value)
    return total, [(a, b, c)]


def _tile(tile: pa.Table, first_terms: int) -> pa.Table:
    lang, block_a, block_b = (tile.column(c)[0].as_py() for c in ("lang", "a", "b"))
    term, source = tile.column("term"), tile.column("source")
    edge = term.is_null().to_numpy()
    names = source.to_numpy()
    block, p, q, extent = (tile.column(c).to_numpy() for c in ("block", "p", "q", "extent"))
    width = int(extent[edge][0])
    # Terms that many groups have go first, so that zero quadrants are large.
    inner = ~edge
    words, at = np.unique(np.array(term.filter(pa.array(inner)).to_pylist(), object), return_inverse=True)
    holders = np.zeros(len(words), np.int64)
    holders[at] = extent[inner]
    order = np.lexsort((np.arange(len(words)), -holders))
    place = np.empty(len(words), np.int64)
    place[order] = np.arange(len(words))
    in_lang = np.zeros(len(words), np.int64)
    in_lang[place[at]] = q[inner]

    def matrix(one: int) -> tuple[list[str], np.ndarray, np.ndarray]:
        own = np.flatnonzero(edge & (block == one))
        own = own[np.argsort(names[own].astype(object), kind="stable")]
        row = {s: i for i, s in enumerate(names[own])}
        shares = np.zeros((len(own), max(len(words), 1)), np.int64)
        mine = block[inner] == one
        rows = np.fromiter((row[s] for s in names[inner][mine]), np.int64, int(mine.sum()))
        shares[rows, place[at[mine]]] = p[inner][mine]
        return list(row), shares, p[own]

    sources_a, shares_a, base_a = matrix(block_a)
    out: list[tuple[str, str, str, int]] = []
    if block_a == block_b:
        total, _ = joint_differences(shares_a, shares_a, base_a, base_a, width, same=True)
        sources_b = sources_a
        total = np.tril(total, -1)
        pairs = [(i, j) for i in range(len(sources_a)) for j in range(i)]
        lang_row = np.zeros((1, shares_a.shape[1]), np.int64)
        lang_row[0, : len(words)] = in_lang
        _, leaves = joint_differences(shares_a, lang_row, base_a, np.zeros(1, np.int64), width)
        by_place = words[order]
        for row, _, c in leaves:
            more = shares_a[row, c] - lang_row[0, c]
            good = (shares_a[row, c] > 0) & (more > 0)
            row, c, more = row[good], c[good], more[good]
            first = np.lexsort((order[c], -more, row))
            row, c, more = row[first], c[first], more[first]
            starts = np.searchsorted(row, row)
            top = np.arange(len(row)) - starts < first_terms
            out += [
                (sources_a[r], "term", by_place[w], int(v))
                for r, w, v in zip(row[top], c[top], more[top])
            ]
    else:
        sources_b, shares_b, base_b = matrix(block_b)
        total, _ = joint_differences(shares_a, shares_b, base_a, base_b, width)
        pairs = [(i, j) for i in range(len(sources_a)) for j in range(len(sources_b))]
    for i, j in pairs:
        value = int(total[i, j])
        out += [(sources_a[i], "pair", sources_b[j], value), (sources_b[j], "pair", sources_a[i], value)]
    columns = list(zip(*out)) if out else [[], [], [], []]
    return pa.table(
        {
            "lang": pa.array([lang] * len(out), pa.string()),
            "source": pa.array(columns[0], pa.string()),
            "part": pa.array(columns[1], pa.string()),
            "item": pa.array(columns[2], pa.string()),
            "value": pa.array(columns[3], pa.int64()),
        }
    )
