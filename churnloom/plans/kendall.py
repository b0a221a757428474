"""Exact Kendall tau-b for all column pairs as Spark aggregations.

Values become integer codes in value order. The code x of one column is written in base 16: two points with different x
part at exactly one digit, so they meet in exactly one group

    (level of x, leading digits of x)

where the digit says which of them has the smaller x. Inside a group the points are counted by (y, digit), and walking up y
with 16 running counts, one for each digit, counts the points below in y on either side in x. The walk has two steps, so
that no task sees a whole group: inside buckets of y, cut where a quantile sketch of that column says, and across the buckets
of a group, at most 256 rows. The column with fewer digits is x: a row stands once for each of its digits. No point is
ever paired with another one.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnloom.plans.ordered import EVEN_CUTS, SKETCH_ACCURACY, cuts_below, dense_ranks, tall
from churnloom.session import cut_lineage

_BITS = 4
_DIGITS = 1 << _BITS


def kendall_pairs(df: DataFrame, columns: Sequence[str], key: str, target: str | None = None) -> DataFrame:
    """``feature_a``, ``feature_b``, ``tau`` for every unordered pair, in column order.

    With ``target``, only the pairs that this column is in are worked out.

    ``key`` is unique per row. ``tau`` is null where a column is constant. The codes are stored
    once in the shared folder, since several branches read them.
    """
    coded = cut_lineage(_coded(df, columns, key), "codes")
    pairs = _concordance(coded, _pairs(columns, target), len(columns))
    ties = _ties(coded, columns)
    a, b = ties.alias("a"), ties.alias("b")
    free = lambda side: F.col(f"{side}.pairs") - F.col(f"{side}.tied")
    return (
        pairs.join(a, F.col("i") == F.col("a.col"))
        .join(b, F.col("j") == F.col("b.col"))
        .select(
            _name("i", columns).alias("feature_a"),
            _name("j", columns).alias("feature_b"),
            F.try_divide(
                (F.col("agree") - F.col("disagree")).cast("double"),
                F.sqrt(free("a").cast("double")) * F.sqrt(free("b").cast("double")),
            ).alias("tau"),
        )
    )


def kendall_matrix(df: DataFrame, columns: Sequence[str], key: str) -> DataFrame:
    """The full matrix in long form: both orders of each pair and the diagonal."""
    upper = kendall_pairs(df, columns, key)
    both = upper.select(
        F.explode(
            F.array(
                F.struct("feature_a", "feature_b", "tau"),
                F.struct(F.col("feature_b").alias("feature_a"), F.col("feature_a").alias("feature_b"), "tau"),
            )
        ).alias("r")
    ).select("r.*")
    names = F.explode(F.array(*[F.lit(c) for c in columns]))
    one = df.sparkSession.range(1).select(names.alias("feature_a"))
    diagonal = one.select("feature_a", F.col("feature_a").alias("feature_b"), F.lit(1.0).alias("tau"))
    return both.unionByName(diagonal)


def strong_pairs(pairs: DataFrame, above: float = 0.8) -> DataFrame:
    return pairs.where(F.col("tau") > above)


def ranks_with(pairs: DataFrame, target: str = "churn") -> DataFrame:
    """Every feature's tau with ``target``, largest first."""
    other = F.when(F.col("feature_a") == target, F.col("feature_b")).otherwise(F.col("feature_a"))
    return (
        pairs.where((F.col("feature_a") == target) | (F.col("feature_b") == target))
        .select(other.alias("feature"), F.col("tau").alias("kendall_corr"))
        .orderBy(F.desc_nulls_last("kendall_corr"), "feature")
    )


def weak_features(ranks: DataFrame, below: float = 0.04) -> DataFrame:
    return ranks.where(F.abs("kendall_corr") < below)


def _name(index: str, columns: Sequence[str]) -> Column:
    return F.element_at(F.array(*[F.lit(c) for c in columns]), (F.col(index) + 1).cast("int"))


def _coded(df: DataFrame, columns: Sequence[str], key: str) -> DataFrame:
    """One row per input row with ``codes``, an array of non-negative integers in column order.

    Whole numbers are shifted to start at 0. Fractional columns are replaced by dense ranks.
    """
    whole = {f.name for f in df.schema.fields if isinstance(f.dataType, T.IntegralType)}
    shifted = [c for c in columns if c in whole]
    fractional = [c for c in columns if c not in whole]
    out = df.select(key, *columns)
    if fractional:
        values = tall(df, [key], fractional)
        ranks = dense_ranks(values, ["feature"], "value")
        ranked = (
            values.join(ranks, ["feature", "value"], "left")
            .groupBy(key)
            .agg(*[F.max(F.when(F.col("feature") == c, F.col("rank"))).alias(f"_rank_{c}") for c in fractional])
        )
        out = out.join(ranked, key)
    if shifted:
        low = df.select(F.struct(*[F.min(c).alias(c) for c in shifted])).scalar()
        out = out.withColumn("_low", low)
    code = {c: (F.col(c) - F.col(f"_low.{c}")).cast("long") for c in shifted} | {c: F.col(f"_rank_{c}") for c in fractional}
    return out.select(F.array(*[code[c] for c in columns]).alias("codes"))


def _concordance(coded: DataFrame, wanted: list[tuple[int, int]], n: int) -> DataFrame:
    """Numbers of agreeing and disagreeing row pairs for each column pair (i, j)."""
    levels = _levels(coded, n)
    pairs = []
    for i, j in wanted:
        x, y = sorted((i, j), key=lambda c: levels[c])
        pairs.append(f"struct({i} AS i, {j} AS j, {x} AS cx, {y} AS cy, {levels[x]} AS levels)")
    cells = (
        _bucketed(coded, n)
        .selectExpr("codes", "buckets", f"inline(array({', '.join(pairs)}))")
        .selectExpr("i", "j", "levels", "codes[cx] AS x", "codes[cy] AS y", "buckets[cy] AS b")
        .where("x IS NOT NULL AND y IS NOT NULL")
        .groupBy("i", "j", "levels", "x", "b", "y")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    group = ["i", "j", "level", "prefix"]
    digits = [f"s{k}" for k in range(_DIGITS)]
    counted = (
        cells.select("*", F.expr("explode(sequence(0, levels - 1)) AS level"))
        .selectExpr(
            "i", "j", "level", "b", "y", "n",
            # nothing stands before the first digit; a shift by 64 would be none
            f"IF(level = levels - 1, 0L, shiftright(x, (level + 1) * {_BITS})) AS prefix",
            f"shiftright(x, level * {_BITS}) & {_DIGITS - 1} AS digit",
        )
        .groupBy(*group, "b", "y")
        .agg(*[F.expr(f"sum(CASE WHEN digit = {k} THEN n ELSE 0L END) AS s{k}") for k in range(_DIGITS)])
    )
    inside = _met(counted, [*group, "b"], "y").groupBy(*group, "b")
    per_bucket = inside.agg(*[F.sum(c).alias(c) for c in digits], F.sum("agree").alias("agree_in"), F.sum("disagree").alias("disagree_in"))
    across = _met(per_bucket, group, "b")
    return across.groupBy("i", "j").agg(
        F.sum(F.col("agree") + F.col("agree_in")).alias("agree"), F.sum(F.col("disagree") + F.col("disagree_in")).alias("disagree")
    )


def _met(counted: DataFrame, group: list[str], order: str) -> DataFrame:
    """Add ``agree`` and ``disagree``: how the points of a row and those of the rows before it in its group stand to each other."""
    digits = range(_DIGITS)
    # b<k>: points of earlier rows with digit k
    frame = f"(PARTITION BY {', '.join(group)} ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    walked = counted.selectExpr("*", *[f"coalesce(sum(s{k}) OVER {frame}, 0L) AS b{k}" for k in digits])
    plus = lambda terms: " + ".join(terms)
    total = lambda c: plus(f"{c}{k}" for k in digits)
    # products of counts pass 2^63 long before the counts do; below 2^31 points on either side all sums of products fit
    exact = lambda c: f"CAST({c} AS DECIMAL(19,0))"
    product = lambda s, b: f"CAST({exact(s)} * {exact(b)} AS DECIMAL(38,0))"

    def both(pairs: list[tuple[str, str]]) -> str:
        small = plus(f"{s} * ({b})" for s, b in pairs)
        return f"CASE WHEN small THEN CAST({small} AS DECIMAL(38,0)) ELSE {plus(product(s, b) for s, b in pairs)} END"

    below = [(f"s{k}", plus(f"b{m}" for m in range(k))) for k in digits[1:]]
    above = [(f"s{k}", plus(f"b{m}" for m in range(k + 1, _DIGITS))) for k in digits[:-1]]
    marked = walked.selectExpr("*", f"{total('s')} < 2147483648L AND {total('b')} < 2147483648L AS small")
    return marked.selectExpr(*counted.columns, f"{both(below)} AS agree", f"{both(above)} AS disagree")


def _bucketed(coded: DataFrame, n: int) -> DataFrame:
    """Add ``buckets``: for each code the bucket of its column that it lies in, of 256 with about the same number of rows."""
    cuts = F.array(*[F.lit(c) for c in EVEN_CUTS])
    edges = coded.agg(F.array(*[F.percentile_approx(F.col("codes")[k], cuts, F.lit(SKETCH_ACCURACY)) for k in range(n)]).alias("edges"))
    out = coded.withColumn("_edges", edges.scalar())
    return out.select("codes", F.array(*[cuts_below(F.col("_edges")[k], F.col("codes")[k], len(EVEN_CUTS)) for k in range(n)]).alias("buckets"))


def _pairs(columns: Sequence[str], target: str | None) -> list[tuple[int, int]]:
    every = combinations(range(len(columns)), 2)
    return [(i, j) for i, j in every if target is None or target in (columns[i], columns[j])]


def _levels(coded: DataFrame, n: int) -> list[int]:
    """Base-16 digits of the largest code of each column (one row comes back to the driver)."""
    top = coded.agg(*[F.max(F.col("codes")[k]) for k in range(n)]).first()
    return [max(1, -(-int(t or 0).bit_length() // _BITS)) for t in top]


def _ties(coded: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column: all row pairs, and those with equal values."""
    counts = (
        coded.select(F.posexplode("codes").alias("col", "code")).groupBy("col", "code").agg(F.count(F.lit(1)).alias("n"))
    )
    half = lambda c: F.expr(f"CAST({c} AS DECIMAL(19,0)) * CAST({c} - 1 AS DECIMAL(19,0)) / 2BD")
    return counts.groupBy("col").agg(F.sum(half("n")).alias("tied"), F.sum("n").alias("rows")).select(
        "col", "tied", half("rows").alias("pairs")
    )
