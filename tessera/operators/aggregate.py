"""Cost and status sums, sorts, limits and samples."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: US dollars per million tokens of a model without a price of its own: in, out.
DEFAULT_PRICE = (3.0, 15.0)


def cost_by_model(usage: DataFrame, prices: DataFrame, model: str = "model", tokens_in: str = "input_tokens", tokens_out: str = "output_tokens", default: tuple[float, float] = DEFAULT_PRICE, by: list[str] | None = None) -> DataFrame:
    """calls, tokens and cost (four places) by model, and by the columns `by`. prices: model, price_in, price_out, ord; a few rows.

    A model's price is that of its name, or else of the first that one is a prefix of the other, or else the default.
    """
    by = by or []
    sums = usage.groupBy(*by, model).agg(F.count("*").alias("calls"), F.sum(tokens_in).alias("input_tokens"), F.sum(tokens_out).alias("output_tokens"))
    p = prices.select(F.col("model").alias("_p"), "price_in", "price_out", "ord")
    near = F.startswith(F.col(model), F.col("_p")) | F.startswith(F.col("_p"), F.col(model))
    best = sums.select(model).distinct().join(p, near).groupBy(model).agg(F.min_by(F.struct("price_in", "price_out"), F.struct(F.col(model) != F.col("_p"), F.col("ord"))).alias("_price"))
    price = lambda c, d: F.coalesce(F.col(f"_price.{c}"), F.lit(d))
    cost = F.col("input_tokens") / 1e6 * price("price_in", default[0]) + F.col("output_tokens") / 1e6 * price("price_out", default[1])
    return sums.join(best, model, "left").select(*by, model, "calls", "input_tokens", "output_tokens", F.round(cost, 4).alias("cost_usd"))


def status_summary(runs: DataFrame, status: str, cost: str, as_skipped: tuple[str, ...] = ("too_complex",)) -> DataFrame:
    """n and cost by status, some statuses counted as skipped."""
    s = F.when(F.col(status).isin(*as_skipped), "skipped").otherwise(F.col(status))
    return runs.groupBy(s.alias("status")).agg(F.count("*").alias("n"), F.sum(cost).alias("cost"))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """table, n."""
    parts = [t.agg(F.count("*").alias("n")).select(F.lit(name).alias("table"), "n") for name, t in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def smallest(df: DataFrame, key: Column | str, by: list[str], wanted: Column, order: Column | None = None, seed: int = 0) -> DataFrame:
    """Of each group of `by` (all rows, if it is empty) the rows that come first by `order`, then key: `wanted` of them, which may
    use the group's size `_total`. order is a long that spreads evenly over its range, by default the key's seeded hash.

    No order of all rows is made. Rows are counted by the 16 highest bits of order, in one aggregation whose parts merge; that
    gives the cell in which each group's limit lies. Whole cells before it are taken as they are, and only the cell itself, some
    65,536th of a group, is ordered. Rows of one order and key are taken in any order. NULLs in `by` are a group."""
    h = F.xxhash64(F.lit(seed), key) if order is None else order
    rows = df.withColumns({"_h": h, "_cell": F.shiftright(h, 48)})
    cells = rows.groupBy(*by, "_cell").agg(F.count("*").alias("_n"))
    w = Window.partitionBy(*by)
    cells = cells.withColumns({"_total": F.sum("_n").over(w), "_upto": F.sum("_n").over(w.orderBy("_cell").rowsBetween(Window.unboundedPreceding, 0))})
    cells = cells.withColumns({"_wanted": wanted.cast("long"), "_before": F.col("_upto") - F.col("_n")})
    # the cell that holds the limit, one a group; groups that are taken whole have their last one
    last = (F.col("_before") < F.col("_wanted")) & ((F.col("_upto") >= F.col("_wanted")) | (F.col("_upto") == F.col("_total")))
    cuts = cells.where(last).select(*[F.col(c).alias(f"_by_{c}") for c in by], F.col("_cell").alias("_cut"), (F.col("_wanted") - F.col("_before")).alias("_take"))
    joined = rows.crossJoin(F.broadcast(cuts)) if not by else rows.join(cuts, reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in by]))
    whole = joined.where("_cell < _cut").select(*df.columns)
    cell = joined.where("_cell = _cut").withColumn("_rank", F.row_number().over(w.orderBy("_h", key)))
    return whole.unionByName(cell.where("_rank <= _take").select(*df.columns))


def sample_share(df: DataFrame, share: float, key: Column | str, seed: int = 0, by: list[str] | None = None) -> DataFrame:
    """At least one row (of each group), else int(share * n) rows: those with the smallest seeded hashes, so the same ones each time."""
    return smallest(df, key, by or [], F.greatest(F.lit(1), F.floor(F.col("_total") * share)), seed=seed)


def sample_rows(df: DataFrame, n: int, key: Column | str, seed: int = 0, by: list[str] | None = None) -> DataFrame:
    """n rows (of each group), or all if there are no more. Without groups each task keeps n rows at most."""
    if by:
        return smallest(df, key, by, F.lit(n), seed=seed)
    return df.orderBy(F.xxhash64(F.lit(seed), key), key).limit(n)


#: 2 to this power are the distinct values up to which a sketch counts exactly; beyond, the relative error is about 1 %.
LG_DISTINCT = 14
#: The size of quantile sketches: with 800, a quantile's rank is off by 0.4 % at most, 99 times in 100.
K_QUANTILES = 800


def sketches(df: DataFrame, by: list[str], who: str, value: str) -> DataFrame:
    """by, n, distinct_sketch (of who), value_sketch (of value): one small row a group, to be stored, a day's after a day's.
    NULLs are in n alone."""
    return df.groupBy(*by).agg(F.count("*").alias("n"), F.theta_sketch_agg(who, LG_DISTINCT).alias("distinct_sketch"), F.kll_sketch_agg_double(F.col(value).cast("double"), K_QUANTILES).alias("value_sketch"))


def merged(stored: DataFrame, by: list[str]) -> DataFrame:
    """Stored sketches summed to coarser groups; they can be merged again."""
    return stored.groupBy(*by).agg(F.sum("n").alias("n"), F.theta_union_agg("distinct_sketch", LG_DISTINCT).alias("distinct_sketch"), F.kll_merge_agg_double("value_sketch").alias("value_sketch"))


def distinct_rows(df: DataFrame, by: list[str], who: str) -> DataFrame:
    """by, who: a row for each distinct value of who in a group (one of NULL, too), to be stored, a day's after a day's, where
    counts must be exact whatever their size."""
    return df.select(*by, who).distinct()


def distinct_counts(stored: DataFrame, by: list[str], who: str) -> DataFrame:
    """by, n_distinct: exact counts over stored distinct rows, of the same groups or coarser ones. NULLs aren't counted. Values are
    dealt by group and value, so that a group of any size is counted by all tasks."""
    return stored.select(*by, who).distinct().groupBy(*by).agg(F.count(who).alias("n_distinct"))


def estimates(stored: DataFrame, quantiles: list[float]) -> DataFrame:
    """The groups with n, n_distinct, n_values and q_<quantile in per cent>, NULL where a group has no value. 0 and 1 are exact."""
    keep = [c for c in stored.columns if c not in ("distinct_sketch", "value_sketch")]
    n = F.kll_sketch_get_n_double("value_sketch")
    qs = [F.when(n > 0, F.kll_sketch_get_quantile_double("value_sketch", F.lit(q))).alias(f"q_{round(q * 100)}") for q in quantiles]
    return stored.select(*keep, F.theta_sketch_estimate("distinct_sketch").alias("n_distinct"), n.alias("n_values"), *qs)


def in_order(df: DataFrame, *columns: str) -> DataFrame:
    """Sorted ascending, NULLs first."""
    return df.orderBy(*[F.col(c).asc_nulls_first() for c in columns])
