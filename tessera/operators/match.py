"""One-to-one matching of two record sets, its tolerance test, and precision, recall and F1.

Matching asks for equality of a computed key, so taking the first unused partner in order is the same as pairing the
k-th row of one side with the k-th of the other within each key: one window a side and an equi-join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import alias_key, attribute_key, source_category, substance_key

#: Tolerances of a value: from a figure, and from elsewhere.
FIGURE_TOLERANCE, TOLERANCE = 0.10, 0.01


def pair_in_order(left: DataFrame, right: DataFrame, keys: list[str], left_order: str, right_order: str, how: str = "inner") -> DataFrame:
    """left joined with right, the k-th with the k-th row of equal keys; NULL keys are equal. right's columns are prefixed r_."""
    nth = lambda df, order: df.withColumn("_nth", F.row_number().over(Window.partitionBy(*keys).orderBy(order)))
    r = nth(right, right_order)
    r = r.select(*[F.col(c).alias(f"r_{c}") for c in r.columns])
    both = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"r_{k}")) for k in [*keys, "_nth"]])
    return nth(left, left_order).join(r, both, how).drop("_nth", "r__nth")


def mixture_key(slots: list[tuple[str, str]], synonyms: dict[str, str]) -> Column:
    """The set of (canonical substance, concentration to six places) of the slots that name a substance, as sorted text."""
    pairs = [F.struct(substance_key(s, synonyms).alias("s"), F.round(c, 6).alias("c"), F.coalesce(F.col(s) != "", F.lit(False)).alias("has")) for s, c in slots]
    return F.to_json(F.array_sort(F.array_distinct(F.transform(F.filter(F.array(*pairs), lambda x: x["has"]), lambda x: F.struct(x["s"].alias("s"), F.coalesce(x["c"].cast("string"), F.lit("-")).alias("c"))))))


def measurement_keys(df: DataFrame, substances: dict[str, str], attributes: dict[str, str]) -> DataFrame:
    """df with k_1 to k_8: the fields that two measurements must agree on, normalised."""
    low = lambda c, default="": F.lower(F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit(default)))
    return df.withColumns(
        {
            "k_1": mixture_key([("substance_1", "concentration_1"), ("substance_2", "concentration_2")], substances),
            "k_2": low("experiment"),
            "k_3": low("panel_label"),
            "k_4": low("measurement_domain", "sensory"),
            "k_5": low("base_matrix"),
            "k_6": F.coalesce(F.col("is_control"), F.lit(False)),
            "k_7": attribute_key("attribute", attributes),
            "k_8": low("value_type"),
        }
    )


def match_measurements(truth: DataFrame, found: DataFrame, substances: dict[str, str], attributes: dict[str, str], by: tuple[str, ...] = ("paper_id",), order: str = "ord") -> DataFrame:
    """Full outer pairs of truth and found (r_) rows of each paper, with is_correct and pct_diff for the pairs."""
    keys = [*by, *[f"k_{i}" for i in range(1, 9)]]
    pairs = pair_in_order(measurement_keys(truth, substances, attributes).withColumn("_in", F.lit(True)), measurement_keys(found, substances, attributes).withColumn("_in", F.lit(True)), keys, order, order, "full")
    both = F.col("_in").isNotNull() & F.col("r__in").isNotNull()
    ok, diff = value_test("value", "r_value", source_category("source_location") == "figure")
    drop = [c for i in range(1, 9) for c in (f"k_{i}", f"r_k_{i}")]
    status = F.when(both, "matched").when(F.col("_in").isNotNull(), "truth_only").otherwise("found_only")
    return pairs.withColumns({"status": status, "is_correct": F.when(both, ok), "pct_diff": F.when(both, diff)}).drop("_in", "r__in", *drop)


def value_test(truth: str, found: str, loose: Column, tolerance: float = TOLERANCE, loose_tolerance: float = FIGURE_TOLERANCE) -> tuple[Column, Column]:
    """Whether two values agree, and their relative difference to six places; two NULLs agree, one does not."""
    t, f = F.col(truth), F.col(found)
    diff = F.abs(t - f) / F.greatest(F.abs(t), F.lit(1e-12))
    ok = F.when(t.isNull() | f.isNull(), t.isNull() & f.isNull()).otherwise(diff <= F.when(loose, loose_tolerance).otherwise(tolerance))
    return ok, F.when(t.isNull() | f.isNull(), 0.0).otherwise(F.round(diff, 6))


def scores(df: DataFrame) -> DataFrame:
    """precision, recall, f1 (four places, 0 where undefined) and n_correct from n_truth, n_found, ok_truth, ok_found."""
    p = F.coalesce(F.try_divide(F.col("ok_found"), F.col("n_found")), F.lit(0.0))
    r = F.coalesce(F.try_divide(F.col("ok_truth"), F.col("n_truth")), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2 * p * r, p + r), F.lit(0.0))
    rest = [c for c in df.columns if c not in ("ok_truth", "ok_found")]
    return df.select(*rest, F.round(p, 4).alias("precision"), F.round(r, 4).alias("recall"), F.round(f1, 4).alias("f1"), F.greatest("ok_truth", "ok_found").alias("n_correct"))


def breakdown(sides: DataFrame, dimensions: dict[str, Column]) -> DataFrame:
    """Scores by dimension and key in one aggregation over stacked dimensions.

    sides: rows of both sides with is_truth and is_ok. Rows with a blank key are left out of a dimension.
    """
    stacked = F.explode(F.array(*[F.struct(F.lit(n).alias("dimension"), c.cast("string").alias("key")) for n, c in dimensions.items()]))
    rows = sides.select(stacked.alias("_d"), "is_truth", "is_ok").where(F.coalesce(F.col("_d.key"), F.lit("")) != "")
    return scores(rows.groupBy(F.col("_d.dimension").alias("dimension"), F.col("_d.key").alias("key")).agg(*_counts()))


def overall(sides: DataFrame) -> DataFrame:
    return scores(sides.agg(*_counts()))


def _counts() -> list[Column]:
    t, ok = F.col("is_truth"), F.coalesce(F.col("is_ok"), F.lit(False))
    return [F.count_if(t).alias("n_truth"), F.count_if(~t).alias("n_found"), F.count_if(t & ok).alias("ok_truth"), F.count_if(~t & ok).alias("ok_found")]


def measurement_dimensions() -> dict[str, Column]:
    """The six breakdowns of a scored measurement."""
    return {
        "value_type": F.col("value_type"),
        "source": source_category("source_location"),
        "attribute": alias_key("attribute"),
        "experiment": F.col("experiment"),
        "panel": F.coalesce(F.nullif("panel_label", F.lit("")), F.lit("unknown")),
        "domain": F.lower(F.coalesce(F.nullif("measurement_domain", F.lit("")), F.lit("sensory"))),
    }


def two_sides(pairs: DataFrame, columns: list[str]) -> DataFrame:
    """Both sides of match_measurements as rows, each with is_truth and is_ok."""
    left = pairs.where("status <> 'found_only'").select(*columns, F.lit(True).alias("is_truth"), F.col("is_correct").alias("is_ok"))
    right = pairs.where("status <> 'truth_only'").select(*[F.col(f"r_{c}").alias(c) for c in columns], F.lit(False).alias("is_truth"), F.col("is_correct").alias("is_ok"))
    return left.unionByName(right)
