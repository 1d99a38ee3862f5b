"""Nested values: component arrays, and JSON whose keys' order or depth only Python sees."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import alias_key, col, to_double

COMPONENTS = "array<struct<substance:string,concentration:string,unit:string>>"

# fixed values: keys of measured data that name no attribute, and keys that mark an attribute's statistics
STRUCTURAL = ("mean", "sd", "sem", "ci_95", "n", "data_source", "unit", "concentrations", "means", "sems", "sds", "scale", "notes", "source", "error_type")
STATISTICS = ("mean", "sd", "sem", "means")


def components(c: Column | str) -> Column:
    """The components of a JSON text; NULL if it is none."""
    return F.from_json(col(c), COMPONENTS, {"mode": "PERMISSIVE"})


def component_slots(c: Column | str, name: Column | None = None) -> Column:
    """struct of the first two components' substance, concentration, unit, and a note that lists the others."""
    parts = F.coalesce(components(c), F.array().cast(COMPONENTS))
    blank = lambda x: F.nullif(x, F.lit(""))
    one, two = F.get(parts, F.lit(0)), F.get(parts, F.lit(1))
    first = alias_key(F.coalesce(blank(one["substance"]), name if name is not None else F.lit(None), F.lit("")))
    rest = F.slice(parts, 3, F.greatest(F.size(parts) - 2, F.lit(0)))
    label = lambda x: F.coalesce(blank(x["substance"]), F.lit("?"))
    more = F.transform(rest, lambda x: F.when(x["concentration"].isNull(), label(x)).otherwise(F.rtrim(F.concat(label(x), F.lit("@"), x["concentration"], F.lit(" "), F.coalesce(x["unit"], F.lit(""))))))
    return F.struct(
        first.alias("substance_1"), to_double(one["concentration"]).alias("concentration_1"), blank(one["unit"]).alias("unit_1"),
        blank(alias_key(two["substance"])).alias("substance_2"), to_double(two["concentration"]).alias("concentration_2"), blank(two["unit"]).alias("unit_2"),
        F.when(F.size(rest) > 0, F.concat(F.lit("extra components: "), F.array_join(more, "; "))).alias("notes"),
    )


def first_concentration(c: Column | str) -> Column:
    return to_double(F.get(components(c), F.lit(0))["concentration"])


def _loads(text):
    try:
        return json.loads(text) if text else None
    except ValueError:
        return None


@F.pandas_udf(T.StringType())
def flat_demographics(texts: pd.Series) -> pd.Series:
    """key=value pairs of two sections in the document's order; '' for what can't be read."""

    def one(text):
        data = _loads(text)
        parts = [data.get(s) for s in ("demographics", "sensory_traits")] if isinstance(data, dict) else []
        return ", ".join(f"{k}={v}" for p in parts if isinstance(p, dict) for k, v in p.items() if v is not None and v != "")

    return texts.map(one, na_action=None)


@F.pandas_udf(T.ArrayType(T.StringType()))
def attribute_names(texts: pd.Series) -> pd.Series:
    """Sorted names of the attributes measured in a JSON text: keys, at most five levels down, whose value has statistics."""

    def one(text):
        found, level = set(), [_loads(text)]
        for _ in range(6):
            below = []
            for node in level:
                items = [(k, v) for k, v in node.items() if k not in STRUCTURAL] if isinstance(node, dict) else [(None, v) for v in node] if isinstance(node, list) else []
                for key, value in items:
                    if key is not None and isinstance(value, dict) and any(s in value for s in STATISTICS):
                        found.add(key)
                    elif isinstance(value, dict | list):
                        below.append(value)
            level = below
        return sorted(found)

    return texts.map(one)


def attribute_rows(df: DataFrame, key: str, text: str) -> DataFrame:
    """key, attribute_names: as the function attribute_names, by a walk over variants, one level a step, without Python workers. key
    tells rows apart. Rows without an attribute, and texts that are NULL, empty or no JSON, have an empty array; so have
    objects that name a key twice, unless spark.sql.variant.allowDuplicateKeys is set (then the last one counts)."""
    spark, found, node, first = df.sparkSession, F.col("_found"), F.col("_node"), F.col("_first")
    rows = df.select(F.col(key).alias("_key"), F.lit(None).cast("string").alias("_found"), F.try_parse_json(text).alias("_node"), F.lit(True).alias("_first"))
    for _ in range(6):
        below = rows.lateralJoin(spark.tvf.variant_explode_outer(node.outer()))
        name, value = F.col("key"), F.col("value")
        measured = F.array_contains(F.array(*[F.try_variant_get(value, f"$.{s}", "variant").isNotNull() for s in STATISTICS]), True) & name.isNotNull()
        counts = F.coalesce(~name.isin(*STRUCTURAL), F.lit(True))
        rows = below.select(
            "_key", F.coalesce(found, F.when(counts & measured, name)).alias("_found"), F.when(counts & ~measured, value).alias("_node"),
            (first & (F.coalesce("pos", F.lit(0)) == 0)).alias("_first"),
        ).where(found.isNotNull() | node.isNotNull() | first)
    return rows.groupBy("_key").agg(F.array_sort(F.collect_set("_found")).alias("attribute_names")).withColumnRenamed("_key", key)


def rename_keys(c: Column | str, mapping: dict[str, str]) -> Column:
    """JSON text with mapped keys renamed in all objects within objects; of keys that become one the last stays."""

    @F.pandas_udf(T.StringType())
    def run(texts: pd.Series) -> pd.Series:
        def new(node):
            return {mapping.get(k.lower().strip(), k): new(v) for k, v in node.items()} if isinstance(node, dict) else node

        return texts.map(lambda t: None if (d := _loads(t)) is None else json.dumps(new(d), ensure_ascii=False))

    return run(col(c))
