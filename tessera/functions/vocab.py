"""Vocabularies: attribute and substance names, categories, units."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import alias_key, col, lookup

# fixed values: synonyms used in scoring
SCORING_SUBSTANCES = {
    "nacl": "sodium_chloride",
    "sodium chloride": "sodium_chloride",
    "salt": "sodium_chloride",
    "msg": "monosodium_glutamate",
    "monosodium glutamate": "monosodium_glutamate",
    "quinine hcl": "quinine_hydrochloride",
    "quinine hydrochloride": "quinine_hydrochloride",
}
# fixed values: names and their canonical forms
CANONICAL = {
    "reb a": "rebaudioside_a",
    "rebiana": "rebaudioside_a",
    "rebaudioside a": "rebaudioside_a",
    "reb m": "rebaudioside_m",
    "ace-k": "acesulfame_k",
    "acesulfame k": "acesulfame_k",
    "acesulfame potassium": "acesulfame_k",
    "aspartame": "aspartame",
    "neotame": "neotame",
    "sucralose": "sucralose",
    "saccharin": "saccharin",
    "stevia": "stevioside",
    "monk fruit": "mogroside_v",
    "luo han guo": "mogroside_v",
    "kcl": "potassium_chloride",
    "nacl": "sodium_chloride",
    "msg": "monosodium_glutamate",
}
# fixed values: categories and their members
CATEGORIES = {
    "saccharide": ["sucrose", "glucose", "fructose", "lactose", "maltose", "trehalose", "galactose"],
    "polyol": ["sorbitol", "xylitol", "erythritol", "mannitol", "maltitol", "isomalt", "lactitol"],
    "non_nutritive_synthetic": ["sucralose", "aspartame", "acesulfame_k", "saccharin", "neotame", "cyclamate", "advantame"],
    "non_nutritive_natural": ["stevioside", "rebaudioside_a", "rebaudioside_m", "mogroside_v", "thaumatin", "brazzein", "glycyrrhizin"],
    "salt": ["sodium_chloride", "potassium_chloride", "calcium_chloride", "magnesium_chloride"],
    "acid": ["citric_acid", "malic_acid", "tartaric_acid", "acetic_acid", "hydrochloric_acid", "phosphoric_acid", "lactic_acid"],
    "bitter": ["caffeine", "quinine", "denatonium", "propylthiouracil", "phenylthiocarbamide"],
    "umami": ["monosodium_glutamate", "inosine_monophosphate", "guanosine_monophosphate"],
}
# fixed values: unit, canonical unit, multiplier, category
UNITS = [
    ("mM", "M", 0.001, "solutions"),
    ("µM", "M", 0.000001, "solutions"),
    ("% w/v", "g/L", 10.0, "solutions"),
    ("% w/w", "g/kg", 10.0, "formulated_food"),
    ("ppm", "mg/L", 1.0, "solutions"),
    ("ppm", "mg/kg", 1.0, "formulated_food"),
    ("ppb", "µg/L", 1.0, "solutions"),
    ("g/100mL", "g/L", 10.0, "solutions"),
    ("mg/mL", "g/L", 1.0, "solutions"),
    ("µg/mL", "mg/L", 1.0, "solutions"),
]
# fixed values: words of an attribute that don't tell it apart
IDLE_WORDS = (" intensity", " perception", " rating", " score")
ENDINGS = ("ness", "ity")


def vocabulary_term(c: Column | str, mapping: dict[str, str]) -> Column:
    """The term of a name: as it is, without an idle word, or with an ending added; NULL if none is known."""
    key = alias_key(c)
    tries = [key, *[alias_key(F.replace(key, F.lit(w), F.lit(""))) for w in IDLE_WORDS], *[F.concat(key, F.lit(e)) for e in ENDINGS]]
    return F.coalesce(*[lookup(mapping, t) for t in tries])


def canonical_substance(c: Column | str) -> Column:
    """A known name's canonical form; else without signs and with underscores for white space."""
    key = alias_key(c)
    return F.coalesce(lookup(CANONICAL, key), F.regexp_replace(F.regexp_replace(key, r"(?U)[^\w\s]", ""), r"(?U)\s+", "_"))


def substance_category(c: Column | str) -> Column:
    return F.coalesce(lookup({n: k for k, names in CATEGORIES.items() for n in names}, col(c)), F.lit("other"))


def convert_units(df: DataFrame, value: str, unit: str, target: str, weight: str | None = None, rules: DataFrame | None = None) -> DataFrame:
    """df with value_converted and unit_converted: unchanged for one unit, by a rule's multiplier, or by the molecular
    weight from g/L or mg/L to M; NULL for both otherwise. Rules (unit_raw, unit_canonical, multiplier) are few."""
    if rules is None:
        rules = df.sparkSession.createDataFrame(UNITS, "unit_raw string, unit_canonical string, multiplier double, category string")
    one = rules.groupBy("unit_raw", "unit_canonical").agg(F.first("multiplier").alias("_by"))
    joined = df.join(one, (F.col(unit) == F.col("unit_raw")) & (F.col(target) == F.col("unit_canonical")), "left")
    mw = F.nullif(F.col(weight).cast("double"), F.lit(0.0)) if weight else F.lit(None).cast("double")
    by_weight = F.when(F.col(target) == "M", F.when(F.col(unit) == "g/L", F.col(value) / mw).when(F.col(unit) == "mg/L", F.col(value) / 1000 / mw))
    got = F.when(F.col(unit) == F.col(target), F.col(value)).otherwise(F.coalesce(F.col(value) * F.col("_by"), by_weight))
    known = (F.col(unit) == F.col(target)) | F.col("_by").isNotNull() | by_weight.isNotNull()
    return joined.withColumns({"value_converted": got, "unit_converted": F.when(known, F.col(target))}).drop("unit_raw", "unit_canonical", "_by")


def unmapped_terms(df: DataFrame, name: str, mapping: dict[str, str]) -> DataFrame:
    """name, n of the names that the vocabulary does not know, for people to add."""
    key = alias_key(name)
    return df.where(vocabulary_term(name, mapping).isNull() & key.isNotNull()).groupBy(key.alias("name")).agg(F.count("*").alias("n"))
