"""Constant relations: unit rules, and the substances and aliases that a new registry starts with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.vocab import UNITS
from ..operators import store

# fixed values: name, registry number, molecular weight, category
SUBSTANCES = [
    ("sucrose", "57-50-1", 342.3, "saccharide"),
    ("glucose", "50-99-7", 180.16, "saccharide"),
    ("fructose", "57-48-7", 180.16, "saccharide"),
    ("lactose", "63-42-3", 342.3, "saccharide"),
    ("sucralose", "56038-13-2", 397.64, "non_nutritive_synthetic"),
    ("aspartame", "22839-47-0", 294.3, "non_nutritive_synthetic"),
    ("acesulfame_k", "55589-62-3", 201.24, "non_nutritive_synthetic"),
    ("saccharin", "81-07-2", 183.18, "non_nutritive_synthetic"),
    ("stevioside", "57817-89-7", 804.87, "non_nutritive_natural"),
    ("rebaudioside_a", "58543-16-1", 967.01, "non_nutritive_natural"),
    ("erythritol", "149-32-6", 122.12, "polyol"),
    ("xylitol", "87-99-0", 152.15, "polyol"),
    ("sorbitol", "50-70-4", 182.17, "polyol"),
    ("sodium_chloride", "7647-14-5", 58.44, "salt"),
    ("potassium_chloride", "7447-40-7", 74.55, "salt"),
    ("citric_acid", "77-92-9", 192.12, "acid"),
    ("caffeine", "58-08-2", 194.19, "bitter"),
    ("quinine", "130-95-0", 324.42, "bitter"),
    ("monosodium_glutamate", "142-47-2", 169.11, "umami"),
]
# fixed values: aliases by name
ALIASES = {
    "sucrose": ["sugar", "table sugar", "cane sugar", "beet sugar"],
    "glucose": ["dextrose", "d-glucose", "grape sugar", "blood sugar"],
    "fructose": ["fruit sugar", "d-fructose", "levulose"],
    "sucralose": ["splenda"],
    "aspartame": ["equal", "nutrasweet"],
    "acesulfame_k": ["ace-k", "acesulfame potassium", "sunett"],
    "saccharin": ["sweet'n low", "sodium saccharin"],
    "stevioside": ["stevia", "stevia extract"],
    "rebaudioside_a": ["reb a", "rebiana", "rebaudioside a"],
    "sodium_chloride": ["nacl", "salt", "table salt", "common salt"],
    "potassium_chloride": ["kcl"],
    "citric_acid": ["citrate"],
    "caffeine": ["1,3,7-trimethylxanthine"],
    "monosodium_glutamate": ["msg", "sodium glutamate"],
}


def unit_rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(UNITS, "unit_raw string, unit_canonical string, multiplier double, category string")


def seed_substances(substances: DataFrame) -> DataFrame:
    """The registry with the seeds that it lacks, which get the next ids."""
    spark = substances.sparkSession
    seeds = spark.createDataFrame(SUBSTANCES, "normalized_name string, cas_number string, molecular_weight double, category string")
    new = seeds.join(substances.select("normalized_name"), "normalized_name", "left_anti")
    numbered = store.with_ids(substances, new, "substance_id", ["normalized_name"]).withColumn("substance_id", F.col("substance_id").cast(dict(substances.dtypes)["substance_id"]))
    return substances.unionByName(numbered, allowMissingColumns=True)


def seed_aliases(aliases: DataFrame, substances: DataFrame) -> DataFrame:
    """The alias table with the seeds that it lacks; names that are no substance get none."""
    spark = aliases.sparkSession
    seeds = spark.createDataFrame([(a, n) for n, names in ALIASES.items() for a in names], "alias string, normalized_name string")
    return store.insert_missing(aliases, seeds.join(substances.select("normalized_name", "substance_id"), "normalized_name").select("alias", "substance_id"), "alias")
