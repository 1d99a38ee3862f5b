"""Many phrases in many texts at once, by an inverted index of the phrases' rarest word pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What parts words: space, tab, LF, VT, FF, CR.
BLANKS = "[\\x20\\x09-\\x0D]+"


def words(text: Column | str) -> Column:
    """The words of a text, A-Z lower-cased; none for a null."""
    c = F.col(text) if isinstance(text, str) else text
    return F.filter(F.split(F.translate(F.coalesce(c, F.lit("")), _UPPER, _LOWER), BLANKS), lambda w: w != "")


def _line(tokens: Column) -> Column:
    """Words between single spaces, with one at each end, so that phrases are found as whole words."""
    return F.concat(F.lit(" "), F.array_join(tokens, " "), F.lit(" "))


def _keys(tokens: Column) -> Column:
    """Distinct words and pairs of neighbours."""
    n = F.size(tokens)
    pairs = F.when(n > 1, F.zip_with(F.slice(tokens, 1, n - 1), F.slice(tokens, 2, n - 1), lambda a, b: F.concat(a, F.lit(" "), b))).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(tokens, pairs))


def find_phrases(docs: DataFrame, phrases: DataFrame, id_col: str, text_col: str, phrase_id: str, phrase_col: str) -> DataFrame:
    """id_col, phrase_id of each text that has a phrase as whole words in a row (A-Z in any case, blanks of any kind between).

    Each phrase is looked for by one key: the pair of neighbouring words (of a phrase of one word, that word) that the fewest
    texts have, so a text meets only phrases whose rarest pair it holds, and those are then verified in the whole text. No text
    is held against all phrases, and phrases are joined, not broadcast. Nulls and texts or phrases without words are found
    nowhere; rows of one id, and repeated phrases, are found once each; an empty table on either side gives none. A phrase that
    a third of the texts hold gives that many rows, and its key's join can be split by adaptive execution.
    """
    sought = phrases.select(F.col(phrase_id).alias("_p"), words(phrase_col).alias("_w")).where("size(_w) > 0").select("_p", _line(F.col("_w")).alias("_phrase"), F.size("_w").alias("_n"), F.explode(_keys(F.col("_w"))).alias("_key"))
    sought = sought.where((F.col("_n") == 1) | F.col("_key").contains(" "))
    texts = docs.select(F.col(id_col).alias("_d"), words(text_col).alias("_w")).where("_d IS NOT NULL")
    held = texts.select("_d", F.explode(_keys(F.col("_w"))).alias("_key"))
    wanted = sought.select("_key").distinct()
    counts = held.join(wanted, "_key", "left_semi").groupBy("_key").agg(F.count("*").alias("_docs"))
    # a pair that no text has rules its phrase out
    rarest = sought.join(counts, "_key", "left").groupBy("_p", "_phrase").agg(F.min(F.struct(F.coalesce("_docs", F.lit(0)).alias("docs"), "_key")).alias("_r"))
    index = rarest.where("_r.docs > 0").select("_p", "_phrase", F.col("_r._key").alias("_key"))
    candidates = held.join(index, "_key").select("_d", "_p", "_phrase").distinct()
    found = candidates.join(texts.select("_d", _line(F.col("_w")).alias("_text")), "_d").where(F.contains("_text", "_phrase"))
    return found.select(F.col("_d").alias(id_col), F.col("_p").alias(phrase_id)).distinct()
