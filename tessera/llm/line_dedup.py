"""Line dedup with DataFrame functions only.

Lines are exploded and normalised, their keys hashed to 128 bits, distinct documents counted per hash, lines over the
threshold dropped everywhere but in the largest doc_id that holds them, and the rest reassembled by position.
Only hashes, ids and positions are shuffled by line; texts move once, to meet their dropped positions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .columns import need_whole_ids, set_aside
from .scratch import stored

#: The characters stripped from both ends of a line: space, tab, LF, VT, FF, CR.
BLANK = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_NO_ID = -(2**63)


def line_key(line):
    """A line's key: BLANK stripped at both ends, A-Z lower-cased."""
    return F.translate(F.btrim(line, F.lit(BLANK)), _UPPER, _LOWER)


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """docs with its text column replaced by the kept lines, and n_lines, n_dropped (long) added; one row out per row in.

    A null or empty text is one empty line. A null id is the smallest id, and all rows of one id are one document:
    a key is counted once for them. Rows of one id with equal text get equal results. Long lines and long documents
    are treated whole. An empty table gives no rows; ids that are no whole numbers raise TypeError. Columns named n_lines or n_dropped are replaced; all others are kept as they are.
    """
    need_whole_ids(docs, id_col)
    docs, back = set_aside(docs, [id_col, text_col], ["n_lines", "n_dropped"])
    base = docs.withColumns(
        {"_id": F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID)), "_text": F.coalesce(F.col(text_col), F.lit(""))}
    ).withColumn("_th", F.xxhash64("_text"))
    lines = (
        base.select("_id", "_th", F.posexplode(F.split("_text", "\n", -1)).alias("_pos", "_line"))
        .select("_id", "_th", "_pos", line_key(F.col("_line")).alias("_key"))
        .where(F.char_length("_key") >= min_chars)
        .select("_id", "_th", "_pos", F.xxhash64("_key").alias("_h1"), F.xxhash64(F.lit(7), F.reverse("_key")).alias("_h2"))
    )
    often = stored(
        lines.select("_h1", "_h2", "_id").distinct().groupBy("_h1", "_h2").agg(F.count("*").alias("_n"), F.max("_id").alias("_keep")).where(F.col("_n") >= min_docs).select("_h1", "_h2", "_keep"),
        "often-lines",
    )
    drops = lines.join(often, ["_h1", "_h2"]).where(F.col("_id") != F.col("_keep")).groupBy("_id", "_th").agg(F.collect_set("_pos").alias("_drop"))
    split = F.split("_text", "\n", -1)
    kept = F.transform(F.array_except(F.sequence(F.lit(0), F.size(split) - 1), F.col("_drop")), lambda i: F.get(split, i))
    out = base.join(drops, ["_id", "_th"], "left").withColumns(
        {
            "n_lines": F.size(split).cast("long"),
            "n_dropped": F.coalesce(F.size("_drop"), F.lit(0)).cast("long"),
            text_col: F.when(F.col("_drop").isNull(), F.col("_text")).otherwise(F.array_join(kept, "\n")),
        }
    )
    return back(out)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return line_dedup(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


#: The same rows in DuckDB SQL.
SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents
), keyed AS (
  SELECT doc_id, pos, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines
), often AS (
  SELECT k, max(doc_id) AS keep FROM keyed WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5
), marked AS (
  SELECT doc_id, pos, line, often.k IS NOT NULL AND doc_id <> keep AS dropped FROM keyed LEFT JOIN often USING (k)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
