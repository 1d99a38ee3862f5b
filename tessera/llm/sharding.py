"""Sharding by extendible hashing, with DataFrame functions only.

A row's address is the bits of md5(id). The directory is indexed by a prefix of the address; a bucket whose bytes are
over the limit splits on the next bit, and only such buckets do, until every shard fits. The directory is worked out on
sums per cell, TIER bits at a time: rows are summed to cells once, and only cells that are still too large are summed
again by their next TIER bits.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .columns import set_aside
from .scratch import stored

#: Address bits added in one pass over the rows that still need them.
TIER = 12
#: Address bits in all; rows that agree in all of them have the same id.
BITS = 120
LIMIT = 16 << 20


def _address(key: Column) -> Column:
    """The first BITS bits of md5(key) as a string of 0 and 1."""
    part = lambda i: F.lpad(F.conv(F.substring(F.md5(key), 1 + 3 * i, 3), 16, 2), TIER, "0")
    return F.concat(*[part(i) for i in range(BITS // TIER)])


def shard(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT) -> DataFrame:
    """docs with n_bytes, shard (the shard's address bits, '' if there is one only), depth (their number), shard_docs and
    shard_bytes added; one row out per row in.

    n_bytes is the UTF-8 length of the text, 0 for null. A null id is addressed as the empty string. Every shard holds at
    most `limit` bytes, but for a single row that is longer by itself. Rows of one id share all bits of its md5; ids that
    repeat are therefore addressed by id and a number of the row, so that a group of any size is split like others. Empty
    tables give no rows; columns of the added names are replaced.
    """
    added = ["n_bytes", "shard", "depth", "shard_docs", "shard_bytes"]
    base, back = set_aside(docs, [id_col, text_col], added)
    names = base.columns
    base = base.withColumns({"n_bytes": F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long"), "_key": F.coalesce(F.col(id_col).cast("string"), F.lit(""))})
    again = stored(base.groupBy("_key").agg(F.count("*").alias("_n")).where(F.col("_n") > 1).select("_key"), "repeated-ids")
    if again.isEmpty():
        addressed = base.withColumn("_bits", _address(F.col("_key")))
    else:  # the number of a row is stored with it, so that a row that is read again has the address that it was counted by
        base = stored(base.withColumn("_row", F.monotonically_increasing_id()), "numbered-rows")
        own = F.concat_ws("#", "_key", F.col("_row").cast("string"))
        addressed = base.join(again.withColumn("_again", F.lit(True)), "_key", "left").withColumn("_bits", _address(F.when(F.col("_again"), own).otherwise(F.col("_key"))))
    leaves, open_cells = [], None
    for width in range(TIER, BITS + 1, TIER):
        rows = addressed.select(F.substring("_bits", 1, width).alias("_cell"), "n_bytes", F.substring("_bits", 1, width - TIER).alias("_up"))
        if open_cells is not None:
            rows = rows.join(open_cells, "_up", "left_semi")
        cells = rows.groupBy("_cell").agg(F.sum("n_bytes").alias("_b"), F.count("*").alias("_c"))
        # every prefix of a cell in this tier is a bucket; the leaf is the shortest one that fits
        buckets = cells.select("_cell", "_b", "_c", F.explode(F.sequence(F.lit(width - TIER + (width > TIER)), F.lit(width))).alias("depth")).withColumn("shard", F.expr("substring(_cell, 1, depth)"))
        sums = buckets.groupBy("shard", "depth").agg(F.sum("_b").alias("shard_bytes"), F.sum("_c").alias("shard_docs"), F.collect_list("_cell").alias("_cells"))
        fits = (F.col("shard_bytes") <= limit) | (F.col("shard_docs") == 1)
        found = stored(
            sums.where(fits).select("shard", "depth", "shard_docs", "shard_bytes", F.explode("_cells").alias("_cell")).groupBy("_cell").agg(F.min_by(F.struct("shard", "depth", "shard_docs", "shard_bytes"), "depth").alias("_leaf")),
            f"directory-{width}",
        )
        leaves.append((width, found))
        open_cells = stored(cells.join(found, "_cell", "left_anti").select(F.col("_cell").alias("_up")), f"oversized-{width}")
        if open_cells.isEmpty():
            break
    out = addressed
    for width, found in leaves:
        leaf = found.withColumnRenamed("_leaf", f"_leaf{width}").withColumnRenamed("_cell", f"_cell{width}")
        out = out.withColumn(f"_cell{width}", F.substring("_bits", 1, width)).join(leaf, f"_cell{width}", "left")
    leaf = reduce(lambda a, b: F.coalesce(a, b), [F.col(f"_leaf{w}") for w, _ in leaves])
    return back(out.withColumn("_at", leaf).select(*names, "n_bytes", *[F.col(f"_at.{c}").alias(c) for c in added[1:]]))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return shard(docs).drop("text")


#: The same rows in DuckDB SQL, for unique ids and directories of at most 24 bits.
SQL = f"""
WITH a AS (
  SELECT doc_id, strlen(coalesce(text, '')) AS n_bytes,
         right(bin(('0x1' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 6))::BIGINT), 24) AS bits FROM documents
), b AS (
  SELECT substr(bits, 1, d) AS shard, d AS depth, count(*) AS shard_docs, CAST(sum(n_bytes) AS BIGINT) AS shard_bytes
  FROM a, range(0, 25) t(d) GROUP BY 1, 2 HAVING sum(n_bytes) <= {LIMIT} OR count(*) = 1
), c AS (
  SELECT a.doc_id, a.n_bytes, b.shard, CAST(b.depth AS INTEGER) AS depth, b.shard_docs, b.shard_bytes,
         row_number() OVER (PARTITION BY a.doc_id ORDER BY b.depth) AS r
  FROM a JOIN b ON b.shard = substr(a.bits, 1, b.depth)
)
SELECT doc_id, n_bytes, shard, depth, shard_docs, shard_bytes FROM c WHERE r = 1
"""
