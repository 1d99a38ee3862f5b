"""Quality rules with adaptive thresholds.

Each text gets whole-text counts. Per language and source, every rule's value is summed into a quantile sketch: counts
per bin of a log-linear scale, which merge by addition, so that any number of partial sketches give the same sketch.
A rule's threshold is a fence over the sketch's quantiles: an upper quantile, and beyond it some times its distance from
the median. Nothing else bounds it. A group whose sketch holds too few documents for a quantile, or shows no spread, takes
the fence of its language's merged sketch, and where that is no better, of all documents' sketch; a rule without any spread
at all rejects nothing. Documents meet their group's thresholds in a join.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .columns import set_aside
from .scratch import stored
from .textblock import hash_spans, ragged, spans, text_blocks, text_of, windows, words

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: rule -> (numerator, denominator): the value is 1000 * numerator / denominator.
RULES = {
    "symbols": ("n_symbols", "n_words"),
    "dup_lines": ("n_dup_lines", "n_lines"),
    "repeats": ("n_repeat_words", "n_words"),
    "word_length": ("word_chars", "n_words"),
}
#: The fence is this quantile, in hundredths, and FENCE times its distance from the median beyond it.
QUANTILE, FENCE = 95, 3
#: Documents that a group's own sketch needs, so that some lie beyond its upper quantile.
LEAST = 200
MIN_WORDS = 50
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def _per_text(flags: np.ndarray, off: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[off[1:]] - total[off[:-1]]


def _again(keys: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key: whether an equal one is in its text, and whether an equal one came before."""
    order = np.lexsort((keys, text))
    k, t = keys[order], text[order]
    same = (k[1:] == k[:-1]) & (t[1:] == t[:-1])
    later = np.concatenate([[False], same]) if len(keys) else np.zeros(0, bool)
    any_ = later.copy()
    any_[:-1] |= later[1:]
    twice, before = np.empty(len(keys), bool), np.empty(len(keys), bool)
    twice[order], before[order] = any_, later  # lexsort is stable: the first of equal keys comes first
    return twice, before


def text_counts(data: np.ndarray, off: np.ndarray) -> dict[str, np.ndarray]:
    """COUNTS and n_lines (lines with a word) of each text of a block."""
    starts, ends, first = words(data, off)
    n_words = np.diff(first)
    lead = (data & 0xC0) != 0x80  # a code point's first byte
    in_word = np.zeros(len(data) + 1, np.int8)
    np.add.at(in_word, starts, 1)
    np.add.at(in_word, ends, -1)
    inside = np.cumsum(in_word[:-1]).astype(bool)
    key, at = windows(hash_spans(data, starts, ends), first, 3)
    twice, _ = _again(key, text_of(first)[at])
    hit = np.zeros(len(starts), bool)
    for k in range(3):
        hit[at[twice] + k] = True
    ls, le = spans(data != 0x0A, off)
    has_word = np.searchsorted(starts, le) > np.searchsorted(starts, ls)
    ls, le = ls[has_word], le[has_word]
    line_text = np.searchsorted(off, ls, "right") - 1
    _, before = _again(hash_spans(data, ls, le), line_text)
    return {
        "n_words": n_words,
        "word_chars": _per_text(lead & inside, off),
        "n_symbols": _per_text(_SYMBOL[data], off),
        "n_dup_lines": np.bincount(line_text[before], minlength=len(off) - 1),
        "n_repeat_words": np.bincount(text_of(first)[hit], minlength=len(off) - 1),
        "n_lines": np.bincount(line_text, minlength=len(off) - 1),
    }


def counted(docs: DataFrame, text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """docs with COUNTS and n_lines added (long)."""
    added = [*COUNTS, "n_lines"]
    names = [c for c in docs.columns if c not in added and (keep_text or c != text_col)]
    schema = T.StructType([docs.schema[c] for c in names] + [T.StructField(c, T.LongType()) for c in added])

    def run(batches):
        for part, data, off in text_blocks(batches, text_col):
            got = text_counts(data, off)
            yield pa.RecordBatch.from_arrays([part.column(part.schema.get_field_index(c)) for c in names] + [pa.array(got[c].astype(np.int64)) for c in added], names=[*names, *added])

    return docs.mapInArrow(run, schema)


def _bin(v: Column) -> Column:
    """The bin of a whole number: exact below 64, then 32 bins for each power of two."""
    down = F.length(F.bin(v)) - F.lit(6)
    return F.when(v < 64, v).otherwise(down * 32 + F.floor(v / F.pow(F.lit(2), down)))


def _least_of(b: Column) -> Column:
    """The smallest value of a bin."""
    down = F.floor(b / 32) - 1
    return F.when(b < 64, b).otherwise((b - 32 * down) * F.pow(F.lit(2), down)).cast("long")


def _value(rule: str) -> Column:
    top, bottom = RULES[rule]
    return F.when(F.col(bottom) > 0, F.floor(F.lit(1000) * F.col(top) / F.col(bottom))).otherwise(F.lit(0)).cast("long")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def sketches(values: DataFrame, by: list[str]) -> DataFrame:
    """Mergeable sketches: by, rule, bin, n. Merge two with unionByName and a sum of n."""
    bins = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), _bin(_value(r)).cast("long").alias("bin")) for r in RULES])).alias("_s")
    return values.select(*by, bins).groupBy(*by, F.col("_s.rule").alias("rule"), F.col("_s.bin").alias("bin")).agg(F.count("*").alias("n"))


def fences(sketch: DataFrame, by: list[str], least: int) -> DataFrame:
    """by, rule, _fence (a bin): of each sketch with `least` documents and some spread. Works on a few hundred bins a sketch."""
    w = Window.partitionBy(*by, "rule")
    run = sketch.groupBy(*by, "rule", "bin").agg(F.sum("n").alias("n")).withColumns({"_to": F.sum("n").over(w.orderBy("bin")), "_all": F.sum("n").over(w)})
    at = lambda q: _least_of(F.min(F.when(100 * F.col("_to") >= q * F.col("_all"), F.col("bin"))))
    ends = run.groupBy(*by, "rule").agg(at(50).alias("_mid"), at(QUANTILE).alias("_hi"), F.max("_all").alias("_n"))
    fence = _bin(F.col("_hi") + FENCE * (F.col("_hi") - F.col("_mid"))).cast("long")
    return ends.where((F.col("_n") >= least) & (F.col("_hi") > F.col("_mid"))).select(*by, "rule", fence.alias("_fence"))


def thresholds(sketch: DataFrame, by: list[str], least: int = LEAST) -> DataFrame:
    """by, rule, _most: the last bin that the rule lets pass in each group; null where it lets all pass.

    A group's own fence, or that of the sketches merged over ever fewer columns of by."""
    out = sketch.select(*by, "rule").distinct()
    for k in range(len(by), -1, -1):
        level = fences(sketch, by[:k], least if k else 1).withColumnRenamed("_fence", f"_fence{k}")
        out = out.join(level, [*by[:k], "rule"], "left")
    return out.select(*by, "rule", F.coalesce(*[F.col(f"_fence{k}") for k in range(len(by), -1, -1)]).alias("_most"))


def quality_rules(docs: DataFrame, text_col: str = "text", by: tuple[str, ...] = ("lang", "source"), keep_text: bool = True) -> DataFrame:
    """docs with COUNTS, base_failed and kept added; one row out per row in.

    A null or empty text counts nothing and fails the base rule. Null groups are a group like others. Ties lie on one
    side of a threshold together; a document equal to the threshold is kept. Repeated rows count as often as they come.
    Texts are counted whole. An empty table gives no rows. Columns of the added names are replaced.
    """
    added = [*COUNTS, "base_failed", "kept"]
    docs, back = set_aside(docs, [text_col, *by], added)
    names = [c for c in docs.columns if keep_text or c != text_col]
    counts = counted(docs, text_col, keep_text=False)
    if not keep_text:
        counts = stored(counts, "quality-counts")  # small beside the texts; read twice below
    keys = [f"_{c}" for c in by]
    good = counts.where(~base_failed()).select(*[F.coalesce(F.col(c).cast("string"), F.lit("\0")).alias(k) for c, k in zip(by, keys)], *COUNTS, "n_lines")
    # one row a group, after sums of sketches
    most = thresholds(stored(sketches(good, keys), "quality-sketch"), keys).groupBy(*keys).pivot("rule", list(RULES)).agg(F.first("_most"))
    most = stored(most.select(*keys, *[F.col(r).alias(f"_most_{r}") for r in RULES]), "quality-thresholds")
    ok = ~F.col("base_failed")
    for r in RULES:
        ok &= F.col(f"_most_{r}").isNull() | (_bin(_value(r)) <= F.col(f"_most_{r}"))
    rows = (counted(docs, text_col) if keep_text else counts).withColumns({k: F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c, k in zip(by, keys)}).withColumn("base_failed", base_failed())
    return back(rows.join(most, keys, "left").withColumn("kept", ok).select(*names, *added))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source")
    return quality_rules(docs, keep_text=False).drop("lang", "source")


_sql_bin = lambda v: f"CASE WHEN {v} < 64 THEN {v} ELSE (length(bin({v})) - 6) * 32 + ({v} >> (length(bin({v})) - 6)) END"
_sql_value = lambda b: f"CASE WHEN {b} < 64 THEN {b} ELSE ({b} - 32 * ({b} // 32 - 1)) << CAST({b} // 32 - 1 AS BIGINT) END"
_sql_values = ", ".join(f"CASE WHEN {b} > 0 THEN 1000 * {a} // {b} ELSE 0 END AS v_{r}" for r, (a, b) in RULES.items())
_sql_rules = "\n  UNION ALL ".join(f"SELECT l, s, '{r}' AS rule, v_{r} AS v FROM vals WHERE NOT base_failed" for r in RULES)
_sql_kept = " AND ".join(f"coalesce({_sql_bin('v_' + r)} <= (SELECT most FROM fence WHERE fence.l = vals.l AND fence.s = vals.s AND rule = '{r}'), true)" for r in RULES)


def _sql_fence(level: str, by: str, least: int) -> str:
    """The fences of the sketches by some columns."""
    return f"""run_{level} AS (SELECT {by} rule, bin, sum(count(*)) OVER (PARTITION BY {by} rule ORDER BY bin) AS upto, sum(count(*)) OVER (PARTITION BY {by} rule) AS n FROM q GROUP BY {by} rule, bin),
ends_{level} AS (SELECT {by} rule, {_sql_value(f"min(bin) FILTER (100 * upto >= {QUANTILE} * n)")} AS hi, {_sql_value("min(bin) FILTER (100 * upto >= 50 * n)")} AS mid, max(n) AS n FROM run_{level} GROUP BY {by} rule),
fence_{level} AS (SELECT {by} rule, {_sql_bin(f"(hi + {FENCE} * (hi - mid))")} AS most FROM ends_{level} WHERE n >= {least} AND hi > mid)"""


#: The same rows in DuckDB SQL; needs unique ids.
SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(lang, chr(1)) AS l, coalesce(source, chr(1)) AS s FROM documents),
w AS (SELECT doc_id, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
p AS (SELECT doc_id, unnest(ws) AS a, generate_subscripts(ws, 1) AS i FROM w),
g AS (SELECT doc_id, i, a || ' ' || lead(a) OVER o || ' ' || lead(a, 2) OVER o AS tri FROM p WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, tri) AS n FROM g WHERE tri IS NOT NULL) WHERE n > 1),
rep AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM r, range(0, 3) t(k) GROUP BY 1),
li AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d),
dup AS (SELECT doc_id, CAST(sum(n) AS BIGINT) AS n_lines, CAST(sum(n - 1) AS BIGINT) AS n
        FROM (SELECT doc_id, line, count(*) AS n FROM li WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY 1, 2) GROUP BY 1),
base AS (
  SELECT d.doc_id, l, s, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, coalesce(dup.n, 0) AS n_dup_lines,
         coalesce(rep.n, 0) AS n_repeat_words, coalesce(dup.n_lines, 0) AS n_lines
  FROM d JOIN w USING (doc_id) LEFT JOIN dup USING (doc_id) LEFT JOIN rep USING (doc_id)
),
vals AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed, {_sql_values} FROM base),
sk AS (
  {_sql_rules}
),
q AS (SELECT l, s, rule, CAST({_sql_bin('v')} AS BIGINT) AS bin FROM sk),
{_sql_fence("group", "l, s,", LEAST)},
{_sql_fence("lang", "l,", LEAST)},
{_sql_fence("all", "", 1)},
fence AS (
  SELECT g.l, g.s, g.rule, coalesce(a.most, b.most, c.most) AS most FROM (SELECT DISTINCT l, s, rule FROM q) g
  LEFT JOIN fence_group a ON a.l = g.l AND a.s = g.s AND a.rule = g.rule LEFT JOIN fence_lang b ON b.l = g.l AND b.rule = g.rule LEFT JOIN fence_all c ON c.rule = g.rule
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND {_sql_kept} AS kept FROM vals
"""
