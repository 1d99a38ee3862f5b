"""Document fingerprints: homomorphic multiset hashes of paragraphs, with DataFrame functions only.

A paragraph (a line) is hashed to a wide vector, and a text's fingerprint is the sum of its paragraphs' vectors: no order of
paragraphs matters, and one is inserted or deleted by adding or subtracting its vector. A vector has two parts:

* EXACT lanes modulo 2^32 of uniform numbers (sha256 of the paragraph, once for each block of 8 lanes). Texts have equal
  fingerprints if they have the same paragraphs as often, and otherwise with a chance of 2^-1024.
* LIKE lanes modulo 2^16: each clause of the paragraph (a piece between . ! ? , ; :) adds 1 or -1 to one lane. Products of
  two fingerprints' lanes estimate how many clauses the texts share (a count sketch), from which likeness() follows.

In hexadecimal digits a fingerprint is EXACT * 8 + LIKE * 4 long, whatever the text's length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .columns import need_whole_ids, set_aside
from .scratch import discard, stored

EXACT, LIKE = 32, 128
#: Lanes that one row of sums holds: 8 columns, for the likeness lanes two to a column (the upper half counts from bit 32).
COLUMNS = 8
_LIKE_ROWS, _EXACT_ROWS = LIKE // (2 * COLUMNS), EXACT // COLUMNS
#: Bytes of text of a block of neighbouring documents, and the most blocks: their bounds are collected.
BLOCK_BYTES, MOST_BLOCKS = 4 << 20, 10_000
_NO_ID = -(2**63)
CLAUSE_ENDS = "[\n.!?,;:]+"


def _number(hex_digits: Column) -> Column:
    return F.conv(hex_digits, 16, 10).cast("long")


def _items(text: Column) -> Column:
    """The paragraphs (once for each block of exact lanes, kind from _LIKE_ROWS on) and clauses (kind -1) of a text."""
    item = lambda kind: lambda s: F.struct(kind.alias("kind"), s.alias("s"))
    blocks = [F.transform(F.split(text, "\n", -1), item(F.lit(_LIKE_ROWS + i))) for i in range(_EXACT_ROWS)]
    return F.concat(F.transform(F.filter(F.transform(F.split(text, CLAUSE_ENDS), lambda s: F.trim(s)), lambda s: s != ""), item(F.lit(-1))), *blocks)


def _sums(rows: DataFrame, keys: list[str], text: str, also: list[str] | None = None, digest: Column | None = None) -> DataFrame:
    """keys and `also` (numbers that the keys determine) -> like (array of LIKE lanes), exact (array of EXACT lanes); and digest, if
    given, an array of its 8 words. Only numbers are aggregated, so that no rows are sorted for it."""
    also, last = also or [], _LIKE_ROWS + _EXACT_ROWS
    parts = _items(F.col(text))
    if digest is not None:
        parts = F.concat(parts, F.when(digest.isNotNull(), F.array(F.struct(F.lit(last).alias("kind"), digest.alias("s")))).otherwise(F.array().cast("array<struct<kind:int,s:string>>")))
    items = rows.select(*keys, *also, F.explode(parts).alias("_i")).select(*keys, *also, "_i.kind", "_i.s")
    clause = F.col("kind") < 0
    hashed = items.withColumn("_x", F.when(clause, F.md5("s")).when(F.col("kind") == last, F.col("s")).otherwise(F.sha2(F.concat(F.col("kind").cast("string"), F.lit(":"), F.col("s")), 256)))
    at = hashed.withColumn("_c", F.when(clause, _number(F.substring("_x", 1, 4)).cast("int")))
    # a clause's hash: its row of sums, its column, which half of it, and the sign
    bit = lambda k: F.shiftright("_c", k).bitwiseAND(F.lit(1)) == 1
    delta = F.when(bit(6), F.lit(1 << 32)).otherwise(F.lit(1)) * F.when(bit(7), F.lit(-1)).otherwise(F.lit(1))
    at = at.withColumns({"_row": F.when(clause, F.col("_c").bitwiseAND(F.lit(7))).otherwise(F.col("kind")), "_at": F.shiftright("_c", 3).bitwiseAND(F.lit(7)), "_d": delta})
    part = lambda j: F.when(clause, F.when(F.col("_at") == j, F.col("_d")).otherwise(F.lit(0))).otherwise(_number(F.substring("_x", 8 * j + 1, 8)))
    summed = at.groupBy(*keys, "_row").agg(*[F.sum(part(j)).alias(f"_s{j}") for j in range(COLUMNS)], *[F.max(c).alias(c) for c in also])
    held = summed.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("_row", F.array(*[f"_s{j}" for j in range(COLUMNS)])))).alias("_m"), *[F.max(c).alias(c) for c in also])
    none = F.array_repeat(F.lit(0).cast("long"), COLUMNS)
    lanes = lambda begin, end: F.flatten(F.transform(F.sequence(F.lit(begin), F.lit(end - 1)), lambda r: F.coalesce(F.try_element_at("_m", r), none)))
    like = lanes(0, _LIKE_ROWS)
    low = F.transform(like, lambda x: _signed(x, 32))
    high = F.zip_with(like, low, lambda x, y: F.shiftright(x - y, 32))
    words = [F.try_element_at("_m", F.lit(last)).alias("digest")] if digest is not None else []
    return held.select(*keys, *also, F.concat(F.transform(low, _lane16), F.transform(high, _lane16)).alias("like"), F.transform(lanes(_LIKE_ROWS, last), lambda x: F.pmod(x, F.lit(1 << 32))).alias("exact"), *words)


def _signed(x: Column, bits: int) -> Column:
    """x modulo 2^bits, from -2^(bits-1)."""
    return F.pmod(x + (1 << (bits - 1)), F.lit(1 << bits)) - (1 << (bits - 1))


def _lane16(x: Column) -> Column:
    return _signed(x, 16)


def _hex(numbers: Column, bits: int) -> Column:
    return F.transform(numbers, lambda x: F.lower(F.lpad(F.hex(F.pmod(x, F.lit(1 << bits))), bits // 4, "0")))


def _as_text(exact: Column, like: Column) -> Column:
    return F.array_join(F.concat(_hex(exact, 32), _hex(like, 16)), "")


def _parts(fingerprint: Column) -> tuple[Column, Column]:
    """The exact and the likeness lanes of a fingerprint's text."""
    exact = F.transform(F.sequence(F.lit(0), F.lit(EXACT - 1)), lambda i: _number(F.substr(fingerprint, i * 8 + 1, F.lit(8))))
    like = F.transform(F.sequence(F.lit(0), F.lit(LIKE - 1)), lambda i: _lane16(_number(F.substr(fingerprint, i * 4 + EXACT * 8 + 1, F.lit(4)))))
    return exact, like


def combined(a: Column | str, b: Column | str, sign: int = 1) -> Column:
    """The fingerprint of a's and b's paragraphs together (sign 1), or of a's without b's (sign -1)."""
    (ea, la), (eb, lb) = (_parts(F.col(x) if isinstance(x, str) else x) for x in (a, b))
    add = lambda x, y: x + sign * y
    return _as_text(F.zip_with(ea, eb, add), F.zip_with(la, lb, add))


def _likeness(same: Column, a: Column, b: Column) -> Column:
    product = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0).cast("long"), lambda s, p: s + p)
    shared, all_of_them = product(a, b), product(a, a) + product(b, b) - product(a, b)
    return F.when(same, F.lit(1.0)).when((all_of_them == 0) | (shared <= 0), F.lit(0.0)).otherwise(F.least(shared.cast("double") / all_of_them.cast("double"), F.lit(1.0)))


def likeness(a: Column | str, b: Column | str) -> Column:
    """From 0 to 1: the estimated share of clauses of either text that both have (as often). Equal fingerprints give 1; the
    estimate's standard deviation is at most some 0.09. Texts that share nothing give values near 0."""
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    return _likeness(a == b, _parts(a)[1], _parts(b)[1])


def fingerprints(docs: DataFrame, text_col: str = "text", keys: list[str] | None = None, name: str = "fingerprints") -> DataFrame:
    """docs with a column fingerprint added (one of that name is replaced); one row out per row in.

    keys name a row; without them rows are numbered first. A null text is an empty one, and an empty text has one empty
    paragraph. Long texts are taken whole. Equal texts, and texts whose lines are the same in any order, get equal values.
    Null keys and rows of one key are kept as rows of their own. An empty table gives no rows.
    """
    rows, back = set_aside(docs, [text_col, *(keys or [])], ["fingerprint"])
    rows = stored(rows.withColumn("_row_id", F.monotonically_increasing_id()), name)
    found = _sums(rows.select("_row_id", F.coalesce(F.col(text_col), F.lit("")).alias("_text")), ["_row_id"], "_text")
    return back(rows.join(found.select("_row_id", _as_text(F.col("exact"), F.col("like")).alias("fingerprint")), "_row_id").drop("_row_id"))


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", name: str = "neighbours") -> DataFrame:
    """_block, _place, id_col, text_col (null: empty), next_text and guest: each document with the text of the one that
    follows in descending order of ids, the first after the last.

    Rows of one id follow each other by a hash of their text; a null id is the smallest. Texts are shuffled once, to blocks of
    neighbouring ids whose bounds come from ranges of (id, hash), so that an id with many texts is cut as well; only rows
    equal in both share a block. A block's first document is also a guest (guest true, no next_text) at the end of the block
    before it. Bounds are at most MOST_BLOCKS pairs of numbers.
    """
    need_whole_ids(docs, id_col)
    spark = docs.sparkSession
    base = docs.select(id_col, F.coalesce(F.col(text_col), F.lit("")).alias("_text")).withColumns({"_id": F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID)), "_h": F.xxhash64("_text")})
    ids = stored(base.select("_id", "_h", F.octet_length("_text").cast("long").alias("_bytes")), f"{name}-ids")
    in_all = ids.agg(F.sum("_bytes")).first()[0] or 0
    blocks = min(MOST_BLOCKS, max(in_all // BLOCK_BYTES, 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    ranges = ids.repartitionByRange(blocks, "_id", "_h").withColumn("_range", F.spark_partition_id())
    # a range's largest pair is the first of it in descending order: its own block's, and the guest of the block before
    firsts = sorted((r._id, r._h) for r in ranges.groupBy("_range").agg(F.max(F.struct("_id", "_h")).alias("k")).select("k.*").distinct().collect())
    discard(ids)
    numbers = lambda xs: F.split(F.lit(",".join(map(str, xs))), ",").cast("array<bigint>") if xs else F.array().cast("array<bigint>")
    bound_ids, bound_hashes = numbers([i for i, _ in firsts]), numbers([h for _, h in firsts])
    below = lambda at: (F.get(bound_ids, at) < F.col("_id")) | ((F.get(bound_ids, at) == F.col("_id")) & (F.get(bound_hashes, at) < F.col("_h")))
    # the number of bounds below the pair, by halving: a block is what lies over one bound and not over the next
    halves = F.array(*[F.lit(1 << step) for step in reversed(range(max(len(firsts), 1).bit_length()))])
    block = F.aggregate(halves, F.lit(0), lambda at, step: F.when(F.coalesce(below(at + step - 1), F.lit(False)), at + step).otherwise(at))
    placed = base.withColumn("_block", block)
    at_home = F.struct(F.col("_block").alias("b"), F.lit(False).alias("guest"))
    visiting = F.struct(F.pmod(F.col("_block") + 1, F.lit(max(len(firsts), 1))).alias("b"), F.lit(True).alias("guest"))
    first_of_block = F.coalesce((F.get(bound_ids, F.col("_block")) == F.col("_id")) & (F.get(bound_hashes, F.col("_block")) == F.col("_h")), F.lit(False))
    both = placed.withColumn("_v", F.explode(F.when(first_of_block, F.array(at_home, visiting)).otherwise(F.array(at_home))))
    rows = both.select(F.col("_v.b").alias("_block"), F.col("_v.guest").alias("guest"), id_col, "_id", "_h", "_text")
    order = Window.partitionBy("_block").orderBy("guest", F.desc("_id"), F.desc("_h"))
    return rows.withColumns({"_place": F.row_number().over(order), "next_text": F.when(~F.col("guest"), F.lead("_text").over(order))}).select("_block", "_place", id_col, F.col("_text").alias(text_col), "next_text", "guest")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = with_next(docs)
    n = F.char_length("text")
    moved = F.floor(n / 3).cast("int")
    rows = rows.withColumns({"n_chars": n.cast("long"), "_edited": F.when(~F.col("guest"), F.concat(F.left("text", n - moved), F.left("next_text", moved)))})
    versions = F.array(F.struct(F.lit(0).alias("version"), F.col("text").alias("t")), F.struct(F.lit(1).alias("version"), F.col("_edited").alias("t")))
    each = rows.select("_block", "_place", F.col("guest").cast("int").alias("guest"), "doc_id", "n_chars", F.explode(versions).alias("_v")).where("_v.t IS NOT NULL")
    each = each.select("_block", "_place", F.col("_v.version").alias("_version"), "guest", "doc_id", "n_chars", F.col("_v.t").alias("_t"))
    also = ["guest", "doc_id", "n_chars"]
    sums = _sums(each, ["_block", "_place", "_version"], "_t", also, F.when(F.col("_version") == 1, F.sha2("_t", 256)))
    # one row a document again: no exchange, since rows lie by block
    of = lambda v: F.max(F.when(F.col("_version") == v, F.struct("exact", "like", "digest")))
    one = sums.groupBy("_block", "_place").agg(of(0).alias("own"), of(1).alias("edited"), *[F.max(c).alias(c) for c in also])
    one = one.withColumn("_next", F.lead("own").over(Window.partitionBy("_block").orderBy("_place"))).where("guest = 0")
    text = lambda c: _as_text(F.col(f"{c}.exact"), F.col(f"{c}.like"))
    near = lambda c: _likeness((F.col("own.exact") == F.col(f"{c}.exact")) & (F.col("own.like") == F.col(f"{c}.like")), F.col("own.like"), F.col(f"{c}.like"))
    digest = F.array_join(_hex(F.col("edited.digest"), 32), "")
    return one.select("doc_id", "n_chars", digest.alias("edited_sha256"), text("own").alias("fingerprint"), text("edited").alias("edited_fingerprint"), near("edited").alias("near_edited"), near("_next").alias("near_next"))


#: The same rows in DuckDB SQL, for unique ids.
SQL = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n, row_number() OVER (ORDER BY doc_id DESC) AS r, count(*) OVER () AS c FROM documents
), e AS (
  SELECT d.*, x.doc_id AS next_id, left(d.text, CAST(d.n - d.n // 3 AS INT)) || left(x.text, CAST(d.n // 3 AS INT)) AS edited
  FROM d JOIN d x ON x.r = d.r % d.c + 1
), v AS (
  SELECT doc_id, 0 AS v, text AS t FROM e UNION ALL SELECT doc_id, 1, edited FROM e
), lines AS (
  SELECT doc_id, v, unnest(string_split(t, chr(10))) AS s FROM v
), clauses AS (
  SELECT doc_id, v, trim(unnest(regexp_split_to_array(t, '{CLAUSE_ENDS}'))) AS s FROM v
), exact AS (
  SELECT doc_id, v, (b - {_LIKE_ROWS}) * 8 + j AS lane, sum(('0x' || substr(h, CAST(8 * j + 1 AS INT), 8))::BIGINT) AS x
  FROM (SELECT doc_id, v, b, sha256(b || ':' || s) AS h FROM lines, range({_LIKE_ROWS}, {_LIKE_ROWS + _EXACT_ROWS}) g(b)), range(0, 8) w(j) GROUP BY 1, 2, 3
), signs AS (
  SELECT doc_id, v, ('0x' || substr(md5(s), 1, 4))::BIGINT AS c FROM clauses WHERE s <> ''
), likes AS (
  SELECT doc_id, v, ((c >> 6) & 1) * {LIKE // 2} + (c & 7) * 8 + ((c >> 3) & 7) AS lane, sum(CASE WHEN (c >> 7) & 1 = 1 THEN -1 ELSE 1 END)::BIGINT AS x FROM signs GROUP BY 1, 2, 3
), full_likes AS (
  SELECT v.doc_id, v.v, k.lane, (coalesce(x, 0) + 32768) % 65536 - 32768 AS x
  FROM v CROSS JOIN range(0, {LIKE}) k(lane) LEFT JOIN likes l ON l.doc_id = v.doc_id AND l.v = v.v AND l.lane = k.lane
), texts AS (
  SELECT doc_id, v, string_agg(lower(printf('%08x', CAST(x % 4294967296 AS BIGINT))), '' ORDER BY lane) AS a FROM exact GROUP BY 1, 2
), like_texts AS (
  SELECT doc_id, v, string_agg(printf('%04x', CAST((x + 65536) % 65536 AS BIGINT)), '' ORDER BY lane) AS b, list(x ORDER BY lane) AS lanes FROM full_likes GROUP BY 1, 2
), f AS (
  SELECT doc_id, v, a || b AS fp, lanes FROM texts JOIN like_texts USING (doc_id, v)
), pairs AS (
  SELECT e.doc_id, e.n, sha256(e.edited) AS edited_sha256, o.fp AS own, x.fp AS edited, y.fp AS nxt,
         list_sum(list_transform(range(1, {LIKE + 1}), lambda i: o.lanes[i] * o.lanes[i])) AS oo,
         list_sum(list_transform(range(1, {LIKE + 1}), lambda i: x.lanes[i] * x.lanes[i])) AS xx, list_sum(list_transform(range(1, {LIKE + 1}), lambda i: o.lanes[i] * x.lanes[i])) AS ox,
         list_sum(list_transform(range(1, {LIKE + 1}), lambda i: y.lanes[i] * y.lanes[i])) AS yy, list_sum(list_transform(range(1, {LIKE + 1}), lambda i: o.lanes[i] * y.lanes[i])) AS oy
  FROM e JOIN f o ON o.doc_id = e.doc_id AND o.v = 0 JOIN f x ON x.doc_id = e.doc_id AND x.v = 1 JOIN f y ON y.doc_id = e.next_id AND y.v = 0
)
SELECT doc_id, n AS n_chars, edited_sha256, own AS fingerprint, edited AS edited_fingerprint,
       CASE WHEN own = edited THEN 1.0::DOUBLE WHEN oo + xx - ox = 0 OR ox <= 0 THEN 0.0::DOUBLE ELSE least(CAST(ox AS DOUBLE) / CAST(oo + xx - ox AS DOUBLE), 1.0::DOUBLE) END AS near_edited,
       CASE WHEN own = nxt THEN 1.0::DOUBLE WHEN oo + yy - oy = 0 OR oy <= 0 THEN 0.0::DOUBLE ELSE least(CAST(oy AS DOUBLE) / CAST(oo + yy - oy AS DOUBLE), 1.0::DOUBLE) END AS near_next
FROM pairs
"""
