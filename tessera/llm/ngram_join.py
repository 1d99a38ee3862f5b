"""N-gram Jaccard join by a blocked sparse matrix product.

Rows are documents, columns n-grams (word shingles). Equal rows are one class. Two rows that link share a bound number
of columns, which follows from their sizes, among the first columns of each in any common order; so rows whose first
columns are no other row's are left out, and the rest are clustered by what they share there. Some rows of each cluster,
its pivots, are multiplied with all others first: rows that link with the first pivot, or with one that links with such
a row, are joined by that, and need no product among themselves. What is left is cut into tiles of two blocks of rows,
one of them of rows that aren't joined; a tile's overlap counts are accumulated over blocks of columns, and pairs that
can no longer reach the overlap that their sizes ask for are discarded. A tile returns a spanning forest of its links.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .columns import set_aside
from .components import components
from .prefilter import maybe_in
from .repeats import KEY, NO_ID, prepared
from .scratch import discard, stored
from .textblock import LOWER, hash_spans, mix, ragged, text_blocks, windows, words

SHINGLE, PERCENT = 4, 85
#: Columns of so many rows come after the others in the common order, by the power of two of their rows.
LATE_ROWS = 8
#: Slots of the map of those powers, a byte each: so many a column, 32 MB at most; bytes of it that are made at once.
SLOTS, MOST_SLOTS, CHUNK = 16, 1 << 25, 1 << 12
#: Rows that meet in more shared columns than this are clustered without counting pairs.
LIGHT = 32
#: Pivots of a cluster; rows and cells of a block of a tile at most; columns in a block of the product.
PIVOTS, BLOCK, CELLS, COLUMNS = 2, 1024, 1 << 20, 2048


def need(n: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """The least overlap of a set of n that links with another, whatever its size."""
    return (percent * n + 99) // 100


def extra(n):
    """How many common columns are asked for among the first ones; one more column each is looked at."""
    return 1 + n // 20


def block_shingles(data: np.ndarray, off: np.ndarray, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles (hashes, ascending) of each text of a block, end to end, and the bounds of the texts."""
    data = LOWER[data]
    starts, ends, first = words(data, off)
    hashes = hash_spans(data, starts, ends)
    key, at = windows(hashes, first, width)
    text = np.searchsorted(first, at, "right") - 1
    count = np.diff(first)
    few = np.flatnonzero((count > 0) & (count < width))
    if len(few):  # the whole sequence is the one shingle
        whole = np.zeros(len(few), np.uint64)
        for k in range(width - 1):
            has = count[few] > k
            whole[has] = mix(whole[has] * np.uint64(3) + hashes[first[few[has]] + k] + np.uint64(k + 1))
        key, text = np.append(key, whole), np.append(text, few)
    order = np.lexsort((key, text))
    key, text = key[order], text[order]
    if len(key):
        one = np.append(True, (key[1:] != key[:-1]) | (text[1:] != text[:-1]))
        key, text = key[one], text[one]
    return key, np.searchsorted(text, np.arange(len(off)))


def _sets(docs: DataFrame, width: int) -> DataFrame:
    """_id, _row, n, s1, s2: size and two digests of each document's set."""

    def run(batches):
        for part, data, off in text_blocks(batches, "_text"):
            key, bound = block_shingles(data, off, width)
            sums = [np.concatenate([[np.uint64(0)], np.cumsum(mix(key ^ np.uint64(c)), dtype=np.uint64)]) for c in (0x5851F42D4C957F2D, 0x14057B7EF767814F)]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(np.diff(bound)), *[pa.array((s[bound[1:]] - s[bound[:-1]]).view(np.int64)) for s in sums]], names=["_id", "_row", "n", "s1", "s2"])

    return docs.select("_id", "_row", "_text").mapInArrow(run, "_id long, _row long, n long, s1 long, s2 long")


def _first_columns(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """_id, _row, n, c: the first columns of each document in the order of their hashes."""

    def run(batches):
        for part, data, off in text_blocks(batches, "_text"):
            key, bound = block_shingles(data, off, width)
            n = np.diff(bound)
            take = np.minimum(n, n - need(n, percent) + extra(n))
            at = ragged(bound[:-1], take)
            doc = pa.array(np.repeat(np.arange(len(n)), take))
            yield pa.RecordBatch.from_arrays([part.column(0).take(doc), part.column(1).take(doc), pa.array(np.repeat(n, take).astype(np.int32)), pa.array(key[at].view(np.int64))], names=[*KEY, "n", "c"])

    return docs.select(*KEY, "_text").mapInArrow(run, "_id long, _row long, n int, c long")


def _class_sets(docs: DataFrame, width: int) -> DataFrame:
    """cid, n, cells: the whole sets of the given rows (cid, _text)."""

    def run(batches):
        for part, data, off in text_blocks(batches, "_text"):
            key, bound = block_shingles(data, off, width)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.diff(bound).astype(np.int32)), pa.ListArray.from_arrays(pa.array(bound.astype(np.int32)), pa.array(key.view(np.int64)))], names=["cid", "n", "cells"])

    return docs.select("cid", "_text").mapInArrow(run, "cid long, n int, cells array<long>")


def column_levels(sets: DataFrame, name: str) -> np.ndarray:
    """The powers of two of the columns' rows by the lowest bits of the columns, 0 below LATE_ROWS: a map of bounded size, whatever
    the number of columns. Columns of one slot have the larger power; that changes the common order, not the links.

    All columns of the rows are counted, since any of them can come among the first ones once others are put last."""
    key = F.explode("cells").alias("c")
    often = sets.select(key).select(F.col("c").bitwiseAND(F.lit((1 << 31) - 1)).cast("int").alias("c")).groupBy("c").agg(F.count("*").alias("rows"))
    often = stored(often.where(F.col("rows") >= LATE_ROWS).select("c", F.floor(F.log2("rows")).cast("int").alias("level")), f"{name}-often")
    slots = min(MOST_SLOTS, 1 << max(16, (SLOTS * often.count()).bit_length()))
    slot = F.col("c").bitwiseAND(F.lit(slots - 1))

    def chunk(pdf: pd.DataFrame) -> pd.DataFrame:
        levels = np.zeros(CHUNK, np.uint8)
        np.maximum.at(levels, pdf["at"].to_numpy(), pdf["level"].to_numpy().astype(np.uint8))
        return pd.DataFrame({"chunk": pdf["chunk"].iloc[:1], "levels": [levels.tobytes()]})

    parts = often.select(F.floor(slot / CHUNK).cast("int").alias("chunk"), F.pmod(slot, F.lit(CHUNK)).alias("at"), "level")
    out = np.zeros(slots, np.uint8)
    for row in parts.groupBy("chunk").applyInPandas(chunk, "chunk int, levels binary").collect():
        out[row["chunk"] * CHUNK : (row["chunk"] + 1) * CHUNK] = np.frombuffer(row["levels"], np.uint8)
    discard(often)
    return out


def _ordered_columns(sets: DataFrame, levels: np.ndarray, percent: int) -> DataFrame:
    """cid, n, c: the first columns of each class, by their levels and then by their hashes."""
    sent = sets.sparkSession.sparkContext.broadcast(levels)

    def run(batches):
        level = sent.value
        for part in batches:
            out = [[], [], []]
            for cid, n, cells in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(2), strict=True):
                c = cells.values.to_numpy()
                c = c[np.argsort(level[c & (len(level) - 1)], kind="stable")]
                c = c[: n - int(need(np.int64(n), percent)) + extra(n)]
                out[0].append(np.full(len(c), cid))
                out[1].append(np.full(len(c), n, np.int32))
                out[2].append(c)
            flat = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in out]
            yield pa.RecordBatch.from_arrays([pa.array(flat[0].astype(np.int64)), pa.array(flat[1].astype(np.int32)), pa.array(flat[2].astype(np.int64))], names=["cid", "n", "c"])

    return sets.mapInArrow(run, "cid long, n int, c long")


def overlaps(cells_a: list[np.ndarray], cells_b: list[np.ndarray], percent: int = PERCENT, columns: int = COLUMNS) -> np.ndarray:
    """Which pairs of rows link: overlap counts by a product over blocks of shared columns, given up where hopeless."""
    size_a, size_b = (np.fromiter(map(len, c), np.int64, len(c)) for c in (cells_a, cells_b))
    live = (100 * size_a[:, None] >= percent * size_b[None, :]) & (100 * size_b[None, :] >= percent * size_a[:, None])
    if not live.any():
        return live
    least = -(-percent * (size_a[:, None] + size_b[None, :]) // (100 + percent))  # 100 o >= percent (a + b - o)
    flat_a, flat_b = np.concatenate(cells_a), np.concatenate(cells_b)
    shared = np.intersect1d(flat_a, flat_b)

    def placed(flat, sizes):
        at = np.minimum(np.searchsorted(shared, flat), max(len(shared) - 1, 0))
        hit = shared[at] == flat if len(shared) else np.zeros(len(flat), bool)
        return np.repeat(np.arange(len(sizes)), sizes)[hit], at[hit]

    (row_a, col_a), (row_b, col_b) = placed(flat_a, size_a), placed(flat_b, size_b)
    left_a, left_b = np.bincount(row_a, minlength=len(size_a)), np.bincount(row_b, minlength=len(size_b))
    total = np.zeros(live.shape, np.float32)
    for lo in range(0, len(shared), columns):
        live &= total + np.minimum(left_a[:, None], left_b[None, :]) >= least
        rows, cols = np.flatnonzero(live.any(1)), np.flatnonzero(live.any(0))
        if not len(rows):
            break
        parts = []
        for row, col, keep, left in ((row_a, col_a, rows, left_a), (row_b, col_b, cols, left_b)):
            here = (col >= lo) & (col < lo + columns)
            dense = np.zeros((len(left), min(columns, len(shared) - lo)), np.float32)
            dense[row[here], col[here] - lo] = 1
            left -= np.bincount(row[here], minlength=len(left))
            parts.append(dense[keep])
        total[np.ix_(rows, cols)] += parts[0] @ parts[1].T
    return live & (total >= least)


def forest(link: np.ndarray, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the links between two lists of nodes."""
    out, row_todo, col_todo = [], np.ones(len(left), bool), np.ones(len(right), bool)
    for seed in np.flatnonzero(link.any(1)):
        if not row_todo[seed]:
            continue
        row_todo[seed] = False
        front = np.array([seed])
        while len(front):
            cols = np.flatnonzero(link[front].any(0) & col_todo)
            col_todo[cols] = False
            rows = np.flatnonzero(link[:, cols].any(1) & row_todo) if len(cols) else cols
            row_todo[rows] = False
            out += [(int(right[c]), int(left[seed])) for c in cols] + [(int(left[r]), int(left[seed])) for r in rows]
            front = rows
    return [e for e in out if e[0] != e[1]]


def _tile(pdf: pd.DataFrame, percent: int) -> pd.DataFrame:
    one, two = pdf[pdf.part == pdf.ti], pdf[pdf.part == pdf.tj]
    edges = forest(overlaps([*one.cells], [*two.cells], percent), one.cid.to_numpy(), two.cid.to_numpy()) if len(one) and len(two) else []
    return pd.DataFrame(edges, columns=["u", "v"], dtype="int64")


def class_links(sets: DataFrame, percent: int, name: str) -> DataFrame:
    """u, v: links between classes (cid, n, cells) that join every component of links."""
    cols = stored(_ordered_columns(sets, column_levels(sets, name), percent), f"{name}-columns")
    counts = stored(cols.groupBy("c").agg(F.count("*").alias("rows"), F.min("cid").alias("head")).where("rows > 1"), f"{name}-counts")
    shared = stored(cols.join(counts, "c"), f"{name}-shared")
    discard(cols, counts)
    light = shared.where(F.col("rows") <= LIGHT)
    a, b = (light.select("c", F.col("cid").alias(f"{x}"), F.col("n").alias(f"n{x}")) for x in "ab")
    pairs = a.join(b, "c").where("a < b").where(f"100 * least(na, nb) >= {percent} * greatest(na, nb)").groupBy("a", "b", "na", "nb").agg(F.count("*").alias("both"))
    pairs = pairs.where(F.col("both") >= 1 + F.floor(F.least("na", "nb") / 20)).select(F.col("b").alias("u"), F.col("a").alias("v"))
    heavy = shared.where((F.col("rows") > LIGHT) & (F.col("cid") != F.col("head"))).select(F.col("cid").alias("u"), F.col("head").alias("v"))
    near = components(pairs.unionByName(heavy), f"{name}-clusters")
    members = near.select(F.col("node").alias("cid"), F.col("root").alias("cluster")).unionByName(near.select(F.col("root").alias("cid"), F.col("root").alias("cluster")).distinct())
    common = shared.groupBy("cid").agg(F.floor(1000 * F.count("*") / F.max("n")).alias("common"))  # of a row's first columns; most in what others were made from
    held = stored(members.join(common, "cid").join(sets, "cid"), f"{name}-members")
    discard(shared)
    links, state = pivot_links(held, percent, name)
    tiles = stored(held.join(dealt(state, name), ["cluster", "cid"]).select("cluster", "ti", "tj", "part", "cid", "cells"), f"{name}-tiles")
    return tiles.groupBy("cluster", "ti", "tj").applyInPandas(lambda pdf: _tile(pdf, percent), "u long, v long").unionByName(links)


def pivot_links(held: DataFrame, percent: int, name: str) -> tuple[DataFrame, DataFrame]:
    """Of clusters' rows (cid, cluster, n, cells, common): their links with pivots (u, v), and the rows but the pivots, which have
    been compared with all (cid, cluster, n, common, joined). Joined rows are of one component, those of the first pivot."""
    links, state = None, None
    for _ in range(PIVOTS):
        pivot = (held if state is None else state.where("NOT joined")).groupBy("cluster").agg(F.max_by("cid", F.struct("common", -F.col("cid"))).alias("pivot"))
        cells = stored(held.join(pivot, "cluster").where("cid = pivot").select("cluster", "pivot", F.col("n").alias("_n"), F.col("cells").alias("_cells")), f"{name}-pivot")
        both = F.size(F.array_intersect("cells", "_cells"))
        fits = (100 * F.least("n", "_n") >= percent * F.greatest("n", "_n")) & (100 * both >= percent * (F.col("n") + F.col("_n") - both))
        tested = stored(held.join(cells, "cluster").where("cid <> pivot").select("cid", "cluster", "n", "common", "pivot", fits.alias("fits")), f"{name}-tested")
        found = tested.where("fits").select(F.col("cid").alias("u"), F.col("pivot").alias("v"))
        if state is None:
            links, state = found, tested.select("cid", "cluster", "n", "common", F.col("fits").alias("joined"))
            continue
        links = links.unionByName(found)
        left = state.join(cells.select("cluster", F.col("pivot").alias("cid")), ["cluster", "cid"], "left_anti")
        both = left.join(tested.select("cluster", "cid", "fits"), ["cluster", "cid"], "left")
        meets = both.where("joined AND fits").select("cluster", F.lit(True).alias("_meets")).distinct()
        state = stored(both.join(meets, "cluster", "left").select("cid", "cluster", "n", "common", F.expr("joined OR (coalesce(fits, false) AND coalesce(_meets, false))").alias("joined")), f"{name}-state")
    return links, state


def dealt(state: DataFrame, name: str) -> DataFrame:
    """cluster, cid, part, ti, tj: the tiles of each row. Blocks of rows that aren't joined are numbered from 0 in a
    cluster, and meet each other and the blocks of joined rows, which are numbered from -1 downwards."""
    size = lambda some: F.ceil(F.greatest(F.count(F.when(some, 1)) / BLOCK, F.sum(F.when(some, F.col("n")).otherwise(0)) / CELLS)).cast("int")
    joined = F.col("joined")
    blocks = stored(state.groupBy("cluster").agg(size(~joined).alias("a"), size(joined).alias("b")).where("a > 0"), f"{name}-blocks")
    number = F.when(joined, -1 - F.pmod(F.xxhash64("cid"), F.greatest("b", F.lit(1)))).otherwise(F.pmod(F.xxhash64("cid"), F.col("a")))
    own = F.sequence(F.lit(0), F.col("a") - 1)
    others = F.when(~joined & (F.col("b") > 0), F.concat(own, F.sequence(F.lit(-1), -F.col("b"), F.lit(-1)))).otherwise(own)
    placed = state.join(blocks, "cluster").select("cluster", "cid", number.cast("int").alias("part"), F.explode(others).alias("_o"))
    return placed.select("cluster", "cid", "part", F.least("part", "_o").alias("ti"), F.greatest("part", "_o").alias("tj"))


def ngram_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE, percent: int = PERCENT, name: str = "ngrams") -> DataFrame:
    """docs, without the text, with n_shingles and component_id added; one row out per row in.

    Two documents link when 100 * intersection >= percent * union of their sets of lower-cased word shingles; a document
    of fewer words has their whole sequence as its one shingle, one without words (or a null text) no links. The
    component is named by its smallest id. A null id is the smallest; its component is null; ids that are no whole numbers
    raise TypeError. Rows of one id are one document, in one component. Ties, long texts and sizes need no care: links are
    counted exactly over whole texts. An empty table gives no rows. Columns of the added names are replaced.
    """
    docs, back = set_aside(docs, [id_col, text_col], ["n_shingles", "component_id"])
    base = prepared(docs, id_col, text_col)
    each = stored(_sets(base, width), f"{name}-rows")
    rows = each.dropDuplicates(KEY)
    classes = stored(rows.where("n > 0").groupBy("n", "s1", "s2").agg(F.min(F.struct(*KEY)).alias("_r")).select("n", "s1", "s2", F.col("_r._id").alias("cid"), "_r.*"), f"{name}-classes")
    first = _first_columns(base, width, percent)
    again = stored(first.groupBy("c").agg(F.count("*").alias("rows")).where("rows > 1"), f"{name}-again")
    enough = 1 + F.floor(F.ceil(F.col("n") * percent / 100) / 20)
    alive = maybe_in(first, again, "c").join(again.select("c"), "c").groupBy(*KEY, "n").agg(F.count("*").alias("hits")).where(F.col("hits") >= enough).select(*KEY)
    wanted = stored(classes.select(*KEY, "cid").join(alive.distinct(), KEY, "left_semi"), f"{name}-alive")
    discard(again)
    texts = maybe_in(base.select(*KEY, "_text"), wanted, "_row").join(wanted, KEY).dropDuplicates(KEY)
    sets = stored(_class_sets(texts, width), f"{name}-sets")
    roots = stored(components(class_links(sets, percent, name), name), f"{name}-roots")
    discard(sets, wanted)
    named = stored(classes.drop(*KEY).join(roots, F.col("cid") == F.col("node"), "left").select("n", "s1", "s2", F.coalesce("root", "cid").alias("component")), f"{name}-named")
    found = rows.join(named, ["n", "s1", "s2"], "left").select(*KEY, F.col("n").alias("n_shingles"), F.coalesce("component", "_id").alias("_component"))
    found = stored(found, f"{name}-found")
    discard(each, classes, roots, named)
    out = base.drop("_text", text_col).join(found, KEY)
    return back(out.withColumn("component_id", F.when(F.col("_component") != NO_ID, F.col("_component"))).select(*[c for c in docs.columns if c != text_col], "n_shingles", "component_id"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return ngram_components(docs)


#: The same rows in DuckDB SQL; needs unique ids.
SQL = rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + {SHINGLE - 1}], ' ') AS k FROM w, unnest(range(1, greatest(len(ws) - {SHINGLE - 2}, 2))) t(i) WHERE len(ws) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
o AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o FROM s a JOIN s b USING (k) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM o JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * o >= {PERCENT} * (nx.n + ny.n - o)),
r AS (SELECT doc_id AS a, doc_id AS b FROM w UNION SELECT r.a, l.y FROM r JOIN l ON l.x = r.b)
SELECT w.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.b) AS component_id
FROM w JOIN r ON r.a = w.doc_id LEFT JOIN n ON n.doc_id = w.doc_id GROUP BY w.doc_id
"""
