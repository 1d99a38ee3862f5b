"""Substring dedup by De Bruijn compaction.

Windows of k words are edges of a De Bruijn graph. Edges are dealt by their minimizer (see repeats), and consecutive
ones with one minimizer are compacted to a path where they lie, so that no edge is shuffled by itself. Joins compact the
rest: equal paths of several documents are one, joined with the first place that has it; a path whose minimizer has no
other path is nonbranching and repeated as a whole in every later document. Where a minimizer branches, the paths' first
places, and all places in documents of the first id, are opened to edges, and the edges joined with theirs. Neighbouring
paths of a document whose sources continue each other too are then compacted to one span with one source (document and
first word). Long spans are verified at their source's coordinates: the source's words, in chunks by its own word numbers,
are digested in its document and joined with the spans; a span of other words is not removed.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import repeats as R
from .columns import set_aside
from .prefilter import flagged, maybe_in
from .scratch import discard, small_batches, stored
from .textblock import ragged, text_blocks

WORDS = 13
KIND = R.Kind(True, WORDS, 4)
#: Words of a chunk. Spans are verified by the chunks that lie in them: those of 31 words and more have one at least.
CHUNK = 16


def joined_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words of a block with one space after each, and where each begins there (and where the next would)."""
    size = ends - starts + 1
    out = np.append(data, np.uint8(32))[ragged(starts, size)]
    stop = np.cumsum(size)
    out[stop - 1] = 32
    return out, np.concatenate([[0], stop])


def _digests(data, off, starts, ends, bound) -> list[str]:
    line, at = joined_words(data, starts, ends)
    line, at = line.tobytes(), at[bound].tolist()
    return [R.sha(line[a : max(a, b - 1)]) for a, b in zip(at[:-1], at[1:], strict=True)]


def chunk_digest(words: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(words, digest_size=8).digest(), "little", signed=True)


def glued(spans: DataFrame) -> DataFrame:
    """Runs of windows (_id, _row, start, count, from) of a document, those that go on in their source too made one.

    `from` is the source's place of the first window: _id, _row, start."""
    w = Window.partitionBy(*R.KEY).orderBy("start", "count")
    place = F.struct("from._id", "from._row", (F.col("from.start") - F.col("start")).alias("shift"))
    new = (place != F.lag(place).over(w)) | (F.col("start") > F.lag(F.col("start") + F.col("count")).over(w))
    runs = spans.withColumn("_run", F.sum(F.coalesce(new, F.lit(True)).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    out = runs.groupBy(*R.KEY, "_run").agg(F.min("start").alias("start"), F.max(F.col("start") + F.col("count")).alias("_stop"), F.min_by("from", F.struct("start", "count")).alias("from"))
    return out.select(*R.KEY, "start", (F.col("_stop") - F.col("start")).alias("count"), "from")


def source_marks(found: DataFrame, sources: DataFrame, kind: R.Kind, chunk: int) -> DataFrame:
    """_id, _row, marks: a digest of every whole chunk of words of the given documents."""

    def run(batches):
        for part, data, off in text_blocks(batches, "_text", R.BLOCK):
            starts, ends, bound = kind.units(data, off)
            line, at = joined_words(data, starts, ends)
            line = line.tobytes()
            marks = [[chunk_digest(line[at[j] : at[j + chunk]]) for j in range(a, b - chunk + 1, chunk)] for a, b in zip(bound[:-1].tolist(), bound[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(marks, pa.list_(pa.int64()))], names=[*R.KEY, "marks"])

    asked = R.texts_with(found, sources, "_row").select(*R.KEY, "_text")
    return asked.mapInArrow(run, "_id long, _row long, marks array<long>")


def repeated_spans(found: DataFrame, kind: R.Kind, name: str, chunk: int = CHUNK) -> DataFrame:
    """_id, _row, _spans (start, count, first, marks): runs of windows whose words also start in a document of smaller id,
    and the digests of the source's chunks in them, the first of which begins at word `first`; stored."""
    places = R.occurrences(found)
    paths = R.variants(places, name)
    source = paths.where("n > 1").select("a", "h1", "h2", F.col("first").alias("from"))
    again = places.join(source, ["a", "h1", "h2"]).where(F.struct(*R.KEY, "start") > F.col("from"))
    again = stored(again.select("a", "count", "at", *R.KEY, "start", "from", (F.col("_id") > F.col("from._id")).alias("_later")), f"{name}-again")
    whole = again.where("_later").select(*R.KEY, "start", "count", "from")
    # a path's other places in documents of its first id are no copies as a whole: they are opened like the first
    first = R.branching(paths, name, again.where("NOT _later").drop("_later", "from"))
    discard(paths)
    opened = R.windows_of(found, first, kind, name)
    discard(first)
    edges = stored(opened.groupBy("e1", "e2").agg(F.min(F.struct(*R.KEY, "start")).alias("from"), F.max("_id").alias("_to")).where(F.col("from._id") < F.col("_to")).select("e1", "e2", "from"), f"{name}-edges")
    single = maybe_in(opened, edges, "e1").join(edges, ["e1", "e2"]).where(F.col("_id") > F.col("from._id")).select(*R.KEY, "start", F.lit(1).alias("count"), "from")
    runs = stored(glued(whole.unionByName(single)), f"{name}-runs")
    discard(again, opened, edges)
    n = F.col("count") + kind.k - 1  # words of a span
    head = F.ceil(F.col("from.start") / chunk).cast("int")  # the source's first chunk in the span
    chunks = F.floor((F.col("from.start") + n) / chunk).cast("int") - head
    runs_ = runs.withColumns({"_head": head, "_chunks": chunks})
    sources = stored(runs_.where("_chunks > 0").select("from._id", "from._row").distinct(), f"{name}-sources")
    marks = stored(source_marks(found, sources, kind, chunk).select(F.col("_id").alias("_sid"), F.col("_row").alias("_srow"), "marks"), f"{name}-marks")
    known = runs_.join(marks, (F.col("from._id") == F.col("_sid")) & (F.col("from._row") == F.col("_srow")), "left")
    mine = F.when((F.col("_chunks") > 0) & F.col("marks").isNotNull(), F.slice("marks", F.col("_head") + 1, F.greatest("_chunks", F.lit(0))))
    span = F.struct("start", "count", (F.col("start") + F.col("_head") * chunk - F.col("from.start")).cast("int").alias("first"), F.coalesce(mine, F.array().cast("array<long>")).alias("marks"))
    out = stored(known.select(*R.KEY, span.alias("_s")).groupBy(*R.KEY).agg(F.collect_list("_s").alias("_spans")), f"{name}-spans")
    discard(runs, sources, marks)
    return out


def _verified(line: bytes, at: np.ndarray, first: np.ndarray, lists: pa.ListArray, chunk: int) -> np.ndarray:
    """Which spans have the words of their source: `first` is the number of the first whole chunk's first word."""
    size = lists.value_lengths().to_numpy()
    word = np.repeat(first, size) + chunk * ragged(np.zeros(len(size), np.int64), size)
    own = [chunk_digest(line[a:b]) for a, b in zip(at[word].tolist(), at[word + chunk].tolist(), strict=True)]
    wrong = np.flatnonzero(np.array(own, np.int64) != lists.flatten().to_numpy())
    out = np.ones(len(size), bool)
    out[np.repeat(np.arange(len(size)), size)[wrong]] = False
    return out


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", kind: R.Kind = KIND, keep_text: bool = True, name: str = "substring") -> DataFrame:
    """docs with its text less the repeated words, and n_words, n_removed (long), kept_sha256 added; one row out per row in.

    A kept word keeps the white space before it; kept_sha256 is that of the kept words joined by one space. A null text
    has no words and becomes empty. A null id is the smallest; ids that are no whole numbers raise TypeError. Rows of one
    id never remove each other's words; equal rows have equal results. Texts shorter than a window lose nothing; long
    ones are treated whole. An empty table gives no rows. With keep_text False the text is left out. Columns of the added
    names are replaced.
    """
    added = ["n_words", "n_removed", "kept_sha256"]
    docs, back = set_aside(docs, [id_col, text_col], added)
    names = [c for c in docs.columns if c != text_col]
    found = R.candidates(R.prepared(docs, id_col, text_col).drop(text_col), kind, keep_text, name, _digests)
    spans = repeated_spans(found, kind, name)
    rows = flagged(found.drop("paths"), spans, "_row", "_maybe")
    some = rows.where("_maybe").join(spans, R.KEY, "left")
    schema = T.StructType([found.schema[c] for c in names] + [T.StructField("_text", T.StringType()), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept_sha256", T.StringType())])

    def run(batches):
        for part, data, off in text_blocks(batches, "_text", R.BLOCK):
            starts, ends, bound = kind.units(data, off)
            line, at = joined_words(data, starts, ends)
            lists = part.column(part.schema.get_field_index("_spans"))
            flat, per = lists.flatten(), lists.value_lengths().fill_null(0).to_numpy()
            base = np.repeat(bound[:-1], per)
            begin, count, first = (base + flat.field(c).to_numpy().astype(np.int64) for c in ("start", "count", "first"))
            good = _verified(line.tobytes(), at, first, flat.field("marks"), CHUNK)
            gone = R.covered(len(starts), begin[good], (count - base)[good], kind.k)
            size = ends - starts + 1
            kept, kept_at = line[np.repeat(~gone, size)].tobytes(), np.concatenate([[0], np.cumsum(np.where(gone, 0, size))])[bound].tolist()
            removed = np.diff(np.concatenate([[0], np.cumsum(gone)])[bound])
            given = part.column(part.schema.get_field_index("kept_sha256")).to_pylist()
            shas = [R.sha(kept[a : max(a, b - 1)]) if n else sha for a, b, n, sha in zip(kept_at[:-1], kept_at[1:], removed.tolist(), given, strict=True)]
            texts = part.column(part.schema.get_field_index("_text"))
            if keep_text:
                before = np.append(0, ends[:-1])  # a word has the white space before it, but not that of the text before
                before[bound[:-1][np.diff(bound) > 0]] = off[:-1][np.diff(bound) > 0]
                stay = data[ragged(before[~gone], (ends - before)[~gone])].tobytes()
                stay_at = np.concatenate([[0], np.cumsum(np.where(gone, 0, ends - before))])[bound].tolist()
                whole = data.tobytes()
                texts = pa.array([stay[a:b] if n else whole[x:y] for a, b, n, x, y in zip(stay_at[:-1], stay_at[1:], removed.tolist(), off[:-1].tolist(), off[1:].tolist(), strict=True)], pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([part.column(part.schema.get_field_index(c)) for c in names] + [texts, part.column(part.schema.get_field_index("n_units")), pa.array(removed.astype(np.int64)), pa.array(shas, pa.string())], names=schema.names)

    cut = some.mapInArrow(run, schema)
    same = rows.where("NOT _maybe").select(*names, "_text", F.col("n_units").alias("n_words"), F.lit(0).cast("long").alias("n_removed"), "kept_sha256")
    out = cut.unionByName(same)
    return back(out.select(*[F.col("_text").alias(c) if c == text_col else c for c in docs.columns if keep_text or c != text_col], *added))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return substring_dedup(docs, keep_text=False)


#: The same rows in DuckDB SQL; needs unique ids.
SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
g AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + 12], ' ')) AS k FROM w, unnest(range(1, len(ws) - 11)) t(i)),
f AS (SELECT k, min(doc_id) AS first FROM g GROUP BY k HAVING min(doc_id) < max(doc_id)),
r AS (SELECT DISTINCT doc_id, i + j AS i FROM g JOIN f USING (k), range(0, 13) t(j) WHERE doc_id > first),
p AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w),
m AS (SELECT p.doc_id, p.i, word, r.i IS NOT NULL AS gone FROM p LEFT JOIN r ON r.doc_id = p.doc_id AND r.i = p.i)
SELECT w.doc_id, CAST(any_value(len(ws)) AS BIGINT) AS n_words, count(*) FILTER (gone) AS n_removed,
       sha256(coalesce(string_agg(word, ' ' ORDER BY m.i) FILTER (NOT gone), '')) AS kept_sha256
FROM w LEFT JOIN m USING (doc_id) GROUP BY w.doc_id
"""
