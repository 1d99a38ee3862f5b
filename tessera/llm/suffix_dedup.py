"""Suffix-array dedup on a run-length index.

Paths of bytes that share an anchor (see repeats) are the only strings that can hold equal windows. Fragments that are
equal as a whole are one, their first occurrence. The fragments of an anchor, first occurrences first, form a bucket;
a task indexes buckets of some hundred kilobytes at a time: it builds the Burrows-Wheeler transform of the fragments and
keeps the sampled positions at the ends of its runs with what neighbours have in common there. Each fragment is then
streamed through the index: a position's matching statistics against its neighbours in suffix order follow from the last
sample before it, and matches of a window's length with an earlier position are marked.

CAP bounds what a task indexes at once by its memory. The paths of an anchor with more than that (the edge of a passage
that very many texts share) are cut into pieces of PIECE windows by the anchor's place, each keyed by the bytes that all
its windows share. Most pieces are equal to others as a whole, or alone; the others are indexed by their key. Pieces of
which one key has more than CAP, too, are opened to windows, PIECE each at most, joined by 128 bits. So an anchor's rows
grow with its paths, however many there are, and no task gets an unbounded group.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import repeats as R
from .columns import set_aside
from .prefilter import flagged, maybe_in
from .scratch import discard, small_batches, stored
from .textblock import ragged, text_blocks

BYTES = 100
KIND = R.Kind(False, BYTES, 32)
#: Fragments of one anchor that are indexed together: at most 340 KB.
CAP = 2000
#: Bytes of fragments from which on no further anchor is taken into an index.
INDEX_BYTES = 1 << 18
#: Windows of a piece at most.
PIECE = 8


def suffix_order(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The suffix array of symbols by prefix doubling, and each suffix's rank. Works only on suffixes still tied."""
    n, step = len(symbols), 1
    key = symbols.astype(np.uint64)
    if n and symbols.max() < 1 << 16:  # four symbols at once; beyond the end there is nothing to tie with
        for k in (1, 2, 3):
            key = key << np.uint64(16)
            key[: n - k] |= symbols[k:].astype(np.uint64)
        step = 4
    order = np.argsort(key)
    sorted_ = key[order]
    rank, at = np.empty(n, np.int64), np.arange(n)
    mine, key = order, sorted_
    while True:
        fresh = np.ones(len(mine), bool)
        fresh[1:] = key[1:] != key[:-1]
        # ranks count the places before: a group keeps the place of its first member
        rank[mine] = at[np.maximum.accumulate(np.where(fresh, np.arange(len(mine)), 0))]
        tied = ~fresh
        tied[:-1] |= ~fresh[1:]
        at, mine = at[tied], mine[tied]
        if not len(at):
            return order, rank
        next_ = np.where(mine + step < n, rank[np.minimum(mine + step, n - 1)] + 1, 0)
        key = rank[mine] * (n + 1) + next_
        by = np.argsort(key)
        mine, key = mine[by], key[by]
        order[at] = mine  # ties are contiguous, and stay within their places
        step *= 2


def transform(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The runs of the Burrows-Wheeler transform of a text whose last symbol is unique: their symbols, and the text
    positions of their first and last rows. The suffix order is needed to find them, and is not kept."""
    order, _ = suffix_order(symbols)
    bwt = symbols[order - 1]  # the text is a cycle
    start = np.flatnonzero(np.append(True, bwt[1:] != bwt[:-1]))
    return bwt[start], order[start], order[np.append(start[1:], len(order)) - 1]


def common(cells: np.ndarray, one: np.ndarray, two: np.ndarray, most: np.ndarray) -> np.ndarray:
    """How many bytes agree from each of two positions on, `most` at the utmost; cells hold eight bytes each."""
    n, live = np.zeros(len(one), np.int64), np.arange(len(one))
    while len(live):
        x = cells[one[live] + n[live]] ^ cells[two[live] + n[live]]
        low = x & (~x + np.uint64(1))  # the lowest bit that differs
        n[live] += np.where(x == 0, 8, np.log2(np.maximum(low, np.uint64(1)).astype(np.float64)).astype(np.int64) // 8)
        live = live[(x == 0) & (n[live] < most[live])]
    return np.minimum(n, most)


class RunLengthIndex:
    """A run-length index of fragments: for each run of their Burrows-Wheeler transform, the sampled text positions at its
    ends, each with its neighbour in suffix order and how many bytes they have in common.

    Within a run, rows that are neighbours stay so one symbol earlier in the text. So the neighbour of any position, and
    what they have in common, follow from the last sample before it in the text: the index grows with the runs, not with
    the fragments, and holds no order of all positions.
    """

    def __init__(self, symbols: np.ndarray, raw: np.ndarray, ends: np.ndarray):
        self.symbol, first, last = transform(symbols)
        room = lambda p: ends[np.searchsorted(ends, p)] - p
        cells = np.zeros(len(raw) + 8, np.uint64)
        for j in range(8):
            cells[: len(raw) - j] |= raw[j:].astype(np.uint64) << np.uint64(8 * j)
        up, down = last[:-1], first[1:]  # the last row of each run and the first of the next
        shared = common(cells, up, down, np.minimum(room(up), room(down)))
        self.sides = []  # the neighbour before a position in suffix order, and that after it
        for at, other in ((first, np.append(-1, up)), (last, np.append(down, -1))):
            by = np.argsort(at)
            has = np.append(0, shared) if at is first else np.append(shared, 0)
            self.sides.append((at[by], other[by], has[by]))

    def neighbours(self, at: np.ndarray, side: int) -> tuple[np.ndarray, np.ndarray]:
        """The neighbours of text positions in suffix order, and how many bytes they share."""
        sampled, other, shared = self.sides[side]
        k = np.searchsorted(sampled, at, "right") - 1
        past = at - sampled[k]
        return other[k] + past, shared[k] - past


def earlier_matches(index: RunLengthIndex, stream: np.ndarray, k: int) -> np.ndarray:
    """Which positions of the stream have a match of k bytes at an earlier position of the indexed fragments.

    Positions with k bytes in common lie together in suffix order. Both neighbours of a position are asked for, then
    theirs, until an earlier one is found or fewer than k bytes are shared. A position stops at the nearer of the two
    sides, which takes some m log m steps for m equal ones in any order.
    """
    found, live = np.zeros(len(stream), bool), np.arange(len(stream))
    at, open_ = [stream.copy(), stream.copy()], np.ones((2, len(stream)), bool)
    while len(live):
        for side in (0, 1):
            mine = live[open_[side, live]]
            other, shared = index.neighbours(at[side][mine], side)
            near = shared >= k
            open_[side, mine] = near
            at[side][mine] = other
            found[mine[near & (other < stream[mine])]] = True
        live = live[~found[live] & open_[:, live].any(0)]
    return found


def marked(bucket: np.ndarray, raw: list[bytes], k: int) -> list[np.ndarray]:
    """For each fragment the starts of the k-windows that an earlier fragment of its bucket has too.

    The fragments of a bucket come together, first ones first. Only they can share windows, for the bucket's anchor is in
    each; and a window occurs in a fragment once, for it has its anchor at one place. So the first of a bucket has none.
    """
    n = len(raw)
    sizes = np.fromiter(map(len, raw), np.int64, n)
    ends = np.cumsum(sizes + 1) - 1
    symbols = np.empty(int(sizes.sum()) + n, np.int64)
    inside = np.ones(len(symbols), bool)
    inside[ends] = False
    flat = np.zeros(len(symbols), np.uint8)
    flat[inside] = np.frombuffer(b"".join(raw), np.uint8)
    symbols[inside] = flat[inside].astype(np.int64) + n
    symbols[ends] = np.arange(n)  # terminators: the smallest symbols, each of its own
    index = RunLengthIndex(symbols, flat, ends)
    out = []
    streamed = np.append(False, bucket[1:] == bucket[:-1])
    windows = np.where(streamed, np.maximum(sizes - k + 1, 0), 0)
    found = earlier_matches(index, ragged(ends - sizes, windows), k)
    stop = np.cumsum(windows)
    for a, b in zip((stop - windows).tolist(), stop.tolist(), strict=True):
        out.append(np.flatnonzero(found[a:b]))
    return out


FOUND = "_id long, _row long, start int, count int"


def indexed_spans(fragments: DataFrame, k: int, parts: int, index_bytes: int = INDEX_BYTES) -> DataFrame:
    """fragments (a, _id, _row, start, raw) -> _id, _row, start, count of the windows that begin earlier in their bucket."""

    def run(batches):
        held, size, last = [], 0, None

        def flush():
            out = [[], [], [], []]
            got = marked(np.array([h[0] for h in held]), [h[4] for h in held], k)
            for h, at in zip(held, got, strict=True):
                if len(at):
                    head = np.flatnonzero(np.append(True, np.diff(at) > 1))
                    n = np.diff(np.append(head, len(at)))
                    for c, v in zip(out, ([h[1]] * len(n), [h[2]] * len(n), (at[head] + h[3]).tolist(), n.tolist()), strict=True):
                        c += v
            return pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int32()), pa.array(out[3], pa.int32())], names=["_id", "_row", "start", "count"])

        for part in batches:  # sorted by anchor, then by first occurrence
            for h in zip(*(part.column(i).to_pylist() for i in range(5)), strict=True):
                if held and h[:4] == held[-1][:4]:
                    continue  # another row of the same document
                if h[0] != last and size >= index_bytes:
                    yield flush()
                    held, size = [], 0
                held.append(h)
                size += len(h[4]) + 1
                last = h[0]
        if held:
            yield flush()

    dealt = fragments.select("a", "_id", "_row", "start", "raw").repartition(parts, "a").sortWithinPartitions("a", "_id", "_row", "start")
    return dealt.mapInArrow(run, FOUND)


def fragments_of(found: DataFrame, firsts: DataFrame, k: int) -> DataFrame:
    """a, _id, _row, start, raw: the bytes of the given first occurrences (a, _id, _row, start, count), once a row of that text."""

    def run(batches):
        for part, data, off in text_blocks(batches, "_text", R.BLOCK):
            flat = part.column(3).flatten()
            doc, start, count = R._asked(part, "start", "count")
            size = count + k - 1
            raw = data[ragged(off[doc] + start, size)]
            take = pa.array(doc)
            pieces = pa.BinaryArray.from_buffers(pa.binary(), len(doc), [None, pa.py_buffer(np.concatenate([[0], np.cumsum(size)]).astype(np.int32)), pa.py_buffer(raw)])
            yield pa.RecordBatch.from_arrays([flat.field("a"), part.column(0).take(take), part.column(1).take(take), flat.field("start"), pieces], names=["a", *R.KEY, "start", "raw"])

    return R.texts_with(found, firsts, "a", "start", "count").mapInArrow(run, "a long, _id long, _row long, start int, raw binary")


def _settled(found: DataFrame, places: DataFrame, kind: R.Kind, name: str, cap: int) -> tuple[list[DataFrame], DataFrame, list[DataFrame]]:
    """What is known of the paths at these places: tables of repeated runs of windows (_id, _row, start, count), the first
    occurrences of paths (a, count, at, _id, _row, start) whose anchor has more than cap of them, and the stored tables."""
    paths = R.variants(places, name)
    source = paths.where("n > 1").select("a", "h1", "h2", F.col("first").alias("_first"))
    whole = stored(places.join(source, ["a", "h1", "h2"]).where(F.struct(*R.KEY, "start") > F.col("_first")).select(*R.KEY, "start", "count"), f"{name}-whole")
    first = R.branching(paths, name)
    discard(paths)
    parts = max(int(found.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    indexed = stored(indexed_spans(fragments_of(found, first.where(F.col("variants") <= cap), kind.k), kind.k, parts), f"{name}-indexed")
    return [whole, indexed], first.where(F.col("variants") > cap), [whole, indexed, first]


def repeated_spans(found: DataFrame, kind: R.Kind, name: str, cap: int = CAP) -> DataFrame:
    """_id, _row, _spans (start, count): runs of windows whose bytes also start earlier; stored."""
    runs, many, tables = _settled(found, R.occurrences(found), kind, name, cap)
    if many.limit(1).count():  # anchors with too many paths for one index
        pieces = R.pieces_of(found, many, kind, PIECE, name)
        more, many, also = _settled(found, pieces, kind, f"{name}-pieces", cap)
        runs, tables = runs + more, [*tables, pieces, *also]
        if many.limit(1).count():  # pieces that differ in too many ways: their windows, PIECE of each at most
            opened = R.windows_of(found, many, kind, name)
            place = F.struct(*R.KEY, "start")
            edges = stored(opened.groupBy("e1", "e2").agg(F.min(place).alias("_first"), F.count("*").alias("_n")).where("_n > 1").select("e1", "e2", "_first"), f"{name}-edges")
            runs.append(maybe_in(opened, edges, "e1").join(edges, ["e1", "e2"]).where(place > F.col("_first")).select(*R.KEY, "start", F.lit(1).alias("count")))
            tables += [opened, edges]
    both = runs[0]
    for x in runs[1:]:
        both = both.unionByName(x)
    out = stored(both.groupBy(*R.KEY).agg(F.collect_set(F.struct("start", "count")).alias("_spans")), f"{name}-spans")
    discard(*tables)
    return out


def _digests(data, off, *_) -> list[str]:
    raw, at = data.tobytes(), off.tolist()
    return [R.sha(raw[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", kind: R.Kind = KIND, keep_bytes: bool = True, name: str = "suffix") -> DataFrame:
    """docs with its text as kept bytes (binary), and n_bytes, n_removed, n_spans (long), kept_sha256; one row out per row in.

    Removed is every byte in a window of k bytes that also starts earlier: in a row of smaller id, or before in the same
    text. A null text is empty; a null id is the smallest; ids that are no whole numbers raise TypeError. Equal rows of one id are one document and have equal results;
    rows of one id with different texts are documents in the order of a hash. Texts shorter than a window lose nothing;
    long ones are treated whole. An empty table gives no rows. What is kept may cut a character, so it is binary. With keep_bytes False it is left
    out. Columns of the added names are replaced.
    """
    added = ["n_bytes", "n_removed", "n_spans", "kept_sha256"]
    docs, back = set_aside(docs, [id_col, text_col], added)
    names = [c for c in docs.columns if c != text_col]
    found = R.candidates(R.prepared(docs, id_col, text_col).drop(text_col), kind, keep_bytes, name, _digests)
    spans = repeated_spans(found, kind, name)
    rows = flagged(found.drop("paths"), spans, "_row", "_maybe")
    some = rows.where("_maybe").join(spans, R.KEY, "left")
    schema = T.StructType([found.schema[c] for c in names] + [T.StructField("_kept", T.BinaryType()), *[T.StructField(c, T.LongType()) for c in added[:3]], T.StructField("kept_sha256", T.StringType())])

    def run(batches):
        for part, data, off in text_blocks(batches, "_text", R.BLOCK):
            lists = part.column(part.schema.get_field_index("_spans"))
            flat, base = lists.flatten(), np.repeat(off[:-1], lists.value_lengths().fill_null(0).to_numpy())
            begin, count = (flat.field(c).to_numpy().astype(np.int64) for c in ("start", "count"))
            gone = R.covered(len(data), base + begin, count, kind.k)
            head = gone.copy()
            head[1:] &= ~gone[:-1]
            edge = off[:-1][np.diff(off) > 0]
            head[edge] = gone[edge]
            removed, runs = (np.diff(np.concatenate([[0], np.cumsum(x)])[off]) for x in (gone, head))
            stay, at = data[~gone].tobytes(), (off - np.concatenate([[0], np.cumsum(removed)])).tolist()
            given = part.column(part.schema.get_field_index("kept_sha256")).to_pylist()
            shas = [R.sha(stay[a:b]) if n else sha for a, b, n, sha in zip(at[:-1], at[1:], removed.tolist(), given, strict=True)]
            kept = [stay[a:b] for a, b in zip(at[:-1], at[1:], strict=True)] if keep_bytes else [None] * len(shas)
            yield pa.RecordBatch.from_arrays([part.column(part.schema.get_field_index(c)) for c in names] + [pa.array(kept, pa.binary()), part.column(part.schema.get_field_index("n_units")), pa.array(removed.astype(np.int64)), pa.array(runs.astype(np.int64)), pa.array(shas, pa.string())], names=schema.names)

    cut = some.mapInArrow(run, schema)
    none = F.lit(0).cast("long")
    same = rows.where("NOT _maybe").select(*names, F.col("_text").cast("binary").alias("_kept"), F.col("n_units").alias("n_bytes"), none.alias("n_removed"), none.alias("n_spans"), "kept_sha256")
    return back(cut.unionByName(same).select(*[F.col("_kept").alias(c) if c == text_col else c for c in docs.columns if keep_bytes or c != text_col], *added))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return suffix_dedup(docs, keep_bytes=False)
