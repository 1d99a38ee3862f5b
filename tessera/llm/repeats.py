"""Repeated strings of k units (words or bytes) across documents: what substring dedup and suffix-array dedup share.

Every k-window has an anchor, its smallest m-gram by hash; equal windows have equal anchors. Consecutive windows with one
anchor form a path, so a text of n units is a few paths, not n windows. Anchors that occur once in the corpus can't lie in
a repeated window, and their paths are never shuffled. Paths of the others are grouped by their whole content (128 bits);
only groups of paths that share an anchor but differ as a whole need a look at single windows.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .columns import need_whole_ids
from .prefilter import maybe_in
from .scratch import discard, stored
from .textblock import _STEP, BLOCK_BYTES, BYTE, IS_WORD, hash_spans, mix, powers, ragged, spans, text_blocks

NO_ID = -(2**63)
#: A document: rows of one id whose texts have one 64-bit hash. Only texts of one id (or without one) could be mistaken.
KEY = ["_id", "_row"]
#: Texts are worked on in blocks of so many bytes: a unit takes some hundred bytes.
BLOCK = BLOCK_BYTES // 2
_LOW = np.uint64(0xFFFFFFFF)
_inverse = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def inverse_powers(n: int, which: int) -> np.ndarray:
    have = _inverse[which]
    while len(have) < n:
        have = np.concatenate([have, have * np.uint64(pow(int(_STEP[which]), -len(have), 2**64))])
        _inverse[which] = have
    return have[:n]


class Rolling:
    """Hashes of any range of a sequence of 64-bit values."""

    def __init__(self, values: np.ndarray, which: int):
        self.n, self.which = len(values), which
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * powers(len(values), which), dtype=np.uint64)])

    def grams(self, m: int) -> np.ndarray:
        return mix((self.sums[m:] - self.sums[:-m]) * inverse_powers(self.n - m + 1, self.which))

    def ranges(self, starts: np.ndarray, size: np.ndarray | int) -> np.ndarray:
        return mix((self.sums[starts + size] - self.sums[starts]) * inverse_powers(self.n, self.which)[starts] + np.asarray(size).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


@dataclass(frozen=True)
class Kind:
    """What is a unit, the length of a window, and that of an anchor."""

    words: bool
    k: int
    m: int

    def units(self, data: np.ndarray, off: np.ndarray):
        """Starts and ends of the units (None for bytes) and the bounds of the texts in units."""
        if not self.words:
            return None, None, off
        starts, ends = spans(IS_WORD[data], off)
        return starts, ends, np.searchsorted(starts, off)

    def values(self, data: np.ndarray, starts, ends, which: int) -> np.ndarray:
        return hash_spans(data, starts, ends, which) if self.words else BYTE[which][data]


@dataclass
class Paths:
    text: np.ndarray
    anchor: np.ndarray
    start: np.ndarray
    count: np.ndarray
    place: np.ndarray


def block_paths(roll: Rolling, bound: np.ndarray, k: int, m: int) -> Paths:
    """The paths of a block of texts, in order: number of the text, hash of the anchor, first window, number of windows,
    place of the anchor."""
    n = roll.n
    size = np.diff(bound)
    if n < k or not (size >= k).any():
        none = np.zeros(0, np.int64)
        return Paths(none, none.astype(np.uint64), none, none, none)
    grams = roll.grams(m)
    key = (grams & ~_LOW) | np.arange(len(grams), dtype=np.uint64)  # ties go to the left
    width, span = k - m + 1, 1
    while span * 2 <= width:
        key = np.minimum(key[:-span], key[span:])
        span *= 2
    if span < width:
        key = np.minimum(key[: len(key) - (width - span)], key[width - span :])
    valid = np.zeros(n + 1, np.int32)
    long = size >= k
    np.add.at(valid, bound[:-1][long], 1)
    np.add.at(valid, bound[1:][long] - k + 1, -1)
    at = np.flatnonzero(np.cumsum(valid[:-1]))
    place = (key[at] & _LOW).astype(np.int64)
    fresh = np.ones(len(at), bool)
    fresh[1:] = (place[1:] != place[:-1]) | (at[1:] != at[:-1] + 1)
    begin = np.flatnonzero(fresh)
    return Paths(np.searchsorted(bound, at[begin], "right") - 1, grams[place[begin]], at[begin], np.diff(np.append(begin, len(at))), place[begin])


def prepared(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """docs with _text and what makes a document: _id and _row, a hash of id and text."""
    need_whole_ids(docs, id_col)
    base = docs.withColumns({"_id": F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)), "_text": F.coalesce(F.col(text_col), F.lit(""))})
    return base.withColumn("_row", F.xxhash64("_id", "_text"))


def anchors(docs: DataFrame, kind: Kind) -> DataFrame:
    """_id, _row, a: the anchors of each document; once more than its paths only if words are the units."""

    def run(batches):
        for part, data, off in text_blocks(batches, "_text", BLOCK):
            starts, ends, bound = kind.units(data, off)
            p = block_paths(Rolling(kind.values(data, starts, ends, 0), 0), bound, kind.k, kind.m)
            a, t = p.anchor, p.text
            if kind.words and len(a):  # one a document
                order = np.lexsort((a, t))
                a, t = a[order], t[order]
                one = np.append(True, (a[1:] != a[:-1]) | (t[1:] != t[:-1]))
                a, t = a[one], t[one]
            take = pa.array(t)
            yield pa.RecordBatch.from_arrays([part.column(0).take(take), part.column(1).take(take), pa.array(a.view(np.int64))], names=[*KEY, "a"])

    return docs.select(*KEY, "_text").mapInArrow(run, "_id long, _row long, a long")


PATH = T.StructType([T.StructField(c, T.LongType()) for c in ("a", "h1", "h2")] + [T.StructField(c, T.IntegerType()) for c in ("start", "count", "at")])


def candidates(docs: DataFrame, kind: Kind, keep_text: bool, name: str, digests) -> DataFrame:
    """docs (prepared) with n_units, kept_sha256 (of the whole text), paths, and _text null where neither is wanted; stored.

    The paths are those whose anchor occurs twice in the corpus; `at` is the anchor's place in a path.
    digests(data, off, starts, ends, bound) -> a hexadecimal digest of each text of a block.
    """
    again = stored(anchors(docs, kind).groupBy("a").agg(F.count("*").alias("n")).where("n > 1").select("a"), f"{name}-anchors")
    hits = maybe_in(anchors(docs, kind), again, "a").join(again, "a").groupBy(*KEY).agg(F.collect_set("a").alias("_hits"))
    joined = docs.join(hits, KEY, "left")
    names = [c for c in docs.columns if c != "_text"]
    schema = T.StructType([joined.schema[c] for c in names] + [T.StructField("_text", T.StringType()), T.StructField("n_units", T.LongType()), T.StructField("kept_sha256", T.StringType()), T.StructField("paths", T.ArrayType(PATH))])

    def run(batches):
        for part, data, off in text_blocks(batches, "_text", BLOCK):
            starts, ends, bound = kind.units(data, off)
            lists = part.column(part.schema.get_field_index("_hits"))
            hit = lists.is_valid().to_numpy(zero_copy_only=False)
            found = np.unique(lists.flatten().to_numpy().astype(np.int64))
            roll = Rolling(kind.values(data, starts, ends, 0), 0)
            p = block_paths(roll, bound, kind.k, kind.m)
            mine = np.flatnonzero(hit[p.text] & np.isin(p.anchor.view(np.int64), found)) if len(found) else np.zeros(0, np.int64)
            size = p.count[mine] + kind.k - 1
            cols = [p.anchor[mine].view(np.int64)]
            if len(mine):
                second = Rolling(kind.values(data, starts, ends, 1), 1)
                cols += [r.ranges(p.start[mine], size).view(np.int64) for r in (roll, second)]
            else:
                cols += [np.zeros(0, np.int64)] * 2
            per = np.bincount(p.text[mine], minlength=len(off) - 1)
            cols += [x.astype(np.int32) for x in (p.start[mine] - bound[p.text[mine]], p.count[mine], p.place[mine] - p.start[mine])]
            structs = pa.StructArray.from_arrays([pa.array(c) for c in cols], names=PATH.names)
            paths = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(per)]).astype(np.int32)), structs)
            text = part.column(part.schema.get_field_index("_text"))
            if not keep_text:
                text = text.take(pa.array(np.arange(len(per)), mask=per == 0))
            shas = pa.array(digests(data, off, starts, ends, bound), pa.string())
            yield pa.RecordBatch.from_arrays([part.column(part.schema.get_field_index(c)) for c in names] + [text, pa.array(np.diff(bound)), shas, paths], names=schema.names)

    out = stored(joined.mapInArrow(run, schema), f"{name}-candidates")
    discard(again)
    return out


def occurrences(found: DataFrame) -> DataFrame:
    """_id, _row, a, h1, h2, start, count, at of every path."""
    return found.where(F.size("paths") > 0).select(*KEY, F.explode("paths").alias("_p")).select(*KEY, "_p.*")


def variants(places: DataFrame, name: str) -> DataFrame:
    """One row for each path by content: a, h1, h2, its first occurrence, count, at and n occurrences; stored."""
    first = F.min(F.struct(*KEY, "start")).alias("first")
    return stored(places.groupBy("a", "h1", "h2").agg(first, F.first("count").alias("count"), F.first("at").alias("at"), F.count("*").alias("n")), f"{name}-variants")


def branching(paths: DataFrame, name: str, more: DataFrame | None = None) -> DataFrame:
    """a, variants, count, at, _id, _row, start: the first occurrences of paths whose anchor has other paths too; stored.

    With more, its occurrences (a, count, at, _id, _row, start) of such paths too."""
    many = stored(paths.groupBy("a").agg(F.count("*").alias("variants")).where("variants > 1"), f"{name}-anchors")
    places = paths.select("a", "count", "at", "first.*")
    if more is not None:
        places = places.unionByName(more)
    out = stored(places.join(many, "a").select("a", "variants", "count", "at", *KEY, "start"), f"{name}-branching")
    discard(many)
    return out


def texts_with(found: DataFrame, places: DataFrame, *columns: str) -> DataFrame:
    """_id, _row, _text, _of: the texts that have some of the given places, once a row of that text, with what is asked
    for of each place. Other texts are not shuffled."""
    lists = places.groupBy(*KEY).agg(F.collect_set(F.struct(*columns)).alias("_of"))
    texts = maybe_in(found.where(F.size("paths") > 0).select(*KEY, "_text"), places, "_row")
    return texts.join(lists, KEY).select(*KEY, "_text", "_of")


def _asked(part: pa.RecordBatch, *columns: str) -> tuple[np.ndarray, ...]:
    """For each place of a batch of texts_with: the number of its text, and its columns."""
    lists = part.column(3)
    flat = lists.flatten()
    return (np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy()), *[flat.field(c).to_numpy().astype(np.int64) for c in columns])


def windows_of(found: DataFrame, firsts: DataFrame, kind: Kind, name: str) -> DataFrame:
    """_id, _row, start, e1, e2: every window of the given occurrences (_id, _row, start, count); stored."""

    def run(batches):
        for part, data, off in text_blocks(batches, "_text", BLOCK):
            starts, ends, bound = kind.units(data, off)
            doc, begin, count = _asked(part, "start", "count")
            at, doc = ragged(begin, count), np.repeat(doc, count)
            keys = [Rolling(kind.values(data, starts, ends, w), w).ranges(at + bound[doc], kind.k).view(np.int64) for w in (0, 1)]
            take = pa.array(doc)
            yield pa.RecordBatch.from_arrays([part.column(0).take(take), part.column(1).take(take), pa.array(at.astype(np.int32)), pa.array(keys[0]), pa.array(keys[1])], names=[*KEY, "start", "e1", "e2"])

    return stored(texts_with(found, firsts, "start", "count").mapInArrow(run, "_id long, _row long, start int, e1 long, e2 long"), f"{name}-windows")


def pieces_of(found: DataFrame, firsts: DataFrame, kind: Kind, width: int, name: str) -> DataFrame:
    """_id, _row, a, h1, h2, start, count, at: the given occurrences (_id, _row, start, count, at) cut into pieces; stored.

    Equal windows have their anchor at one place, so windows are cut by that place into pieces of at most `width`, and
    all windows of a piece hold the k - width + 1 units in its middle. These are the piece's anchor a: pieces of other
    paths that can share a window have it too. A path of n windows makes n / width pieces, most of which are as a whole
    equal to others or share no anchor.
    """

    def run(batches):
        for part, data, off in text_blocks(batches, "_text", BLOCK):
            starts, ends, bound = kind.units(data, off)
            doc, begin, count, at = _asked(part, "start", "count", "at")
            left = at[np.repeat(np.arange(len(at)), count)] - ragged(np.zeros(len(at), np.int64), count)  # units before the anchor
            path = np.repeat(np.arange(len(at)), count)
            cell = left // width
            head = np.flatnonzero(np.append(True, (path[1:] != path[:-1]) | (cell[1:] != cell[:-1]))) if len(path) else path
            size = np.diff(np.append(head, len(path)))
            path, cell = path[head], cell[head]
            start = begin[path] + at[path] - left[head]
            core = begin[path] + at[path] - cell * width
            text = doc[path]
            two = [Rolling(kind.values(data, starts, ends, w), w) for w in (0, 1)]
            keys = [two[0].ranges(core + bound[text], kind.k - width + 1)] + [r.ranges(start + bound[text], size + kind.k - 1) for r in two]
            take = pa.array(text)
            ints = [pa.array(x.astype(np.int32)) for x in (start, size, core - start)]
            yield pa.RecordBatch.from_arrays([part.column(0).take(take), part.column(1).take(take), *[pa.array(k.view(np.int64)) for k in keys], *ints], names=[*KEY, *PATH.names])

    schema = T.StructType([T.StructField(c, T.LongType()) for c in KEY] + PATH.fields)
    return stored(texts_with(found, firsts, "start", "count", "at").mapInArrow(run, schema), f"{name}-pieces")


def covered(n: int, starts: np.ndarray, counts: np.ndarray, k: int) -> np.ndarray:
    """Which of n units lie in a window of one of these runs of windows."""
    edge = np.zeros(n + 1, np.int32)
    np.add.at(edge, starts, 1)
    np.add.at(edge, np.minimum(starts + counts + k - 1, n), -1)
    return np.cumsum(edge[:-1]) > 0


def sha(raw: bytes) -> str:
    return hashlib.sha256(raw).hexdigest()
