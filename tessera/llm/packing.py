"""Best-fit packing by a grouping genetic algorithm.

Documents are encoded, cut into pieces of at most CAPACITY tokens, and the pieces packed. A full piece is a sequence by
itself. The others are dealt to shards of bounded size by a hash; on each shard some islands evolve packings: crossover
injects whole well-filled bins of one parent into another, removes the duplicates, and best-fits the displaced pieces:
the longest opens a bin, and gets the displaced pieces that fit its room best. Between two epochs each island gets the
best packing of the next one. Badly filled bins of all shards are then packed once more together. A shard stops as soon
as it needs no more bins than the sum of its lengths does, for there are no better packings.
"""

from __future__ import annotations

import os
import zlib

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .columns import set_aside
from .pretokens import distinct, pretokens
from .scratch import small_batches, stored
from .textblock import ragged, text_blocks

CAPACITY, END = 1024, 2
#: Pieces a shard gets on average, islands a shard, epochs, generations an epoch, packings an island.
SHARD, ISLANDS, EPOCHS, GENERATIONS, POPULATION = 4096, 2, 2, 20, 4
#: A bin is well filled, and injected whole, from this share of its capacity on.
WELL = 0.99
#: Crossover injects between these shares of a parent's well-filled bins.
INJECTED = (0.02, 0.3)
#: Pretokens kept by a worker; beyond it, it begins anew.
KEPT = 200_000
BLOCK = 2 << 20


class Encoder:
    """Ids of texts by a tokenizers file of byte-level BPE; each distinct pretoken is encoded once."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in set(shown)]
        self.letters = dict(zip([*shown, *hidden], map(chr, [*shown, *range(256, 256 + len(hidden))]), strict=True))
        self.special = [t.content.encode() for t in self.whole.get_added_tokens_decoder().values()]
        self._empty()

    def _empty(self) -> None:
        self.at: dict[bytes, int] = {}
        self.count, self.flat, self.used = np.zeros(1024, np.int64), np.zeros(4096, np.int32), 0
        self.first = np.zeros(1024, np.int64)

    def _add(self, pieces: list[bytes]) -> None:
        tokenize, letters, at = self.model.tokenize, self.letters, len(self.at)
        found = [[t.id for t in tokenize(p.decode("latin-1").translate(letters))] for p in pieces]
        count = np.fromiter(map(len, found), np.int64, len(found))
        need = at + len(found)
        while len(self.count) < need:
            self.count, self.first = np.concatenate([self.count, np.zeros_like(self.count)]), np.concatenate([self.first, np.zeros_like(self.first)])
        total = int(count.sum())
        while len(self.flat) < self.used + total:
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.count[at:need] = count
        self.first[at:need] = self.used + np.cumsum(count) - count
        self.flat[self.used : self.used + total] = np.fromiter((i for x in found for i in x), np.int32, total)
        self.used += total
        self.at.update(zip(pieces, range(at, need), strict=True))

    def block(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a block of texts, and where each text's begin (and their number)."""
        starts, ends, first = pretokens(data, off)
        rep, which = distinct(data, starts, ends)
        raw = data.tobytes()
        pieces = [raw[a:b] for a, b in zip(starts[rep].tolist(), ends[rep].tolist(), strict=True)]
        if len(self.at) + len(pieces) > KEPT:
            self._empty()
        self._add([p for p in pieces if p not in self.at])
        mine = np.fromiter(map(self.at.__getitem__, pieces), np.int64, len(pieces))[which] if len(which) else np.zeros(0, np.int64)
        count = self.count[mine]
        ids = self.flat[ragged(self.first[mine], count)] if len(mine) else np.zeros(0, np.int32)
        bound = np.concatenate([[0], np.cumsum(count)])[first]
        if any(s in raw for s in self.special):  # texts that spell a special token have its id there
            texts = [raw[a:b] for a, b in zip(off[:-1], off[1:], strict=True)]
            each = [np.array(self.whole.encode(t.decode(), add_special_tokens=False).ids, np.int32) if any(s in t for s in self.special) else ids[a:b] for t, a, b in zip(texts, bound[:-1], bound[1:], strict=True)]
            ids, bound = np.concatenate(each), np.concatenate([[0], np.cumsum(list(map(len, each)))])
        return ids, bound


def token_pieces(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end: int = END, with_ids: bool = False) -> DataFrame:
    """docs without the text, a row for each piece, with piece, start, length, ids_crc32 (and ids): each document's ids and
    `end`, in pieces of `capacity` of which only the first may be shorter.

    A null or empty text is the piece [end]; no document is left out, however long. Null ids, repeated ids and repeated
    rows are documents like others. An empty table gives no rows. Columns of the added names are replaced; the id may not
    have one of them.
    """
    added = ["piece", "start", "length", "ids_crc32"] + (["ids"] if with_ids else [])
    if id_col in added:
        raise ValueError(f"the id's column can't be called {id_col}")
    docs, back = set_aside(docs, [id_col, text_col], added)
    names = [c for c in docs.columns if c != text_col]
    fields = [*[docs.schema[c] for c in names], T.StructField("piece", T.IntegerType()), *[T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32")]]
    fields += [T.StructField("ids", T.ArrayType(T.IntegerType()))] if with_ids else []

    def run(batches):
        enc = Encoder(path)  # one a task, so that a worker doesn't keep it while it does other things
        for part, data, off in text_blocks(batches, text_col, BLOCK):
            ids, bound = enc.block(data, off)
            n_docs = len(off) - 1
            at = bound[1:]
            ids = np.insert(ids, at, end).astype("<u4")
            bound = bound + np.arange(n_docs + 1)
            total = np.diff(bound)
            pieces = -(-total // capacity)
            doc = np.repeat(np.arange(n_docs), pieces)
            piece = ragged(np.zeros(n_docs, np.int64), pieces)
            short = total - (pieces - 1) * capacity
            start = np.where(piece == 0, 0, short[doc] + (piece - 1) * capacity)
            length = np.where(piece == 0, short[doc], capacity)
            raw, lo = ids.tobytes(), bound[doc] + start
            crc = np.fromiter((zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(lo.tolist(), (lo + length).tolist(), strict=True)), np.int64, len(lo))
            take = pa.array(doc)
            out = [*[part.column(part.schema.get_field_index(c)).take(take) for c in names], pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc)]
            if with_ids:
                out.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(length)]).astype(np.int32)), pa.array(ids.astype(np.int32))))
            yield pa.RecordBatch.from_arrays(out, names=[f.name for f in fields])

    return back(docs.mapInArrow(run, T.StructType(fields)))


class _Bins:
    """Bins of items, and the room left in each."""

    def __init__(self, capacity: int):
        self.capacity, self.bins, self.room = capacity, [], []

    def add(self, items: list[int], room: int) -> None:
        self.bins.append(items)
        self.room.append(room)


def best_fit(lengths: list[int], order, capacity: int) -> _Bins:
    """Each item into the bin where it leaves the least room; into a new one if it fits in none."""
    out, open_, mask = _Bins(capacity), [[] for _ in range(capacity + 1)], 0
    for i in order:
        fits = mask >> lengths[i]
        if fits:
            room = lengths[i] + (fits & -fits).bit_length() - 1
            at = open_[room].pop()
            if not open_[room]:
                mask &= ~(1 << room)
            out.bins[at].append(i)
        else:
            room, at = capacity, len(out.bins)
            out.add([i], 0)
        out.room[at] = left = room - lengths[i]
        open_[left].append(at)
        mask |= 1 << left
    return out


class Displaced:
    """Displaced items by length; a bit of `mask` for each length that there is."""

    def __init__(self, capacity: int):
        self.of, self.mask = [[] for _ in range(capacity + 1)], 0

    def add(self, item: int, length: int) -> None:
        self.of[length].append(item)
        self.mask |= 1 << length

    def take(self, length: int) -> int:
        item = self.of[length].pop()
        if not self.of[length]:
            self.mask &= ~(1 << length)
        return item

    def fitting(self, room: int) -> list[int]:
        """Lengths that fill the room best: one that is just it, or two, or else the best sum of any, longer ones first."""
        if self.mask >> room & 1:
            return [room]
        small = self.mask & ((1 << room) - 1)
        half = (room + 1) // 2
        long = small >> half << half
        while long:
            a = long.bit_length() - 1
            long ^= 1 << a
            if small >> (room - a) & 1 and (2 * a != room or len(self.of[a]) > 1):
                return [a, room - a]
        lengths: list[int] = []
        while small:
            a = (small & -small).bit_length() - 1
            small &= small - 1
            lengths += [a] * min(len(self.of[a]), room // a)
        sums, within = [1], (2 << room) - 1  # bit s of sums[k]: the first k lengths can make s
        for a in lengths:
            sums.append((sums[-1] | sums[-1] << a) & within)
        left, out = sums[-1].bit_length() - 1, []
        for k in range(len(lengths) - 1, -1, -1):
            if left >= lengths[k] and sums[k] >> (left - lengths[k]) & 1:
                out.append(lengths[k])
                left -= lengths[k]
        return out


def fitness(p: _Bins) -> float:
    """Fewer bins first; of as many, those with room in fewer bins (mean squared room)."""
    return sum(r * r for r in p.room) / len(p.bins) / p.capacity**2 - len(p.bins)


def crossover(a: _Bins, b: _Bins, lengths: list[int], rng: np.random.Generator) -> _Bins:
    """b's well-filled bins, with some of a's injected whole; the pieces that these displace, and those of b's other bins,
    are best-fitted."""
    most = (1 - WELL) * a.capacity
    good = [i for i, r in enumerate(a.room) if r <= most]
    chosen = rng.choice(len(good), max(1, int(len(good) * rng.uniform(*INJECTED))), replace=False).tolist() if good else []
    out, loose, inside = _Bins(a.capacity), Displaced(a.capacity), set()
    for i in chosen:
        out.add(a.bins[good[i]], a.room[good[i]])
        inside.update(a.bins[good[i]])
    for items, room in zip(b.bins, b.room, strict=True):
        if room <= most and inside.isdisjoint(items):
            out.add(items, room)
        else:
            for x in items:
                if x not in inside:
                    loose.add(x, lengths[x])
    while loose.mask:
        length = loose.mask.bit_length() - 1
        items, room = [loose.take(length)], out.capacity - length
        for more in loose.fitting(room) if room and loose.mask else []:
            items.append(loose.take(more))
            room -= more
        out.add(items, room)
    return out


def _from_bins(bin_of: list[int], lengths: list[int], capacity: int) -> _Bins:
    groups: dict[int, list[int]] = {}
    for i, b in enumerate(bin_of):
        groups.setdefault(b, []).append(i)
    out = _Bins(capacity)
    for items in groups.values():
        out.add(items, capacity - sum(lengths[i] for i in items))
    return out


def evolve(lengths: list[int], seeds: list[list[int]], seed: int, capacity: int = CAPACITY, generations: int = GENERATIONS, population: int = POPULATION) -> _Bins:
    """The best packing found from best fit, some shuffled variants and the given packings (a bin for each piece)."""
    rng, n = np.random.default_rng(seed), len(lengths)
    least = -(-sum(lengths) // capacity)
    falling = sorted(range(n), key=lambda i: -lengths[i])
    pool = [_from_bins(s, lengths, capacity) for s in seeds] or [best_fit(lengths, falling, capacity)]
    best = max(pool, key=fitness)
    if len(best.bins) <= least:
        return best
    while len(pool) < population:
        noise = rng.normal(0, capacity / 25, n)
        pool.append(best_fit(lengths, sorted(range(n), key=lambda i: -lengths[i] + noise[i]), capacity))
    fit = [fitness(p) for p in pool]
    for _ in range(generations):
        one, two = rng.choice(len(pool), 2, replace=False)
        if fit[one] > fit[two] and rng.random() < 0.7:  # mostly the better parent gives the greater part
            one, two = two, one
        child = crossover(pool[one], pool[two], lengths, rng)
        worst = min(range(len(pool)), key=fit.__getitem__)
        if fitness(child) > fit[worst]:
            pool[worst], fit[worst] = child, fitness(child)
        if len(child.bins) <= least:
            break
    return pool[max(range(len(pool)), key=fit.__getitem__)]


def _epoch(rows: DataFrame, capacity: int, epoch: int) -> DataFrame:
    """rows (shard, island, lengths, seeds) -> shard, island, bin_of, score."""

    def run(parts):
        for pdf in parts:
            out = []
            for r in pdf.itertuples():
                lengths = [int(x) for x in r.lengths]
                got = evolve(lengths, [list(map(int, s)) for s in r.seeds], hash((int(r.shard), int(r.island), epoch)) & 0xFFFFFFFF, capacity)
                bin_of = np.zeros(len(lengths), np.int32)
                for b, items in enumerate(got.bins):
                    bin_of[items] = b
                out.append((r.shard, r.island, bin_of, fitness(got)))
            yield pd.DataFrame(out, columns=["shard", "island", "bin_of", "score"])

    return rows.mapInPandas(run, "shard long, island int, bin_of array<int>, score double")


def pack_round(items: DataFrame, shards: int, capacity: int, name: str) -> DataFrame:
    """items (uid, length) -> uid, length, shard, bin. A shard gets its items by a hash of the uid, so in even numbers."""
    groups = stored(
        items.groupBy(F.pmod(F.xxhash64("uid"), F.lit(shards)).alias("shard")).agg(F.sort_array(F.collect_list(F.struct("length", "uid")), False).alias("_i")).select("shard", F.col("_i.uid").alias("uids"), F.col("_i.length").alias("lengths")),
        f"{name}-shards",
    )
    islands = groups.select("shard", F.explode(F.array(*map(F.lit, range(ISLANDS)))).alias("island"), "lengths")
    elite = None
    for epoch in range(EPOCHS):
        if elite is None:
            rows = islands.withColumn("seeds", F.array().cast("array<array<int>>"))
        else:  # an island goes on with its own best and that of its neighbour
            near = elite.select("shard", F.pmod(F.col("island") + 1, F.lit(ISLANDS)).alias("island"), F.col("bin_of").alias("_near"))
            rows = islands.join(elite.select("shard", "island", "bin_of"), ["shard", "island"]).join(near, ["shard", "island"]).select("shard", "island", "lengths", F.array("bin_of", "_near").alias("seeds"))
        elite = stored(_epoch(rows.repartition(max(1, min(shards * ISLANDS, 4096)), "shard", "island"), capacity, epoch), f"{name}-elite")
    best = elite.groupBy("shard").agg(F.max_by("bin_of", F.struct("score", -F.col("island"))).alias("bin_of"))
    return groups.join(best, "shard").select("shard", F.explode(F.arrays_zip("uids", "lengths", "bin_of")).alias("_r")).select(F.col("_r.uids").alias("uid"), F.col("_r.lengths").alias("length"), "shard", F.col("_r.bin_of").alias("bin"))


def pack(pieces: DataFrame, capacity: int = CAPACITY, shard_items: int = SHARD) -> DataFrame:
    """pieces (with length, 1 to capacity) and sequence_id, offset (long). Rows in = rows out; equal rows are packed apart.

    Pieces of equal length are alike. Columns of the added names are replaced. An empty table gives no rows.
    """
    pieces, back = set_aside(pieces, ["length"], ["sequence_id", "offset"])
    names = pieces.columns
    held = stored(pieces.select(*names).withColumn("uid", F.monotonically_increasing_id()), "pieces")
    small = held.where(F.col("length") < capacity).select("uid", F.col("length").cast("int").alias("length"))
    first = stored(pack_round(small, max(1, -(-small.count() // shard_items)), capacity, "first"), "packed")
    fill = first.groupBy("shard", "bin").agg(F.sum("length").alias("fill"))
    poor = fill.where(F.col("fill") < WELL * capacity).select("shard", "bin")
    again = stored(first.join(poor, ["shard", "bin"], "left_semi").select("uid", "length"), "leftover")
    n = again.count()
    second = pack_round(again, max(1, -(-n // shard_items)), capacity, "second").select("uid", "length", F.col("shard"), F.col("bin"), F.lit(1).alias("_round"))
    kept = first.join(poor, ["shard", "bin"], "left_anti").select("uid", "length", "shard", "bin", F.lit(0).alias("_round"))
    # three kinds of sequence numbers: first round, second round, full pieces
    before = Window.partitionBy("_round", "shard", "bin").orderBy("uid").rowsBetween(Window.unboundedPreceding, -1)  # a bin has `capacity` rows at most
    placed = kept.unionByName(second).withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0).cast("long")))
    placed = placed.select(((F.col("shard") * (1 << 20) + F.col("bin")) * 4 + F.col("_round")).alias("sequence_id"), "uid", "offset")
    out = held.join(placed, "uid", "left").select(
        *names,
        F.coalesce(F.col("sequence_id"), F.col("uid") * 4 + 2).alias("sequence_id"),
        F.coalesce(F.col("offset"), F.lit(0).cast("long")).alias("offset"),
    )
    return back(out)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return pack(token_pieces(docs, public_tokenizers.path("byte_bpe_50k.json")))
