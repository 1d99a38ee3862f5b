"""Byte-level BPE encoding and decoding.

The distinct pretokens of a block are put into padded matrices by length. In each round every row merges its leftmost
pair of minimum rank; ranks come from a hashed pair table, merged cells are compacted away, and rows without a pair
leave. Encodings of pretokens are kept for later blocks in a dictionary of bounded size.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .pretokens import distinct, pretokens
from .textblock import ragged, text_blocks

NONE = np.iinfo(np.int32).max
#: Pretokens kept by a worker; beyond it, it begins anew.
KEPT = 200_000
#: Longer pretokens are merged one by one with a heap, in n log n steps.
LONGEST_ROW = 512


class PairTable:
    """Open addressing in arrays: (left id, right id) -> rank of the two together."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray):
        bits = max(4, int(len(left) * 4).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), np.int64((1 << bits) - 1)
        self.keys = np.full(1 << bits, np.iinfo(np.uint64).max, np.uint64)
        self.ranks = np.full(1 << bits, NONE, np.int32)
        key = left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)
        slot, todo = self._slot(key), np.arange(len(key))
        while len(todo):
            free = self.keys[slot[todo]] == np.iinfo(np.uint64).max
            take, first = np.unique(slot[todo][free], return_index=True)
            won = todo[free][first]
            self.keys[take], self.ranks[take] = key[won], rank[won]
            todo = np.setdiff1d(todo, won, assume_unique=True)
            slot[todo] = (slot[todo] + 1) & self.mask

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def get(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The ranks of pairs of ids, NONE where there is none."""
        key = left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)
        slot = self._slot(key)
        found = self.keys[slot]
        out = np.where(found == key, self.ranks[slot], NONE)
        todo = np.flatnonzero((found != key) & (found != np.iinfo(np.uint64).max))
        while len(todo):
            slot[todo] = (slot[todo] + 1) & self.mask
            found = self.keys[slot[todo]]
            hit = found == key[todo]
            out[todo[hit]] = self.ranks[slot[todo[hit]]]
            todo = todo[~hit & (found != np.iinfo(np.uint64).max)]
        return out


class Vocabulary:
    """Ranks of a .tiktoken file."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.tokens = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        pairs = [(self.ranks[t[:k]], self.ranks[t[k:]], r) for t, r in self.ranks.items() for k in range(1, len(t)) if t[:k] in self.ranks and t[k:] in self.ranks]
        self.pairs = PairTable(*np.array(pairs, np.int64).reshape(-1, 3).T.astype(np.int32))
        self.byte = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self.kept: dict[bytes, tuple[int, bytes, bytes, np.ndarray]] = {}

    def encode_pieces(self, pieces: list[bytes]) -> list[np.ndarray]:
        """The ids of each piece."""
        out: list = [None] * len(pieces)
        size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        rows = []
        for i, piece in enumerate(pieces):
            if (whole := self.ranks.get(piece)) is not None:
                out[i] = np.array([whole], np.int32)
            elif size[i] > LONGEST_ROW:
                out[i] = self._heap(piece)
            else:
                rows.append(i)
        rows = np.array(rows, np.int64)
        width = 2
        while len(rows):
            here = rows[size[rows] <= width]
            rows = rows[size[rows] > width]
            for part in np.array_split(here, max(1, len(here) * width // (1 << 22) + 1)):
                if len(part):
                    self._matrix([pieces[i] for i in part], part, size[part], out)
            width *= 2
        return out

    def _matrix(self, pieces: list[bytes], at: np.ndarray, size: np.ndarray, out: list) -> None:
        width = int(size.max())
        ids = np.full((len(pieces), width + 1), -1, np.int32)  # a last column of padding: every pair has a right side
        ids[np.repeat(np.arange(len(pieces)), size), ragged(np.zeros(len(size), np.int64), size)] = self.byte[np.frombuffer(b"".join(pieces), np.uint8)]
        rank = np.full((len(pieces), width), NONE, np.int32)
        r, k = np.nonzero(ids[:, 1:] >= 0)
        rank[r, k] = self.pairs.get(ids[r, k], ids[r, k + 1])
        while True:
            pos = rank.argmin(1)
            line = np.arange(len(pos))
            least = rank[line, pos]
            stop = least == NONE
            if stop.any():
                for i, row in zip(at[stop], ids[stop], strict=True):
                    out[i] = row[row >= 0]
                go = ~stop
                ids, rank, at, pos, least = ids[go], rank[go], at[go], pos[go], least[go]
                if not len(at):
                    return
                line = np.arange(len(pos))
            ids[line, pos] = least
            keep = np.ones(ids.shape, bool)
            keep[line, pos + 1] = False
            ids = ids[keep].reshape(len(at), -1)
            keep = np.ones(rank.shape, bool)
            keep[line, pos] = False
            rank = rank[keep].reshape(len(at), -1)
            left = np.flatnonzero(pos > 0)
            rank[left, pos[left] - 1] = self.pairs.get(ids[left, pos[left] - 1], ids[left, pos[left]])
            right = np.flatnonzero(pos < rank.shape[1])
            right = right[ids[right, pos[right] + 1] >= 0]
            rank[right, pos[right]] = self.pairs.get(ids[right, pos[right]], ids[right, pos[right] + 1])

    def _heap(self, piece: bytes) -> np.ndarray:
        ids = [int(x) for x in self.byte[np.frombuffer(piece, np.uint8)]]
        n = len(ids)
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        pair = lambda i: self.ranks.get(self.tokens[ids[i]] + self.tokens[ids[after[i]]]) if after[i] >= 0 else None
        heap = [(r, i, ids[i], ids[after[i]]) for i in range(n) if (r := pair(i)) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            if ids[i] != a or after[i] < 0 or ids[after[i]] != b:
                continue  # one of the two is gone
            gone = after[i]
            ids[i], ids[gone], after[i] = rank, -1, after[gone]
            if after[i] >= 0:
                before[after[i]] = i
            after[gone] = -1
            for j in (before[i], i):
                if j >= 0 and (r := pair(j)) is not None:
                    heapq.heappush(heap, (r, j, ids[j], ids[after[j]]))
        return np.array([x for x in ids if x >= 0], np.int32)

    def entries(self, pieces: list[bytes]) -> list[tuple[int, bytes, bytes, np.ndarray]]:
        """For each piece: number of ids, ids as text with a comma after each, decoded bytes, ids."""
        missing = list(dict.fromkeys(p for p in pieces if p not in self.kept))
        if missing:
            if len(self.kept) + len(missing) > KEPT:
                self.kept = {}
                missing = list(dict.fromkeys(pieces))
            for piece, ids in zip(missing, self.encode_pieces(missing), strict=True):
                plain = ids.tolist()
                self.kept[piece] = (len(plain), b"".join(b"%d," % i for i in plain), self.decode(plain), ids)
        return [self.kept[p] for p in pieces]

    def decode(self, ids) -> bytes:
        return b"".join([self.tokens[i] for i in ids])


@functools.cache
def vocabulary(path: str) -> Vocabulary:
    """One vocabulary a worker."""
    return Vocabulary(path)


def block_entries(vocab: Vocabulary, data: np.ndarray, off: np.ndarray):
    """The entries of a block's distinct pretokens, for each pretoken the number of its entry, and each text's first pretoken."""
    starts, ends, first = pretokens(data, off)
    rep, which = distinct(data, starts, ends)
    raw = data.tobytes()
    return vocab.entries([raw[a:b] for a, b in zip(starts[rep].tolist(), ends[rep].tolist(), strict=True)]), which, first


SCHEMA = T.StructType([T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])


def bpe_round_trip(docs: DataFrame, path: str, text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """docs, without the text, with n_tokens, ids_sha256 and decoded_sha256 (and ids array<int>, if wanted) added.

    A null text is empty and has no tokens: both digests are those of no bytes. Whole texts are encoded, however long.
    Of pairs of one rank the leftmost is merged first. Pretokens of more than LONGEST_ROW bytes (runs of one kind of
    character without a space) leave the matrices, whose rounds would be as many as their bytes, and are merged with a
    heap, to the same ids. Rows are independent of each other, so repeated rows repeat; an empty table gives no rows.
    Columns of the added names are replaced.
    """
    added = T.StructType([*SCHEMA, *([T.StructField("ids", T.ArrayType(T.IntegerType()))] if with_ids else [])])
    names = [c for c in docs.columns if c not in added.names and c != text_col]

    def run(batches):
        vocab = vocabulary(path)
        for part, data, off in text_blocks(batches, text_col):
            entries, which, first = block_entries(vocab, data, off)
            counts, texts, decoded, ids = zip(*entries, strict=True) if entries else ((), (), (), ())
            n = np.concatenate([[0], np.cumsum(np.array(counts, np.int64)[which] if len(which) else np.zeros(0, np.int64))])
            which = which.tolist()
            cols = [[], []]
            for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
                mine = which[a:b]
                cols[0].append(hashlib.sha256(b"".join([texts[i] for i in mine])[:-1]).hexdigest())
                cols[1].append(hashlib.sha256(b"".join([decoded[i] for i in mine])).hexdigest())
            out = [pa.array(n[first[1:]] - n[first[:-1]]), pa.array(cols[0]), pa.array(cols[1])]
            if with_ids:
                out.append(pa.array([np.concatenate([ids[i] for i in which[a:b]] or [np.empty(0, np.int32)]) for a, b in zip(first[:-1], first[1:], strict=True)], pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays([part.column(part.schema.get_field_index(c)) for c in names] + out, names=[*names, *added.names])

    return docs.mapInArrow(run, T.StructType([docs.schema[c] for c in names] + list(added)))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return bpe_round_trip(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
