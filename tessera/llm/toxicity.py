"""Toxicity by a factorization machine over hashed terms.

Terms are a text's lower-cased words and the words' first letters, hashed to a fixed number of slots; each term counts
once a text. The machine scores a bias, a weight per term, and the products of the terms' factors, so that pairs of
terms (an insult with the mention of a group) weigh more or less than the two apart. It is fitted on the driver on a
bounded sample of labelled rows, and its fixed-size parameters are broadcast.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .scratch import stored
from .textblock import LOWER, hash_spans, text_blocks, text_of, words

#: Slots of the hashed terms; size of the factors. Both bound what is broadcast: 4 * SLOTS * (FACTORS + 1) bytes.
SLOTS, FACTORS = 1 << 18, 4
#: Labelled rows of each label that the machine is fitted on, at most: those with the smallest hashes of their ids.
SAMPLE = 3000
#: Lengths in bytes of the beginnings of words that are terms too.
PREFIXES = (4, 5, 6)
EPOCHS, BATCH, RATE = 12, 64, 0.08
#: A term takes part if its likelihood ratio between the labels is at least this, and it is in so many sampled rows.
TELLING, LEAST_ROWS = 12.0, 3


def block_terms(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct terms (slots, ascending) of each text of a block, end to end, and the bounds of the texts."""
    data = LOWER[data]
    starts, ends, first = words(data, off)
    text = text_of(first)
    _, rep, which = np.unique(hash_spans(data, starts, ends), return_index=True, return_inverse=True)
    s, e = starts[np.sort(rep)], ends[np.sort(rep)]
    rank = np.empty(len(rep), np.int64)
    rank[np.argsort(rep)] = np.arange(len(rep))
    kinds = [hash_spans(data, s, e)]
    for k in PREFIXES:  # a beginning that would end inside a letter is cut there on all workers alike
        kinds.append(hash_spans(data, s, np.minimum(e, s + k)) ^ np.uint64(0x9E3779B97F4A7C15 * k % 2**64))
    slots = (np.stack(kinds, 1) >> np.uint64(64 - SLOTS.bit_length() + 1)).astype(np.int64)
    n = len(off) - 1
    keys = np.unique((text[:, None] * SLOTS + slots[rank[which]]).ravel()) if len(text) else np.zeros(0, np.int64)
    return keys % SLOTS, np.searchsorted(keys, np.arange(n + 1) * SLOTS)


def _sums(values: np.ndarray, bound: np.ndarray) -> np.ndarray:
    """Sums of the rows between bounds; 0 for empty ranges."""
    out = np.zeros((len(bound) - 1, *values.shape[1:]), np.float64)
    full = np.flatnonzero(np.diff(bound) > 0)
    if len(full):
        out[full] = np.add.reduceat(values, bound[full], axis=0)
    return out


class Machine:
    """bias + sum w_i + sum over pairs <v_i, v_j>, over the terms that a text has."""

    def __init__(self, bias: float, w: np.ndarray, v: np.ndarray):
        self.bias, self.w, self.v = bias, w, v

    def margin(self, terms: np.ndarray, bound: np.ndarray) -> np.ndarray:
        used = np.concatenate([[0], np.cumsum(self.w[terms] != 0)])  # terms of weight 0 have no factors either
        terms, bound = terms[self.w[terms] != 0], used[bound]
        v = self.v[terms]
        pairs = (_sums(v, bound) ** 2).sum(1) - _sums((v.astype(np.float64) ** 2).sum(1), bound)
        return self.bias + _sums(self.w[terms], bound) + 0.5 * pairs

    def score(self, terms: np.ndarray, bound: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(terms, bound), -30, 30)))


def telling(rows: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """The terms that tell the labels apart, by the likelihood ratio of their two-by-two tables."""
    n1, n0 = int(labels.sum()), int(len(labels) - labels.sum())
    in1 = np.bincount(np.concatenate([r for r, y in zip(rows, labels, strict=True) if y]), minlength=SLOTS)
    in0 = np.bincount(np.concatenate([r for r, y in zip(rows, labels, strict=True) if not y]), minlength=SLOTS)
    total = 0.0
    for seen, n in ((in1, n1), (in0, n0)):
        for cell, rest in ((seen, in1 + in0), (n - seen, n1 + n0 - in1 - in0)):
            expected = np.maximum(rest * n / (n1 + n0), 1e-12)
            total = total + 2 * cell * np.log(np.maximum(cell, 1e-12) / expected)
    return (total >= TELLING) & (in1 + in0 >= LEAST_ROWS)


def fit(rows: list[np.ndarray], labels: np.ndarray, seed: int = 5) -> Machine:
    """Adaptive gradient descent on the log loss over the telling terms; the two labels weigh alike."""
    rng = np.random.default_rng(seed)
    m = Machine(0.0, np.zeros(SLOTS, np.float32), np.zeros((SLOTS, FACTORS), np.float32))
    if not len(rows) or labels.min() == labels.max():
        m.bias = 0.0 if not len(rows) else (4.0 if labels[0] else -4.0)
        return m
    mask = telling(rows, labels)
    rows = [r[mask[r]] for r in rows]
    m.w[mask] = 1e-6
    m.v[mask] = rng.normal(0, 0.02, (int(mask.sum()), FACTORS))
    weight = np.where(labels == 1, 0.5 / labels.mean(), 0.5 / (1 - labels.mean()))
    gw, gv, gb = np.full(SLOTS, 1e-4, np.float32), np.full((SLOTS, FACTORS), 1e-4, np.float32), 1e-4
    for _ in range(EPOCHS):
        order = rng.permutation(len(rows))
        for part in np.array_split(order, max(1, len(order) // BATCH)):
            size = np.array([len(rows[i]) for i in part])
            terms, bound = np.concatenate([rows[i] for i in part]), np.concatenate([[0], np.cumsum(size)])
            err = (m.score(terms, bound) - labels[part]) * weight[part] / len(part)
            gb += err.sum() ** 2
            m.bias -= RATE * err.sum() / np.sqrt(gb)
            if not len(terms):
                continue
            total, text = _sums(m.v[terms], bound), np.repeat(np.arange(len(part)), size)
            at, inverse = np.unique(terms, return_inverse=True)
            dw = np.bincount(inverse, err[text], len(at)).astype(np.float32)
            each = err[text][:, None] * (total[text] - m.v[terms])
            dv = np.stack([np.bincount(inverse, each[:, k], len(at)) for k in range(FACTORS)], 1).astype(np.float32)
            gw[at] += dw**2
            gv[at] += dv**2
            m.w[at] -= RATE * dw / np.sqrt(gw[at])
            m.v[at] -= RATE * 0.1 * dv / np.sqrt(gv[at])
    return m


def fit_on(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE) -> Machine:
    """A machine for labelled documents; null labels are left out. At most `sample` ids of each label are fetched, as terms.

    The sample is drawn from the labels, so that texts are only read, and those outside the sample go no further. One
    text an id is fetched: of several, that of the smallest hash. An id of both labels counts as toxic. Null ids have no
    label; a label without a document counts for nothing. Without documents or with one label only, the machine has a
    bias alone.
    """
    parts = []
    for value in (0, 1):  # a bounded top-k each: partial results of at most `sample` ids a task
        ids = labels.where(F.col(label_col) == value).select(id_col).distinct().orderBy(F.xxhash64(id_col), id_col).limit(sample)
        parts.append(ids.withColumn("_label", F.lit(value)))
    chosen = stored(parts[0].unionByName(parts[1]), "toxicity-sample")
    chosen = chosen.groupBy(id_col).agg(F.max("_label").alias("_label"))
    rows = docs.select(id_col, text_col).join(F.broadcast(chosen), id_col)  # at most 2 * sample ids

    def run(batches):
        for part, data, off in text_blocks(batches, text_col):
            terms, bound = block_terms(data, off)
            lists = pa.ListArray.from_arrays(pa.array(bound.astype(np.int32)), pa.array(terms.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), part.column(2), lists], names=["id", "label", "hash", "terms"])

    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("label", T.IntegerType()), T.StructField("hash", T.LongType()), T.StructField("terms", T.ArrayType(T.IntegerType()))])
    each = rows.select(id_col, "_label", F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("_hash"), text_col).mapInArrow(run, schema)
    got = each.groupBy("id", "label").agg(F.min_by("terms", "hash").alias("terms")).toPandas().sort_values("id")
    return fit([np.asarray(t, np.int64) for t in got.terms], got.label.to_numpy())


def toxicity(docs: DataFrame, machine: Machine, text_col: str = "text") -> DataFrame:
    """docs, without the text, with score (double) and predicted (int) added; one row out per row in.

    A null or empty text has no terms and the bias for its score. Whole texts are scored. Equal texts get equal scores;
    repeated rows repeat. Columns of the added names are replaced.
    """
    names = [c for c in docs.columns if c not in ("score", "predicted", text_col)]
    sent = docs.sparkSession.sparkContext.broadcast((machine.bias, machine.w, machine.v))

    def run(batches):
        m = Machine(*sent.value)
        for part, data, off in text_blocks(batches, text_col):
            score = m.score(*block_terms(data, off))
            yield pa.RecordBatch.from_arrays([part.column(part.schema.get_field_index(c)) for c in names] + [pa.array(score), pa.array((score >= 0.5).astype(np.int32))], names=[*names, "score", "predicted"])

    return docs.mapInArrow(run, T.StructType([docs.schema[c] for c in names] + [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    machine = fit_on(docs, labels.where(~held_out))
    return toxicity(docs.withColumn("held_out", F.coalesce(held_out, F.lit(False))), machine)
