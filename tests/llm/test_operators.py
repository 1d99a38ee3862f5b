"""Each operator against a brute-force version on a table of nulls, empty and long texts, ties and repeated rows."""

import base64
import hashlib
import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tessera.llm import bpe, line_dedup, media, ngram_join, packing, quality_rules, sharding, substring_dedup, suffix_dedup, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, _id long, _text string, _row string, n string, kept string, start int, a string, uid string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _rows():
    rnd = random.Random(8)
    word = lambda: "".join(rnd.choice("abcdeéñ") for _ in range(rnd.randint(1, 5)))
    text = lambda n: "".join(word() + rnd.choice([" ", " ", " ", ". ", "\n", "  "]) for _ in range(n))
    passage, line = text(40), "This line is in many of the documents, more than five."
    rows = [(1, text(80)), (2, None), (3, ""), (4, " \n\t \n"), (5, text(6000) + passage), (None, passage + text(20)), (7, "one two"), (7, "one two"), (8, "One  TWO")]
    rows += [(i, f"{text(30)}\n  {line.upper() if i % 2 else line} \n{passage if i % 3 else ''}{text(30)}") for i in range(20, 32)]
    base = text(120).split(" ")
    for i in range(40, 60):
        own = list(base)
        own[rnd.randrange(len(own))] = word()
        rows.append((i, " ".join(own)))
    rows += [(i, rows[0][1]) for i in (61, 62)] + [(63, "ab" * 3000), (64, "it's we'll  they've\n\n 12,5 日本語😀"), (65, text(60)), (65, text(60))]
    return [(i, t, "en" if (i or 0) % 2 else None, "s", 1, "x", "y", "z", "k", 3, "a", "u") for i, t in rows]


@pytest.fixture(scope="module")
def rows():
    return _rows()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def _by(df, *cols):
    return Counter(tuple(r[c] for c in ("doc_id", *cols)) for r in df.collect())


def _sha(raw):
    return hashlib.sha256(raw).hexdigest()


def test_columns_of_any_name_are_kept(docs, empty):
    kept = {"_id": 1, "_text": "x", "_row": "y", "n": "z", "start": 3, "a": "a", "uid": "u"}
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    for run in (line_dedup.line_dedup, sharding.shard, quality_rules.quality_rules, substring_dedup.substring_dedup, suffix_dedup.suffix_dedup, ngram_join.ngram_components, lambda d: bpe.bpe_round_trip(d, path), media.to_media):
        out = run(docs)
        assert out.count() == docs.count()
        first = out.first()
        assert {c: first[c] for c in kept} == kept
        assert run(empty).count() == 0


def test_media(docs, rows, empty):
    got = media.media_features(media.to_media(docs))
    want = Counter()
    for i, t, *_ in rows:
        raw = (t or "").encode()
        full = raw + b" " * (-len(raw) % 192 if raw else 192)
        want[i, len(raw), len(full), _sha(full), zlib.crc32(full[-16:])] += 1
    assert _by(got, "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32") == want
    assert media.media_features(media.to_media(empty)).count() == 0


def test_images():
    image = np.random.default_rng(1).integers(0, 256, (7, 5, 3), dtype=np.uint8)
    assert (media.decode(media.encode_ppm(image)) == image).all() and (media.decode(media.encode_bmp(image)) == image).all()
    assert (media.decode(b"P2 # a\n2 1\n9\n3 7\n") == [[[3], [7]]]).all() and (media.decode(b"P1\n2 2\n1 0\n01") == [[[0], [255]], [[255], [0]]]).all()
    assert (media.decode(b"P4\n3 1\n\xa0") == [[[0], [255], [0]]]).all() and (media.decode(b"P5\n1 1\n65535\n\x01\x02") == 258).all()
    small = media.area_resize(image, 3, 2)
    ones = np.kron(image.astype(float), np.ones((3, 2, 1)))  # each pixel as 3 x 2: whole cells
    assert np.allclose(small, ones.reshape(3, 7, 2, 5, 3).mean((1, 3)))
    whole = np.zeros_like(image)
    for y, x, raw in media.npy_tiles(image, 4):
        tile = np.load(__import__("io").BytesIO(raw))
        whole[4 * y : 4 * y + 4, 4 * x : 4 * x + 4] = tile
    assert (whole == image).all()
    huge = struct.pack("<2sIHHIIiiHHIIiiII", b"BM", 54, 0, 0, 54, 40, 2**31 - 1, -(2**31) + 1, 1, 24, 0, 0, 0, 0, 0, 0)
    for bad in [*BAD, b"P6 99999999999999999999 9 255\n", b"P4 99999999999999999999 9\n", b"P5 9 99999999999999999999 65535\n", huge]:
        with pytest.raises((ValueError, struct.error)):
            media.decode(bad)
    tall = np.random.default_rng(2).integers(0, 256, (3 * media.BAND + 5, 4, 3), dtype=np.uint8)
    whole = np.concatenate([[np.zeros((4, 3))], np.cumsum(tall, 0, dtype=float)])
    at = np.arange(12) * len(tall) / 11
    low = np.minimum(at.astype(int), len(tall) - 1)
    rows = whole[low] + (whole[low + 1] - whole[low]) * (at - low)[:, None, None]
    want = np.diff(rows, axis=0).reshape(11, 2, 2, 3).mean(2) * 11 / len(tall)
    assert np.allclose(media.area_resize(tall, 11, 2), want)


_PALETTE = struct.pack("<2sIHHIIiiHHIIiiII", b"BM", 66, 0, 0, 62, 40, 1, 1, 1, 8, 0, 4, 0, 0, 2, 0) + bytes(8)
#: No pictures: no or wrong headers, no pixels, missing or too large samples, a pixel beyond the palette.
BAD = [b"", b"P9", b"BMxx", b"GIF89a", b"P6\n0 0\n255\n", b"P5\n1 1\n70000\n\x01\x02", b"P2\n1 1\n255\n99999999999999999999999", b"P2\n1 1\n255\n256", b"P2\n2 1\n255\n1", b"P1\n1 1\n7", _PALETTE + b"\x05\0\0\0"]


def test_bad_pictures_give_nulls(spark):
    good = media.encode_ppm(np.arange(36, dtype=np.uint8).reshape(3, 4, 3))
    df = spark.createDataFrame([(i, x) for i, x in enumerate([*BAD, None, good])], "id long, media binary")
    got = {r.id: r for r in media.media_features(df).collect()}
    assert all(got[i].feature is None and got[i].payload_sha256 is None and got[i].media_sha256 == _sha(b or b"") for i, b in enumerate([*BAD, None])) and got[len(BAD) + 1].height == 3
    assert {r.id for r in media.media_tiles(df, "id").select("id").collect()} == {len(BAD) + 1}


def test_tiles(docs, empty):
    held = media.to_media(docs)
    tiles = media.media_tiles(held.where("doc_id = 1"), "doc_id").collect()
    raw = held.where("doc_id = 1").first()["media"]
    image = np.rint(media.area_resize(media.decode(raw), 64, 64)).astype(np.uint8)
    whole = np.zeros_like(image)
    for r in tiles:
        tile = np.load(__import__("io").BytesIO(r.npy))
        whole[32 * r.tile_row : 32 * r.tile_row + 32, 32 * r.tile_col : 32 * r.tile_col + 32] = tile
    assert len(tiles) == 4 and (whole == image).all()
    row = media.media_features(held.where("doc_id = 1")).first()
    assert row.n_tiles == 4 and row.tiles_sha256 == _sha(b"".join(bytes(r.npy) for r in sorted(tiles, key=lambda r: (r.tile_row, r.tile_col))))
    assert media.media_tiles(media.to_media(empty), "doc_id").count() == 0


def test_bpe(docs, rows, empty):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = Counter()
    for i, t, *_ in rows:
        ids = enc.encode_ordinary(t or "")
        want[i, len(ids), _sha(",".join(map(str, ids)).encode()), _sha((t or "").encode())] += 1
    assert _by(bpe.bpe_round_trip(docs, path), "n_tokens", "ids_sha256", "decoded_sha256") == want
    with_ids = bpe.bpe_round_trip(docs, path, with_ids=True).where("doc_id = 64").first()
    assert with_ids["ids"] == enc.encode_ordinary(next(t for i, t, *_ in rows if i == 64))


def test_packing(docs, rows, empty):
    path = public_tokenizers.path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    got = packing.pack(packing.token_pieces(docs, path)).collect()
    want = Counter()
    for i, t, *_ in rows:
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 2]
        n = -(-len(ids) // 1024)
        cut = [0, *[len(ids) - 1024 * (n - 1 - k) for k in range(n)]]
        for k in range(n):
            part = ids[cut[k] : cut[k + 1]]
            want[i, k, cut[k], len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    seqs = defaultdict(list)
    for r in got:
        seqs[r.sequence_id].append((r.offset, r.length))
    for parts in seqs.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(seqs) <= -(-sum(r.length for r in got) // 1024) + 1
    assert packing.pack(packing.token_pieces(empty, path)).count() == 0
    first = packing.pack(packing.token_pieces(docs, path, with_ids=True)).where("doc_id = 3").first()
    assert {c: first[c] for c in ("_id", "_text", "_row", "n", "a", "uid", "start", "ids")} == {"_id": 1, "_text": "x", "_row": "y", "n": "z", "a": "a", "uid": "u", "start": 0, "ids": [2]}
    with pytest.raises(ValueError):
        packing.token_pieces(docs.withColumnRenamed("doc_id", "piece"), path, "piece")


def _triplets(n, seed):
    """Lengths that fill n bins of 1024 in threes, and no bin in twos."""
    rnd, out = random.Random(seed), []
    while len(out) < 3 * n:
        a, b = rnd.randint(260, 500), rnd.randint(260, 500)
        out += [a, b, 1024 - a - b] if 256 < 1024 - a - b < 512 else []
    rnd.shuffle(out)
    return out


def _falling(lengths):
    return packing.best_fit(lengths, sorted(range(len(lengths)), key=lambda i: -lengths[i]), 1024)


def test_evolution_beats_best_fit_decreasing():
    for n in (20, 40, 80):
        lengths = _triplets(n, n)
        got = packing.evolve(lengths, [], 1)
        assert sorted(x for b in got.bins for x in b) == list(range(len(lengths))) and all(sum(lengths[i] for i in b) == 1024 - r for b, r in zip(got.bins, got.room, strict=True))
        assert n <= len(got.bins) < len(_falling(lengths).bins)


def test_evolution_is_crossover(monkeypatch):
    lengths = _triplets(60, 7)
    monkeypatch.setattr(packing, "crossover", lambda a, b, lengths, rng: b)
    assert len(packing.evolve(lengths, [], 1).bins) >= len(_falling(lengths).bins) - 1
    monkeypatch.undo()
    assert len(packing.evolve(lengths, [], 1).bins) < len(_falling(lengths).bins) - 3


def test_crossover_injects_whole_bins():
    rnd = np.random.default_rng(2)
    lengths = rnd.integers(1, 700, 300).tolist()
    a, b = _falling(lengths), packing.best_fit(lengths, range(300), 1024)
    got = packing.crossover(a, b, lengths, rnd)
    assert sorted(x for i in got.bins for x in i) == list(range(300)) and all(0 <= r == 1024 - sum(lengths[x] for x in i) for i, r in zip(got.bins, got.room, strict=True))
    assert {frozenset(i) for i in a.bins} & {frozenset(i) for i in got.bins}


def test_distinct_spans():
    from tessera.llm.pretokens import distinct

    rnd = random.Random(1)
    parts = [bytes(rnd.choice(b"ab\0") for _ in range(rnd.choice([1, 2, 7, 8, 9, 15, 16, 17, 30]))) for _ in range(3000)] * 2
    stop = np.cumsum(list(map(len, parts)))
    rep, which = distinct(np.frombuffer(b"".join(parts), np.uint8), stop - list(map(len, parts)), stop)
    assert [parts[i] for i in rep[which]] == parts and len(rep) == len(set(parts))


def test_toxicity(spark, empty):
    rnd = random.Random(4)
    words = [f"w{i}" for i in range(200)]
    data = []
    for i in range(600):
        own = [rnd.choice(words) for _ in range(30)]
        insult, group = rnd.random() < 0.5, rnd.random() < 0.5
        own += ["scoundrel"] * insult + ["neighbours"] * group
        rnd.shuffle(own)
        data.append((i, " ".join(own), int(insult and group)))
    df = spark.createDataFrame(data, "doc_id long, text string, toxic int")
    machine = toxicity.fit_on(df.drop("toxic"), df.where("doc_id < 400").drop("text"))
    got = {r.doc_id: r for r in toxicity.toxicity(df.drop("toxic"), machine).collect()}
    right = sum(got[i].predicted == y for i, _, y in data if i >= 400)
    assert right >= 190  # the pair counts, not either word
    odd = spark.createDataFrame([(1, None), (1, None), (2, "")], "doc_id long, text string")
    assert len({r.score for r in toxicity.toxicity(odd, machine).collect()}) == 1
    assert toxicity.toxicity(empty, machine).count() == 0 and toxicity.fit_on(df.drop("toxic"), df.limit(0).drop("text")).bias == 0


def test_scores_are_sums_over_pairs():
    rnd = np.random.default_rng(3)
    m = toxicity.Machine(0.3, np.zeros(toxicity.SLOTS, np.float32), np.zeros((toxicity.SLOTS, toxicity.FACTORS), np.float32))
    used = rnd.choice(toxicity.SLOTS, 40, replace=False)
    m.w[used], m.v[used] = rnd.normal(size=40), rnd.normal(size=(40, toxicity.FACTORS))
    texts = [rnd.choice(used, n, replace=False) for n in (0, 1, 2, 17)]
    got = m.score(np.concatenate(texts), np.cumsum([0, *map(len, texts)]))
    for t, g in zip(texts, got, strict=True):
        margin = 0.3 + sum(float(m.w[i]) for i in t)
        for x in range(len(t)):
            for y in range(x):
                margin += sum(float(a) * float(b) for a, b in zip(m.v[t[x]], m.v[t[y]], strict=True))
        assert abs(g - 1 / (1 + np.exp(-margin))) < 1e-5


def test_toxicity_query(spark, tmp_path):
    rnd = random.Random(8)
    rows = [(i, " ".join([f"w{rnd.randrange(60)}" for _ in range(20)] + ["scum"] * (i % 2))) for i in range(400)]
    rows += [(7, "another text of one id"), (7, None)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    # in the rows that are held out, labels are the other way round: they may not be learnt from
    held = {i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 0}
    labels = [(i, (i % 2) ^ (i in held)) for i in range(400)] + [(9, 0), (999, 1), (None, 1), (3, None)]
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = toxicity.query(spark, str(tmp_path)).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in rows)
    assert all(r.held_out == (r.doc_id in held) and r.predicted == (r.score >= 0.5) for r in got)
    assert all(r.predicted == r.doc_id % 2 for r in got if r.doc_id != 7)
    again = toxicity.query(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id, r.score) for r in again) == sorted((r.doc_id, r.score) for r in got)


def test_line_dedup(docs, rows, empty):
    blank = " \t\n\x0b\x0c\r"
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda x: x.strip(blank).translate(low)
    ident = lambda i: -(2**63) if i is None else i
    holds = defaultdict(set)
    for i, t, *_ in rows:
        for x in (t or "").split("\n"):
            holds[key(x)].add(ident(i))
    bad = {k: max(v) for k, v in holds.items() if len(k) >= 40 and len(v) >= 5}
    assert bad
    want = Counter()
    for i, t, *_ in rows:
        all_ = (t or "").split("\n")
        kept = [x for x in all_ if bad.get(key(x), ident(i)) == ident(i)]
        want[i, "\n".join(kept), len(all_), len(all_) - len(kept)] += 1
    assert _by(line_dedup.line_dedup(docs), "text", "n_lines", "n_dropped") == want


def test_ngram_components(docs, rows, empty):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for _, t, *_ in rows:
        w = WORD.findall((t or "").translate(low))
        sets.append({tuple(w[k : k + 4]) for k in range(max(1, len(w) - 3))} if w else set())
    label = list(range(len(rows)))
    for x in range(len(rows)):
        for y in range(x):
            same = rows[x][:2] == rows[y][:2]
            if same or (sets[x] and sets[y] and 100 * len(sets[x] & sets[y]) >= 85 * len(sets[x] | sets[y])):
                a, b = label[x], label[y]
                label = [b if v == a else v for v in label]
    least = {}
    for (i, *_), v in zip(rows, label, strict=True):
        i = -(2**63) if i is None else i
        least[v] = min(least.get(v, i), i)
    want = Counter((r[0], len(s), None if least[v] == -(2**63) else least[v]) for r, s, v in zip(rows, sets, label, strict=True))
    assert _by(ngram_join.ngram_components(docs), "n_shingles", "component_id") == want
    assert ngram_join.ngram_components(empty).count() == 0


@pytest.mark.parametrize(("pivots", "cells"), [(1, 10**6), (3, 600)])
def test_large_clusters_are_tiled(spark, monkeypatch, pivots, cells):
    monkeypatch.setattr(ngram_join, "LIGHT", 4)
    monkeypatch.setattr(ngram_join, "BLOCK", 4)
    monkeypatch.setattr(ngram_join, "CELLS", cells)
    monkeypatch.setattr(ngram_join, "PIVOTS", pivots)
    monkeypatch.setattr(ngram_join, "LATE_ROWS", 3)
    rnd = random.Random(2)
    base = [f"v{rnd.randrange(10**6)}" for _ in range(200)]
    data = []
    for i in range(40):
        own = list(base)
        for _ in range(rnd.randint(0, 7)):
            own[rnd.randrange(200)] = f"n{rnd.randrange(10**6)}"
        data.append((i, " ".join(own)))
    far = list(base)
    for i in range(100, 125):  # each links with the next one only
        for k in range(3):
            far[(i * 3 + k) * 7 % 200] = f"f{rnd.randrange(10**6)}"
        data.append((i * 37 % 100 + 100, " ".join(far)))
    got = {r.doc_id: r.component_id for r in ngram_join.ngram_components(spark.createDataFrame(data, "doc_id long, text string")).collect()}
    sets = {i: {tuple(t.split()[k : k + 4]) for k in range(197)} for i, t in data}
    label = {i: i for i in sets}
    for x in sets:
        for y in [y for y in sets if y < x]:
            if 100 * len(sets[x] & sets[y]) >= 85 * len(sets[x] | sets[y]):
                a, b = max(label[x], label[y]), min(label[x], label[y])
                label = {k: b if v == a else v for k, v in label.items()}
    assert got == label and 1 < len(set(label.values())) < 40 and max(Counter(label.values()).values()) > 20


def test_common_columns_make_no_clusters(spark, monkeypatch):
    """Sixty texts of 30 % common sentences and 70 % words of their own link with none, and none is sent to a cluster."""
    rnd = random.Random(5)
    common = [" ".join(f"c{rnd.randrange(10**6)}" for _ in range(16)) for _ in range(10)]
    data = []
    for i in range(60):
        own = [" ".join(f"o{rnd.randrange(10**9)}" for _ in range(28)) for _ in range(10)]
        data.append((i, " ".join(x for pair in zip(common, own, strict=True) for x in pair)))
    real, members = ngram_join.stored, []

    def stored(df, name):
        out = real(df, name)
        if name.endswith("-members"):
            members.append(out.count())
        return out

    monkeypatch.setattr(ngram_join, "stored", stored)
    got = ngram_join.ngram_components(spark.createDataFrame(data, "doc_id long, text string"))
    assert {r.doc_id: r.component_id for r in got.collect()} == {i: i for i in range(60)}
    assert members == [0]


def _removed_words(rows, k=13):
    first = {}
    for i, t, *_ in sorted(rows, key=lambda r: -(2**63) if r[0] is None else r[0]):
        w = (WORD.findall(t or ""))
        for j in range(len(w) - k + 1):
            first.setdefault(tuple(w[j : j + k]), -(2**63) if i is None else i)
    for i, t, *_ in rows:
        w, me = WORD.findall(t or ""), -(2**63) if i is None else i
        gone = [False] * len(w)
        for j in range(len(w) - k + 1):
            if first[tuple(w[j : j + k])] < me:
                gone[j : j + k] = [True] * k
        yield i, w, gone


def test_substring_dedup(docs, rows, empty):
    want = Counter((i, len(w), sum(g), _sha(" ".join(x for x, y in zip(w, g, strict=True) if not y).encode())) for i, w, g in _removed_words(rows))
    got = substring_dedup.substring_dedup(docs)
    assert _by(got, "n_words", "n_removed", "kept_sha256") == want and any(k[2] for k in want)
    for r in got.collect():
        assert _sha(" ".join(WORD.findall(r.text)).encode()) == r.kept_sha256


def test_substring_dedup_within_a_document(spark):
    rnd, rows = random.Random(5), []
    some = lambda n: [f"w{rnd.randrange(10**9)}" for _ in range(n)]
    for at in range(0, 800, 20):  # independent cases: each has words of its own
        a, b, p, x = some(9), some(9), some(rnd.randint(3, 30)), some(rnd.randint(13, 40))
        t = some(rnd.randint(5, 25))
        cases = [(1, a + x + b), (2, p + x + p + x + p), (3, t), (4, t * 3), (4, p + x + p), (5, x[2:] + t + x[2:] + t[:-1])]
        rows += [(at + i, " ".join(w)) for i, w in cases]
    rows += [(None, "n " + rows[1][1]), (None, "m " + rows[1][1] + " " + rows[1][1])]
    got = substring_dedup.substring_dedup(spark.createDataFrame(rows, "doc_id long, text string"))
    want = Counter((i, len(w), sum(g), _sha(" ".join(x for x, y in zip(w, g, strict=True) if not y).encode())) for i, w, g in _removed_words(rows))
    assert _by(got, "n_words", "n_removed", "kept_sha256") == want


def _removed_bytes(rows, k=100):
    seen, out = {}, []
    order = sorted({(-(2**63) if r[0] is None else r[0], (r[1] or "").encode()) for r in rows if r[0] != 65 or len(rows[0]) == 2}, key=lambda x: x[0])
    done = {}
    for i, b in order:
        edge = np.zeros(len(b) + 1, int)
        for j in range(len(b) - k + 1):
            if b[j : j + k] in seen:
                edge[j] += 1
                edge[j + k] -= 1
            else:
                seen[b[j : j + k]] = 1
        done[i, b] = np.cumsum(edge[:-1]) > 0
    for i, t, *_ in rows:
        if i != 65 or len(rows[0]) == 2:
            b = (t or "").encode()
            g = done[-(2**63) if i is None else i, b]
            out.append((i, len(b), int(g.sum()), int(g[:1].sum() + (g[1:] & ~g[:-1]).sum()), _sha(bytes(x for x, y in zip(b, g, strict=True) if not y))))
    return Counter(out)


def test_suffix_dedup(docs, rows, empty, monkeypatch):
    some = docs.where("doc_id IS NULL OR doc_id <> 65")  # an id of two texts has an order of its own
    want = _removed_bytes(rows)
    assert any(k[2] for k in want)
    assert _by(suffix_dedup.suffix_dedup(some), "n_bytes", "n_removed", "n_spans", "kept_sha256") == want
    monkeypatch.setattr(suffix_dedup.repeated_spans, "__defaults__", (2,))  # nearly all by windows
    assert _by(suffix_dedup.suffix_dedup(some), "n_bytes", "n_removed", "n_spans", "kept_sha256") == want


def _fragments(rnd, k):
    """Buckets of strings that hold their bucket's anchor at one place each, as paths do."""
    out = []
    for bucket in range(rnd.randint(1, 4)):
        anchor = f"<{bucket}>"
        near = lambda n: "".join(rnd.choice("ab") for _ in range(n))
        sides = [near(k) for _ in range(3)]
        for _ in range(rnd.randint(1, 9)):
            left, right = rnd.choice(sides)[rnd.randint(0, 3) + 3 :], rnd.choice(sides)[: k - 3 - rnd.randint(0, 3)]
            out.append((bucket, (left + anchor + right).encode()))
    return [b for b, _ in out], [x for _, x in out]


def test_matching_statistics():
    rnd = random.Random(3)
    for _ in range(150):
        k = rnd.choice([8, 10, 13])
        bucket, raw = _fragments(rnd, k)
        seen = set()
        for text, got in zip(raw, suffix_dedup.marked(np.array(bucket), raw, k), strict=True):
            want = [i for i in range(len(text) - k + 1) if text[i : i + k] in seen]
            seen |= {text[i : i + k] for i in range(len(text) - k + 1)}
            assert got.tolist() == want


def test_run_length_index():
    """Neighbours and what they share follow from the samples alone, of which repeated texts have few."""
    raw = [b"the quick brown fox jumps over the lazy dog"] * 60 + [b"the quick brown cat jumps over the lazy dog"] * 3
    text = b"".join(x + b"\0" for x in raw)
    flat = np.frombuffer(text, np.uint8)
    ends = np.flatnonzero(flat == 0)
    symbols = flat.astype(np.int64) + len(raw)
    symbols[ends] = np.arange(len(raw))
    index = suffix_dedup.RunLengthIndex(symbols, flat, ends)
    order = sorted(range(len(text)), key=lambda i: symbols[i:].tolist())
    rest = [text[i : text.index(b"\0", i)] for i in range(len(text))]
    agree = lambda a, b: next((n for n, (x, y) in enumerate(zip(rest[a], rest[b])) if x != y), min(len(rest[a]), len(rest[b])))
    for side, pairs in ((0, list(zip(order[1:], order[:-1], strict=True))), (1, list(zip(order[:-1], order[1:], strict=True)))):
        at, other = map(np.array, zip(*pairs, strict=True))
        got, shared = index.neighbours(at, side)
        assert got.tolist() == other.tolist() and shared.tolist() == [agree(a, b) for a, b in pairs]
    held = [x for side in index.sides for x in side] + [index.symbol]
    assert max(map(len, held)) == len(index.symbol) < len(text) / 10  # as many samples as runs, no order of all positions
    assert {k for k, v in vars(index).items()} == {"symbol", "sides"}


def test_many_paths_of_one_anchor(spark, monkeypatch):
    """The edge of a passage that all texts have: rows stay in proportion, results are those of the index."""
    rnd = random.Random(9)
    line = lambda n: "".join(rnd.choice("abcdefgh ") for _ in range(n))
    passage = line(260)
    data = [(i, line(rnd.randint(90, 130)) + passage + line(rnd.randint(90, 130))) for i in range(120)]
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(4)
    want = _removed_bytes(data)
    made = []
    keep = suffix_dedup.stored
    monkeypatch.setattr(suffix_dedup.R, "stored", lambda d, name: made.append((name, keep(d, name))) or made[-1][1])
    monkeypatch.setattr(suffix_dedup, "discard", lambda *_: None)
    for cap in (2, 50, 20_000):
        made.clear()
        monkeypatch.setattr(suffix_dedup.repeated_spans, "__defaults__", (cap,))
        assert _by(suffix_dedup.suffix_dedup(df), "n_bytes", "n_removed", "n_spans", "kept_sha256") == want
        rows = {name: t.count() for name, t in made if name.endswith(("-pieces", "-windows"))}
        assert bool(rows) == (cap < 120) and all(n <= 30 * len(data) for n in rows.values())


def test_sharding(spark, docs, empty):
    for limit in (2000, 300, 1 << 30):
        got = sharding.shard(docs, limit=limit).collect()
        size, count, bits = Counter(), Counter(), {}
        for r in got:
            size[r.shard] += r.n_bytes
            count[r.shard] += 1
            bits[r.shard] = (r.depth, r.shard_docs, r.shard_bytes)
        for s in size:
            assert bits[s] == (len(s), count[s], size[s]) and (size[s] <= limit or count[s] == 1)
            up = s[:-1]
            assert not s or sum(v for k, v in size.items() if k.startswith(up)) > limit  # no split without need
        assert not any(a != b and b.startswith(a) for a in size for b in size)
    with_row = sharding.shard(docs.union(docs), limit=300).where("doc_id = 3").first()
    assert with_row["_row"] == "y" and sharding.shard(empty).count() == 0
    same = spark.createDataFrame([(5, "x" * 100)] * 50, "doc_id long, text string")
    assert max(r.shard_bytes for r in sharding.shard(same, limit=1000).collect()) <= 1000


def test_quality_counts(docs, rows):
    got = Counter(tuple(r[c] for c in ("doc_id", *quality_rules.COUNTS, "base_failed")) for r in quality_rules.quality_rules(docs).collect())
    want = Counter()
    for i, t, *_ in rows:
        t = t or ""
        w = WORD.findall(t)
        seen, dup = set(), 0
        for x in t.split("\n"):
            if WORD.search(x):
                dup += x in seen
                seen.add(x)
        tri = Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
        rep = {k + j for k in range(len(w) - 2) if tri[tuple(w[k : k + 3])] > 1 for j in range(3)}
        want[i, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(rep), len(w) < 50 or 100 * len(rep) > 50 * len(w)] += 1
    assert got == want
    assert not quality_rules.quality_rules(docs).where("kept AND base_failed").count()


def test_sketches_merge(spark):
    from tessera.llm.quality_rules import RULES, sketches, thresholds

    rnd = random.Random(1)
    data = [(rnd.choice("xy"), *[rnd.randint(0, 900) for _ in range(6)]) for _ in range(500)]
    df = spark.createDataFrame(data, "g string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long")
    one, two = sketches(df.limit(200), ["g"]), sketches(df.subtract(df.limit(200)), ["g"])
    merged = one.unionByName(two).groupBy("g", "rule", "bin").agg(F.sum("n").alias("n"))
    assert sorted(map(tuple, thresholds(merged, ["g"]).collect())) == sorted(map(tuple, thresholds(sketches(df.distinct(), ["g"]), ["g"]).collect()))
    assert len(RULES) * 2 == thresholds(merged, ["g"]).count()


def test_unlike_groups_have_unlike_thresholds(spark):
    rnd, rows = random.Random(6), []
    words = [f"w{i}" for i in range(5000)]
    for i in range(1400):
        lang, source = [("a", "code"), ("a", "prose"), ("a", "few"), ("b", "few")][(i % 2) if i < 1200 else 2 + i % 2]
        share = rnd.random() * (0.4 if source == "code" else 0.9 if lang == "b" else 0.02)
        text = [w + "#" * (rnd.random() < share) for w in rnd.sample(words, 100)]
        rows.append((i, " ".join(text), lang, source))
    rows += [(5000, " ".join(w + "#" * (k % 3 == 0) for k, w in enumerate(words[:100])), "a", "code"), (5001, " ".join(w + "#" * (k % 3 == 0) for k, w in enumerate(words[:100])), "a", "prose")]
    got = {r.doc_id: r.kept for r in quality_rules.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert got[5000] and not got[5001]  # as many symbols are usual in the one source only
    counts = quality_rules.counted(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"), keep_text=False)
    most = {(r.lang, r.source): r._most for r in quality_rules.thresholds(quality_rules.sketches(counts, ["lang", "source"]), ["lang", "source"]).where("rule = 'symbols'").collect()}
    assert len({most["a", "code"], most["a", "prose"], most["a", "few"]}) == 3  # the third has too few documents: that of its language
    assert most["b", "few"] not in (None, most["a", "few"])  # too few of the language: that of all
    assert {r._most for r in quality_rules.thresholds(quality_rules.sketches(counts, ["lang", "source"]), ["lang", "source"]).where("rule = 'dup_lines'").collect()} == {None}
    with_name = quality_rules.quality_rules(spark.createDataFrame([(1, "x", "a", "b", 7)], "doc_id long, text string, lang string, source string, n_lines int"))
    assert with_name.first()["n_lines"] == 7


def test_components(spark):
    from tessera.llm.components import components

    rnd = random.Random(5)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(180)] + [(k, k + 1) for k in range(1000, 1040)] + [(9, 9)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long"), "t").collect()}
    label = {x: x for e in edges for x in e}
    for a, b in edges:
        x, y = sorted((label[a], label[b]))
        label = {k: x if v == y else v for k, v in label.items()}
    least = {}
    for k, v in label.items():
        least[v] = min(least.get(v, k), k)
    assert got == {k: least[v] for k, v in label.items() if least[v] != k}
    assert components(spark.createDataFrame([], "u long, v long"), "t").count() == 0


def test_prefilter_loses_nothing(spark):
    from tessera.llm.prefilter import maybe_in

    rows = spark.range(20000).select(F.xxhash64("id").alias("k"), "id")
    wanted = rows.where("id % 100 = 7").select("k")
    got = maybe_in(rows, wanted, "k")
    assert got.join(wanted, "k", "left_semi").count() == 200 and got.count() < 260 and got.columns == rows.columns
    assert maybe_in(rows, wanted.limit(0), "k").count() == 0


def test_ids_must_be_whole_numbers(spark):
    df = spark.createDataFrame([("a", "x")], "doc_id string, text string")
    for run in (line_dedup.line_dedup, ngram_join.ngram_components, substring_dedup.substring_dedup, suffix_dedup.suffix_dedup):
        with pytest.raises(TypeError):
            run(df)


def test_tables_of_others_stay(spark):
    from tessera.llm.scratch import delete, owned, stored

    other, mine = stored(spark.range(3), "t"), []
    with owned(mine):
        own = stored(spark.range(4), "t")
    assert len(mine) == 1 and own.count() == 4
    delete(spark, mine)
    assert other.count() == 3 and not mine


def test_no_local_scratch_on_a_cluster():
    from types import SimpleNamespace

    from tessera.llm.scratch import shared_dir

    far = SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=SimpleNamespace(applicationId="far", master="spark://there:7077"))
    with pytest.raises(RuntimeError):
        shared_dir(far)


def test_spans_of_other_words_are_found(spark):
    import pyarrow as pa

    words = [f"w{i}".encode() for i in range(64)]
    line, at = b" ".join(words) + b" ", np.cumsum([0] + [len(w) + 1 for w in words])
    marks = [[substring_dedup.chunk_digest(line[at[j] : at[j + 16]]) for j in (0, 16)], [substring_dedup.chunk_digest(b"other words")], []]
    got = substring_dedup._verified(line, at, np.array([0, 32, 60]), pa.array(marks, pa.list_(pa.int64())), 16)
    assert got.tolist() == [True, False, True]
