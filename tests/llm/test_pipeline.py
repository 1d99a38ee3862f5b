"""The pipeline against plain Python."""

import struct
import zlib
from collections import Counter

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from tests.llm.test_operators import WORD, _removed_words, _rows

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
PIECES = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _id(i):
    return -(2**63) if i is None else i


def _documents():
    """Nulls, repeated ids and rows, near copies without an id or of one id, a passage repeated within a document."""
    rows = [r[:4] for r in _rows()]
    own = lambda k, n: " ".join(f"w{k}x{j}" for j in range(n))
    rows += [(None, own(1, 90), "de", "t"), (None, own(1, 90) + " end", "de", "t"), (None, own(2, 90), "de", "t")]
    rows += [(70, own(3, 90), "de", "t"), (70, own(3, 90) + " end", "de", "t"), (70, own(4, 90), "de", "t"), (71, own(4, 90) + " more", None, "t")]
    rows += [(80, own(5, 9) + " " + own(6, 20) + " " + own(7, 40), "de", "t"), (81, f"{own(8, 60)} {own(6, 20)} {own(8, 30)[::-1]} {own(6, 20)} end", "de", "t")]
    return [(*r, len(r[1] or "")) for r in rows]


def _near_copies(rows):
    rows = sorted(set(rows), key=lambda r: (_id(r[0]), r[1] or ""))
    sets = []
    for r in rows:
        w = WORD.findall((r[1] or "").translate(LOW))
        sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    label = list(range(len(rows)))
    for x in range(len(rows)):
        for y in range(x):
            same = rows[x][:2] == rows[y][:2]
            if same or (sets[x] and sets[y] and 100 * len(sets[x] & sets[y]) >= 80 * len(sets[x] | sets[y])):
                a, b = label[x], label[y]
                label = [b if v == a else v for v in label]
    groups = {}
    for r, v in zip(rows, label, strict=True):
        groups.setdefault(v, []).append(r)
    return list(groups.values())


def _one_of_each(got, groups):
    """Each group has one row in got, of its smallest id; which text of that id is the order of a hash."""
    left = Counter(got)
    for g in groups:
        least = [r for r in g if _id(r[0]) == min(_id(x[0]) for x in g)]
        stay = [r for r in g if left[r]]
        assert len(stay) == 1 and stay[0] in least and left.pop(stay[0]) == 1
    assert not +left


def test_one_near_copy_of_each_group_stays(spark):
    rows = _documents()
    got = pipeline.near_copies(spark, spark.createDataFrame(rows, SCHEMA).repartition(5), "")
    assert got.columns == pipeline.COLUMNS
    _one_of_each([tuple(r) for r in got.collect()], _near_copies(rows))


def _quality(rows):
    counts = []
    for _, t, *_ in rows:
        t = t or ""
        w, seen, dup, n = WORD.findall(t), set(), 0, 0
        for x in t.split("\n"):
            if WORD.search(x):
                n, dup = n + 1, dup + (x in seen)
                seen.add(x)
        tri = Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
        rep = len({k + j for k in range(len(w) - 2) if tri[tuple(w[k : k + 3])] > 1 for j in range(3)})
        parts = {"symbols": (sum(c in "#*$%&|<>" for c in t), len(w)), "dup_lines": (dup, n), "repeats": (rep, len(w)), "word_length": (sum(map(len, w)), len(w))}
        counts.append((len(w) < 50 or 100 * rep > 50 * len(w), {r: 1000 * a // b if b else 0 for r, (a, b) in parts.items()}))
    bin_ = lambda v: v if v < 64 else (v.bit_length() - 6) * 32 + (v >> (v.bit_length() - 6))
    least_of = lambda b: b if b < 64 else (b - 32 * (b // 32 - 1)) << (b // 32 - 1)

    def fence(rule, like, least):
        v = sorted(bin_(x[rule]) for r, (bad, x) in zip(rows, counts, strict=True) if not bad and like(r))
        if len(v) < least:
            return None
        mid, high = (least_of(v[-(-q * len(v) // 100) - 1]) for q in (50, 95))
        return bin_(high + 3 * (high - mid)) if high > mid else None

    def passes(r, rule, value):
        for like, least in ((lambda x: x[2:4] == r[2:4], 200), (lambda x: x[2] == r[2], 200), (lambda x: True, 1)):
            most = fence(rule, like, least)
            if most is not None:
                return bin_(value) <= most
        return True

    return [r for r, (bad, x) in zip(rows, counts, strict=True) if not bad and all(passes(r, k, v) for k, v in x.items())]


def _lines(rows):
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(LOW)
    holds = {}
    for i, t, *_ in rows:
        for x in (t or "").split("\n"):
            holds.setdefault(key(x), set()).add(_id(i))
    bad = {k: max(v) for k, v in holds.items() if len(k) >= 40 and len(v) >= 5}
    texts = ["\n".join(x for x in (r[1] or "").split("\n") if bad.get(key(x), _id(r[0])) == _id(r[0])) for r in rows]
    return [(r[0], t, *r[2:4], len(t)) for r, t in zip(rows, texts, strict=True)]


def _substrings(rows):
    out = []
    for r, (_, _, gone) in zip(rows, _removed_words(rows), strict=True):
        at = list(WORD.finditer(r[1] or ""))
        t = r[1] or ""
        if any(gone):
            t = "".join(t[at[j - 1].end() if j else 0 : m.end()] for j, m in enumerate(at) if not gone[j])
        out.append((r[0], t, *r[2:4], len(t)))
    return out


def _pieces(rows):
    tok, out = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), Counter()
    for i, t, *_ in rows:
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 2]
        n = -(-len(ids) // 1024)
        cut = [0, *[len(ids) - 1024 * (n - 1 - k) for k in range(n)]]
        for k in range(n):
            part = ids[cut[k] : cut[k + 1]]
            out[i, k, cut[k], len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part))] += 1
    return out


def test_stages_and_run(spark, tmp_path):
    rows = _documents()
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    want = {"quality_rules": _quality, "line_dedup": _lines, "substring_dedup": _substrings}
    for name, stage in pipeline.STAGES:
        df = stage(spark, spark.createDataFrame(rows, SCHEMA).repartition(3), str(tmp_path))
        got = [tuple(r) for r in df.collect()]
        if name == "best_fit_packing":
            assert df.columns == PIECES and Counter(r[:5] for r in got) == _pieces(rows)
            break
        assert df.columns == pipeline.COLUMNS
        if name == "ngram_jaccard_join":
            _one_of_each(got, _near_copies(rows))
        else:
            assert Counter(got) == Counter(want[name](rows)), name
        rows = got
    out = pipeline.run(spark, str(tmp_path))
    assert out.columns == PIECES and Counter(tuple(r)[:5] for r in out.collect()) == _pieces(rows)


def test_stages_of_an_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    for name, stage in pipeline.STAGES:
        df = stage(spark, docs, "")
        assert df.collect() == [] and (df.columns == PIECES or df.columns == pipeline.COLUMNS or set(PIECES) <= set(df.columns)), name


def test_rows_without_words_and_of_one_id(spark):
    """Repeated rows go, other texts of one id stay, with words or without; null ids among them."""
    long = " ".join(f"w{i}" for i in range(40))
    rows = [(1, ""), (1, ""), (1, None), (1, " "), (None, ""), (None, "?"), (None, "?"), (2, long), (2, long), (2, long.replace("w", "v")), (3, long), (None, long.upper().lower() + " more")]
    got = pipeline.near_copies(spark, spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], SCHEMA).repartition(4), "")
    found = Counter((r.doc_id, r.text or "") for r in got.collect())
    assert found == Counter([(1, ""), (1, " "), (None, ""), (None, "?"), (2, long.replace("w", "v")), (None, long + " more")])
