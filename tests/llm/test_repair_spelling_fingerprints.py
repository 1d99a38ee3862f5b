"""Conversation repair, spelling variants and fingerprints against plain Python."""

import hashlib
import random
import re
import zlib
from functools import cache

import pytest
from pyspark.sql import functions as F

from tessera.llm import conversation_repair as repair
from tessera.llm import fingerprints as fp
from tessera.llm import spelling

TURNS = "conv_id long, turn long, role string, text string"


def cheapest(codes):
    """(cost, audit) by recursion over (turn, state) with every order of edits."""

    @cache
    def go(i, role):  # role: the last role of the result, '' at its start
        allowed = {"": "su", "s": "u", "u": "a", "a": "u"}[role]
        found = [(0, "")] if i == len(codes) and role in ("", "a") else []
        want = "a" if role == "u" else "u"
        if i < len(codes):
            initial, fault = codes[i]
            found += [(4 + c, "D" + a) for c, a in [go(i + 1, role)]]
            if fault not in ("blank", "duplicate"):
                more = 3 * (fault == "truncated")
                if initial and initial in allowed:
                    found += [(more + c, "K" + a) for c, a in [go(i + 1, initial)]]
                found += [(3 + more + c, "R" + a) for c, a in [go(i + 1, want)]]
        if want == "a":  # an insertion leads back to a role that needs no more of them
            found += [(3 + c, "I" + a) for c, a in [go(i, "a")]]
        else:
            found += [(3 + c, "I" + a) for c, a in [after_user(i)]]
        return min(found)

    @cache
    def after_user(i):
        found = [(3 + c, "I" + a) for c, a in [(0, "")] if i == len(codes)]
        if i < len(codes):
            initial, fault = codes[i]
            found += [(4 + c, "D" + a) for c, a in [go(i + 1, "u")]]
            if fault not in ("blank", "duplicate"):
                more = 3 * (fault == "truncated")
                if initial == "a":
                    found += [(more + c, "K" + a) for c, a in [go(i + 1, "a")]]
                found += [(3 + more + c, "R" + a) for c, a in [go(i + 1, "a")]]
        return min(found) if found else (10**9, "")

    return go(0, "")


def plain_repair(turns):
    out = {}
    for conv in {t[0] for t in turns}:
        rows = [(t, " " if r is None else r, " " if x is None else x) for c, t, r, x in turns if c == conv]
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, codes, counts = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, role, text in rows:
            core = text.strip(" \t\n\x0b\x0c\r")
            fault = "blank" if not core else "duplicate" if (role, text) in seen else "truncated" if core[-1] not in ".!?" else None
            seen.add((role, text))
            codes.append((role[:1], fault))
            if fault:
                counts[fault] += 1
        cost, audit = cheapest(tuple(codes))
        lines, last, i = [], "", 0
        for letter in audit:
            want = "assistant" if last == "u" else "user"
            if letter == "I":
                lines.append(f"{want}:")
                last = want[0]
                continue
            if letter == "K":
                lines.append(f"{rows[i][1]}:{rows[i][2]}")
                last = rows[i][1][0]
            elif letter == "R":
                lines.append(f"{want}:{rows[i][2]}")
                last = want[0]
            i += 1
        numbers = {t for t, _, _ in rows if t is not None}
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(codes, codes[1:]))
        out[conv] = (gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def random_turns(seed):
    rng, turns = random.Random(seed), []
    for conv in [*range(60), None]:
        for turn in range(rng.choice([1, 2, 3, 5, 9, 17])):
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool", None, ""])
            text = rng.choice(["Yes.", "No!", "why?", " ", "", "cut", None, f"word {rng.random()}.", f"cut {rng.random()}"])
            turns.append((conv, rng.choice([turn, turn, turn, turn + 3, None]), role, text))
    return turns


@pytest.mark.parametrize("segment", [1, 10])
def test_repair_equals_recursion(spark, monkeypatch, segment):
    """Segments of two turns too, so that nearly every conversation is put together from several."""
    monkeypatch.setattr(repair, "SEGMENT", segment)
    turns = random_turns(segment)
    found = repair.conversation_repair(spark.createDataFrame(turns, TURNS).withColumn("_c", F.lit(1))).collect()
    assert {r[0]: tuple(r)[1:] for r in found} == plain_repair(turns)


def test_repaired_turns_give_the_texts(spark, monkeypatch):
    monkeypatch.setattr(repair, "SEGMENT", 1)
    turns = random_turns(5)
    want = plain_repair(turns)
    rows = {}
    for r in repair.repaired_turns(spark.createDataFrame(turns, TURNS)).orderBy("conv_id", "position").collect():
        rows.setdefault(r.conv_id, []).append(r)
    for conv, parts in rows.items():
        assert "".join(r.edit for r in parts) == want[conv][6]
        assert hashlib.sha256("\n".join(f"{r.role}:{r.text}" for r in parts if r.role is not None).encode()).hexdigest() == want[conv][7]
        assert re.fullmatch("(s?(ua)+)?", "".join(r.role[0] for r in parts if r.role is not None))


def test_repair_of_nothing_and_of_copies(spark):
    assert repair.conversation_repair(spark.createDataFrame([], TURNS)).collect() == []
    row = repair.conversation_repair(spark.createDataFrame([(1, 0, "user", "Hi.")] * 3000 + [(1, 1, "assistant", "Yes.")], TURNS)).first()
    assert (row.duplicate, row.cost, row.audit) == (2999, 4 * 2999, "K" + "D" * 2999 + "K")


def test_damage(spark):
    turns = [(c, t, "assistant", "One. Two!") for c in range(30) for t in range(5)] + [(None, None, None, None)]
    got = sorted((tuple(r) for r in repair.damaged(spark.createDataFrame(turns, TURNS)).collect()), key=str)
    want = []
    for c, t, role, text in turns:
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if k:
            want += [(c, t, "user" if k == 4 else role, "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text)] * (2 if k == 3 else 1)
    assert got == sorted(want, key=str)


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_spelling(words):
    out = {}
    for w, n in words.items():
        others = [(-m, x) for x, m in words.items() if near(w, x)]
        top = min(others, default=None)
        form = top[1] if top and -top[0] >= 10 * n else None
        out[w] = (form, n, len(others), -top[0] if form else None)
    root = lambda w: root(out[w][0]) if out[w][0] else w
    return {w: (f, root(w), n, k, m) for w, (f, n, k, m) in out.items()}


def test_spelling_equals_all_pairs(spark):
    """Short words of few letters (many ties and repeated letters), and words around and over the length whose keys are hashes."""
    rng, words = random.Random(3), {}
    for size in (3, 4, 5):
        for _ in range(60):
            words["".join(rng.choice("aabé") for _ in range(size))] = rng.choice([2, 2, 3, 20, 30, 30, 400])
    for size in (63, 64, 65, 66, 67, 70):
        base = "".join(rng.choice("ab") for _ in range(size))
        for w in (base, base[:-1], base[1:], "z" + base, base[:5] + "ü" + base[6:], base[:-1] + "x", base[:30] + base[30] + base[30:]):
            words[w] = rng.choice([2, 20, 200, 2000])
    rows = spark.createDataFrame(list(words.items()), "word string, n int").select("word", F.explode(F.sequence(F.lit(1), "n")).alias("_i")).select("word")
    rows = rows.unionByName(spark.createDataFrame([(None,), ("lonely",)], "word string"))
    found = spelling.spelling_variants(rows).collect()
    assert {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in found} == plain_spelling(words)


def test_forms_lead_to_roots_over_many_steps(spark):
    words = [("a" * 7 + "bcdefghij"[:i], 10**i) for i in range(9, -1, -1)]
    rows = spark.createDataFrame([(w, w[:-1] if len(w) > 7 else None) for w, _ in words], "word string, form string")
    found = {r.form: r.root for r in spelling._roots(rows.where("form IS NOT NULL"), "roots").collect()}
    assert found == {w[:-1]: "a" * 7 for w, _ in words if len(w) > 7}


def test_damaged_words(spark):
    texts = [(1, "Straße ÀÉÎabcdef-Übermutig ×÷abcdef x"), (2, None), (None, "abcdefg HIJKLMNO " * 40), (3, ""), (4, " ".join(f"w{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10]}xyzxyz" for i in range(100)))]
    got = sorted(r.word for r in spelling.damaged_words(spark.createDataFrame(texts, "doc_id long, text string")).collect())
    want = []
    for i, text in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            want += [run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run]
    assert got == sorted(w for w in want if len(w) >= 7)
    assert any(len(w) == 8 for w in got)


def test_spelling_of_nothing(spark):
    assert spelling.spelling_variants(spark.createDataFrame([], "word string")).collect() == []
    with pytest.raises(ValueError):
        spelling.spelling_variants(spark.createDataFrame([], "word string"), times=1)


def plain_lanes(text):
    exact, like = [0] * fp.EXACT, [0] * fp.LIKE
    for line in text.split("\n"):
        for b in range(fp.EXACT // 8):
            h = hashlib.sha256(f"{fp.LIKE // 16 + b}:{line}".encode()).hexdigest()
            for j in range(8):
                exact[8 * b + j] += int(h[8 * j : 8 * j + 8], 16)
    for clause in re.split(fp.CLAUSE_ENDS, text):
        if clause.strip(" "):
            c = int(hashlib.md5(clause.strip(" ").encode()).hexdigest()[:4], 16)
            like[(c >> 6 & 1) * fp.LIKE // 2 + (c & 7) * 8 + (c >> 3 & 7)] += -1 if c >> 7 & 1 else 1
    return exact, like


def plain_fingerprint(text):
    exact, like = plain_lanes(text)
    return "".join(f"{x % 2**32:08x}" for x in exact) + "".join(f"{x % 2**16:04x}" for x in like)


TEXTS = ["", None, "one line", "b, c; d.\n\na! a! a! e?", "\n\n", "x.\ny.\nz.", "z.\nx.\ny.", "same. " * 70_000, "é, ü. 漢字、"]


def test_fingerprints_equal_plain_sums(spark):
    docs = spark.createDataFrame([(i, t, "kept", "old") for i, t in enumerate(TEXTS)], "doc_id long, text string, _row string, fingerprint string")
    found = {r.doc_id: r for r in fp.fingerprints(docs).collect()}
    assert {i: r.fingerprint for i, r in found.items()} == {i: plain_fingerprint(t or "") for i, t in enumerate(TEXTS)}
    assert found[5].fingerprint == found[6].fingerprint != found[4].fingerprint and found[0].fingerprint == found[1].fingerprint
    assert found[3]._row == "kept" and found[3].text == TEXTS[3]
    assert fp.fingerprints(docs.limit(0)).collect() == []


def test_paragraphs_are_added_and_taken_away(spark):
    docs = spark.createDataFrame([(0, "a, b.\nc"), (1, "d.\ne, f!"), (2, "d.\nc\ne, f!\na, b.")], "doc_id long, text string")
    a, b, both = (r.fingerprint for r in fp.fingerprints(docs).orderBy("doc_id").collect())
    row = spark.createDataFrame([(a, b, both)], "a string, b string, c string").select(fp.combined("a", "b").alias("sum"), fp.combined("c", "b", -1).alias("rest"), fp.likeness("c", "c").alias("same"), fp.likeness("a", "b").alias("none"), fp.likeness("a", "c").alias("half")).first()
    assert (row.sum, row.rest, row.same) == (both, a, 1.0)
    assert row.none < 0.3 < row.half < 0.9


@pytest.mark.parametrize("block_bytes", [1, 1 << 20])
def test_next_documents(spark, monkeypatch, block_bytes):
    """Each document meets its successor, however the blocks are cut; repeated rows, null ids and texts among them."""
    monkeypatch.setattr(fp, "BLOCK_BYTES", block_bytes)
    ids = [*range(0, 90, 3), 7, 7, 7, None, None, -5]
    docs = spark.createDataFrame([(i, None if k == 3 else f"text {k % 29}") for k, i in enumerate(ids)], "doc_id long, text string").repartition(3)
    rows = [r for r in fp.with_next(docs).collect() if not r.guest]
    assert len(rows) == len(ids)
    texts = {r.doc_id: r.text for r in rows}
    single = sorted((i for i in ids if i is not None and i != 7), reverse=True)
    after = {r.doc_id: r.next_text for r in rows if r.doc_id in single}
    for i, j in zip(single, single[1:]):
        if (i, j) != (9, 6):
            assert after[i] == texts[j]
    assert after[9] in {r.text for r in rows if r.doc_id == 7} and after[-5] in {r.text for r in rows if r.doc_id is None}
    assert texts[single[0]] in {r.next_text for r in rows if r.doc_id is None}
    assert sorted(r.text for r in rows) == sorted(r.next_text for r in rows)


def test_one_document_follows_itself_and_none_gives_none(spark):
    schema = "doc_id long, text string"
    assert [r.next_text for r in fp.with_next(spark.createDataFrame([(1, "a")], schema)).collect() if not r.guest] == ["a"]
    assert fp.with_next(spark.createDataFrame([], schema)).collect() == []
    with pytest.raises(TypeError):
        fp.with_next(spark.createDataFrame([("1", "a")], "doc_id string, text string"))
