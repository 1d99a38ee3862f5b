"""Repair of conversations: the cheapest edits that give each one the order of roles of a dialogue.

A dynamic program runs over tensors of time, conversation and state: the conversations of a batch are bucketed by length,
and each turn updates the costs of all of them at once, from the last turn to the first. The costs are kept, and the edits
are traced from the first turn on, again for all conversations at once; the least letter that keeps the cost is taken.

Turns are ranged by conversation and turn and numbered, so that a conversation of any length lies in segments of at most
SEGMENT turns, which are worked on apart. What a segment costs from each state to each is a 4 x 4 matrix; the matrices of a
conversation give the costs that lie ahead of each segment, and the states in which the segments are entered.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import discard, stored

BLANKS = " \t\n\x0b\x0c\r"
#: Turns of a segment, as a power of two.
SEGMENT = 10
# fixed values: costs of edits
DELETE, REROLE, INSERT, TRUNCATED = 4, 3, 3, 3
_FAR = 1 << 40
#: States: nothing yet, after the system's turn, after the user's, after the assistant's. 4 is none.
_KEPT = np.array([[1, 4, 4, 4], [2, 2, 4, 2], [4, 4, 3, 4], [4, 4, 4, 4]])  # by class of role (s, u, a, other) and state
_TURNED = np.array([2, 2, 3, 2])  # where a turn of the role that a state asks for leads
_KEEP_COST, _TURN_COST = np.array([0, _FAR, _FAR, TRUNCATED]), np.array([REROLE, _FAR, _FAR, REROLE + TRUNCATED])  # by fault
_NAMES = ("", "", "user", "assistant")
#: What lies ahead after the last turn: a dialogue ends as it began or with the assistant's turn.
_END = (0, 2 * INSERT, INSERT, 0)
_LEGAL = {(0, 1), (1, 2), (2, 1)}


def backward_costs(codes: np.ndarray, ahead: np.ndarray) -> np.ndarray:
    """Costs [T + 1, conversations, 4] of what is still to be done before each turn in each state. codes [T, conversations] are
    4 * class + fault (0 none, 1 blank, 2 duplicate, 3 truncated), -1 after a conversation's end; ahead: costs after the last."""
    steps, n = codes.shape
    costs = np.empty((steps + 1, n, 4), np.int64)
    costs[steps] = ahead
    far = np.full((n, 1), _FAR)
    for t in range(steps - 1, -1, -1):
        kind, fault, later = codes[t] >> 2, codes[t] & 3, costs[t + 1]
        keep = np.take_along_axis(np.hstack([later, far]), _KEPT[kind], 1) + _KEEP_COST[fault][:, None]
        best = np.minimum(np.minimum(keep, later[:, _TURNED] + _TURN_COST[fault][:, None]), later + DELETE)
        for _ in range(2):
            best = np.minimum(best, best[:, _TURNED] + INSERT)
        costs[t] = np.where((codes[t] >= 0)[:, None], best, later)
    return costs


def trace(codes: np.ndarray, costs: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Letters [T, conversations, 3] (up to two insertions and the turn's own, 0 for none) of the cheapest edits from these
    states, the ASCII-least of equally cheap ones, and the states after the last turn."""
    steps, n = codes.shape
    letters, state, each = np.zeros((steps, n, 3), np.uint8), start.copy(), np.arange(n)
    for t in range(steps):
        live, kind, fault, later = codes[t] >= 0, codes[t] >> 2, codes[t] & 3, np.hstack([costs[t + 1], np.full((n, 1), _FAR)])
        for r in range(2):
            here = costs[t][each, state]
            put = live & (later[each, state] + DELETE != here) & (costs[t][each, _TURNED[state]] + INSERT == here)
            letters[t, put, r] = ord("I")
            state = np.where(put, _TURNED[state], state)
        here, kept = costs[t][each, state], _KEPT[kind, state]
        gone = live & (later[each, state] + DELETE == here)
        stays = live & ~gone & (later[each, kept] + _KEEP_COST[fault] == here)
        letters[t, :, 2] = np.where(gone, ord("D"), np.where(stays, ord("K"), np.where(live, ord("R"), 0)))
        state = np.where(stays, kept, np.where(live & ~gone, _TURNED[state], state))
    return letters, state


def _buckets(codes: pd.Series) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of the conversations of a bucket of lengths, and their codes as a matrix [T, conversations]."""
    sizes = codes.map(len).to_numpy()
    wide = np.maximum(1, 2 ** np.ceil(np.log2(np.maximum(sizes, 1))).astype(int))
    for width in np.unique(wide):
        at = np.flatnonzero(wide == width)
        out = np.full((width, len(at)), -1, np.int64)
        for j, i in enumerate(at):
            out[: sizes[i], j] = codes.iloc[i]
        yield at, out


def _transfers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """m: what a segment costs from each state (rows) to each (columns)."""
    for b in batches:
        m = np.empty((len(b), 4, 4), np.int64)
        for at, codes in _buckets(b["codes"]):
            for to in range(4):
                m[at, :, to] = backward_costs(codes, np.where(np.arange(4) == to, 0, _FAR))[0]
        yield b[["_c", "_seg"]].assign(m=[x.ravel() for x in m])


def _aheads(segments: pd.DataFrame) -> pd.DataFrame:
    """ahead: the costs after each segment of a conversation. It has one matrix for 2^SEGMENT turns."""
    segments, now, out = segments.sort_values("_seg"), np.array(_END, np.int64), []
    for m in reversed(segments["m"].tolist()):
        out.append(now)
        now = (np.asarray(m).reshape(4, 4) + now).min(1)
    return segments[["_c", "_seg"]].assign(ahead=out[::-1])


def _exits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """exits: the state after a segment, for each state before it."""
    for b in batches:
        exits = np.empty((len(b), 4), np.int64)
        for at, codes in _buckets(b["codes"]):
            costs = backward_costs(codes, np.stack(b["ahead"].iloc[at].tolist()))
            for start in range(4):
                exits[at, start] = trace(codes, costs, np.full(len(at), start))[1]
        yield b[["_c", "_seg", "ahead"]].assign(exits=list(exits))


def _entries(segments: pd.DataFrame) -> pd.DataFrame:
    """entry: the state in which each segment of a conversation is entered; more: whether another one follows."""
    segments, state, out = segments.sort_values("_seg"), 0, []
    for exits in segments["exits"]:
        out.append(state)
        state = int(exits[state])
    return segments[["_c", "_seg", "ahead"]].assign(entry=out, more=[True] * (len(out) - 1) + [False])


def _walk(audit: str, state: int, codes, roles, texts) -> Iterator[tuple[str, int, str | None, str | None]]:
    """(edit, cost, role, text) of each letter of an audit; a deleted turn has no role."""
    i = 0
    for letter in audit:
        if letter == "I":
            state = int(_TURNED[state])
            yield letter, INSERT, _NAMES[state], ""
            continue
        kind, cut = int(codes[i]) >> 2, TRUNCATED * (int(codes[i]) & 3 == 3)
        if letter == "D":
            yield letter, DELETE, None, texts[i]
        elif letter == "K":
            state = int(_KEPT[kind, state])
            yield letter, cut, roles[i], texts[i]
        else:
            state = int(_TURNED[state])
            yield letter, REROLE + cut, _NAMES[state], texts[i]
        i += 1


_EDITED = "_c string, _seg long, edits array<struct<edit:string,cost:int,role:string,text:string>>, audit string"


def _edited(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """edits and audit of each segment."""
    for b in batches:
        audits = np.empty(len(b), object)
        for at, codes in _buckets(b["codes"]):
            letters, state = trace(codes, backward_costs(codes, np.stack(b["ahead"].iloc[at].tolist())), b["entry"].to_numpy()[at].astype(int))
            flat = letters.transpose(1, 0, 2).reshape(len(at), -1)
            more = b["more"].to_numpy()[at]
            for j, i in enumerate(at):
                left = 0 if more[j] else (0, 2, 1, 0)[state[j]]
                audits[i] = flat[j].tobytes().replace(b"\0", b"").decode() + "I" * left
        walks = [[{"edit": e, "cost": c, "role": r, "text": t} for e, c, r, t in _walk(*row)] for row in zip(audits, b["entry"].astype(int), b["codes"], b["roles"], b["texts"], strict=True)]
        yield b[["_c", "_seg"]].assign(edits=walks, audit=audits)


def _joined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row a conversation from its segments, which come in order: sums, the audit's parts and the hash of its text, so far."""
    now = None

    def row(x):
        return pd.DataFrame([{"_c": x["c"], "illegal": x["illegal"], "blank": x["blank"], "duplicate": x["duplicate"], "truncated": x["truncated"], "cost": x["cost"], "audit": "".join(x["audit"]), "repaired_sha256": x["sha"].hexdigest()}])

    for b in batches:
        for r in b.itertuples():
            if now is None or now["c"] != r._1:
                if now:
                    yield row(now)
                now = {"c": r._1, "illegal": 0, "blank": 0, "duplicate": 0, "truncated": 0, "cost": 0, "audit": [], "sha": hashlib.sha256(), "last": None, "any": False}
            now["illegal"] += r.illegal + (now["last"] is not None and (now["last"], r.first_class) not in _LEGAL)
            now["last"] = r.last_class
            for c in ("blank", "duplicate", "truncated", "cost"):
                now[c] += getattr(r, c)
            now["audit"].append(r.audit)
            if r.piece is not None:
                now["sha"].update((("\n" if now["any"] else "") + r.piece).encode())
                now["any"] = True
    if now:
        yield row(now)


def _key(column: str):
    return F.when(F.col(column).isNull(), F.lit("")).otherwise(F.concat(F.lit("#"), F.col(column).cast("string")))


def _numbered(turns: DataFrame, name: str) -> DataFrame:
    """conv_id, turn, role, text -> the same with _c, _pos (ascending with conversation and turn), _class, _fault (but for
    duplicates) and a hash of role and text, stored."""
    rows = turns.select("conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"))
    core = F.btrim("text", F.lit(BLANKS))
    initial = F.left("role", F.lit(1))
    rows = rows.withColumns({
        "_c": _key("conv_id"), "_class": F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3),
        "_fault": F.when(core == "", 1).when(~F.right(core, F.lit(1)).isin(".", "!", "?"), 3).otherwise(0),
        "_h1": F.xxhash64("role", "text"), "_h2": F.xxhash64(F.lit(11), F.reverse("text"), "role"), "_salt": F.monotonically_increasing_id(),
    })
    # equal rows may lie in any order, so their number splits a large group of them
    order = [F.col("_c"), F.col("turn").asc_nulls_first(), F.col("role"), F.left("text", F.lit(32)), F.col("_h1"), F.col("_salt")]
    return stored(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_pos", F.monotonically_increasing_id()).drop("_salt"), f"{name}-turns")


def _segments(rows: DataFrame, name: str) -> DataFrame:
    """_c, _seg, codes, roles, texts, entry, ahead, more, alone (whether its conversation is one segment), of numbered rows."""
    first = rows.groupBy("_c", "_h1", "_h2").agg(F.min("_pos").alias("_pos")).select("_pos", F.lit(True).alias("_first"))
    fault = F.when(F.col("_fault") == 1, 1).when(F.col("_first").isNull(), 2).otherwise(F.col("_fault"))
    seg = F.shiftright("_pos", SEGMENT).alias("_seg")
    coded = rows.select("_c", "_pos", "_class", "_fault").join(first, "_pos", "left").select("_c", seg, "_pos", (F.col("_class") * 4 + fault).alias("code"))
    in_order = lambda c: F.array_sort(F.collect_list(F.struct("_pos", *c)))
    codes = stored(coded.groupBy("_c", "_seg").agg(in_order(["code"]).alias("x")).select("_c", "_seg", F.transform("x", lambda x: x["code"]).alias("codes")), f"{name}-codes")
    many = codes.groupBy("_c").agg(F.count("*").alias("n")).where("n > 1").select("_c")
    parts = stored(codes.join(many, "_c", "left_semi"), f"{name}-parts")
    matrices = stored(parts.mapInPandas(_transfers, "_c string, _seg long, m array<long>"), f"{name}-matrices")
    aheads = stored(matrices.groupBy("_c").applyInPandas(_aheads, "_c string, _seg long, ahead array<long>"), f"{name}-aheads")
    exits = stored(parts.join(aheads, ["_c", "_seg"]).mapInPandas(_exits, "_c string, _seg long, ahead array<long>, exits array<long>"), f"{name}-exits")
    entries = stored(exits.groupBy("_c").applyInPandas(_entries, "_c string, _seg long, ahead array<long>, entry int, more boolean"), f"{name}-entries")
    discard(matrices, aheads, exits, parts)
    texts = rows.select("_c", seg, "_pos", "role", "text").groupBy("_c", "_seg").agg(in_order(["role", "text"]).alias("x"))
    texts = texts.select("_c", "_seg", F.transform("x", lambda x: x["role"]).alias("roles"), F.transform("x", lambda x: x["text"]).alias("texts"))
    end = F.array(*[F.lit(x).cast("long") for x in _END])
    return texts.join(codes, ["_c", "_seg"]).join(entries, ["_c", "_seg"], "left").select(
        "_c", "_seg", "codes", "roles", "texts", F.coalesce("entry", F.lit(0)).alias("entry"), F.coalesce("ahead", end).alias("ahead"), F.coalesce("more", F.lit(False)).alias("more"), F.col("entry").isNull().alias("alone")
    )


def repaired_turns(turns: DataFrame, name: str = "repaired") -> DataFrame:
    """turns (conv_id, turn, role, text) -> conv_id, position (long, ascending within a conversation), edit (K, R, D or I), role,
    text: what the cheapest edits make of each conversation, deleted turns included (without a role).

    Nulls and order as in conversation_repair. One row for each turn and each insertion."""
    rows = _numbered(turns, name)
    edited = stored(_segments(rows, name).mapInPandas(_edited, _EDITED), f"{name}-edits")
    ids = rows.groupBy("_c").agg(F.first("conv_id").alias("conv_id"))
    opened = edited.select("_c", "_seg", F.posexplode("edits").alias("_at", "e"))
    return opened.join(ids, "_c").select("conv_id", (F.col("_seg") * (4 << SEGMENT) + F.col("_at")).alias("position"), "e.edit", "e.role", "e.text")


def conversation_repair(turns: DataFrame, name: str = "repair") -> DataFrame:
    """turns (conv_id, turn, role, text) -> one row a conversation: conv_id; gaps (turn numbers missing between the least and
    the largest), blank, duplicate, truncated (turns whose first fault that is), illegal (neighbouring turns whose roles don't
    follow each other), cost (long); audit (the edits' initials); repaired_sha256 (of `role:text`, joined by newlines).

    Turns are taken by number, nulls first; turns of one number by role and text (its first 32 letters, then a hash). Null
    roles and texts are one space; turns without a conv_id are one conversation. Repeated rows are duplicates. An empty table
    gives no rows; other columns are left out. Long texts and conversations of any length are taken whole: only numbers, the
    audit and a hash's state are held for a whole conversation.
    """
    rows = _numbered(turns, name)
    edited = _segments(rows, name)
    cls, fault = F.transform("codes", lambda c: F.shiftright(c, 2)), F.transform("codes", lambda c: c.bitwiseAND(F.lit(3)))
    follows = F.zip_with(F.slice(cls, 1, F.size(cls) - 1), F.slice(cls, 2, F.size(cls)), lambda a, b: ((a == 0) & (b == 1)) | ((a == 1) & (b == 2)) | ((a == 2) & (b == 1)))
    count = lambda k: F.size(F.filter(fault, lambda f: f == k)).cast("long")
    facts = edited.select("_c", "_seg", "alone", F.when(F.size(cls) > 1, F.size(F.filter(follows, lambda x: ~x))).otherwise(F.lit(0)).cast("long").alias("illegal"), *[count(k).alias(n) for k, n in ((1, "blank"), (2, "duplicate"), (3, "truncated"))], F.element_at(cls, 1).alias("first_class"), F.element_at(cls, -1).alias("last_class"))
    edits = edited.mapInPandas(_edited, _EDITED)
    lines = F.transform(F.filter("edits", lambda e: e["role"].isNotNull()), lambda e: F.concat(e["role"], F.lit(":"), e["text"]))
    pieces = edits.select("_c", "_seg", "audit", F.aggregate("edits", F.lit(0).cast("long"), lambda s, e: s + e["cost"]).alias("cost"), F.when(F.size(lines) > 0, F.array_join(lines, "\n")).alias("piece"))
    pieces = stored(pieces, f"{name}-pieces")
    facts = stored(facts, f"{name}-facts")
    both = facts.join(pieces, ["_c", "_seg"])
    one = both.where("alone").select("_c", "illegal", "blank", "duplicate", "truncated", "cost", "audit", F.sha2(F.coalesce("piece", F.lit("")), 256).alias("repaired_sha256"))
    rest = both.where("NOT alone").repartition("_c").sortWithinPartitions("_c", "_seg").select("_c", "illegal", "blank", "duplicate", "truncated", "first_class", "last_class", "cost", "audit", "piece")
    rest = rest.mapInPandas(_joined, "_c string, illegal long, blank long, duplicate long, truncated long, cost long, audit string, repaired_sha256 string")
    gaps = rows.groupBy("_c").agg(F.first("conv_id").alias("conv_id"), F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long").alias("gaps"))
    return one.unionByName(rest).join(gaps, "_c").select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def damaged(turns: DataFrame) -> DataFrame:
    """turns (conv_id, turn, role, text), with a fault in every fourth or so by crc32('<conv_id>:<turn>') % 20: 0 drops the turn,
    1 empties its text, 2 takes the marks .!? out of it, 3 repeats it, 4 makes its role user. Nulls are one space there."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn"))) % 20
    rows = turns.select("conv_id", "turn", blank("role").alias("role"), blank("text").alias("text"), kind.alias("_k")).where("_k <> 0")
    text = F.when(F.col("_k") == 1, F.lit("")).when(F.col("_k") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.explode(F.when(F.col("_k") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("_n")
    return rows.select("conv_id", "turn", F.when(F.col("_k") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"), text.alias("text"), copies).drop("_n")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    found = conversation_repair(damaged(turns))
    every = turns.select("conv_id", _key("conv_id").alias("_c")).groupBy("_c").agg(F.first("conv_id").alias("conv_id"))
    out = every.join(found.withColumn("_c", _key("conv_id")).drop("conv_id"), "_c", "left")
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select("conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


#: The same rows in DuckDB SQL: forward, with the least cost and audit of each state after each turn.
SQL = r"""
WITH RECURSIVE crc_table AS (
  SELECT list(r ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i::BIGINT, range(0, 8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END) AS r FROM range(0, 256) g(i))
), raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations
), hashed AS (
  SELECT conv_id, turn, role, text, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(k, ''), lambda x: ascii(x)::BIGINT)),
         lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])), 4294967295::BIGINT) % 20 AS f FROM raw, crc_table
), turns AS (
  SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role, CASE f WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(range(0, CASE WHEN f = 3 THEN 2 ELSE 1 END)) AS copy FROM hashed WHERE f <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i, left(role, 1) AS initial,
         trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS core FROM turns
), coded AS (
  SELECT *, CASE WHEN core = '' THEN 1 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 2 WHEN right(core, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault,
         lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS former FROM placed
), facts AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate,
         count(*) FILTER (fault = 3) AS truncated, count(*) FILTER (i > 1 AND former || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM coded GROUP BY 1
), put(s, letters, cost, s1) AS (
  VALUES (0, '', 0, 0), (1, '', 0, 1), (2, '', 0, 2), (3, '', 0, 3), (0, 'I', 3, 2), (1, 'I', 3, 2), (3, 'I', 3, 2), (2, 'I', 3, 3), (0, 'II', 6, 3), (1, 'II', 6, 3)
), act(letter, cost, initial, s1, s2) AS (
  VALUES ('D', 4, NULL, 0, 0), ('D', 4, NULL, 1, 1), ('D', 4, NULL, 2, 2), ('D', 4, NULL, 3, 3), ('K', 0, 's', 0, 1), ('K', 0, 'u', 0, 2), ('K', 0, 'u', 1, 2), ('K', 0, 'u', 3, 2), ('K', 0, 'a', 2, 3),
         ('R', 3, NULL, 0, 2), ('R', 3, NULL, 1, 2), ('R', 3, NULL, 3, 2), ('R', 3, NULL, 2, 3)
), dp AS (
  SELECT conv_id, 0::BIGINT AS i, 0 AS s, 0 AS cost, '' AS audit FROM facts
  UNION ALL
  SELECT conv_id, i, s, m.cost, m.audit FROM (
    SELECT d.conv_id, c.i, a.s2 AS s, min({'cost': d.cost + p.cost + a.cost + CASE WHEN c.fault = 3 AND a.letter <> 'D' THEN 3 ELSE 0 END, 'audit': d.audit || p.letters || a.letter}) AS m
    FROM dp d JOIN coded c ON c.conv_id IS NOT DISTINCT FROM d.conv_id AND c.i = d.i + 1 JOIN put p ON p.s = d.s
    JOIN act a ON a.s1 = p.s1 AND (a.letter = 'D' OR c.fault NOT IN (1, 2)) AND (a.initial IS NULL OR a.initial = c.initial)
    GROUP BY 1, 2, 3)
), ends AS (
  SELECT d.conv_id, min({'cost': d.cost + p.cost, 'audit': d.audit || p.letters}) AS m FROM dp d JOIN facts f ON f.conv_id IS NOT DISTINCT FROM d.conv_id AND f.n = d.i JOIN put p ON p.s = d.s AND p.s1 IN (0, 3) GROUP BY 1
), letters AS (
  SELECT conv_id, unnest(string_split(m.audit, '')) AS letter, generate_subscripts(string_split(m.audit, ''), 1) AS pos FROM ends WHERE m.audit <> ''
), lettered AS (
  SELECT *, sum(CASE WHEN letter <> 'I' THEN 1 ELSE 0 END) OVER w AS i, sum(CASE WHEN letter <> 'D' THEN 1 ELSE 0 END) OVER w AS j FROM letters WINDOW w AS (PARTITION BY conv_id ORDER BY pos)
), lines AS (
  SELECT l.conv_id, l.pos, l.letter, l.j, c.role, c.text, bool_or(l.letter = 'K' AND c.initial = 's') OVER (PARTITION BY l.conv_id) AS has_s
  FROM lettered l LEFT JOIN coded c ON c.conv_id IS NOT DISTINCT FROM l.conv_id AND c.i = l.i AND l.letter <> 'I' WHERE l.letter <> 'D'
), hashes AS (
  SELECT conv_id, sha256(string_agg(CASE WHEN letter = 'K' THEN role WHEN (j % 2 = 1) <> has_s THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN letter = 'I' THEN '' ELSE text END, chr(10) ORDER BY pos)) AS h FROM lines GROUP BY 1
), every AS (
  SELECT DISTINCT conv_id FROM conversations
)
SELECT e.conv_id, coalesce(f.gaps, 0)::BIGINT AS gaps, coalesce(f.blank, 0) AS blank, coalesce(f.duplicate, 0) AS duplicate, coalesce(f.truncated, 0) AS truncated, coalesce(f.illegal, 0) AS illegal,
       coalesce(x.m.cost, 0)::BIGINT AS cost, coalesce(x.m.audit, '') AS audit, coalesce(h.h, sha256('')) AS repaired_sha256
FROM every e LEFT JOIN facts f ON f.conv_id IS NOT DISTINCT FROM e.conv_id LEFT JOIN ends x ON x.conv_id IS NOT DISTINCT FROM e.conv_id LEFT JOIN hashes h ON h.conv_id IS NOT DISTINCT FROM e.conv_id
"""
