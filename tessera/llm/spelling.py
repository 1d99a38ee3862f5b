"""Spelling variants: words that differ by one letter, found without forming pairs.

A word is put under a key for each place: its text with that letter as a wildcard (prefix, place and suffix), its text
without that letter, and its text itself. Words that share a wildcard key differ by one replaced letter; a text without a
letter that is itself a word differs by one inserted or deleted letter. Each key keeps its number of words and its two most
frequent ones, from which every member takes how many others there are and which of them is the most frequent. The
alphabet bounds a key: at most 90 words share a wildcard, and 90 for each place a shortened text.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .scratch import discard, stored

LETTERS = "A-Za-zÀ-ÿ"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Keys of longer texts are hashes that follow from one pass over the word: a word of a million letters has as many keys.
LONG = 64
_PRIME, _BASE = (1 << 127) - 1, 0x9E3779B97F4A7C15F39CC0605CEDC835
_ENTRY = "key string, kind int, word string, n long"


def _without(word: Column, at: Column) -> Column:
    return F.concat(F.left(word, at), F.substr(word, at + 2))


def damaged_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 7, every: int = 31) -> DataFrame:
    """word: every run of letters, lower-cased in A-Z, of at least `least` letters; one row an occurrence. A run for which
    crc32('<id>:<run>') is divisible by `every` has lost one letter. A null text has no runs; a null id is the empty text."""
    runs = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("_id"), F.explode(F.regexp_extract_all(text_col, F.lit(f"[{LETTERS}]{{{least},}}"), F.lit(0))).alias("_run"))
    runs = runs.select("_id", F.translate("_run", _UPPER, _LOWER).alias("_run")).select("_run", F.crc32(F.concat_ws(":", "_id", "_run")).alias("_h"))
    lost = _without(F.col("_run"), (F.col("_h") % F.char_length("_run")).cast("int"))
    return runs.select(F.when(F.col("_h") % every == 0, lost).otherwise(F.col("_run")).alias("word")).where(F.char_length("word") >= least)


def _short_keys(words: DataFrame) -> DataFrame:
    """The keys of at most LONG letters, with built-in functions."""
    w, length = F.col("word"), F.char_length("word")
    places = F.sequence(F.lit(0), length - 1)
    entry = lambda key, kind: F.struct(key.alias("key"), F.lit(kind).alias("kind"))
    none = F.array().cast("array<struct<key:string,kind:int>>")
    wild = F.transform(places, lambda i: entry(F.concat(F.left(w, i), F.lit("*"), F.substr(w, i + 2)), 0))
    own_places = F.filter(places, lambda i: (i == 0) | (F.substr(w, i + 1, F.lit(1)) != F.substr(w, i, F.lit(1))))
    shorter = F.transform(own_places, lambda i: entry(_without(w, i), 1))
    keys = F.concat(F.when(length <= LONG, F.concat(F.array(entry(w, 0)), wild)).otherwise(none), F.when(length <= LONG + 1, shorter).otherwise(none))
    return words.where(length <= LONG + 1).select(F.explode(keys).alias("e"), "word", "n").select("e.*", "word", "n")


def _long_keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The keys of more than LONG letters as polynomial hashes: that of a text without or with another letter follows from
    the hashes of what stands before and behind."""
    for words in batches:
        for word, n in zip(words["word"], words["n"], strict=True):
            size, before, power = len(word), [0], [1]
            for c in word:
                before.append((before[-1] * _BASE + ord(c)) % _PRIME)
                power.append(power[-1] * _BASE % _PRIME)
            behind = lambda i, b=before, p=power, s=size: (b[s] - b[i] * p[s - i]) % _PRIME
            keys = [(before[size], 0)]
            for i in range(size):
                keys.append(((before[i] * power[size - i] + ord("*") * power[size - i - 1] + behind(i + 1)) % _PRIME, 0))
                if size > LONG + 1 and (i == 0 or word[i] != word[i - 1]):
                    keys.append(((before[i] * power[size - i - 1] + behind(i + 1)) % _PRIME, 1))
            for at in range(0, len(keys), 10_000):
                part = keys[at : at + 10_000]
                yield pd.DataFrame({"key": [f"#{k:x}" for k, _ in part], "kind": [kind for _, kind in part], "word": word, "n": n})


def near_words(words: DataFrame) -> DataFrame:
    """words (word, n; each word once) -> word, n_near, near, near_n: how many of the words differ by one replaced, inserted
    or deleted letter, and the one of largest n among them (ties: smallest in code-point order). Words without any are left
    out. Words of any length are compared whole (those over LONG letters by 127-bit hashes of their keys)."""
    keys = _short_keys(words).unionByName(words.where(F.char_length("word") > LONG).mapInPandas(_long_keys, _ENTRY))
    member = F.struct((-F.col("n")).alias("m"), F.col("word").alias("w"))
    # a key's own word comes first, then the others by n: the first two are all that a key keeps
    by_key = Window.partitionBy("key")
    in_order = by_key.orderBy("kind", F.desc("n"), "word")
    held = keys.withColumns({
        "_place": F.row_number().over(in_order), "_second": F.lead(member).over(in_order), "_first": F.first(F.struct("kind", member.alias("member"))).over(in_order),
        "_size": F.count("*").over(by_key.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
    })
    # kind 1 is a text without one letter: such words are near the key's own word only, not each other
    found = held.where((F.col("_size") > 1) & (F.col("_first.kind") == 0)).select(
        "word",
        F.when((F.col("_place") == 1) | (F.col("kind") == 0), F.col("_size") - 1).otherwise(F.lit(1)).alias("_n"),
        F.when(F.col("_place") == 1, F.col("_second")).otherwise(F.col("_first.member")).alias("_best"),
    )
    best = found.groupBy("word").agg(F.sum("_n").alias("n_near"), F.min("_best").alias("_best"))
    return best.select("word", "n_near", F.col("_best.w").alias("near"), (-F.col("_best.m")).alias("near_n"))


def _roots(forms: DataFrame, name: str) -> DataFrame:
    """forms (word, form) without circles -> form, root: where a form leads in the end. Steps double, so a chain of 18 forms
    (n grows tenfold a step) takes five rounds; only forms that have forms themselves take part."""
    tops = forms.select("form").distinct()
    steps = stored(tops.join(forms.select(F.col("word").alias("form"), F.col("form").alias("root")), "form"), f"{name}-steps")
    while True:
        ahead = steps.select(F.col("form").alias("root"), F.col("root").alias("_ahead"))
        if steps.join(ahead, "root", "left_semi").isEmpty():
            return tops.join(steps, "form", "left").select("form", F.coalesce("root", "form").alias("root"))
        old, steps = steps, stored(steps.join(ahead, "root", "left").select("form", F.coalesce("_ahead", "root").alias("root")), f"{name}-steps")
        discard(old)


def spelling_variants(occurrences: DataFrame, least_n: int = 2, times: int = 10, name: str = "spelling") -> DataFrame:
    """occurrences (word) -> word, form, root (string); n, n_near, form_n (long): one row a word that occurs at least
    least_n times, n.

    n_near counts the words that differ from it by exactly one letter (0 if none). form is the most frequent of them (ties:
    smallest in code-point order) if its n is at least `times` that of the word, which must be over 1, or else null; root
    is where forms lead in the end, the word itself if it has no form. Null words are left out; an empty table gives no
    rows. A word of any number of occurrences is summed before it is shuffled.
    """
    if times < 2:
        raise ValueError("a form must be at least twice as frequent as the word")
    words = stored(occurrences.where("word IS NOT NULL").groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_n), f"{name}-words")
    near = stored(near_words(words), f"{name}-near")
    taken = F.col("near_n") >= times * F.col("n")
    rows = stored(words.join(near, "word", "left").select("word", F.when(taken, F.col("near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(taken, F.col("near_n")).cast("long").alias("form_n")), f"{name}-rows")
    discard(near)
    roots = stored(_roots(rows.where("form IS NOT NULL").select("word", "form"), name), f"{name}-roots")
    return rows.join(roots, "form", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(damaged_words(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")))


#: crc32 of the UTF-8 text {0} in DuckDB SQL, by a table of 256 remainders that the CTE crc_table(t) holds.
CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, 2 * strlen({0}) + 1, 2), lambda i: ('0x' || substr(hex(encode({0})), i, 2))::BIGINT)),
         lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])), 4294967295::BIGINT)"""
CRC_TABLE = """crc_table AS (
  SELECT list(r ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i::BIGINT, range(0, 8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END) AS r FROM range(0, 256) g(i)))"""
#: The same rows in DuckDB SQL.
SQL = f"""
WITH RECURSIVE {CRC_TABLE}, runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), '{_UPPER}', '{_LOWER}') AS r FROM documents
), counted AS (
  SELECT r, doc_id, count(*) AS n FROM runs WHERE length(r) >= 7 GROUP BY 1, 2
), keyed AS (
  SELECT r, n, coalesce(CAST(doc_id AS VARCHAR), '') || ':' || r AS k FROM counted
), hashed AS (
  SELECT r, n, {CRC.format("k")} AS h FROM keyed, crc_table
), lost AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(r, 1, CAST(h % length(r) AS INT)) || substr(r, CAST(h % length(r) AS INT) + 2) ELSE r END AS word, n FROM hashed
), words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM lost WHERE length(word) >= 7 GROUP BY 1 HAVING sum(n) >= 2
), places AS (
  SELECT word, n, unnest(range(0, length(word))) AS i FROM words
), wild AS (
  SELECT word, n, substr(word, 1, i) || '*' || substr(word, i + 2) AS k FROM places
), shorter AS (
  SELECT DISTINCT word, n, substr(word, 1, i) || substr(word, i + 2) AS k FROM places
), near AS (
  SELECT a.word, b.word AS other, b.n AS m FROM wild a JOIN wild b ON a.k = b.k AND a.word <> b.word
  UNION ALL SELECT s.word, w.word, w.n FROM shorter s JOIN words w ON s.k = w.word
  UNION ALL SELECT w.word, s.word, s.n FROM shorter s JOIN words w ON s.k = w.word
), best AS (
  SELECT word, count(*) AS n_near, max(m) AS m FROM near GROUP BY 1
), top AS (
  SELECT b.word, b.n_near, b.m, min(x.other) AS other FROM best b JOIN near x ON x.word = b.word AND x.m = b.m GROUP BY 1, 2, 3
), formed AS (
  SELECT w.word, w.n, coalesce(t.n_near, 0) AS n_near, CASE WHEN t.m >= 10 * w.n THEN t.other END AS form, CASE WHEN t.m >= 10 * w.n THEN t.m END AS form_n
  FROM words w LEFT JOIN top t ON t.word = w.word
), walk AS (
  SELECT word, word AS top, 0 AS d FROM formed
  UNION ALL SELECT w.word, f.form, d + 1 FROM walk w JOIN formed f ON f.word = w.top WHERE f.form IS NOT NULL
), ends AS (
  SELECT word, arg_max(top, d) AS root FROM walk GROUP BY 1
)
SELECT f.word, f.form, e.root, f.n, f.n_near, f.form_n FROM formed f JOIN ends e ON e.word = f.word
"""
