"""Where a figure's picture is: stored already, beside its saved page, or still to be fetched."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import extension

# fixed values: what browsers call the folder of a saved page's pictures
COMPANIONS = ("_files", " Files", "_bestanden")


def _folder(path: Column) -> Column:
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def _name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def unquoted(text: Column) -> Column:
    """Text with %-escapes resolved; a plus stays one, and text with broken escapes stays as it is."""
    return F.coalesce(F.try_url_decode(F.replace(text, F.lit("+"), F.lit("%2B"))), text)


def address_path(url: Column) -> Column:
    """The path of an address with a scheme, or else the whole of it, escapes resolved."""
    return unquoted(F.when(url.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*:(?://[^/?#]*)?([^?#]*)", 1)).otherwise(url))


def picture_status(figures: DataFrame, files: DataFrame, store: str, study: str = "study_id", page: str = "path") -> DataFrame:
    """figures (figure_id, image_url, the study's and the page's column) with local_path, found_at and status; one row out per row in.

    files is a listing with a column path of everything below the pages' folders and the store. In this order:
    no_url, if the address is blank; exists, if store/<study>/<figure_id><suffix> is listed; local_copy, if the picture is listed at
    the address's place from the page's folder, or by its name in the page's companion folder, or in any *_files folder beside
    the page (of several, the first in order): found_at is where it is; and else to_fetch. local_path is where the picture is or
    will be kept, NULL without an address. Each figure has at most six places to look, joined to the listing by path, so a
    page with many pictures and a folder with many files cost no more than their rows.
    """
    url = F.coalesce(F.trim("image_url"), F.lit(""))
    kept = F.concat_ws("/", F.lit(store), F.col(study), F.concat(F.coalesce("figure_id", F.lit("unknown")), extension(url)))
    where, stem = _folder(F.col(page)), F.regexp_replace(_name(F.col(page)), r"(?<=.)\.[^.]*$", "")
    at = address_path(url)
    name = F.regexp_extract(at, r"([^/]*)/?$", 1)
    beside = F.when(at.startswith("/"), at).otherwise(F.concat_ws("/", where, F.regexp_replace(at, r"^(\./)+", "")))
    named = [F.when(name != "", F.concat_ws("/", where, folder, name)) for folder in (*[F.concat(stem, F.lit(c)) for c in COMPANIONS], F.lit("*_files"))]
    rows = figures.withColumns({"_row": F.monotonically_increasing_id(), "_url": url, "local_path": F.when(url != "", kept)})
    places = F.array_compact(F.array(*[F.when(url != "", F.struct(F.lit(i).alias("i"), place.alias("key"))) for i, place in enumerate((kept, F.when(name != "", beside), *named))]))
    asked = rows.select("_row", F.explode(F.filter(places, lambda p: p["key"].isNotNull())).alias("p")).select("_row", "p.i", "p.key")
    listed = files.select(F.col("path").alias("at"))
    inside = listed.where(_folder(F.col("at")).endswith("_files")).select(F.concat_ws("/", _folder(_folder(F.col("at"))), F.lit("*_files"), _name(F.col("at"))).alias("key"), "at")
    keyed = listed.select(F.col("at").alias("key"), "at").unionByName(inside).groupBy("key").agg(F.min("at").alias("at"))
    best = asked.join(keyed, "key").groupBy("_row").agg(F.min(F.struct("i", "at")).alias("_b"))
    status = F.when(F.col("_url") == "", "no_url").when(F.col("_b.i") == 0, "exists").when(F.col("_b").isNotNull(), "local_copy").otherwise("to_fetch")
    return rows.join(best, "_row", "left").select(*figures.columns, "local_path", F.when(F.col("_b.i") > 0, F.col("_b.at")).alias("found_at"), status.alias("status"))
