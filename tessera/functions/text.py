"""Scalar column functions on text: cleaning, typed parsing, identifiers, categories, JSON repair.

White space and word characters are Unicode's, as (?U) gives them, with the four separators U+001C to U+001F.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPACE = r"(?U)[\s\x1c-\x1f]"
# fixed values: sections in order, with the words that name them
SECTIONS = {
    "introduction": ["introduction", "background"],
    "methods": ["methods", "materials and methods", "experimental", "experimental section", "methodology", "materials", "experimental procedures"],
    "results": ["results", "results and discussion", "findings"],
    "discussion": ["discussion", "general discussion"],
    "conclusion": ["conclusion", "conclusions", "concluding remarks"],
    "references": ["references", "bibliography"],
}
_NUMBER = r"^[+-]?(\d+(_\d+)*\.?(\d+(_\d+)*)?|\.\d+(_\d+)*)([eE][+-]?\d+(_\d+)*)?$"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """White space off both ends."""
    return F.regexp_replace(col(c), rf"^{_SPACE}+|{_SPACE}+$", "")


def clean_text(c: Column | str) -> Column:
    """Runs of white space to one space, stripped; then reference marks like [12] dropped, whatever spaces that leaves."""
    return F.regexp_replace(strip(F.regexp_replace(col(c), rf"{_SPACE}+", " ")), r"\[\d+\]", "")


def to_double(c: Column | str) -> Column:
    """A decimal number, digits maybe grouped by single underscores; NULL for all else, NaN and infinity included."""
    s = strip(c)
    return F.when(s.rlike(_NUMBER), F.regexp_replace(s, "_", "").try_cast("double"))


def to_str(c: Column | str) -> Column:
    """Stripped; NULL if nothing is left."""
    return F.nullif(strip(c), F.lit(""))


def to_int(c: Column | str) -> Column:
    """A whole number without a point; NULL for all else."""
    s = strip(c)
    return F.when(s.rlike(r"^[+-]?\d+(_\d+)*$"), F.regexp_replace(s, "_", "").try_cast("int"))


def to_bool(c: Column | str) -> Column:
    """TRUE, 1 and YES in any case are true; all else, NULL included, is false."""
    return F.coalesce(F.upper(strip(c)).isin("TRUE", "1", "YES"), F.lit(False))


def alias_key(c: Column | str) -> Column:
    return strip(F.lower(col(c)))


def _safe_id(c: Column) -> Column:
    return F.lower(F.regexp_replace(F.regexp_replace(c, "[^a-zA-Z0-9]+", "_"), "^_+|_+$", ""))


def doi_key(c: Column | str) -> Column:
    """An identifier from a DOI; each of the three address prefixes is dropped once, in this order."""
    return _safe_id(reduce(lambda s, p: F.regexp_replace(s, f"^(?i){p}", ""), ("https://doi\\.org/", "http://doi\\.org/", "doi:"), strip(c)))


def file_key(c: Column | str) -> Column:
    """An identifier from a file's name without its last suffix; a leading dot is part of the name."""
    name = F.element_at(F.split(col(c), "/"), -1)
    return _safe_id(F.regexp_replace(name, r"(?<=.)\.[^.]+$", ""))


def lookup(mapping: dict[str, str], key: Column) -> Column:
    """A small fixed mapping as a literal; NULL where it has no such key. Larger ones are for joins."""
    if not mapping:
        return F.lit(None).cast("string")
    return F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])[key]


def substance_key(c: Column | str, synonyms: dict[str, str]) -> Column:
    """The synonym of the name with underscores, or else of the name with spaces, or else the former."""
    key = alias_key(F.coalesce(col(c), F.lit("")))
    under = F.replace(key, F.lit(" "), F.lit("_"))
    return F.coalesce(lookup(synonyms, under), lookup(synonyms, key), under)


def attribute_key(c: Column | str, synonyms: dict[str, str]) -> Column:
    key = alias_key(F.coalesce(col(c), F.lit("")))
    return F.coalesce(lookup(synonyms, key), key)


def source_category(c: Column | str) -> Column:
    """figure, table, text, or unknown for a blank location."""
    s = alias_key(F.coalesce(col(c), F.lit("")))
    return F.when(s.startswith("fig"), "figure").when(s.startswith("table"), "table").when(s != "", "text").otherwise("unknown")


def without_prefix(c: Column | str, prefix: Column) -> Column:
    """Without `prefix` and two underscores, if it begins with them."""
    lead = F.concat(prefix, F.lit("__"))
    return F.when(F.startswith(col(c), lead), F.substring(col(c), F.length(lead) + 1, F.length(col(c)))).otherwise(col(c))


def scale_range(c: Column | str) -> Column:
    """struct<low, high> of the first two parts between hyphens; NULL unless both are numbers."""
    parts = F.split(col(c), "-")
    low, high = to_double(F.get(parts, F.lit(0))), to_double(F.get(parts, F.lit(1)))
    return F.when(low.isNotNull() & high.isNotNull(), F.struct(low.alias("low"), high.alias("high")))


def experiment_key(paper: Column, label: Column) -> Column:
    """paper__exp and the label with every "exp" removed; a label that is absent is exp1."""
    return F.concat(paper, F.lit("__exp"), F.replace(F.coalesce(label, F.lit("exp1")), F.lit("exp"), F.lit("")))


def panel_key(paper: Column, label: Column) -> Column:
    return F.concat(paper, F.lit("__panel_"), label)


def json_repair(c: Column | str) -> Column:
    """VARIANT of the text without code fences, or of its outermost braces, or of its outermost brackets; else NULL."""
    bare = F.regexp_replace(F.regexp_replace(col(c), r"```(?:json)?\s*\n?", ""), r"\n?```", "")
    cut = lambda p: F.nullif(F.regexp_extract(bare, p, 0), F.lit(""))
    return F.coalesce(F.try_parse_json(strip(bare)), F.try_parse_json(cut(r"(?s)\{.*\}")), F.try_parse_json(cut(r"(?s)\[.*\]")))


def within_limit(c: Column | str, limit: int) -> Column:
    """Whether a prompt has at most `limit` characters; a limit of 0 or less lets all pass."""
    return F.lit(True) if limit <= 0 else F.coalesce(F.length(col(c)) <= limit, F.lit(True))


def media_type(c: Column | str) -> Column:
    """The media type by a file's suffix; png if unknown."""
    # fixed values: suffixes and media types
    types = {"png": "image/png", "jpg": "image/jpeg", "jpeg": "image/jpeg", "gif": "image/gif", "webp": "image/webp"}
    return F.coalesce(lookup(types, F.lower(F.regexp_extract(col(c), r"\.([^.]+)$", 1))), F.lit("image/png"))


def fill_template(template: Column | str, values: dict[str, Column]) -> Column:
    """Placeholders replaced one after the other; later ones are also found in what earlier ones put in."""
    return reduce(lambda t, kv: F.replace(t, F.lit(kv[0]), kv[1]), values.items(), col(template))


#: Suffixes of pictures.
PICTURES = (".png", ".jpg", ".jpeg", ".gif", ".svg", ".tiff", ".tif", ".webp")


def extension(c: Column | str) -> Column:
    """The suffix of a picture's address, its query left out; .png for any other."""
    found = F.regexp_extract(F.substring_index(F.lower(col(c)), "?", 1), r"\.[^./]*$", 0)
    return F.when(found.isin(*PICTURES), found).otherwise(".png")


def figure_key(c: Column | str) -> Column:
    """A picture's address without path, suffix and resolution, to find the same picture in several sizes."""
    name = F.element_at(F.split(col(c), "/"), -1)
    name = F.regexp_replace(name, r"\.[^.]*$", "")
    name = F.regexp_replace(name, r"[-_]\d{3,4}$", "")
    return F.lower(F.regexp_replace(name, r"(?i)[-_](small|large|thumb|preview|hi-res|hires)$", ""))


def document_kind(c: Column | str) -> Column:
    """xml or html, by how a page begins and by what it holds."""
    s = col(c)
    xml = strip(s).startswith("<?xml") | s.contains("<ce:") | (F.substring(s, 1, 500).contains("<article") & F.substring(s, 1, 2000).contains("dtd-version"))
    return F.when(xml, "xml").otherwise("html")


def section_name(c: Column | str) -> Column:
    """A heading's canonical section: the first with a word in it; else the heading as it is."""
    s = F.regexp_replace(strip(F.lower(col(c))), r"^\d+\.?\s*", "")
    return F.coalesce(*[F.when(reduce(Column.__or__, [s.contains(w) for w in words]), F.lit(name)) for name, words in SECTIONS.items()], col(c))
