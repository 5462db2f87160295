"""Names, paths, sources and selectors as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def stem(path: Column) -> Column:
    """File name without folder and last extension."""
    return F.regexp_extract(path, r"([^/\\]*?)(\.[^./\\]*)?$", 1)


def device_key(name: Column) -> Column:
    """Case-insensitive key of a device or file name."""
    return F.lower(stem(F.trim(name)))


def no_value(c: Column) -> Column:
    """Null for the several spellings of "no value": null, blank, none."""
    return F.when(~F.lower(F.trim(c)).isin("", "none", "null", "nan", "n/a"), c)


def wafer_key(name: Column) -> Column:
    """Key under which a wafer is selected: lower case, without a leading ``wafer_``."""
    return F.regexp_replace(F.lower(F.trim(name)), "^wafer_", "")


def canonical_wafer_id(name: Column) -> Column:
    """``Wafer_`` is prefixed unless the name begins with it in any case. S1."""
    return F.when(F.lower(F.trim(name)).startswith("wafer_"), F.trim(name)).otherwise(F.concat(F.lit("Wafer_"), F.trim(name)))


def cell_of(name: Column) -> tuple[Column, Column, Column]:
    """(wafer, row, column) of ``<wafer>_cell_<row>-<col>``; nulls where the name is none. F2."""
    pat = r"^(.*?)(?:^|_)cell_(\d+)-(\d+)$"
    part = lambda i: F.when(stem(name).rlike(pat), F.regexp_extract(stem(name), pat, i))
    return F.nullif(part(1), F.lit("")), part(2).cast("int"), part(3).cast("int")


def tile_of(path: Column) -> tuple[Column, Column]:
    """(column, row) of ``tile_x###_y###`` anywhere in a path. S4."""
    pat = r"tile_x(\d+)_y(\d+)"
    return tuple(F.when(path.rlike(pat), F.regexp_extract(path, pat, i)).cast("int") for i in (1, 2))


def source_kind(source: Column) -> Column:
    """Manual or automatic, by the record's source; unknown sources count as manual. F12."""
    s = F.lower(F.coalesce(source, F.lit("")))
    return F.when(s.contains("manual"), "manual").when(s.contains("algorithmic") | s.contains("automatic") | s.contains("detector"), "automatic").otherwise("manual")


def is_derived_image(name: Column) -> Column:
    """Previews, overlays and masks are no source images. P17."""
    return F.lower(name).rlike("preview|overlay|mask")


def device_matches(query: str, row: Column, col: Column, label: Column) -> Column:
    """The viewer's search box: the word device is dropped; ``a-b`` means that cell; a number means a label that holds
    it, or that row or column; anything else is a substring of the label. P14."""
    q = query.lower().replace("device", "").strip()
    if not q:
        return F.lit(True)
    parts = q.replace(" ", "").split("-")
    if len(parts) == 2 and all(p.isdigit() for p in parts):
        return (row == int(parts[0])) & (col == int(parts[1]))
    if q.isdigit():
        return F.lower(label).contains(q) | (row == int(q)) | (col == int(q))
    return F.lower(label).contains(q)


def subtracted_name(json_path: Column) -> Column:
    """Name of the design file after subtraction. S26."""
    base = F.regexp_replace(stem(json_path), r"(_device)?_defects$", "")
    parent = F.regexp_extract(json_path, r"([^/\\]+)[/\\][^/\\]*$", 1)
    return F.concat(F.when(base == "", parent).otherwise(base), F.lit("_subtracted_defects.gds"))


def minutes_text(seconds: Column) -> Column:
    """A duration as ``m:ss``, from an hour on as ``h:mm:ss``; null and negative ones as ``--:--``. F13."""
    s = F.bround(seconds).cast("long")
    short = F.format_string("%d:%02d", F.floor(s / 60), s % 60)
    long_ = F.format_string("%d:%02d:%02d", F.floor(s / 3600), F.floor(s / 60) % 60, s % 60)
    return F.when(s.isNull() | (s < 0), "--:--").when(s < 3600, short).otherwise(long_)


def quoted(word: Column) -> Column:
    """A word of a command line, in quotes where it is empty or holds white space. F13."""
    return F.when((word == "") | word.rlike(r"\s"), F.concat(F.lit('"'), word, F.lit('"'))).otherwise(word)
