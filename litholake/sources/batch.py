"""Batch files, directory expansion, run layout, tiles and config."""

from __future__ import annotations

import json
import os
import shutil
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from litholake.functions.strings import canonical_wafer_id, cell_of, tile_of

WAFERS = "wafer_id string, after_folder string, source_kind string, source_group string"


def parse_batch(spark: SparkSession, text: str) -> tuple[DataFrame, DataFrame]:
    """(declarations, errors) of a batch file's text. S1.

    A byte order mark, blank lines and ``#`` lines are dropped, line numbers stay physical. Lines pair up: ``name`` or
    ``folder_name``, then ``path``; keys in any case, split at the first ``:``, values not empty. A declared name that
    repeats in any case, an odd number of lines and an empty file are errors. Errors are rows (``line_no, problem``), in
    the order of lines; callers that want the first to stop everything take the first."""
    lines = text.removeprefix("\ufeff").splitlines()
    df = spark.createDataFrame([(i, s) for i, s in enumerate(lines, 1)], "line_no int, text string").withColumn("text", F.trim("text")).filter((F.col("text") != "") & ~F.col("text").startswith("#"))
    at = F.instr("text", ":")
    df = df.withColumns({"key": F.when(at > 0, F.lower(F.trim(F.expr("substring(text, 1, instr(text, ':') - 1)")))), "value": F.when(at > 0, F.trim(F.expr("substring(text, instr(text, ':') + 1)")))})
    w = Window.orderBy("line_no")  # a hand-written file
    df = df.withColumn("n", F.row_number().over(w)).withColumns({"path_key": F.lead("key").over(w), "path": F.lead("value").over(w), "path_line": F.lead("line_no").over(w)})
    pairs = df.filter("n % 2 = 1").withColumn("id", F.when(F.col("key") == "name", canonical_wafer_id(F.col("value"))).otherwise(F.col("value")))
    pairs = pairs.withColumn("dup", F.row_number().over(Window.partitionBy("key", F.lower("id")).orderBy("line_no")) > 1)
    problem = (
        F.when(F.col("key").isNull(), "no 'key: value'")
        .when(~F.col("key").isin("name", "folder_name"), "expected name or folder_name")
        .when(F.col("value") == "", "empty value")
        .when(F.col("path_line").isNull(), "declaration without path")
        .when(F.coalesce("path_key", F.lit("")) != "path", "expected path")
        .when(F.col("path") == "", "empty path")
        .when(F.col("dup"), "repeated wafer id")
    )
    errors = pairs.select("line_no", problem.alias("problem")).filter("problem is not null")
    if not any(s.strip() and not s.strip().startswith("#") for s in lines):
        errors = spark.createDataFrame([(0, "no wafer entries")], "line_no int, problem string")
    good = pairs.filter(problem.isNull()).select(F.col("id").alias("wafer_id"), F.col("path").alias("after_folder"), F.col("key").alias("source_kind"), F.when(F.col("key") == "folder_name", F.col("value")).alias("source_group"))
    return good, errors.orderBy("line_no")


def expand_groups(declared: DataFrame) -> DataFrame:
    """``folder_name`` entries become one wafer for each child directory, named group_child, in order of their names. S2.

    Directories are listed on the driver (a batch names a few); loose files, nested directories, missing or empty groups
    raise ValueError, as does an id that comes out twice."""
    out = []
    for r in declared.collect():
        root = Path(r.after_folder).expanduser()
        if not root.is_dir():
            raise ValueError(f"{r.wafer_id}: no such directory: {root}")
        entries = sorted(root.iterdir(), key=lambda p: p.name.lower())
        if r.source_kind == "name":
            leaves = [(r.wafer_id, root)]
        else:
            loose = [p.name for p in entries if p.is_file()]
            if loose:
                raise ValueError(f"{r.source_group}: loose file {loose[0]}")
            leaves = [(f"{r.source_group}_{p.name}", p) for p in entries]
            if not leaves:
                raise ValueError(f"{r.source_group}: no wafer directories")
        for name, leaf in leaves:
            nested = [p.name for p in leaf.iterdir() if p.is_dir()]
            if nested:
                raise ValueError(f"{name}: nested directory {nested[0]}")
            out.append((name, str(leaf), r.source_kind, r.source_group))
    ids = [o[0].lower() for o in out]
    if len(set(ids)) < len(ids):
        raise ValueError("repeated wafer id")
    return declared.sparkSession.createDataFrame(out, WAFERS)


def run_paths(wafers: DataFrame, base: str) -> DataFrame:
    """The fixed paths of each wafer's run. S3."""
    root = F.concat_ws("/", F.lit(base.rstrip("/")), F.trim("wafer_id"))
    at = lambda *p: F.concat_ws("/", root, *[F.lit(x) if isinstance(x, str) else x for x in p])
    gds = F.concat(F.trim("wafer_id"), F.lit("_device_defects.json"))
    return wafers.withColumns({"root": root, "input": at("analysis_png"), "metadata": at("metadata"), "seam_masks": at("seam_masks"), "previews": at("algo_previews"), "review_previews": at("previews"), "detector_json": at("algo_defects.json"), "gds_json": at(gds), "review_state": F.concat(at(gds), F.lit(".review_state.json"))})


IMAGE_EXTENSIONS = ("png", "jpg", "jpeg", "tif", "tiff")


def image_inventory(files: DataFrame, path_col: str = "path") -> DataFrame:
    """Runs with the number of analysis images and whether both folders are there, from a listing of paths. S3, P17."""
    p = F.translate(F.col(path_col), "\\", "/")
    run = F.regexp_extract(p, r"^(.*)/(analysis_png|metadata)/[^/]+$", 1)
    kind = F.regexp_extract(p, r"/(analysis_png|metadata)/[^/]+$", 1)
    ext = F.lower(F.regexp_extract(p, r"\.([^./]+)$", 1))
    d = files.select(run.alias("run"), kind.alias("kind"), (ext.isin(*IMAGE_EXTENSIONS)).alias("image")).filter("kind <> ''")
    return d.groupBy("run").agg(F.count_if((F.col("kind") == "analysis_png") & F.col("image")).alias("images"), (F.max(F.col("kind") == "analysis_png") & F.max(F.col("kind") == "metadata")).alias("complete"))


def scan_tiles(files: DataFrame, path_col: str = "path") -> DataFrame:
    """Tiles by grid position; of several files for one position the last in path order counts, copies like ``(1)``
    before plain names. S4. ``col, row, path``."""
    c, r = tile_of(F.col(path_col))
    d = files.select(c.alias("col"), r.alias("row"), F.col(path_col).alias("path")).filter("col is not null")
    plain = (~F.col("path").rlike(r"\(\d+\)\.[^.]+$")).cast("int")
    return d.groupBy("col", "row").agg(F.max_by("path", F.struct(plain, "path")).alias("path"))


def grid_size(tiles: DataFrame) -> DataFrame:
    return tiles.agg(F.max("col").alias("cols"), F.max("row").alias("rows"), F.count("*").alias("tiles"))


def binary_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Files with path, size and content; the listing alone is read where ``content`` isn't selected."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)


def load_config(path: str) -> dict:
    with open(path, encoding="utf-8-sig") as f:
        return json.load(f)


def design_path(config: dict, config_path: str, explicit: str | None = None) -> str:
    """The design file: given, or ``design_gds``/``gds_path`` of the config, relative to it; must be an existing .gds. S10."""
    name = explicit or next((config[k] for k in ("design_gds", "gds_path", "gds") if config.get(k)), None)
    if not name:
        raise ValueError("no design file is configured")
    p = Path(name) if explicit or os.path.isabs(name) else Path(config_path).parent / name
    if p.suffix.lower() != ".gds":
        raise ValueError(f"not a .gds file: {p}")
    if not p.exists():
        raise FileNotFoundError(p)
    return str(p)


def option(config: dict, names: tuple[str, ...], default, kind=float):
    """The first of several keys that is set and of the right kind; else the default. F9."""
    for n in names:
        if config.get(n) is not None:
            try:
                v = config[n]
                return str(v).strip().lower() in ("1", "true", "yes", "on") if kind is bool else kind(v)
            except (TypeError, ValueError):
                continue
    return default


def read_exclusions(paths: list[str | None]) -> list[str]:
    """Names of the first existing list among explicit, sibling and working-directory files. S17."""
    for p in paths:
        if p and os.path.isfile(p):
            with open(p, encoding="utf-8-sig") as f:
                data = json.load(f)
            return sorted({str(v).strip() for v in (data if isinstance(data, list) else [])})
    return []


def exclude(df: DataFrame, names: list[str], *columns: str) -> DataFrame:
    """Rows none of whose columns, as name or as stem, is excluded. S17, G9."""
    from litholake.functions.strings import device_key

    gone = [device_key(F.lit(n)) for n in names]
    hit = F.lit(False)
    for c in columns:
        hit = hit | F.coalesce(device_key(F.col(c)).isin(*gone) if gone else F.lit(False), F.lit(False))
    return df.filter(~hit)


def wafer_of_cell(name_col: str):
    """Wafer id inferred from a cell file's name. S3."""
    return cell_of(F.col(name_col))[0]


def safe_remove_tree(path: str, inside: str) -> bool:
    """Removes a stale output directory; refuses the root, the working directory, its parents, and anything that is not
    below ``inside``. S24."""
    p, base, here = Path(path).resolve(), Path(inside).resolve(), Path.cwd().resolve()
    if p == base or base not in p.parents or p == here or p in here.parents:
        raise ValueError(f"refusing to remove {p}")
    if not p.is_dir():
        return False
    shutil.rmtree(p)
    return True
