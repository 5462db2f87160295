"""Deeply nested semi-structured records as related flat tables (problem 2).

Method: Arrow-buffer flattening. A nested column arrives as Arrow arrays; a child table is emitted from the list
offsets alone: ``parents = repeat(row, length)`` and ``place = arange - start[parent]`` are computed for a whole batch at
once, nested levels compose by taking the parents of parents, and keys are propagated with one vectorised ``take``. No
row is visited. JSON texts are no Arrow lists: ``kernels.jsonindex`` finds tokens, parents and places of a whole buffer of
texts at once, from where on the same kernels run; no text, list or point is visited by itself.

Repeated deliveries: rows are hashed and sorted by id, and a repeated id is skipped where it follows its twin.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from litholake.kernels.jsonindex import LIST, OBJECT, STRING, JsonIndex, objects_of, points_of

POINT_SCHEMA = "parent_table string, parent_id long, child string, item_no int, point_no int, x double, y double"
_ARROW = pa.schema([("parent_table", pa.string()), ("parent_id", pa.int64()), ("child", pa.string()), ("item_no", pa.int32()), ("point_no", pa.int32()), ("x", pa.float64()), ("y", pa.float64())])


# --- offset kernels -------------------------------------------------------------------------------------------------


def list_layout(arr: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(parent index, place in the parent, child values) of a list array; null and empty lists have no child."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    lengths = pc.fill_null(pc.list_value_length(arr), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    parents, place = expand(lengths)
    return parents, place, pc.list_flatten(arr)


def expand(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Parent index and place of every child, from the lengths of the lists."""
    parents = np.repeat(np.arange(len(lengths)), lengths)
    starts = np.cumsum(lengths) - lengths
    return parents, np.arange(len(parents)) - starts[parents] if len(parents) else np.zeros(0, np.int64)


def first_two(points: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(usable, x, y) of a list<list<number>> array's inner lists: at least two elements, the first two not null."""
    n = len(points)
    lengths = pc.fill_null(pc.list_value_length(points), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = pc.cast(pc.list_flatten(points), pa.float64())
    starts = np.cumsum(lengths) - lengths
    ok = lengths >= 2
    at = np.where(ok, starts, 0)
    x, y = np.full(n, np.nan), np.full(n, np.nan)
    if len(values):
        valid = pc.is_valid(values).to_numpy(zero_copy_only=False)
        raw = pc.fill_null(values, 0.0).to_numpy(zero_copy_only=False)
        nxt = np.minimum(at + 1, len(raw) - 1)
        ok = ok & valid[at] & valid[nxt]
        x, y = np.where(ok, raw[at], np.nan), np.where(ok, raw[nxt], np.nan)
    else:
        ok = np.zeros(n, bool)
    return ok, x, y


def emit(table: str, ids: np.ndarray, child: pa.Array | str, item: np.ndarray, point: np.ndarray, x: np.ndarray | None = None, y: np.ndarray | None = None) -> pa.RecordBatch:
    n = len(ids)
    names = pa.array([child]).take(pa.array(np.zeros(n, np.int64))).cast(pa.string()) if isinstance(child, str) else child
    coords = [pa.nulls(n, pa.float64()) if v is None else pa.array(v, mask=np.asarray(point) < 0) for v in (x, y)]
    return pa.RecordBatch.from_arrays([pa.array([table]).take(pa.array(np.zeros(n, np.int64))), pa.array(ids, pa.int64()), names, pa.array(item.astype(np.int32)), pa.array(point.astype(np.int32)), *coords], schema=_ARROW)


def points_with_gaps(item_parent: np.ndarray, n_items: int, ok: np.ndarray, place: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Item index, point number, x, y: the usable points of every item, and one row numbered -1 for an item without any."""
    rows = np.flatnonzero(ok)
    owner = item_parent[rows]
    bare = np.flatnonzero(np.bincount(owner, minlength=n_items) == 0)
    nan = np.full(len(bare), np.nan)
    return np.concatenate([owner, bare]), np.concatenate([place[rows], np.full(len(bare), -1)]), np.concatenate([x[rows], nan]), np.concatenate([y[rows], nan])


def flatten_defects(ids: np.ndarray, defects: pa.Array, table: str = "device_entries", child: str = "defects") -> pa.RecordBatch:
    """list<struct<polygon_px: list<list<number>>, ..>> by offsets: record -> defect -> point."""
    parents, item_no, flat = list_layout(defects)
    live = pc.is_valid(flat).to_numpy(zero_copy_only=False)
    keep = np.flatnonzero(live)
    parents, item_no = parents[keep], item_no[keep]
    polygons = pc.struct_field(flat.take(pa.array(keep)), "polygon_px")
    owner, place, points = list_layout(polygons)
    ok, x, y = first_two(points)
    item, point, x, y = points_with_gaps(owner, len(keep), ok, place, x, y)
    return emit(table, ids[parents[item]], child, item_no[item], point, x, y)


# --- JSON texts -----------------------------------------------------------------------------------------------------


def flatten_metadata(ids: np.ndarray, texts: pa.Array, fields: tuple[str, ...] = ("gds_corners_um", "overlapping_tiles"), table: str = "cell_records") -> Iterator[pa.RecordBatch]:
    for ix, row, token in objects_of(texts):
        for name in fields:
            owner, place, ok, x, y = points_of(ix, ix.member(token, name))
            yield _corner(table, ids[row[owner[ok]]], name, place[ok], x[ok], y[ok])


def _corner(table: str, ids: np.ndarray, name: str, item: np.ndarray, x: np.ndarray, y: np.ndarray) -> pa.RecordBatch:
    """Corners and tiles are items themselves: numbered by item, with coordinates and point -1."""
    batch = emit(table, ids, name, item, np.full(len(ids), -1))
    return pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(x, pa.float64()), pa.array(y, pa.float64())], schema=_ARROW)


class Images:
    """The images of detector bodies of one index, in their three shapes: row of the body, place in it, name; and their
    defect slots: image, place, token (objects only)."""

    def __init__(self, ix: JsonIndex, row: np.ndarray, token: np.ndarray):
        listed, noted = ix.member(token, "images"), ix.member(token, "annotations")
        kind = lambda t: np.where(t >= 0, ix.kind[t], 0)
        # a list of images
        lists = np.flatnonzero(kind(listed) == LIST)
        image, owner, place = ix.children(listed[lists])
        whole = ix.kind[image] == OBJECT
        image, row_a, no_a = image[whole], row[lists[owner[whole]]], place[whole]
        name, defects = ix.member(image, "image"), ix.member(image, "defects")
        named = kind(name) == STRING
        texts = ix.strings(name[named])
        names_a = texts.take(pa.array(np.where(named, np.cumsum(named) - 1, 0), mask=~named)) if len(texts) else pa.nulls(len(name), pa.large_string())
        # an object from name to list of defects
        plain = np.flatnonzero(listed < 0)
        of = np.where(noted[plain] >= 0, noted[plain], token[plain])
        held = np.flatnonzero(kind(of) == OBJECT)
        keys = ix.keys[np.isin(ix.parent[ix.keys], of[held])]
        inv = np.full(len(ix.kind) + 1, -1)
        inv[of[held]] = row[plain[held]]
        key_names = ix.strings(keys)
        code = key_names.dictionary_encode().indices.to_numpy(zero_copy_only=False) if len(keys) else np.zeros(0, np.int64)
        _, latest = np.unique(np.stack([ix.parent[keys][::-1], code[::-1]]), axis=1, return_index=True) if len(keys) else (None, np.zeros(0, np.int64))
        latest = np.sort(len(keys) - 1 - latest)  # of repeated names the last counts
        latest = latest[ix.kind[keys[latest] + 2] == LIST]
        keys, names_b = keys[latest], key_names.take(pa.array(latest))
        parents = ix.parent[keys]
        order = np.argsort(parents, kind="stable")
        keys, names_b, parents = keys[order], names_b.take(pa.array(order)), parents[order]
        no_b = np.arange(len(keys)) - np.searchsorted(parents, parents)
        self.row = np.concatenate([row_a, inv[parents]]).astype(np.int64)
        self.no = np.concatenate([no_a, no_b]).astype(np.int64)
        self.name = pa.concat_arrays([names_a, names_b]).cast(pa.string())
        defects = np.concatenate([defects, keys + 2]).astype(np.int64)
        # slots: the elements of a list, or a lone object
        is_list, lone = np.flatnonzero(kind(defects) == LIST), np.flatnonzero(kind(defects) == OBJECT)
        slot, owner, place = ix.children(defects[is_list])
        live = ix.kind[slot] == OBJECT
        self.slot = np.concatenate([slot[live], defects[lone]]).astype(np.int64)
        self.image = np.concatenate([is_list[owner[live]], lone]).astype(np.int64)
        self.place = np.concatenate([place[live], np.zeros(len(lone), np.int64)]).astype(np.int64)


def flatten_bodies(ids: np.ndarray, texts: pa.Array, table: str = "detector_results") -> Iterator[pa.RecordBatch]:
    """Body -> image -> defect -> point, each level by the parents of the one before."""
    for ix, row, token in objects_of(texts):
        im = Images(ix, row, token)
        owner, place, ok, x, y = points_of(ix, ix.member(im.slot, "polygon_px"))
        item, point, x, y = points_with_gaps(owner, len(im.slot), ok, place, x, y)
        bare = np.flatnonzero(np.bincount(im.image, minlength=len(im.row)) == 0)
        image = np.concatenate([im.image[item], bare]).astype(np.int64)
        missing, nan = np.full(len(bare), -1), np.full(len(bare), np.nan)
        yield emit(table, ids[im.row[image]], im.name.take(pa.array(image)), np.concatenate([im.place[item], missing]), np.concatenate([point, missing]), np.concatenate([x, nan]), np.concatenate([y, nan]))


def flatten_images(ids: np.ndarray, texts: pa.Array) -> Iterator[pa.RecordBatch]:
    for ix, row, token in objects_of(texts):
        im = Images(ix, row, token)
        defects = np.bincount(im.image, minlength=len(im.row)).astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(ids[im.row], pa.int64()), pa.array(im.no.astype(np.int32)), im.name, pa.array(defects)], names=["parent_id", "image_no", "image", "defects"])


def flatten_members(ids: np.ndarray, texts: pa.Array, fields: tuple[str, ...]) -> Iterator[pa.RecordBatch]:
    """Strings and numbers of the named members of each object; what is neither is null."""
    for ix, row, token in objects_of(texts):
        for name in fields:
            v = ix.member(token, name)
            word, number = np.flatnonzero((v >= 0) & (np.where(v >= 0, ix.kind[v], 0) == STRING)), np.flatnonzero((v >= 0) & ix.number[v])
            at = np.concatenate([word, number])
            text = pa.concat_arrays([ix.strings(v[word]).cast(pa.string()), pa.nulls(len(number), pa.string())])
            value = pa.concat_arrays([pa.nulls(len(word), pa.float64()), pa.array(ix.numbers(v[number]), pa.float64())])
            yield pa.RecordBatch.from_arrays([pa.array(ids[row[at]], pa.int64()), pa.array([name]).take(pa.array(np.zeros(len(at), np.int64))), text, value], names=["parent_id", "member", "text", "number"])


# --- operators ------------------------------------------------------------------------------------------------------

#: Bytes of text that one kernel call indexes; its arrays are about forty times as large. A longer text goes alone.
TEXT_BYTES = 1 << 20


def by_bytes(col: pa.Array, limit: int = TEXT_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes of text, or of one row."""
    upto = np.cumsum(pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    a, n = 0, len(col)
    while a < n:
        base = upto[a - 1] if a else 0
        b = min(n, max(a + 1, int(np.searchsorted(upto, base + limit, "right"))))
        yield a, b
        a = b


def _mapped(df: DataFrame, id_col: str, value_col: str, kernel: Callable[[np.ndarray, pa.Array], Iterator[pa.RecordBatch]], schema: str = POINT_SCHEMA) -> DataFrame:
    """Each id once, through the kernel: rows are hashed and sorted by id, so a repeat follows its twin, also over batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for b in batches:
            ids = b.column(0).to_numpy(zero_copy_only=False)
            fresh = np.concatenate([[len(ids) > 0 and ids[0] != last], ids[1:] != ids[:-1]]) if len(ids) else np.zeros(0, bool)
            last = ids[-1] if len(ids) else last
            ids, col = ids[fresh], b.column(1).filter(pa.array(fresh))
            for i, j in by_bytes(col) if pa.types.is_string(col.type) or pa.types.is_large_string(col.type) else [(0, len(col))]:
                yield from kernel(ids[i:j], col.slice(i, j - i))

    flat = df.filter(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long"), value_col)
    return flat.repartition(id_col).sortWithinPartitions(id_col).mapInArrow(run, schema)


def metadata_points(df: DataFrame, id_col: str = "record_id", text_col: str = "metadata", fields: tuple[str, ...] = ("gds_corners_um", "overlapping_tiles"), table: str = "cell_records") -> DataFrame:
    """One row for each point of the named fields of a JSON text; ``x``/``y`` hold it.

    A null, empty or broken text and a text that isn't an object give no row; neither does a row without id. Repeated
    ids count once. Extra columns of ``df`` play no part."""
    return _mapped(df, id_col, text_col, lambda ids, col: flatten_metadata(ids, col, fields, table))


def metadata_members(df: DataFrame, id_col: str, text_col: str, fields: tuple[str, ...]) -> DataFrame:
    """``parent_id, member, text, number``: one row for each named member of a JSON object that is a string or a number."""
    return _mapped(df, id_col, text_col, lambda ids, col: flatten_members(ids, col, fields), "parent_id long, member string, text string, number double")


def defect_points(df: DataFrame, id_col: str = "entry_id", defects_col: str = "defects", table: str = "device_entries") -> DataFrame:
    """One row for each polygon point of each non-null defect of an array column; a defect without points gives one row
    with ``point_no`` -1. Null and empty arrays give no row. Repeated ids count once."""
    narrow = df.select(id_col, F.transform(F.col(defects_col), lambda d: F.when(d.isNotNull(), F.struct(d["polygon_px"].alias("polygon_px")))).alias(defects_col))
    return _mapped(narrow, id_col, defects_col, lambda ids, col: iter([flatten_defects(ids, col, table)]))


def child_rows(df: DataFrame, id_col: str, list_col: str, fields: list[str]) -> DataFrame:
    """The child table of an array of structs: ``parent_id``, ``item_no`` and the named scalar fields of each non-null
    element, by list offsets and one ``take`` per field. Null and empty arrays give no row. Repeated ids count once."""
    kind = df.schema[list_col].dataType.elementType
    schema = "parent_id long, item_no int, " + ", ".join(f"{f} {kind[f].dataType.simpleString()}" for f in fields)

    def kernel(ids: np.ndarray, col: pa.Array) -> Iterator[pa.RecordBatch]:
        parents, place, flat = list_layout(col)
        keep = np.flatnonzero(pc.is_valid(flat).to_numpy(zero_copy_only=False))
        live = flat.take(pa.array(keep))
        yield pa.RecordBatch.from_arrays([pa.array(ids[parents[keep]], pa.int64()), pa.array(place[keep].astype(np.int32)), *(pc.struct_field(live, f) for f in fields)], names=["parent_id", "item_no", *fields])

    narrow = df.select(id_col, F.transform(F.col(list_col), lambda d: F.when(d.isNotNull(), F.struct(*[d[f].alias(f) for f in fields]))).alias(list_col))
    return _mapped(narrow, id_col, list_col, kernel, schema)


def body_points(df: DataFrame, id_col: str = "result_id", text_col: str = "body", table: str = "detector_results") -> DataFrame:
    """One row for each polygon point of each defect object of each image of a JSON body; -1 where a level is empty."""
    return _mapped(df, id_col, text_col, lambda ids, col: flatten_bodies(ids, col, table))


def body_images(df: DataFrame, id_col: str = "result_id", text_col: str = "body") -> DataFrame:
    """``parent_id, image_no, image, defects``: one row for each image of a JSON body, with the number of its defects."""
    return _mapped(df, id_col, text_col, flatten_images, "parent_id long, image_no int, image string, defects int")
