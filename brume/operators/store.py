"""Arrays and members of reference stores, as tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.project import build_ref_key, extract, parse_chunk_key
from .windows import place_on_axis


def extract_chunk_index(refs: DataFrame, coords: DataFrame, arrays: DataFrame, tasks: int | None = None) -> DataFrame:
    """One row per chunk of `path/i.j...` keys: path, chunk, uri, offset, length and `at`, its coordinate by dim.

    `coords`: path, dim, i, coord, one row for each. `arrays`: path, pos (place of the dim), dim, chunk_size, size. A dim with
    chunks of one is indexed by its coordinate, one with a single chunk of its whole size is left out; any other chunking, an
    indexed dim without that coordinate and a coordinate given twice fail the job. Inline values have offset and length -1; chunks that
    are not there give no row. A chunk stays one row: each place that is indexed in some array is one join, so nothing is regrouped.
    `tasks`: partitions of each join, where the caller knows how many chunks there are.
    """
    dealt = lambda df, *keys: df if tasks is None else df.repartition(tasks, *keys)
    places = {r["pos"]: r["indexed"] for r in arrays.where("pos IS NOT NULL").groupBy("pos").agg(F.bool_or(F.col("chunk_size") == 1).alias("indexed")).collect()}  # as many rows as the largest array has dims
    met = parse_chunk_key(refs).where("path IS NOT NULL").select("key", "path", "chunk", "uri", F.coalesce("offset", F.lit(-1)).alias("offset"), F.coalesce("length", F.lit(-1)).alias("length"))
    columns, met = met.columns, dealt(met, "path")
    bad = F.raise_error(F.concat(F.lit("no rule for a dim of "), F.col("key"))).cast("string")
    for p in sorted(places):
        met = met.join(dealt(arrays.where(F.col("pos") == p).select("path", F.struct("dim", "chunk_size", "size").alias(f"_array{p}")), "path"), "path", "left")
    for p in places:
        a = F.col(f"_array{p}")
        rule = F.when(a["chunk_size"] == 1, a["dim"]).when(a["chunk_size"] == a["size"], F.lit(None)).otherwise(bad)
        met = met.withColumns({f"_dim{p}": F.when(F.size("chunk") > p, rule), f"_i{p}": F.get("chunk", p)})
    n = F.count("*")
    twice = F.raise_error(F.concat(F.lit("two coordinates of "), F.col("path"))).cast("bigint")
    single = dealt(coords, "path", "dim", "i").groupBy("path", "dim", "i").agg(F.when(n == 1, F.max("coord")).otherwise(twice).alias("coord"))
    entries = [F.when(F.size("chunk") > max(places, default=-1) + 1, F.struct(bad.alias("dim"), F.lit(None).cast("bigint").alias("coord")))]
    for p, indexed in places.items():
        if indexed:
            met = dealt(met, "path", f"_dim{p}", f"_i{p}").join(single.select("path", F.col("dim").alias(f"_dim{p}"), F.col("i").alias(f"_i{p}"), F.col("coord").alias(f"_coord{p}")), ["path", f"_dim{p}", f"_i{p}"], "left")
        coord = F.col(f"_coord{p}") if indexed else F.lit(None).cast("bigint")
        found = F.when(coord.isNotNull(), coord).otherwise(F.raise_error(F.concat(F.lit("no coordinate for "), F.col("key"))).cast("bigint"))
        entries.append(F.when(F.col(f"_dim{p}").isNotNull(), F.struct(F.col(f"_dim{p}").alias("dim"), found.alias("coord"))))
    known = F.filter(F.array(*entries), lambda x: x.isNotNull())
    return met.withColumn("_at", known).select(*columns, F.when(F.size("_at") > 0, F.map_from_entries("_at")).alias("at"))


def packed_values(column: str) -> Column:
    """Arrays of numbers as little-endian doubles; all rows of a batch are laid out at once."""

    @F.pandas_udf("binary")
    def pack(values: pd.Series) -> pd.Series:
        sizes = [0 if v is None else len(v) for v in values]
        flat = np.concatenate([np.zeros(0), *(v for v in values if v is not None)]).astype("<f8").tobytes()
        ends = np.cumsum(sizes) * 8
        return pd.Series([None if v is None else flat[e - 8 * n : e] for v, n, e in zip(values, sizes, ends, strict=True)], dtype=object)

    return pack(column)


def inline_value(column: str) -> Column:
    """Numbers as a `base64:` value of one line: Spark breaks long ones, which readers of stores need not accept."""
    return F.concat(F.lit("base64:"), F.translate(F.base64(packed_values(column)), "\r\n", ""))


def coord_metadata(coords: DataFrame) -> DataFrame:
    """Coordinate arrays as rows: shape, chunks, new dim name and the bytes (little-endian f8) as base64."""
    names = {"time": "run_times", "valid_time": "valid_times", "step": "model_horizons"}
    renamed = F.create_map(*(F.lit(x) for kv in names.items() for x in kv))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("i", "coord"))), lambda x: x["coord"].cast("double"))
    out = coords.groupBy("path", "dim").agg(F.count("*").alias("shape"), ordered.alias("v"))
    return out.select("path", "dim", F.coalesce(renamed[F.col("dim")], F.col("dim")).alias("dim_name"), "shape", F.col("shape").alias("chunks"), inline_value("v").alias("inline"))


def datavar_metadata(chunks: DataFrame, n_lat: int = 721, n_lon: int = 1440) -> DataFrame:
    """`.zarray` JSON of each variable (one chunk per time and step, whole grids, NaN as fill) with its dims, and how many chunks it has."""
    sizes = chunks.groupBy("varname").agg(F.count_distinct("time").alias("nt"), F.count_distinct("step_h").alias("ns"), F.count("*").alias("n_chunks"))
    dims = F.array(*map(F.lit, ("time", "step", "latitude", "longitude")))
    doc = F.to_json(F.struct(F.array("nt", "ns", F.lit(n_lat), F.lit(n_lon)).alias("shape"), F.array(F.lit(1), F.lit(1), F.lit(n_lat), F.lit(n_lon)).alias("chunks"), F.lit("NaN").alias("fill_value"), dims.alias("dims")))
    return sizes.select("varname", "n_chunks", doc.alias("zarray"))


def chunk_keys(chunks: DataFrame, dims: tuple[str, ...] = ("time", "step_h"), key: str = "varname") -> DataFrame:
    """Key `i.j.0.0` (with a level `i.j.k.0.0`) of each chunk by its places on the axes of its variable."""
    places = [f"_place{n}" for n in range(len(dims))]
    placed = chunks
    for dim, place in zip(dims, places, strict=True):
        placed = place_on_axis(placed, dim, place, key)
    return placed.withColumn("key", F.concat_ws(".", *(F.col(p).cast("string") for p in places), F.lit("0"), F.lit("0"))).drop(*places)


def drop_member_dim(refs: DataFrame) -> DataFrame:
    """Keys `path/i.j.m.k...` of all members at once as `path/i.j.k...` with a member column."""
    p = parse_chunk_key(refs).where("path IS NOT NULL AND NOT path LIKE '%number' AND size(chunk) >= 3")
    rest = F.concat(F.slice("chunk", 1, 2), F.slice("chunk", 4, 99))
    return p.select(F.get("chunk", 2).alias("member"), F.concat(F.col("path"), F.lit("/"), F.array_join(F.transform(rest, lambda x: x.cast("string")), ".")).alias("key"), "uri", "offset", "length")


def drop_member_arrays(arrays: DataFrame) -> DataFrame:
    """Arrays (path, shape, chunks, dims) of a store of all members as those of one member: no `number` dim, and no array of it.

    `single_member` marks the root's attributes (path '').
    """
    at = F.array_position("dims", "number").cast("int")
    without = lambda c: F.when(at > 0, F.concat(F.slice(c, F.lit(1), at - 1), F.slice(c, at + 1, F.lit(99)))).otherwise(F.col(c))
    kept = arrays.where(~F.col("path").rlike("(^|/)number$"))
    return kept.select(*(c for c in arrays.columns if c not in ("shape", "chunks", "dims")), without("shape").alias("shape"), without("chunks").alias("chunks"), without("dims").alias("dims"), (F.col("path") == "").alias("single_member"))


def add_member_dim(arrays: DataFrame, members: int = 51) -> DataFrame:
    """`number` after `step` (or first) in dims, and the member count at the same place in the shape."""
    place = F.array_position("dims", "step").cast("int") + 1
    return arrays.withColumns({"shape": F.array_insert("shape", place, F.lit(members)), "chunks": F.array_insert("chunks", place, F.lit(1)), "dims": F.array_insert("dims", place, F.lit("number"))})


def split_members(refs: DataFrame, key: str = "key", value: str | None = None) -> DataFrame:
    """Member of each key: by the first form of the key that matches, the number in its attributes, or a form of its value.

    `combined_data` where none does.
    """
    forms = [extract(F.col(key), p) for p in (r"/number/(\d+)/", r"number_(\d+)", r"ens_?(\d+)")]
    ways = [*(F.concat(F.lit("ens"), f) for f in forms), F.when(F.col(key).contains("control"), "control")]
    if value is not None:
        attrs = F.when(F.col(key).endswith(".zattrs"), F.get_json_object(value, "$.number"))
        ways += [F.concat(F.lit("ens"), attrs), F.concat(F.lit("ens"), extract(F.col(value), r"[/._-]ens_?(\d+)[/._-]"))]
    return refs.withColumn("member_group", F.coalesce(*ways, F.lit("combined_data")))


def hierarchical_layout(messages: DataFrame) -> DataFrame:
    """For each (variable, step type, level type): how many levels and members, and so which dims are joined along."""
    out = messages.groupBy("varname", "stepType", "typeOfLevel").agg(F.count_distinct("level").alias("n_levels"), F.count_distinct("number").alias("n_members"), F.count("*").alias("n"))
    return out.withColumns({"path": F.concat_ws("/", "varname", "stepType", "typeOfLevel"), "level_dim": F.when(F.col("n_levels") > 1, "concat").otherwise("identical"), "member_dim": F.col("n_members") > 1})


def tag_messages(keyed: DataFrame) -> DataFrame:
    return keyed.withColumn("ensemble_member", F.when(F.col("number") == -1, "control").otherwise(F.format_string("ens%02d", "number")))


def refs_from_index(index: DataFrame, with_level: bool = True) -> DataFrame:
    """References of all members and hours in one job, and a metadata row for each run (key `_run/<time>`).

    Length -1 runs to the end of the file; a message goes if that is unknown.
    """
    length = F.when(F.col("length") == -1, F.col("file_size") - F.col("offset")).otherwise(F.col("length"))
    rows = build_ref_key(index.withColumn("length", length).where("length IS NOT NULL"), with_level)
    refs = rows.select("key", "uri", "offset", "length", F.lit(None).cast("string").alias("meta"))
    time = F.date_format("run_time", "yyyy-MM-dd'T'HH:mm:ss")
    runs = rows.groupBy(time.alias("run_time")).agg(F.count_distinct("member").alias("n_members"), F.count("*").alias("n_refs"))
    none = [F.lit(None).cast(t).alias(c) for c, t in (("uri", "string"), ("offset", "bigint"), ("length", "bigint"))]
    return refs.unionByName(runs.select(F.concat(F.lit("_run/"), "run_time").alias("key"), *none, F.to_json(F.struct("run_time", "n_members", "n_refs")).alias("meta")))


def cells_from_grid(grids: DataFrame, lon0: float = -180.0, step: float = 0.25, width: int = 1440) -> DataFrame:
    """Row-major values as cells: latitude falls from 90, longitude rises from lon0."""
    flat = grids.select(*(c for c in grids.columns if c != "values"), F.posexplode("values").alias("pos", "value"))
    return flat.withColumns({"lat": 90.0 - step * F.floor(F.col("pos") / width), "lon": lon0 + step * F.pmod("pos", F.lit(width))})


def assemble_grid(chunks: DataFrame, arrays: DataFrame) -> DataFrame:
    """Cells of arrays of any number of dimensions: array, at (index in each dimension), place (row-major in the whole) and value.

    chunks: array, chunk (the chunk's number in each dimension) and values (row-major, whole chunks). arrays: array, shape and
    chunks (the chunk's size in each dimension). What hangs over an edge goes. A chunk that is not there has no cells; one with
    another number of dimensions or values than its array says fails. Arrays without metadata are left out, as are null values
    of a whole chunk. An array of no dimensions has one chunk with one value.
    """
    sizes = arrays.select("array", F.transform("shape", lambda n: n.cast("bigint")).alias("_shape"), F.transform("chunks", lambda n: n.cast("bigint")).alias("_sizes"))
    one = F.lit(1).cast("bigint")
    product = lambda v: F.aggregate(v, one, lambda a, x: a * x)
    dims = F.sequence(F.lit(1), F.size("_shape"))
    none = F.array().cast("array<bigint>")
    strides = lambda c: F.when(F.size("_shape") == 0, none).otherwise(F.transform(dims, lambda d: product(F.slice(c, d + 1, F.size(c)))))
    met = chunks.join(sizes, "array").where("values IS NOT NULL")
    fits = (F.size("chunk") == F.size("_shape")) & (F.size("_sizes") == F.size("_shape")) & (F.size("values") == product(F.col("_sizes")))
    told = F.concat(F.lit("chunk of another form than its array: "), F.col("array").cast("string"))
    met = met.withColumn("values", F.when(fits, F.col("values")).otherwise(F.raise_error(told).cast(met.schema["values"].dataType)))
    met = met.withColumns({"_in": strides(F.col("_sizes")), "_out": strides(F.col("_shape")), "_from": F.zip_with("chunk", "_sizes", lambda c, n: c * n)})
    flat = met.select("array", "_shape", "_sizes", "_in", "_out", "_from", F.posexplode("values").alias("_pos", "value"))
    within = F.transform("_in", lambda stride, d: F.floor(F.col("_pos") / stride) % F.get("_sizes", d))
    flat = flat.withColumn("at", F.zip_with("_from", within, lambda a, b: a + b))
    inside = F.forall(F.zip_with("at", "_shape", lambda i, n: i < n), lambda x: x)
    place = F.aggregate(F.zip_with("at", "_out", lambda i, n: i * n), F.lit(0).cast("bigint"), lambda a, x: a + x)
    return flat.where(inside).select("array", "at", place.alias("place"), "value")


def flatten_tree(cells: DataFrame, names: list[str]) -> DataFrame:
    """One wide row per step, member and cell with a column for each variable."""
    return cells.groupBy("step_h", "member", "cell").pivot("varname", names).agg(F.first("value"))


def split_numbers(raw: pd.Series, dtype: str) -> pd.Series:
    """Numbers of each value: all bytes of a batch are read at once, then divided by the values' lengths."""
    width = np.dtype(dtype).itemsize
    sizes = np.array([0 if b is None else len(b) // width for b in raw])
    numbers = np.frombuffer(b"".join(b[: n * width] for b, n in zip(raw, sizes, strict=True) if b is not None), dtype).astype(float)
    ends = np.cumsum(sizes)
    return pd.Series([None if b is None else numbers[e - n : e] for b, n, e in zip(raw, sizes, ends, strict=True)], dtype=object)


def bytes_to_array(df: DataFrame, column: str = "data", dtype: str = "<f4") -> DataFrame:
    @F.pandas_udf("array<double>")
    def numbers(raw: pd.Series) -> pd.Series:
        return split_numbers(raw, dtype)

    return df.withColumn("values", numbers(column))


def decode_chunks(df: DataFrame, decoders: dict[str, Callable[[bytes], object]], column: str = "data") -> DataFrame:
    """`decode_batches` with decoders of one chunk, which raise ValueError or TypeError for a chunk that they cannot read."""
    return decode_batches(df, {name: each(decode) for name, decode in decoders.items()}, column)


def decode_batches(df: DataFrame, decoders: dict[str, Callable[[list[bytes]], list]], column: str = "data") -> DataFrame:
    """Values of each chunk by the first decoder that can read it; `status` names it, or is 'failed' or, of null bytes, 'missing'.

    A decoder gets a list of chunks (bytes) and gives one array of numbers for each, None for those that it cannot read; if it
    raises ValueError or TypeError it has read none of them. The next decoder gets what is left, so each is called once for a
    batch and no number passes through Python by itself. A NaN stays a NaN.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column(column).to_pylist()
            values: list = [None] * len(raw)
            status = ["missing" if x is None else "failed" for x in raw]
            left = [i for i, x in enumerate(raw) if x is not None]
            for name, decode in decoders.items():
                if not left:
                    break
                try:
                    got = decode([raw[i] for i in left])
                except (ValueError, TypeError):
                    continue
                for i, v in zip(left, got, strict=True):
                    if v is not None:
                        values[i], status[i] = np.asarray(v, "f8").ravel(), name
                left = [i for i in left if values[i] is None]
            sizes = np.array([0 if v is None else len(v) for v in values], "i8")
            known = [v for v in values if v is not None]
            flat = pa.array(np.concatenate(known) if known else np.zeros(0))
            ends = np.concatenate([[0], np.cumsum(sizes)])
            if ends[-1] >= 2**31:
                raise ValueError("a batch decodes to over 2^31 numbers: lower spark.sql.execution.arrow.maxRecordsPerBatch")
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat, mask=pa.array([v is None for v in values], pa.bool_()))
            columns = [c for n, c in zip(batch.schema.names, batch.columns) if n not in ("values", "status")]
            names = [n for n in batch.schema.names if n not in ("values", "status")]
            yield pa.RecordBatch.from_arrays([*columns, lists, pa.array(status, pa.string())], [*names, "values", "status"])

    kept = df.drop("values", "status")
    return kept.mapInArrow(run, kept.withColumns({"values": F.lit(None).cast("array<double>"), "status": F.lit("")}).schema)


def each(decode: Callable[[bytes], object]) -> Callable[[list[bytes]], list]:
    """A decoder of one chunk as a decoder of a list of chunks: those that raise ValueError or TypeError are None."""

    def decode_list(chunks: list[bytes]) -> list:
        out = []
        for raw in chunks:
            try:
                out.append(decode(raw))
            except (ValueError, TypeError):
                out.append(None)
        return out

    return decode_list


def decoder_counts(decoded: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Chunks and numbers of each status."""
    return decoded.groupBy(*by, "status").agg(F.count("*").alias("n_chunks"), F.sum(F.coalesce(F.size("values"), F.lit(0)).cast("bigint")).alias("n_values"))


#: The dims that stand for time in the arrays of each axis, in order; an axis table numbers its cells by them in `place`.
AXIS_DIMS = {"horizon": ("step", "valid_time"), "valid_time": ("valid_time", "step"), "run_time": ("time", "step"), "best_available": ("valid_time",)}
_STORE = {"axis": "string", "key": "string", "kind": "string", "uri": "string", "offset": "bigint", "length": "bigint", "meta": "string", "inline": "string"}


def place_levels(chunks: DataFrame) -> DataFrame:
    """A chunk index with `path`, all `levels` of its path in order and `k`, the place of its own level among them.

    Levels of a path are gathered in one row: they are the values of an axis of one array. Null levels have no place.
    """
    keyed = chunks.withColumn("path", F.concat_ws("/", "varname", "stepType", "typeOfLevel"))
    levels = keyed.groupBy("path").agg(F.sort_array(F.collect_set("level")).alias("levels"))
    return keyed.join(levels, "path").withColumn("k", F.array_position("levels", F.col("level")) - 1).where("k >= 0")


def store_chunks(axes: DataFrame, placed: DataFrame) -> DataFrame:
    """Chunk rows of the stores of all axes: `path/variable/i.j.k.0.0` by place on the axis and, of several levels, by level.

    `axes`: axis, time, step_h, valid_time, place (array<bigint>). Of several chunks for a key the first by uri and offset counts.
    All axes are joined with the index at once, so it is read and shuffled once whatever their number; of the chunks of one time, step and level
    only the first is joined, as each cell of an axis has one time and step.
    """
    one = placed.groupBy("time", "step_h", "path", "varname", "k", (F.size("levels") > 1).alias("several")).agg(F.min_by(F.struct("uri", "offset", "length"), F.struct("uri", "offset")).alias("chunk"))
    met = axes.select("axis", "time", "step_h", "place").join(one, ["time", "step_h"])
    level = F.when(F.col("several"), F.array("k")).otherwise(F.array().cast("array<bigint>"))
    zero = F.array(F.lit(0).cast("bigint"), F.lit(0).cast("bigint"))
    number = F.array_join(F.concat("place", level, zero).cast("array<string>"), ".")
    first = met.groupBy("axis", F.concat("path", F.lit("/"), "varname", F.lit("/"), number).alias("key")).agg(F.min_by("chunk", F.struct("chunk.uri", "chunk.offset")).alias("c"))
    return first.select("axis", "key", F.lit("chunk").alias("kind"), "c.uri", "c.offset", "c.length", F.lit(None).cast("string").alias("meta"), F.lit(None).cast("string").alias("inline"))


def store_metadata(axes: DataFrame, placed: DataFrame, n_lat: int = 721, n_lon: int = 1440) -> DataFrame:
    """Array and coordinate rows of the stores of all axes.

    Each group has an `array` row and `coord` rows for time, valid_time, step (hours) and its levels. A coordinate is its values
    in row-major order of its dims as little-endian doubles in base64 (times as seconds since 1970); it runs over one dim if it
    depends on that alone. The values of an axis are gathered in one row, as the store keeps them in one value.
    """
    names = {"time": "run_times", "valid_time": "valid_times", "step": "model_horizons"}
    seconds = lambda c: F.expr(f"timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {c})").cast("double")
    own = {"time": seconds("time"), "valid_time": seconds("valid_time"), "step": F.col("step_h").cast("double")}
    by_axis = lambda rule: F.coalesce(*(F.when(F.col("axis") == a, rule(d)) for a, d in AXIS_DIMS.items()))
    strings = lambda d: F.array(*map(F.lit, d))
    # a coordinate that is itself a dim (but of horizons, whose steps repeat along time) runs over that dim alone
    alone = lambda n, d: n in d and d != AXIS_DIMS["horizon"]
    at = {n: by_axis(lambda d, n=n: F.lit(d.index(n) if alone(n, d) else -1)) for n in own}
    first, second = F.get("place", 0), F.get("place", 1)
    needed = {n: (at[n] < 0) | (F.coalesce(F.get("place", 1 - F.greatest(at[n], F.lit(0))), F.lit(0)) == 0) for n in own}
    gathered = axes.groupBy("axis").agg(
        F.max(first).alias("last_0"), F.max(second).alias("last_1"),
        *(F.sort_array(F.collect_list(F.when(needed[n], F.struct(first.alias("p"), second.alias("q"), v.alias("v"))))).alias(n) for n, v in own.items()),
    )
    ends = F.filter(F.array(F.col("last_0") + 1, F.col("last_1") + 1), lambda n: n.isNotNull())
    coords = []
    for n in own:
        dims = by_axis(lambda d, n=n: strings([names[n]] if alone(n, d) else [names[x] for x in d]))
        shape = F.when(at[n] < 0, F.col("ends")).otherwise(F.array(F.get("ends", F.greatest(at[n], F.lit(0)))))
        coords.append(F.struct(F.lit(n).alias("name"), shape.alias("shape"), dims.alias("dims"), F.col(n)["v"].alias("v")))
    per_axis = gathered.withColumn("ends", ends).withColumn("coords", F.array(*coords)).select("axis", "ends", "coords")
    packed = per_axis.select("axis", F.explode("coords").alias("c")).select("axis", "c.name", "c.shape", "c.dims", "c.v")
    groups = placed.groupBy("path", "varname", "typeOfLevel").agg(F.first("levels").alias("levels"))
    several = F.size("levels") > 1
    described = lambda shape, chunks, dims: F.to_json(F.struct(shape.alias("shape"), chunks.alias("chunks"), dims.alias("dims")))
    ones = lambda a: F.transform(a, lambda x: F.lit(1).cast("bigint"))
    whole = F.array(F.lit(n_lat).cast("bigint"), F.lit(n_lon).cast("bigint"))
    with_levels = lambda a, extra: F.when(several, F.concat(a, F.array(extra))).otherwise(a)
    time_dims = by_axis(lambda d: strings([names[x] for x in d]))
    shape = with_levels(F.col("ends"), F.size("levels").cast("bigint"))
    dims = F.concat(with_levels(time_dims, F.col("typeOfLevel")), strings(["latitude", "longitude"]))
    pairs = groups.crossJoin(per_axis.select("axis", "ends"))
    empty = lambda *columns: [F.lit(None).cast(_STORE[c]).alias(c) for c in columns]
    place = ("uri", "offset", "length")
    arrays = pairs.select("axis", F.concat_ws("/", "path", "varname", F.lit(".zarray")).alias("key"), F.lit("array").alias("kind"), *empty(*place), described(F.concat(shape, whole), F.concat(ones(shape), whole), dims).alias("meta"), *empty("inline"))
    inline = inline_value("v").alias("inline")
    number = F.array_join(F.transform("shape", lambda x: F.lit("0")), ".")
    once = packed.select("axis", "name", described(F.col("shape"), F.col("shape"), F.col("dims")).alias("meta"), number.alias("number"), inline)
    timed = groups.select("path").crossJoin(once).select("axis", F.concat_ws("/", "path", "name", "number").alias("key"), F.lit("coord").alias("kind"), *empty(*place), "meta", "inline")
    n_levels = F.when(several, F.array(F.size("levels"))).otherwise(F.array().cast("array<int>"))
    level_dims = F.when(several, F.array("typeOfLevel")).otherwise(F.array().cast("array<string>"))
    levels = groups.select("path", "typeOfLevel", "levels", described(n_levels, n_levels, level_dims).alias("meta"), F.transform("levels", lambda x: x.cast("double")).alias("v"))
    levels = levels.select(F.concat_ws("/", "path", "typeOfLevel", F.when(F.size("v") > 1, "0")).alias("key"), F.lit("coord").alias("kind"), *empty(*place), "meta", inline)
    leveled = levels.crossJoin(per_axis.select("axis")).select(*_STORE)
    return arrays.unionByName(timed).unionByName(leveled)
