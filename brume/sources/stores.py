"""Reference stores, templates and file listings; and the sinks that write them."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.project import chunk_ref_kind, extract


def read_reference_table(table: DataFrame) -> DataFrame:
    """(key, value binary) rows as references; `version` is left out."""
    text = table.where("key <> 'version'").select("key", F.decode("value", "UTF-8").alias("value"))
    kinds = chunk_ref_kind(text)
    meta = F.col("value").startswith("{")
    return kinds.select("key", F.when(meta, "meta").when(F.col("kind") == "ref", "ref").otherwise("inline").alias("kind"), "uri", "offset", "length", F.when(~meta & (F.col("kind") != "ref"), F.col("value")).alias("inline"), F.when(meta, F.col("value")).alias("meta"))


def read_legacy_blob(table: DataFrame) -> DataFrame:
    """The old form: one row whose value is the whole store as JSON. Entries become (key, value) rows."""
    entries = F.explode(F.from_json(F.decode("value", "UTF-8"), "map<string,string>"))
    return table.where("key = 'refs'").select(entries.alias("key", "value"))


def read_mapping(spark: SparkSession, path: str) -> DataFrame:
    """Templates written by `write_mapping`: member and forecast_hour come from the folders and prune the scan."""
    return spark.read.parquet(path)


def write_mapping(mapping: DataFrame, path: str) -> None:
    mapping.write.mode("overwrite").partitionBy("member", "forecast_hour").parquet(path)


def load_member_hours(refs: DataFrame) -> DataFrame:
    """All hours of each member in one store; a later hour overwrites an equal key.

    The last reference is an aggregate, so that a key of very many hours or runs is merged before it moves.
    """
    rest = [c for c in refs.columns if c not in ("member", "key")]
    last = refs.groupBy("member", "key").agg(F.max_by(F.struct(*rest), F.struct("forecast_hour", "uri", "offset")).alias("r"))
    return last.select("member", "key", "r.*").select(*refs.columns)


def list_files(spark: SparkSession, path: str, keep: str = ".*", drop: str = r"\.idx$") -> DataFrame:
    """path and size of the files under a folder; contents are not read."""
    return select_files(spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", F.col("length").alias("size")), keep, drop)


def select_files(files: DataFrame, keep: str = ".*", drop: str = r"\.idx$") -> DataFrame:
    return files.where(F.col("path").rlike(keep) & ~F.col("path").rlike(drop)).orderBy("path")


def expected_files(runs: DataFrame, members: int, hours: tuple[int, int, int], pattern: str = "s3://bucket/%s/%s/ge%02d.f%03d") -> DataFrame:
    """Paths that a run (run_time) must have: members x forecast hours (first, last, step)."""
    grid = runs.select("run_time").distinct().withColumn("member", F.explode(F.sequence(F.lit(1), F.lit(members)))).withColumn("forecast_hour", F.explode(F.sequence(*map(F.lit, hours))))
    return grid.withColumn("path", F.format_string(pattern, F.date_format("run_time", "yyyyMMdd"), F.date_format("run_time", "HH"), "member", "forecast_hour"))


def fetch_ranges(refs: DataFrame, partitions: int, retries: int = 3, suffix: str = ".grib2", span: int = 64 << 20, near: int = 64 << 10) -> DataFrame:
    """`data` (bytes), `status` and `read_from` of each (uri, offset, length).

    A file is split by offset into spans of `span` bytes, each of which is one task's, so many tasks read one large file and
    a file is opened once for a span. Within a span, ranges with gaps of at most `near` bytes are one read, which ranges
    share and which begins at `read_from` (null where nothing was read). Memory is
    bounded by a span and the longest range. A path that is not there is tried with `suffix`; a `base64:` value is its own data.
    Null offsets and lengths are 'null range'. Reading goes through fsspec if it is there, else only local files can be read;
    a failed read is a null and its error for all ranges that share it. A range past the end of its file has what there is.
    """
    inline = F.col("uri").startswith("base64:")
    is_range = F.coalesce(~inline, F.lit(False)) & F.col("offset").isNotNull() & F.col("length").isNotNull()
    start, end = F.col("offset"), F.col("offset") + F.col("length")
    names = refs.columns
    placed = refs.withColumns({"_range": is_range, "_span": F.when(is_range, F.floor(start / span)).otherwise(F.pmod(F.xxhash64("uri", "offset"), F.lit(partitions)))})
    # gaps and islands: a range that begins over `near` bytes past the end of all before it begins a read
    order = Window.partitionBy("uri", "_span", "_range").orderBy("offset", "length")
    reached = F.max(end).over(order.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.when(reached.isNull() | (start - reached > near), 1).otherwise(0)
    numbered = placed.withColumn("_begins", begins).withColumn("_read", F.sum("_begins").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    of_read = Window.partitionBy("uri", "_span", "_range", "_read")
    spread = numbered.withColumns({"_from": F.min(start).over(of_read), "_to": F.max(end).over(of_read)}).drop("_begins")

    def fetch(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import base64

        try:
            from fsspec import open as opener
        except ImportError:
            opener = None
        held: list = [None, None]  # the last path and its open file
        block: list = [None, b"", "ok"]  # the last read (path, from), its bytes and status

        def read(uri: str, offset: int, length: int) -> bytes:
            if held[0] != uri:
                close()
                held[:] = uri, (opener(uri, "rb").open() if opener else open(uri.removeprefix("file:"), "rb"))  # noqa: SIM115
            held[1].seek(offset)
            return held[1].read(length)

        def close() -> None:
            if held[1] is not None:
                held[1].close()
            held[:] = None, None

        def load(uri: str, first: int, length: int) -> None:
            if block[0] == (uri, first):
                return
            got, said = b"", "ok"
            for _ in range(retries):
                try:
                    try:
                        got = read(uri, first, length)
                    except FileNotFoundError:
                        got = read(uri + suffix, first, length)
                    said = "ok"
                    break
                except OSError as e:
                    said = type(e).__name__
                    close()
            block[:] = (uri, first), got, said

        for part in parts:
            data, status, began = [], [], []
            for uri, offset, length, whole, first, last in zip(part.uri, part.offset, part.length, part._range, part._from, part._to, strict=True):
                if not whole:
                    known = isinstance(uri, str) and uri.startswith("base64:")
                    data.append(base64.b64decode(uri[7:]) if known else None)
                    status.append("inline" if known else "null range")
                    began.append(None)
                    continue
                first, offset, length = int(first), int(offset), int(length)
                load(uri, first, int(last) - first)
                data.append(block[1][offset - first : offset - first + length] if block[2] == "ok" else None)
                status.append(block[2])
                began.append(first if block[2] == "ok" else None)
            yield part[names].assign(data=data, status=status, read_from=pd.array(began, "Int64"))
        close()

    schema = refs.withColumns({"data": F.lit(None).cast("binary"), "status": F.lit(""), "read_from": F.lit(None).cast("bigint")}).schema
    return spread.repartition(partitions, "uri", "_span").sortWithinPartitions("uri", "_span", "_from", "offset").mapInPandas(fetch, schema)


def discover_members(files: DataFrame, pattern: str = r"/(gep\d{2}|control|ens\d{2})\.", path: str = "path") -> DataFrame:
    return files.select(extract(F.col(path), pattern).alias("member")).where("member IS NOT NULL").distinct().orderBy("member")


def wire_form(refs: DataFrame) -> DataFrame:
    """References as (key, value binary): triples and metadata as JSON."""
    triple = F.concat(F.lit('["'), F.col("uri"), F.lit('",'), F.col("offset").cast("string"), F.lit(","), F.col("length").cast("string"), F.lit("]"))
    value = F.when(F.col("kind") == "ref", triple).when(F.col("kind") == "meta", F.col("meta")).otherwise(F.col("inline"))
    keep = [c for c in refs.columns if c in ("member", "date", "run", "source")]
    return refs.select("key", F.encode(value, "UTF-8").alias("value"), *keep)


def write_reference_table(refs: DataFrame, path: str, partition: str | None = None, compression: str = "zstd") -> None:
    out = wire_form(refs).write.mode("overwrite").option("compression", compression)
    (out.partitionBy(partition) if partition else out).parquet(path)


def tag_and_write(refs: DataFrame, path: str, run: str, source: str) -> None:
    """Append references under their date (a column) and run, with the source they came from."""
    tagged = wire_form(refs).withColumns({"run": F.lit(run), "source": F.lit(source)})
    tagged.write.mode("append").partitionBy("date", "run").parquet(path)


def write_chunked(refs: DataFrame, path: str, max_keys: int = 10_000) -> DataFrame:
    """Files of at most `max_keys` keys, and a manifest beside them, which is returned."""
    wire_form(refs).write.mode("overwrite").option("maxRecordsPerFile", max_keys).option("compression", "zstd").parquet(f"{path}/chunks")
    files = refs.sparkSession.read.parquet(f"{path}/chunks").groupBy(F.col("_metadata.file_name").alias("file")).agg(F.count("*").alias("keys"))
    manifest = files.agg(F.count("*").alias("num_chunks"), F.sum("keys").alias("total_keys"), F.max("keys").alias("largest")).withColumn("schema_version", F.lit(1))
    manifest.write.mode("overwrite").parquet(f"{path}/manifest")
    return refs.sparkSession.read.parquet(f"{path}/manifest")


def read_chunked(spark: SparkSession, path: str, schema_version: int = 1) -> DataFrame:
    """The references of all chunks; fails if the manifest is of another version or counts other chunks or keys."""
    said = spark.read.parquet(f"{path}/manifest").first()
    table = spark.read.parquet(f"{path}/chunks")
    found = table.groupBy(F.col("_metadata.file_name")).count().agg(F.count("*").alias("chunks"), F.sum("count").alias("keys")).first()
    if said["schema_version"] != schema_version or (found["chunks"], found["keys"]) != (said["num_chunks"], said["total_keys"]):
        raise ValueError("the chunks differ from their manifest")
    return read_reference_table(table)


def verify_write(written: DataFrame, source: DataFrame) -> DataFrame:
    """How many keys are on one side only, and how many values differ."""
    a, b = written.select("key", F.col("value").alias("a")), source.select("key", F.col("value").alias("b"))
    both = a.withColumn("in_a", F.lit(True)).join(b.withColumn("in_b", F.lit(True)), "key", "full_outer")
    return both.agg(F.count_if(F.col("in_b").isNull()).alias("only_written"), F.count_if(F.col("in_a").isNull()).alias("only_source"), F.count_if(F.col("in_a") & F.col("in_b") & ~F.col("a").eqNullSafe(F.col("b"))).alias("different"))


def new_times(new: DataFrame, existing: DataFrame, time: str = "valid_time") -> DataFrame:
    """Rows of `new` at times that `existing` does not have."""
    return new.join(existing.select(time).distinct(), time, "left_anti")


def append_new_times(new: DataFrame, path: str, time: str = "valid_time") -> int:
    """Append unseen times to a table; grids must be equal. Returns the rows appended."""
    spark = new.sparkSession
    try:
        old = spark.read.parquet(path)
    except Exception as e:  # the table is not there yet
        if "PATH_NOT_FOUND" not in str(e):
            raise
        new.write.parquet(path)
        return new.count()
    grid = [new.select("lat", "lon").distinct(), old.select("lat", "lon").distinct()]
    if not grid[0].exceptAll(grid[1]).isEmpty() or not grid[1].exceptAll(grid[0]).isEmpty():
        raise ValueError("the grids differ")
    fresh = new_times(new, old, time)
    n = fresh.count()
    if n:
        fresh.write.mode("append").parquet(path)
    return n


def feature_cube(cells: DataFrame, variables: list[str]) -> DataFrame:
    """`{v}_ensemble_mean` and `{v}_ensemble_standard_deviation` (float32) per step, valid time (if there is one) and cell."""
    value = F.nanvl(F.col("value").cast("double"), F.lit(None))
    dims = [c for c in ("step_h", "valid_time", "cell") if c in cells.columns]
    return cells.groupBy(*dims).pivot("varname", variables).agg(F.avg(value).cast("float").alias("ensemble_mean"), F.stddev_pop(value).cast("float").alias("ensemble_standard_deviation"))


def write_run_report(report: DataFrame, path: str) -> None:
    report.coalesce(1).write.mode("overwrite").json(path)


def select_dates(table: DataFrame, dates: DataFrame, time: str = "valid_time") -> DataFrame:
    """Rows on the given dates (a small table with column `date`)."""
    return table.join(dates.select("date").distinct(), F.to_date(time) == F.col("date"), "left_semi")
