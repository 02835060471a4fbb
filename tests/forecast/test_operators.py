"""What SQL over the driver's tables does not show: errors, files, edge values, invariants."""

from __future__ import annotations

import base64
import datetime
import json
import math
import os
import struct

import pytest
from pyspark.sql import functions as F

from brume.functions import project
from brume.operators import aggregates, axes, filters, joins, sets, store, windows
from brume.sources import index_files, scratch, stores


def test_strict_index_fails_on_a_bad_line(spark, tmp_path):
    (tmp_path / "a.idx").write_text("1:0:d=2024010100:TMP:2 m:3 hour fcst:\n12.1:9:d=2024010100:X:\n")
    rows = index_files.read_idx(index_files.index_lines(spark, str(tmp_path)))
    with pytest.raises(Exception, match="Could not parse line"):
        rows.collect()
    lenient = index_files.read_idx_lenient(index_files.index_lines(spark, str(tmp_path)))
    assert [r.record for r in lenient.collect()] == [1]
    assert index_files.bad_lines(index_files.index_lines(spark, str(tmp_path))).first().n_short == 1


def test_lengths_end_with_the_file(spark, tmp_path):
    (tmp_path / "a.idx").write_text("1:0:d:A:\n2:70:d:B:x\n3:100:d:C:\n")
    lines = index_files.index_lines(spark, str(tmp_path))
    sizes = lines.select("idx_uri").distinct().withColumn("file_size", F.lit(130).cast("long"))
    assert [r.length for r in index_files.read_idx(lines, sizes).orderBy("idx").collect()] == [70, 30, 30]


def test_template_of_one_date_serves_another(spark):
    """The index mapped with another date's template equals the index mapped with its own."""
    def index(day, shift):
        return spark.createDataFrame([(f"f{h}", i, f"u{h}", 100 * i + shift, 50, f"V{i}:{h} hour", h) for h in (0, 3) for i in (1, 2, 3)], "file STRING, idx INT, uri STRING, offset LONG, length LONG, attrs STRING, step_h INT").withColumn("run_time", F.to_timestamp_ntz(F.lit(day)))

    def template(rows):
        return rows.select("attrs", F.split("attrs", ":")[0].alias("varname"), F.lit("surface").alias("typeOfLevel"), F.lit("instant").alias("stepType"), F.lit(0.0).alias("level"), F.col("step_h").alias("map_step_h"))

    first, second = index("2022-10-14", 0), index("2023-11-04", 7)
    a, b = joins.map_from_index(second, template(first)), joins.map_from_index(second, template(second))
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty() and a.count() == 6
    assert a.where("valid_time <> time + make_dt_interval(0, step_h)").isEmpty()


def test_axes_keep_time_plus_step(spark):
    runs = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-01 00:00:00' AS run_time")
    for axis, n in ((axes.axes_gfs, 121), (axes.axes_gefs, 81), (axes.axes_ecmwf, 85), (axes.axes_cfs, 41)):
        assert axis(runs).count() == n
    valid = spark.sql("SELECT explode(sequence(0, 10)) AS j").select("j", (F.to_timestamp_ntz(F.lit("2024-01-01")) + F.make_dt_interval(hours="j")).alias("valid_time"))
    as_of = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-01 02:00:00' AS as_of")
    best = axes.best_available(valid, as_of).orderBy("valid_time").collect()
    assert [r.step_h for r in best] == [0, 0, 0, 1, 2, 3, 4, 5, 6, 7, 8]
    ranges = spark.createDataFrame([(0, [0, 1, 2]), (1, [6, 7])], "horizon_pos INT, steps ARRAY<INT>")
    grid = axes.horizon(valid.where("j < 4"), ranges)
    assert [r.step_h for r in grid.where("horizon_pos = 1").orderBy("j").collect()] == [6, 7, 6, 7]
    assert grid.where("time + make_dt_interval(0, step_h) <> valid_time").isEmpty()


def test_members_in_every_form(spark):
    got = project.normalize_member(spark.createDataFrame([(x,) for x in (None, "-1", "0", "9", "ens_9", "ens09", "09", "9.0")], "number STRING")).collect()
    assert [r.member for r in got] == ["control"] * 3 + ["ens09"] * 5


def test_store_round_trip(spark, tmp_path):
    refs = spark.createDataFrame([("v/0.0", "ref", "s3://a", 5, 9, None, None), ("v/.zarray", "meta", None, None, None, None, '{"shape":[1]}'), ("lat/0", "inline", None, None, None, "base64:" + base64.b64encode(struct.pack("<2d", 1.5, -2.0)).decode(), None)], "key STRING, kind STRING, uri STRING, offset LONG, length LONG, inline STRING, meta STRING")
    stores.write_reference_table(refs, f"{tmp_path}/t")
    back = stores.read_reference_table(spark.read.parquet(f"{tmp_path}/t"))
    assert back.exceptAll(refs).isEmpty() and refs.exceptAll(back).isEmpty()
    assert stores.verify_write(stores.wire_form(back), stores.wire_form(refs)).first().asDict() == {"only_written": 0, "only_source": 0, "different": 0}
    assert project.decode_inline(back.withColumn("value", F.col("inline")).where("kind = 'inline'")).first()["values"] == [1.5, -2.0]
    assert [r.key for r in filters.strip_chunks(refs.unionByName(refs.limit(1).withColumn("key", F.lit("latitude/0")))).orderBy("key").collect()] == ["latitude/0", "v/.zarray"]
    blob = spark.createDataFrame([("refs", bytearray(json.dumps({"a": "x", "b": "[1,2]"}).encode()))], "key STRING, value BINARY")
    assert {r.key: r.value for r in stores.read_legacy_blob(blob).collect()} == {"a": "x", "b": "[1,2]"}
    manifest = stores.write_chunked(refs, f"{tmp_path}/c", max_keys=1).first()
    assert manifest.total_keys == 3 and manifest.largest == 1


def test_ranges_are_read_from_files(spark, tmp_path):
    (tmp_path / "data").write_bytes(bytes(range(100)))
    refs = spark.createDataFrame([(f"{tmp_path}/data", 3, 4), (f"{tmp_path}/data", 90, 2), (f"{tmp_path}/none", 0, 1)], "uri STRING, offset LONG, length LONG")
    got = {(r.offset, r.length): (r.data and bytes(r.data), r.status) for r in stores.fetch_ranges(refs, 2).collect()}
    assert got == {(3, 4): (bytes([3, 4, 5, 6]), "ok"), (90, 2): (bytes([90, 91]), "ok"), (0, 1): (None, "FileNotFoundError")}


def test_append_only_new_times(spark, tmp_path):
    def cells(hours):
        return spark.createDataFrame([(h, lat, 0.0, 1.0) for h in hours for lat in (1.0, 2.0)], "valid_time INT, lat DOUBLE, lon DOUBLE, value DOUBLE")

    assert stores.append_new_times(cells([0, 3]), f"{tmp_path}/a") == 4
    assert stores.append_new_times(cells([3, 6]), f"{tmp_path}/a") == 2
    assert spark.read.parquet(f"{tmp_path}/a").count() == 6
    with pytest.raises(ValueError, match="grids differ"):
        stores.append_new_times(cells([9]).withColumn("lat", F.col("lat") + 1), f"{tmp_path}/a")


def test_modes_that_fail(spark):
    rows = spark.createDataFrame([("f", 1, "a"), ("f", 2, "a")], "file STRING, idx INT, attrs STRING")
    assert aggregates.uniqueness_check(rows).count() == 1
    with pytest.raises(Exception, match="not unique"):
        aggregates.uniqueness_check(rows, mode="fail").collect()
    chunks = spark.createDataFrame([(0, "u", 1, 1), (0, "v", 2, 1)], "step_h INT, uri STRING, offset LONG, length LONG")
    with pytest.raises(Exception, match="more than one chunk"):
        joins.axis_lookup(chunks.select("step_h").distinct(), chunks, ("step_h",), mode="fail").collect()
    a = spark.createDataFrame([(1.0, 2.0)], "lat DOUBLE, lon DOUBLE")
    with pytest.raises(Exception, match="grids differ"):
        sets.combine_hours([a, a.unionByName(a.withColumn("lat", F.lit(9.0)))]).collect()


def test_missing_is_never_over_a_threshold(spark):
    cells = spark.createDataFrame([("tp", 0, 0, 0, float("nan")), ("tp", 1, 0, 0, 30.0), ("tp", 2, 0, 0, None)], "varname STRING, member INT, day INT, cell INT, value DOUBLE")
    all_members = {r.threshold: r.probability for r in aggregates.exceedance_prob(cells).collect()}
    valid = {r.threshold: r.probability for r in aggregates.exceedance_prob_valid(cells).collect()}
    assert round(all_members[25.0], 3) == 33.333 and all_members[50.0] == 0 and valid[25.0] == 100


def test_totals_without_any_pair_stay_as_they_are(spark):
    cells = spark.createDataFrame([("tp", 0, 0, 6, 4.0)], "varname STRING, member INT, cell INT, step_h INT, value DOUBLE")
    assert [(r.step_h, r.total) for r in joins.diff_24h(cells).collect()] == [(6, 4.0)]


def test_ties_are_broken_by_idx(spark):
    rows = spark.createDataFrame([("t", "surface", 0, 9, 5, "u"), ("t", "surface", 0, 9, 2, "u"), ("t", "other", 0, 99, 1, "u"), ("q", "other", 0, 1, 1, "u")], "varname STRING, typeOfLevel STRING, time INT, length LONG, idx INT, uri STRING")
    wanted = spark.createDataFrame([("t", "surface")], "varname STRING, typeOfLevel STRING")
    assert sorted((r.varname, r.idx) for r in windows.dedupe_largest(rows, wanted).collect()) == [("q", 1), ("t", 2)]


def test_decoders_are_tried_in_order(spark):
    rows = spark.createDataFrame([(bytearray(b"\x01\x02"),), (bytearray(b"abc"),)], "data BINARY")

    def two(raw):
        if len(raw) != 2:
            raise ValueError
        return list(raw)

    got = store.decode_chunks(rows, {"two": two}).collect()
    assert [(r["values"], r.status) for r in got] == [([1.0, 2.0], "two"), (None, "failed")]


def test_entry_and_queries_import():
    import __spark_entry__

    assert "exceedance_prob" in __spark_entry__.queries() and "exceedance_prob" in __spark_entry__.oracle_sql()


def test_broken_json_lines_fail_or_are_skipped_and_counted(spark):
    lines = spark.createDataFrame([('{"_offset": 5, "_length": 7, "param": "t"},',), ("{broken",), ("[1]",), ("",)], "value STRING")
    with pytest.raises(Exception, match="Could not parse line"):
        index_files.read_idx_json(lines).collect()
    assert [(r.offset, r.length, r.param) for r in index_files.read_idx_json(lines, mode="skip").collect()] == [(5, 7, "t")]
    assert index_files.bad_json_lines(lines).first()[:] == (4, 3)


def test_hours_off_the_axis_fail(spark):
    hours = spark.createDataFrame([(3,), (147,)], "step_h INT")
    with pytest.raises(Exception, match="no forecast hour"):
        windows.hour_index(hours).collect()
    assert {r.step_h: r.hour_index for r in windows.hour_index(hours, mode="null").collect()} == {3: 1, 147: None}


def test_chunk_rules(spark):
    refs = spark.createDataFrame([("a/0.1", "u", 5, 6), ("a/1.0", None, None, None), ("a/.zarray", None, None, None)], "key STRING, uri STRING, offset LONG, length LONG")
    coords = spark.createDataFrame([("a", "time", 0, 100), ("a", "time", 1, 200)], "path STRING, dim STRING, i INT, coord LONG")
    arrays = lambda chunk, size: spark.createDataFrame([("a", 0, "time", 1, 2), ("a", 1, "x", chunk, size)], "path STRING, pos INT, dim STRING, chunk_size INT, size INT")
    got = store.extract_chunk_index(refs, coords, arrays(4, 4)).collect()
    assert {(r.key, r["at"]["time"], r.offset, r.length) for r in got} == {("a/0.1", 100, 5, 6), ("a/1.0", 200, -1, -1)}
    with pytest.raises(Exception, match="no rule for a dim"):
        store.extract_chunk_index(refs, coords, arrays(2, 4)).collect()
    with pytest.raises(Exception, match="no coordinate"):
        store.extract_chunk_index(refs, coords.where("i = 0"), arrays(4, 4)).collect()


def test_keys_with_a_level(spark):
    rows = spark.createDataFrame([("v", 10, 3, 500), ("v", 20, 3, 850), ("v", 20, 6, 500)], "varname STRING, time INT, step_h INT, level INT")
    assert {r.key for r in store.chunk_keys(rows, ("time", "step_h", "level")).collect()} == {"0.0.0.0.0", "1.0.1.0.0", "1.1.0.0.0"}


def test_manifest_is_checked_on_reload(spark, tmp_path):
    refs = spark.createDataFrame([(f"k{i}", "ref", "u", i, 1, None, None) for i in range(25)], "key STRING, kind STRING, uri STRING, offset LONG, length LONG, inline STRING, meta STRING")
    manifest = stores.write_chunked(refs.coalesce(1), str(tmp_path), 10).first()
    assert (manifest.num_chunks, manifest.total_keys, manifest.largest) == (3, 25, 10)
    assert stores.read_chunked(spark, str(tmp_path)).count() == 25
    refs.limit(1).transform(stores.wire_form).write.mode("append").parquet(f"{tmp_path}/chunks")
    with pytest.raises(ValueError, match="manifest"):
        stores.read_chunked(spark, str(tmp_path))


def test_inline_values_and_suffixes_are_read(spark, tmp_path):
    (tmp_path / "f.grib2").write_bytes(bytes(range(50)))
    refs = spark.createDataFrame([(f"file:{tmp_path}/f", 4, 2), ("base64:AAEC", 0, 3)], "uri STRING, offset LONG, length LONG")
    assert {(bytes(r.data), r.status) for r in stores.fetch_ranges(refs, 2).collect()} == {(b"\x04\x05", "ok"), (b"\x00\x01\x02", "inline")}


def test_mapper_must_keep_columns(spark):
    rows = spark.createDataFrame([(1, 2)], "a INT, b INT")
    assert joins.mapped(rows, None) is rows
    with pytest.raises(ValueError, match="dropped"):
        joins.mapped(rows, lambda m: m.drop("b"))


def test_totals_without_any_pair_are_the_values(spark):
    cells = spark.createDataFrame([("v", 1, 0, 3, 5.0), ("v", 1, 0, 9, 7.0)], "varname STRING, member INT, cell INT, step_h INT, value DOUBLE")
    assert {(r.step_h, r.total) for r in joins.diff_24h(cells).collect()} == {(3, 5.0), (9, 7.0)}


def test_nearest_runs(spark):
    day = lambda n: datetime.date(2024, 1, n)
    runs = spark.createDataFrame([("k", day(3)), ("k", day(9)), ("j", day(5))], "k STRING, run_date DATE")
    targets = spark.createDataFrame([("k", day(1)), ("k", day(6)), ("k", day(7)), ("k", day(20)), ("k", None), ("j", day(5)), ("none", day(5))], "k STRING, target_date DATE")
    got = {(r.k, r.target_date): r.run_date for r in joins.nearest_run(targets, runs, "k").collect()}
    assert got == {("k", day(1)): day(3), ("k", day(6)): day(9), ("k", day(7)): day(9), ("k", day(20)): day(9), ("k", None): day(9), ("j", day(5)): day(5), ("none", day(5)): None}


def test_largest_messages_in_one_window(spark):
    rows = [("a", "pl", 1, 5, 1), ("a", "pl", 1, 9, 2), ("a", "sfc", 1, 50, 3), ("b", "pl", 1, 1, 4), ("b", "pl", 1, 2, 5)]
    df = spark.createDataFrame([(*r, "u") for r in rows], "varname STRING, typeOfLevel STRING, time INT, length INT, idx INT, uri STRING")
    kept = windows.dedupe_largest(df, spark.createDataFrame([("a", "pl")], "varname STRING, typeOfLevel STRING"))
    assert {r.idx for r in kept.collect()} == {2, 4, 5} and kept.columns == df.columns


def test_a_named_folder_is_needed_on_a_cluster(spark, monkeypatch):
    class Context:
        master = "spark://there"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:  # noqa: N801
            get = staticmethod(lambda key, default=None: default)

    with pytest.raises(RuntimeError, match="checkpoint"):
        scratch.checkpoint_folder(Session())


def test_a_window_without_its_start_is_missing(spark):
    cells = spark.createDataFrame([("tp", 0, 0, s, v) for s, v in ((24, 1.0), (48, 2.0), (96, 5.0), (120, 9.0))], "varname STRING, member INT, cell INT, step_h INT, value DOUBLE")
    assert {r.step_h: r.total for r in joins.precip_window(cells, 48).collect()} == {24: 1.0, 48: 2.0, 96: 3.0, 120: None}


def test_hours_of_other_points_do_not_combine(spark):
    grid = lambda *lats: spark.createDataFrame([(float(x), 0.0, 1) for x in lats], "lat DOUBLE, lon DOUBLE, step_h INT")
    with pytest.raises(Exception, match="the grids differ"):
        sets.combine_hours([grid(1, 2), grid(7, 8)]).collect()
    assert sets.combine_hours([grid(1, 2), grid(2, 1, 1), grid()]).count() == 5


def landing(spark, tmp_path, schema, *batches):
    """A stream that reads one batch after the other."""
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/in-{i}")
        (part,) = [f for f in os.listdir(f"{tmp_path}/in-{i}") if f.startswith("part")]
        os.makedirs(f"{tmp_path}/in", exist_ok=True)
        os.rename(f"{tmp_path}/in-{i}/{part}", f"{tmp_path}/in/{i}.parquet")
        os.utime(f"{tmp_path}/in/{i}.parquet", (1_700_000_000 + i, 1_700_000_000 + i))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")


def test_runs_time_out_once(spark, tmp_path):
    from brume.plans.streamed import drained, rocks
    from brume.streaming import streams

    at = lambda h: datetime.datetime(2024, 1, 1) + datetime.timedelta(hours=h)
    batches = [[("a", 1, at(0)), ("a", 2, at(1)), ("b", 1, at(2)), ("b", 1, at(3)), ("c", 1, at(4)), (None, 5, at(0)), ("d", None, at(1))], [("c", 2, at(20)), ("a", 3, at(5))], [("c", 3, at(40)), ("e", 1, at(90))], [("b", 7, at(91)), ("c", 4, at(91))], [("z", 1, at(200))]]
    with rocks(spark):
        stream = landing(spark, tmp_path, "run_date STRING, number INT, arrived TIMESTAMP", *batches)
        out = drained(streams.stream_run_timeout(stream, least=3, timeout_hours=24), spark, "timeouts").collect()
    found = sorted((r.run_date or "", r.n_members, r.complete) for r in out)
    assert found == [("", 1, False), ("a", 3, True), ("b", 1, False), ("c", 2, False), ("e", 1, False)]


def test_late_rows_are_counted_and_open_windows_kept(spark, tmp_path):
    from brume.streaming import streams

    at = lambda h: datetime.datetime(2024, 1, 1) + datetime.timedelta(hours=h)
    batches = [[("tp", 0, 1.0, at(0)), ("tp", 0, 2.0, at(7))], [("tp", 0, 4.0, at(8)), ("tp", 0, 8.0, at(300))], [("tp", 0, 32.0, at(301))], [("tp", 0, 16.0, at(1))]]
    stream = landing(spark, tmp_path, "varname STRING, cell INT, value DOUBLE, valid_time TIMESTAMP", *batches)
    run = streams.stream_totals(stream, f"{tmp_path}/out", f"{tmp_path}/checkpoint", slide="12 hours")
    run.awaitTermination()
    assert streams.late_rows(run) == 2  # one row, in two windows
    totals = {(r.window_end - at(0)).total_seconds() / 3600: r.total for r in streams.latest_totals(spark.read.parquet(f"{tmp_path}/out")).collect()}
    assert totals == {12: 7.0, 24: 7.0, 312: 40.0, 324: 40.0}


def test_chunks_of_arrays_of_any_dimensions(spark):
    """Arrays of three, two, one and no dimensions, with edges that chunks hang over, against numpy."""
    import numpy as np

    rng = np.random.default_rng(3)
    arrays = {"a": ((5, 7, 3), (2, 3, 3)), "b": ((4, 9), (4, 2)), "c": ((10,), (4,)), "d": ((), ())}
    chunks, metadata, want = [], [], {}
    for name, (shape, sizes) in arrays.items():
        whole = rng.random(shape)
        want |= {(name, at): (float(v), int(np.ravel_multi_index(at, shape)) if shape else 0) for at, v in np.ndenumerate(whole)}
        metadata.append((name, list(shape), list(sizes)))
        counts = tuple(-(-n // c) for n, c in zip(shape, sizes, strict=True))
        padded = np.full(tuple(n * c for n, c in zip(counts, sizes, strict=True)), -1.0)
        padded[tuple(slice(0, n) for n in shape)] = whole
        for number in np.ndindex(*counts):
            part = padded[tuple(slice(i * c, (i + 1) * c) for i, c in zip(number, sizes, strict=True))]
            chunks.append((name, list(map(int, number)), [float(x) for x in part.ravel()]))
    form = "array STRING, chunk ARRAY<INT>, values ARRAY<DOUBLE>"
    about = spark.createDataFrame(metadata, "array STRING, shape ARRAY<INT>, chunks ARRAY<INT>")
    got = store.assemble_grid(spark.createDataFrame([*chunks, ("a", [0, 0, 0], None)], form), about).collect()
    assert {(r.array, tuple(r["at"])): (r.value, r.place) for r in got} == want and len(got) == len(want)
    assert store.assemble_grid(spark.createDataFrame([], form), about).isEmpty()
    with pytest.raises(Exception, match="another form"):
        store.assemble_grid(spark.createDataFrame([("b", [0, 0], [1.0])], form), about).collect()


def test_batches_go_to_the_next_decoder_with_what_is_left(spark):
    import numpy as np

    def doubles(raw):
        return [np.frombuffer(x, "<f8") if len(x) % 8 == 0 else None for x in raw]

    def broken(raw):
        raise ValueError("none of them")

    rows = [(1, bytearray(struct.pack("<2d", 1.5, float("nan")))), (2, bytearray(b"\x07")), (3, None), (4, bytearray(b"abc")), (5, bytearray(b""))]
    df = spark.createDataFrame(rows, "id INT, data BINARY")
    out = store.decode_batches(df, {"broken": broken, "doubles": doubles, "one": lambda raw: [list(x) if len(x) == 1 else None for x in raw]})
    got = {r.id: (r["values"], r.status) for r in out.collect()}
    assert got[1][0][0] == 1.5 and math.isnan(got[1][0][1]) and got[1][1] == "doubles"
    assert got[2] == ([7.0], "one") and got[3] == (None, "missing") and got[4] == (None, "failed") and got[5] == ([], "doubles")
    assert {(r.status, r.n_chunks, r.n_values) for r in store.decoder_counts(out).collect()} == {("doubles", 2, 2), ("one", 1, 1), ("missing", 1, 0), ("failed", 1, 0)}


def test_runs_of_a_hot_key_are_found_over_buckets(spark):
    """Half of all rows have one key; buckets of 16 days, some without runs and some without targets; against brute force."""
    import random

    rng, start = random.Random(5), datetime.date(2020, 1, 1)
    day = lambda: start + datetime.timedelta(rng.choice([rng.randrange(40), 300 + rng.randrange(60), 900, 2000 - rng.randrange(5000)]))
    keys = ["hot"] * 200 + [None] * 20 + [f"k{i % 30}" for i in range(180)]
    runs, targets = [(k, day()) for k in keys], [(k, day()) for k in keys] + [("hot", None), ("alone", start)]
    of_key = {}
    for k, d in runs:
        of_key.setdefault(k, set()).add(d)
    def brute(k, d):
        mine = of_key.get(k)
        return None if not mine else max(mine) if d is None else min(mine, key=lambda r: (abs((r - d).days), -r.toordinal()))
    found = joins.nearest_run(spark.createDataFrame(targets, "k STRING, target_date DATE"), spark.createDataFrame(runs, "k STRING, run_date DATE"), "k", bucket_days=16).collect()
    assert {(r.k, r.target_date): r.run_date for r in found} == {(k, d): brute(k, d) for k, d in targets} and len(found) == len(set(targets))


def test_percentiles_by_selection(spark):
    """Several rounds, ties over wanted ranks, missing values and variables without any, against numpy."""
    import numpy as np

    rng = np.random.default_rng(11)
    of = {"wide": rng.normal(size=4000), "ties": np.repeat([1.0, 2.0, 3.0], [2500, 400, 100]), "few": np.array([4.0, 9.0]), "one": np.array([5.0]), "half": np.concatenate([np.zeros(1500), rng.random(1500)])}
    rows = [(n, float(v)) for n, vs in of.items() for v in vs] + [("wide", float("nan")), ("wide", None), ("none", None), ("none", float("nan"))]
    got = {r.varname: r for r in aggregates.percentile_thresholds(spark.createDataFrame(rows, "varname STRING, value DOUBLE"), small=20).collect()}
    assert set(got) == {*of, "none"}
    for name, values in of.items():
        for p in (25, 50, 75, 90, 95, 99):
            assert got[name][f"p{p}"] == pytest.approx(np.percentile(values, p), abs=1e-6), (name, p)
    assert got["none"].p50 is None


def test_ranges_of_one_file_are_read_by_several_tasks(spark, tmp_path):
    """Near ranges share reads, and far ones do not; equal and overlapping ranges have their own bytes; null ranges are named."""
    raw = bytes(i * i % 251 for i in range(10_000))
    (tmp_path / "one").write_bytes(raw)
    ranges = [(o, n) for o in range(0, 10_000, 100) for n in (10, 130)] + [(0, 10), (9_990, 100), (5_000, 0)]
    refs = spark.createDataFrame([(f"{tmp_path}/one", o, n) for o, n in ranges] + [(f"{tmp_path}/one", None, 4)], "uri STRING, offset LONG, length LONG").repartition(3)
    near = stores.fetch_ranges(refs, 8, span=2_000, near=1_000)
    got = near.where("status = 'ok'").collect()
    assert sorted((r.offset, r.length) for r in got) == sorted(ranges)
    assert all(bytes(r.data) == raw[r.offset : r.offset + r.length] for r in got)
    assert len({r.read_from for r in got}) == 5  # one read for each span
    assert near.where("status = 'ok'").selectExpr("spark_partition_id() AS p").distinct().count() > 1
    assert near.where("status = 'null range'").count() == 1
    apart = stores.fetch_ranges(refs.where("length = 10"), 8, span=2_000, near=5).select("read_from").distinct().count()
    assert apart == 100


def test_inline_values_are_one_line(spark):
    coords = spark.range(100).selectExpr("'p' AS path", "'step' AS dim", "id AS i", "id AS coord")
    raw = store.coord_metadata(coords).first().inline
    assert "\n" not in raw and base64.b64decode(raw[7:], validate=True) == struct.pack("<100d", *range(100))
