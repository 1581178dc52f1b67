import datetime as dt
import json

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from trafficspark.schema import STATE_SCHEMA
from trafficspark.sources import decode, files, manifest, tables

FULL = ["abc123", "TEST123", "India", 1234567890, 1234567890, 72.8, 19.0, 1000, False, 100, 90, 0, [1, 2], 1050, "1234", False, 0]


def envelopes(spark, *bodies):
    return spark.createDataFrame([(json.dumps(b) if not isinstance(b, str) else b,) for b in bodies], "json string")


def test_decode_states(spark):
    rows = decode.decode_states(envelopes(spark, {"time": 7, "states": [FULL, [*FULL, 3], ["bad", "data"]]})).collect()
    assert [r.category for r in rows] == [None, 3, None]
    assert (rows[0].icao24, rows[0].baro_altitude, rows[0].on_ground, rows[0].sensors, rows[0].capture_time) == ("abc123", 1000.0, False, [1, 2], 7)
    assert rows[2].callsign == "data" and rows[2].latitude is None


def test_decode_states_without_rows(spark):
    df = decode.decode_states(envelopes(spark, {"time": 7, "states": []}, {"time": 8, "states": None}, "not json"))
    assert df.count() == 0 and df.columns == STATE_SCHEMA.names


def test_decode_flights_bad_value_is_null(spark):
    rows = decode.decode_flights(envelopes(spark, [{"icao24": "a", "firstSeen": 5, "lastSeen": "x"}])).collect()
    assert (rows[0].firstSeen, rows[0].lastSeen, rows[0].callsign) == (5, None, None)


def write(path, **columns):
    pq.write_table(pa.table(columns), path)
    return str(path)


def test_drifting_files(spark, tmp_path):
    paths = [
        write(tmp_path / "a.parquet", a=pa.array([1], pa.int32()), sensors=pa.array([None], pa.null())),
        write(tmp_path / "b.parquet", a=pa.array([1.5], pa.float64()), sensors=pa.array([[1, 2]], pa.list_(pa.int64()))),
        write(tmp_path / "c.parquet", a=pa.array([3], pa.int64())),
    ]
    schema = tables.T.StructType([tables.T.StructField("a", tables.T.DoubleType()), tables.T.StructField("sensors", tables.T.ArrayType(tables.T.LongType()))])
    df = files.read_drifting(spark, paths, schema)
    assert sorted((r.a, r.sensors) for r in df.collect() if r.a != 1.5) == [(1.0, None), (3.0, None)]
    assert df.where("a = 1.5").first().sensors == [1, 2]


def test_drift_to_text_and_bad_kinds(spark):
    a, b = spark.createDataFrame([(1,)], "x int"), spark.createDataFrame([("q",)], "x string")
    assert sorted(r.x for r in tables.drift_union(a, b).collect()) == ["1", "q"]
    arrays = tables.T.StructType([tables.T.StructField("x", tables.T.ArrayType(tables.T.LongType()))])
    with pytest.raises(Exception, match="another kind"):
        tables.drift_union(a, schema=arrays).collect()


def states(spark, *times):
    return spark.createDataFrame([(f"e{i}", t) for i, t in enumerate(times)], "icao24 string, capture_time bigint")


def test_days_round_trip_with_pruning(spark, tmp_path):
    root, day = str(tmp_path / "raw"), 86_400
    assert tables.write_raw(states(spark, 0, 5, day, 3 * day), root) == 4
    df = tables.read_days(spark, root, dt.date(1970, 1, 1), dt.date(1970, 1, 2))
    assert df.count() == 3
    assert "PartitionFilters: [isnotnull" in df._jdf.queryExecution().executedPlan().toString()
    assert tables.read_days(spark, root, dt.date(1970, 1, 4), dt.date(1970, 1, 9)).count() == 1


def test_range_over_a_year_end(spark, tmp_path):
    root = str(tmp_path / "raw")
    tables.write_raw(states(spark, 364 * 86_400, 365 * 86_400), root)
    assert tables.read_days(spark, root, dt.date(1970, 12, 31), dt.date(1971, 1, 1)).count() == 2


def test_unreadable_file_is_skipped(spark, tmp_path):
    root = str(tmp_path / "raw")
    tables.write_raw(states(spark, 0), root)
    (tmp_path / "raw/year=1970/month=1/day=1/broken.parquet").write_text("no parquet")
    df = tables.read_days(spark, root, dt.date(1970, 1, 1), dt.date(1970, 1, 1), schema=states(spark, 0).schema, skip_bad=True)
    assert df.count() == 1


def test_overwriting_a_day_leaves_others(spark, tmp_path):
    root = str(tmp_path / "days")
    rows = lambda *v: spark.createDataFrame([(x, dt.date(2024, 1, d)) for x, d in v], "x int, feature_date date")
    tables.overwrite_day(rows((1, 1), (2, 2)), root)
    for _ in range(2):
        tables.overwrite_day(rows((9, 2)), root)
    assert sorted(r.x for r in spark.read.parquet(root).collect()) == [1, 9]


DAY_ONE = dt.date(1970, 1, 1)


def test_compaction_by_a_published_list(spark, tmp_path):
    root, folder = str(tmp_path / "raw"), tmp_path / "raw/year=1970/month=1/day=1"
    for i in range(5):
        tables.write_raw(states(spark, i, i + 100), root)
    seen = lambda: sorted(r.capture_time for r in tables.read_compacted(spark, root, DAY_ONE, DAY_ONE).collect())
    want = sorted([*range(5), *range(100, 105)])
    assert seen() == want
    before = set(folder.glob("*.parquet"))
    assert tables.compact_day(spark, root, DAY_ONE) == 1
    assert set(folder.glob("*.parquet")) == before and seen() == want  # old readers still have their files
    assert tables.read_days(spark, root, DAY_ONE, DAY_ONE).count() == 10
    assert tables.read_compacted(spark, root, DAY_ONE, DAY_ONE).columns == ["icao24", "capture_time", "year", "month", "day"]
    tables.write_raw(states(spark, 7), root)  # comes after the list
    assert seen() == sorted([*want, 7])
    assert tables.compact_day(spark, root, DAY_ONE) == 1 and seen() == sorted([*want, 7])
    assert manifest.vacuum(spark, str(folder)) >= 11 and seen() == sorted([*want, 7])
    assert tables.compact_day(spark, root, DAY_ONE) == 1 and not list(folder.glob("*.parquet"))


def test_packing_that_goes_wrong_publishes_nothing(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "raw")
    for i in range(3):
        tables.write_raw(states(spark, i), root)
    sums = iter([(3, 1), (3, 2)])
    monkeypatch.setattr(manifest, "checksum", lambda df: next(sums))
    with pytest.raises(ValueError, match="differ"):
        tables.compact_day(spark, root, DAY_ONE)
    assert manifest.current(spark, tables.day_folder(root, DAY_ONE)).version == 0
    assert tables.read_compacted(spark, root, DAY_ONE, DAY_ONE).count() == 3


def test_files_added_while_packing_stay(spark, tmp_path, monkeypatch):
    root, whole = str(tmp_path / "raw"), manifest.publish
    for i in range(3):
        tables.write_raw(states(spark, i), root)

    def late(*args):
        tables.write_raw(states(spark, 50), root)
        whole(*args)

    monkeypatch.setattr(manifest, "publish", late)
    tables.compact_day(spark, root, DAY_ONE)
    assert sorted(r.capture_time for r in tables.read_compacted(spark, root, DAY_ONE, DAY_ONE).collect()) == [0, 1, 2, 50]


def test_bins_keep_to_their_size():
    sizes = {f"f{i}": (i * 37) % 90 + 1 for i in range(200)}
    groups = manifest.bins(sizes, 100)
    assert sorted(p for g in groups for p in g) == sorted(sizes) and all(sum(sizes[p] for p in g) <= 100 for g in groups)
    assert len(groups) <= 1.25 * sum(sizes.values()) / 100 + 1
    assert manifest.bins({"a": 500}, 100) == [["a"]] and manifest.bins({}, 100) == []


def test_rolling_window(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, d),) for d in range(1, 31)], "feature_date date")
    assert tables.rolling_window(df, dt.date(2024, 1, 20)).count() == 14
    with pytest.raises(ValueError):
        tables.rolling_window(df, dt.date(2025, 1, 1))


def test_sample(spark, tmp_path):
    tables.write_sample(spark.range(50).withColumn("x", F.lit("a")), str(tmp_path / "s"))
    assert spark.read.json(str(tmp_path / "s")).count() == 20


def jobs_of(spark, work):
    """Number of jobs that `work` runs, and what it returns."""
    spark.sparkContext.setJobGroup("counted", "")
    before = len(spark.sparkContext.statusTracker().getJobIdsForGroup("counted"))
    out = work()
    spark.sparkContext._jvm.System.gc()
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup("counted")) - before, out


def test_many_drifting_files_take_few_jobs(spark, tmp_path):
    kinds = [("int32", pa.int32()), ("double", pa.float64()), ("text", pa.string())]
    for i in range(5000):
        _, kind = kinds[i % 3]
        write(tmp_path / f"{i:05d}.parquet", id=pa.array([i]), a=pa.array([str(i) if i % 3 == 2 else i], kind), **({"late": pa.array([None], pa.null())} if i % 5 == 0 else {}))
    jobs, df = jobs_of(spark, lambda: files.read_drifting(spark, str(tmp_path)))
    assert jobs < 25
    assert [(f.name, f.dataType.simpleString()) for f in df.schema.fields] == [("id", "bigint"), ("a", "string"), ("late", "void")]
    got = {r.id: r.a for r in df.collect()}
    assert len(got) == 5000 and got[1] == "1.0" and got[2] == "2" and got[3] == "3"


def test_drifting_files_equal_drift_union(spark, tmp_path):
    a = spark.createDataFrame([(1, dt.date(2024, 1, 1), [1])], "x int, d date, l array<int>")
    b = spark.createDataFrame([(2.5, dt.datetime(2024, 1, 2), "t")], "x double, d timestamp_ntz, s string")
    c = spark.createDataFrame([([1.5],)], "l array<double>")
    for i, df in enumerate((a, b, c)):
        df.coalesce(1).write.parquet(str(tmp_path / f"{i}"))
    got, want = files.read_drifting(spark, str(tmp_path)), tables.drift_union(a, b, c)
    assert got.schema.simpleString() == want.schema.simpleString()
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_folding_schemas_does_not_hang_on_the_order():
    kinds = [tables.T.ByteType(), tables.T.IntegerType(), tables.T.LongType(), tables.T.DoubleType(), tables.T.DateType(), tables.T.TimestampNTZType(), tables.T.StringType(), tables.T.NullType(), tables.T.ArrayType(tables.T.LongType())]
    for a in kinds:
        for b in kinds:
            assert tables.supertype(a, b) == tables.supertype(b, a)
            for c in kinds:
                assert tables.supertype(tables.supertype(a, b), c) == tables.supertype(a, tables.supertype(b, c))


def test_types_of_foreign_files(spark, tmp_path):
    write(tmp_path / "a.parquet", u=pa.array([1], pa.uint16()), t=pa.array([0], pa.timestamp("us")), z=pa.array([0], pa.timestamp("us", "UTC")), c=pa.array(["x"]).dictionary_encode(), s=pa.array([{"p": 1}]), d=pa.array([b"q"]))
    found = files.read_drifting(spark, str(tmp_path))
    assert found.schema.simpleString() == spark.read.parquet(str(tmp_path)).schema.simpleString()
    assert found.first().c == "x"


def test_files_that_only_spark_can_open(spark, tmp_path):
    write(tmp_path / "a.parquet", a=pa.array([1]))
    found = files.footers(files.list_files(spark, str(tmp_path)), direct=())
    assert [(r.n_rows, r.reason) for r in found.collect()] == [(1, None)]


def test_each_file_is_good_or_in_quarantine(spark, tmp_path):
    for i in range(6):
        write(tmp_path / f"{i}.parquet", a=pa.array(range(3000)), b=pa.array([f"v{i}-{k}" for k in range(3000)]))
    whole = (tmp_path / "0.parquet").read_bytes()
    (tmp_path / "1.parquet").write_bytes(whole[: len(whole) // 2])  # the end is lost
    (tmp_path / "2.parquet").write_bytes(b"")
    (tmp_path / "3.parquet").write_bytes(whole[:50] + bytes(600) + whole[650:])  # pages are spoilt, the footer is not
    write(tmp_path / "4.parquet", a=pa.array([], pa.int64()), b=pa.array([], pa.string()))
    good, bad = files.read_quarantined(spark, str(tmp_path))
    reasons = {r.path.rsplit("/", 1)[1]: r.reason for r in bad.collect()}
    assert reasons.keys() == {"1.parquet", "2.parquet", "3.parquet"} and "of 3000 rows" in reasons["3.parquet"]
    assert good.count() == 6000
    with pytest.raises(ValueError, match="1.parquet"):
        files.read_drifting(spark, str(tmp_path))


def test_no_files(spark, tmp_path):
    (tmp_path / "x").mkdir()
    good, bad = files.read_quarantined(spark, str(tmp_path / "x"))
    assert good.count() == bad.count() == 0


def test_each_line_is_good_or_in_quarantine(spark):
    lines = [json.dumps({"time": 7, "states": [FULL]}), json.dumps({"time": 7, "states": []}), '{"time": 7, "states": null}', '{"time": 7, "sta', "", None, '{"states": []}', '{"time": 7, "states": {"a": 1}}', '{"time": 7, "states": [["bad", "data"]]}', '{"time": 7, "states": [["a"], 5]}', "[1]"]
    df = envelopes(spark, *(x for x in lines if x is not None)).unionByName(spark.createDataFrame([(None,)], "json string"))
    good, bad = decode.split_lines(df, decode.envelope_fault(F.col("json")))
    assert good.count() == 4 and decode.decode_states(good).count() == 2
    assert sorted(r.reason for r in bad.collect()) == sorted(["no JSON", "empty line", "empty line", "no time", "states are no lists", "a state is no list", "no time"])
    strict = decode.split_lines(df, decode.envelope_fault(F.col("json"), least=17))[1]
    assert strict.where("reason like 'a state of fewer%'").first().raw == lines[8]
    flights = envelopes(spark, [{"icao24": "a"}], [], "{}", "[5]", "[")
    assert sorted(r.reason for r in decode.split_lines(flights, decode.flights_fault(F.col("json")))[1].collect()) == ["a flight is no object", "no JSON", "no list"]
