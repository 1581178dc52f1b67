import datetime as dt
import json

from pyspark.sql import functions as F

from trafficspark.operators.aggregates import hourly_counts, merged_counts
from trafficspark.plans.fixtures import table
from trafficspark.sources.tables import read_days
from trafficspark.streaming import jobs, restate


def run(df, name):
    q = df.writeStream.format("memory").queryName(name).outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()


def test_stream_equals_batch_on_emitted_hours(spark, sf_dir, tmp_path):
    events = table(spark, sf_dir, "events")
    events.orderBy("ts").coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))
    run(jobs.hourly_counts_stream(stream, entity="user_id", time="ts"), "hours")
    got = {r.hour_start: r.flight_count for r in spark.table("hours").collect()}
    batch = {r.hour_start: r.flight_count for r in hourly_counts(events, entity="user_id", time="ts").collect()}
    assert len(batch) - 3 <= len(got) <= len(batch) and all(batch[h] == n for h, n in got.items())


def test_late_rows_are_dropped(spark, tmp_path):
    base = dt.datetime(2024, 1, 1)
    schema = "user_id int, ts timestamp_ntz"
    for i, rows in enumerate(([(1, base), (2, base + dt.timedelta(hours=5))], [(3, base)], [(4, base + dt.timedelta(hours=9))])):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / f"in/p={i}"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in/*"))
    run(jobs.hourly_counts_stream(stream, entity="user_id", time="ts"), "late")
    got = {r.hour_start: r.flight_count for r in spark.table("late").collect()}
    assert got[base] <= 2 and set(got) <= {base, base + dt.timedelta(hours=5)}


def test_ingest_takes_each_file_once(spark, tmp_path):
    landing, root, checkpoint = (str(tmp_path / n) for n in ("landing", "raw", "checkpoint"))
    (tmp_path / "landing").mkdir()
    for i in range(2):
        (tmp_path / f"landing/{i}.json").write_text(json.dumps({"time": i * 86_400, "states": [["a", "b"]]}) + "\n")
        jobs.ingest_stream(spark, landing, root, checkpoint).awaitTermination()
    jobs.ingest_stream(spark, landing, root, checkpoint).awaitTermination()
    assert read_days(spark, root, dt.date(1970, 1, 1), dt.date(1970, 1, 2)).count() == 2


def test_alarm_stream(spark, tmp_path):
    base = dt.datetime(2024, 1, 1)
    rows = [("failed", base + dt.timedelta(minutes=m)) for m in (0, 1, 2, 10)] + [("success", base + dt.timedelta(hours=2))]
    spark.createDataFrame(rows, "status string, created_at timestamp").coalesce(1).write.parquet(str(tmp_path / "in"))
    run(jobs.failure_alarm_stream(spark.readStream.schema("status string, created_at timestamp").parquet(str(tmp_path / "in"))), "alarms")
    assert [r.failures for r in spark.table("alarms").collect()] == [3]


STATES = "k string, user_id int, ts timestamp_ntz"


def counted(rows):
    """(key, hour) to distinct users, null one of them."""
    out = {}
    for k, u, t in rows:
        if t is not None:
            out.setdefault((k, t.replace(minute=0)), set()).add(u)
    return {x: len(u) for x, u in out.items()}


def test_late_rows_restate_their_hours(spark, tmp_path):
    base = dt.datetime(2024, 1, 10)
    at = lambda h, m=0: base + dt.timedelta(hours=h, minutes=m)
    batches = [
        [("a", 1, at(0)), ("a", 2, at(0, 5)), (None, 1, at(1))],
        [("a", 3, at(72)), ("a", None, at(72, 3)), ("b", 1, None)],
        [("a", 9, at(0, 59)), ("a", 1, at(0, 30)), ("b", 5, at(0, 1)), ("a", 4, at(73))],  # three days late
        [(None, 7, at(1, 1)), (None, 7, at(1, 1))],
    ]
    root, kept = str(tmp_path / "out"), []
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, STATES).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(STATES).parquet(str(tmp_path / "in"))
        restate.restated_counts_stream(stream, root, str(tmp_path / "checkpoint"), entity="user_id", time="ts", keys=("k",)).awaitTermination()
        kept += rows
        for _ in range(2):  # as it is, and after the batch is replayed
            got = {(r.k, r.hour_start): r.flight_count for r in restate.read_counts(spark, root, keys=("k",)).collect()}
            assert got == counted(kept)
            restate.restate_batch(spark.createDataFrame(rows, STATES), i, root, entity="user_id", time="ts", keys=("k",))
    assert {(r.batch, r.hour_start, r.rows) for r in restate.restatements(spark, root).collect()} == {(2, base, 3), (3, at(1), 2)}


def test_only_touched_hours_are_written(spark, tmp_path):
    root, base = str(tmp_path / "out"), dt.datetime(2024, 1, 10)
    for i, hour in enumerate((0, 1, 30)):
        restate.restate_batch(spark.createDataFrame([("a", i, base + dt.timedelta(hours=hour))], STATES), i, root, entity="user_id", time="ts", span="hour")
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "out/counts").rglob("*.parquet")}
    restate.restate_batch(spark.createDataFrame([("a", 7, base)], STATES), 3, root, entity="user_id", time="ts", span="hour")
    after = {p: p.stat().st_mtime_ns for p in (tmp_path / "out/counts").rglob("*.parquet")}
    assert len(after) == 3 and len(before.items() & after.items()) == 2


def test_sketch_state_does_not_grow_with_entities(spark, tmp_path):
    base, sizes = dt.datetime(2024, 1, 1), {}
    for n in (20_000, 80_000):
        rows = spark.range(n).select((F.col("id") % 4).alias("k"), F.when(F.col("id") > 3, F.col("id")).alias("u"), (F.lit(base) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("id") % 7200)).alias("ts"))
        rows = rows.unionByName(rows.limit(1).withColumn("ts", F.lit(base + dt.timedelta(days=2))))
        rows.coalesce(1).write.parquet(str(tmp_path / f"in{n}"))
        stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / f"in{n}"))
        out = jobs.hourly_sketch_stream(stream, entity="u", time="ts", keys=("k",))
        q = out.writeStream.format("memory").queryName(f"sketches{n}").outputMode("append").trigger(availableNow=True).start()
        q.awaitTermination()
        sizes[n] = max(s["numRowsTotal"] for p in q.recentProgress for s in p["stateOperators"])
        found = spark.table(f"sketches{n}")
        assert found.agg(F.max(F.length("sketch"))).first()[0] < 17_000
        exact = {(r.k, r.hour_start): r.flight_count for r in hourly_counts(rows.where(F.col("ts") < base + dt.timedelta(days=1)), entity="u", time="ts", keys=("k",)).collect()}
        got = {(r.k, r.hour_start): r.flight_count for r in jobs.sketch_counts(found).collect()}
        assert got.keys() == exact.keys() and all(abs(got[x] - c) <= 0.03 * c for x, c in exact.items())
        whole = {r.k: r.flight_count for r in merged_counts(found, "day", keys=("k",)).collect()}
        assert all(abs(c - n / 4) <= 0.03 * n / 4 for c in whole.values()) and len(whole) == 4
    assert sizes[20_000] == sizes[80_000] == 9  # one sketch for each key and hour, and the last row's


def test_null_entities_are_one(spark, tmp_path):
    base = dt.datetime(2024, 1, 1)
    rows = [(None, base)] * 3 + [("a", base), ("a", base + dt.timedelta(days=1))]
    spark.createDataFrame(rows, "u string, ts timestamp_ntz").coalesce(1).write.parquet(str(tmp_path / "in"))
    run(jobs.hourly_sketch_stream(spark.readStream.schema("u string, ts timestamp_ntz").parquet(str(tmp_path / "in")), entity="u", time="ts"), "nulls")
    assert [(r.hour_start, r.flight_count) for r in jobs.sketch_counts(spark.table("nulls")).collect()] == [(base, 2)]
