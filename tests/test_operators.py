import datetime as dt
import warnings

import numpy as np
import pytest
from pyspark.sql import functions as F

from trafficspark.functions import scalars as S
from trafficspark.operators import aggregates as agg
from trafficspark.operators import cleaning, derive, features, filters, model, moving, ordered, runlog

STATE = "icao24 string, latitude double, longitude double, baro_altitude double, velocity double, vertical_rate double, capture_time bigint"


def states(spark, rows):
    return spark.createDataFrame(rows, STATE)


GOOD = ("a", 10.0, 20.0, 100.0, 50.0, 0.0, 1_704_067_200)


@pytest.mark.parametrize(
    "place, value, kept",
    [(0, None, 0), (1, None, 0), (2, None, 0), (1, 90.0, 1), (1, -90.0, 1), (1, 90.1, 0), (2, 180.0, 1), (2, -180.5, 0), (3, -1000.0, 1), (3, 50000.0, 1), (3, 50001.0, 0), (3, None, 1), (4, 0.0, 1), (4, 1000.0, 1), (4, -0.1, 0), (4, None, 1)],
)
def test_cleaning_rules(spark, place, value, kept):
    row = list(GOOD)
    row[place] = value
    assert cleaning.clean_states(states(spark, [tuple(row)])).count() == kept


def test_cleaning_drops_duplicates_and_is_idempotent(spark):
    df = states(spark, [GOOD, GOOD, ("b", *GOOD[1:])])
    once = cleaning.clean_states(df)
    assert once.count() == 2 and cleaning.clean_states(once).count() == 2
    audit = {r.rule: r.removed for r in cleaning.clean_audit(df).collect()}
    assert audit["duplicate"] == 1 and audit["total"] == 1


def test_cleaning_without_optional_columns(spark):
    df = states(spark, [GOOD]).drop("baro_altitude", "velocity")
    assert cleaning.clean_states(df).count() == 1
    assert "altitude_ft" not in derive.add_derived_columns(df).columns


@pytest.mark.parametrize("rate, phase", [(2.0, "level"), (2.1, "climbing"), (-2.0, "level"), (-2.1, "descending"), (None, "level")])
def test_flight_phase(spark, rate, phase):
    df = spark.createDataFrame([(rate,)], "r double").select(S.flight_phase(F.col("r")).alias("p"))
    assert df.first().p == phase


def test_friday_is_weekend_as_observed_only(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 5),)], "t timestamp_ntz")
    observed, documented = (df.select(*(c.alias(n) for n, c in zip("dw", S.weekday_columns(F.col("t"), m), strict=True))).first() for m in ("observed", "documented"))
    assert (observed.d, observed.w, documented.d, documented.w) == (5, 1, 4, 0)


def test_null_entity_counts_as_one(spark):
    df = spark.createDataFrame([("a", dt.datetime(2024, 1, 1, 3, 5)), (None, dt.datetime(2024, 1, 1, 3, 9)), (None, dt.datetime(2024, 1, 1, 3, 59))], "e string, t timestamp_ntz")
    assert [tuple(r) for r in agg.hourly_counts(df, entity="e", time="t").collect()] == [(dt.datetime(2024, 1, 1, 3), 2)]


def hours(spark, n, skip=()):
    rows = [(dt.datetime(2024, 1, 1) + dt.timedelta(hours=i), i) for i in range(n) if i not in skip]
    return spark.createDataFrame(rows, "hour_start timestamp_ntz, flight_count bigint")


def test_lags_go_by_rows_or_by_clock(spark):
    assert features.hourly_features(hours(spark, 24)).count() == 0
    by_row = features.hourly_features(hours(spark, 30, skip={10})).orderBy("hour_start").first()
    assert (by_row.flight_count, by_row.lag_24h) == (25, 0)
    by_clock = features.hourly_features(hours(spark, 30, skip={10}), calendar=True).orderBy("hour_start").first()
    assert (by_clock.flight_count, by_clock.lag_24h, by_clock.rolling_mean_6h) == (24, 0, 20.5)


def test_split_sizes(spark):
    for n in (0, 1, 9, 10, 37):
        counts = {r.split: r["count"] for r in features.time_split(hours(spark, n)).groupBy("split").count().collect()}
        assert counts.get("train", 0) == int(n * 0.9) and sum(counts.values()) == n


def test_histogram_edges(spark):
    values = lambda xs: spark.createDataFrame([(x,) for x in xs], "v double")
    rows = agg.histogram(values([0.0, 1.0, 2.0, 2.0, None]), "v", 2).orderBy("bin").collect()
    assert [r.n for r in rows] == [1, 3]
    rows = agg.histogram(values([5.0, 5.0]), "v", 4).orderBy("bin").collect()
    assert sum(r.n for r in rows) == 2 and (rows[0].low, rows[-1].high) == (4.5, 5.5)
    assert agg.histogram(values([None]), "v", 4).count() == 0


def test_summary_of_no_rows(spark):
    told = {r.metric: r.value for r in agg.data_summary(states(spark, [])).collect()}
    assert told["total_records"] == 0 and told["unique_entities"] == 0 and told["mean_latitude"] is None


def test_percentage_error_of_zero(spark):
    df = spark.createDataFrame([("test", 0.0, 1.0), ("test", 2.0, 1.0)], "split string, y double, p double")
    row = model.regression_metrics(df, actual="y", predicted="p").first()
    assert row.mae == 1.0 and row.mape > 1e15


def training(spark, n=60):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(n, 2))
    y = 3 + x @ [2.0, -1.0] + rng.normal(0, 0.1, n)
    rows = [(dt.datetime(2024, 1, 1) + dt.timedelta(hours=i), float(a), float(b), float(c)) for i, ((a, b), c) in enumerate(zip(x, y, strict=True))]
    return spark.createDataFrame(rows, "hour_start timestamp_ntz, a double, b double, y double"), x, y


def test_fits_equal_closed_forms(spark):
    df, x, y = training(spark)
    centred, gap = x - x.mean(axis=0), y - y.mean()
    for alpha, fit in ((0.0, model.fit_ols(df, ["a", "b"], "y")), (5.0, model.fit_ridge(df, ["a", "b"], "y", 5.0))):
        exact = np.linalg.solve(centred.T @ centred + alpha * np.eye(2), centred.T @ gap)
        assert np.allclose(fit.coefficients.toArray(), exact, atol=1e-8)
    by_key = model.fit_by_key(df.withColumn("k", F.lit("one")), ["k"], ["a", "b"], "y", 5.0).collect()
    assert np.allclose([r.coefficient for r in by_key if r.term in "ab"], exact, atol=1e-8)


def test_alpha_selection_equals_brute_force(spark):
    df, x, y = training(spark, 53)
    told = {r.alpha: r.mean_r2 for r in model.select_alpha(df, ["a", "b"], "y").collect()}
    folds = np.array_split(np.arange(53), 5)
    for alpha, found in told.items():
        scores = []
        for fold in folds:
            rest = np.setdiff1d(np.arange(53), fold)
            m, c = x[rest].mean(axis=0), y[rest].mean()
            w = np.linalg.solve((x[rest] - m).T @ (x[rest] - m) + alpha * np.eye(2), (x[rest] - m).T @ (y[rest] - c))
            p = c + (x[fold] - m) @ w
            scores.append(1 - ((y[fold] - p) ** 2).sum() / ((y[fold] - y[fold].mean()) ** 2).sum())
        assert abs(found - np.mean(scores)) < 1e-9


def test_population_scaling(spark):
    df, x, _ = training(spark)
    scaled = np.array([tuple(r) for r in model.scale_population(df, [], ["a", "b"])[0].select("a", "b").collect()])
    assert np.allclose(sorted(scaled[:, 0]), sorted(((x - x.mean(axis=0)) / x.std(axis=0))[:, 0]))


def test_polynomial_terms(spark):
    names = model.polynomial_terms(spark.createDataFrame([(1.0,) * 6], ", ".join(f"c{i} double" for i in range(6))), [f"c{i}" for i in range(6)])[1]
    assert len(names) == 27


def test_run_state_keeps_what_updates_leave_out(spark):
    rows = [(1, 1, "pending", None, None), (1, 2, "success", 5, None), (1, 3, None, None, "late note"), (2, 4, "pending", None, None)]
    told = {r.run_id: r for r in runlog.run_state(spark.createDataFrame(rows, "run_id int, seq int, status string, record_count int, error_message string")).collect()}
    assert (told[1].status, told[1].record_count, told[1].error_message, told[2].record_count) == ("success", 5, "late note", None)


@pytest.mark.parametrize("kind, category", [("S3ConfigurationError", "S3_CONFIG"), ("ConfigurationError", "CONFIG"), ("APITimeoutError", "API_TIMEOUT"), ("KeyError", "UNEXPECTED")])
def test_error_rules_go_in_order(spark, kind, category):
    assert runlog.classify_errors(spark.createDataFrame([(kind,)], "error_type string")).first().category == category


@pytest.mark.parametrize("message, category, detail", [("[PARQUET] bad file", "PARQUET", "bad file"), ("no prefix", "UNKNOWN", "no prefix"), (None, None, None)])
def test_message_category(spark, message, category, detail):
    row = runlog.with_error_category(spark.createDataFrame([(message,)], "error_message string")).first()
    assert (row.category, row.detail) == (category, detail)


def test_box_edges_are_inclusive(spark):
    df = states(spark, [("a", 18.0, 71.5, None, None, None, 1), ("b", 20.0, 74.0, None, None, None, 1), ("c", 20.1, 74.0, None, None, None, 1)])
    assert filters.query_states(df, bbox=filters.DEFAULT_BOX).count() == 2
    assert filters.query_states(df, entities="A", time=1).count() == 1


def test_long_intervals_of_flights_are_warned_of(spark):
    df = spark.createDataFrame([("a", 0, 10)], "icao24 string, firstSeen long, lastSeen long")
    with pytest.warns(UserWarning, match="7201 seconds"):
        assert filters.query_flights(df, 0, 7201).count() == 1
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        assert filters.query_flights(df, 0, 7200).count() == 1
    with pytest.raises(ValueError):
        filters.query_flights(df, 1, 0)


def test_models_are_compared_on_stored_rows(spark, sf_dir):
    from trafficspark.plans import catalog

    rows = catalog.split(spark, sf_dir)
    assert not any("events" in f for f in rows.inputFiles())  # no fit goes back to the events


def test_kde_equals_direct_sum(spark):
    x = np.random.default_rng(3).normal(size=400)
    rows = agg.kde(spark.createDataFrame([(float(v),) for v in x], "v double"), "v", 50).orderBy("i").collect()
    width = x.std(ddof=1) * len(x) ** -0.2
    grid = np.linspace(x.min(), x.max(), 50)
    exact = np.exp(-0.5 * ((grid[:, None] - x) / width) ** 2).sum(axis=1) / (len(x) * width * np.sqrt(2 * np.pi))
    assert np.allclose([r.density for r in rows], exact, atol=1e-5)


def test_box_stats(spark):
    row = agg.box_stats(spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 5, 100]], "v double"), "v", exact=True).first()
    assert (row.q1, row.median, row.q3, row.whisker_high, row.n_outliers) == (2.25, 3.5, 4.75, 5.0, 1)


def test_run_events_are_appended_and_folded(spark, tmp_path):
    root = str(tmp_path / "log")
    kind = "run_id int, seq int, created_at timestamp_ntz, window_start timestamp_ntz, window_end timestamp_ntz, status string, record_count int"
    at = lambda h: dt.datetime(2024, 1, 1, h)
    runlog.append_run_events(spark.createDataFrame([(1, 1, at(1), at(0), at(1), "pending", None), (2, 2, at(2), at(1), at(2), "pending", None)], kind), root)
    runlog.append_run_events(spark.createDataFrame([(1, 3, None, None, None, "success", 9)], kind), root)
    state = runlog.run_state(spark.read.parquet(root))
    assert [(r.run_id, r.status, r.record_count) for r in runlog.latest_runs(state, 5).collect()] == [(2, "pending", None), (1, "success", 9)]
    assert [r.run_id for r in runlog.runs_in_range(state, "2024-01-01 00:30:00", "2024-01-01 02:00:00").collect()] == [2]
    assert runlog.run_by_id(state, 1).count() == runlog.runs_by_status(state, "success").count() == 1


def test_runs_are_created_and_updated(spark, tmp_path):
    root, at = str(tmp_path / "log"), dt.datetime(2024, 1, 1)
    assert runlog.logged_state(spark, root).count() == 0
    first, second = (runlog.create_run(spark, root, at, at + dt.timedelta(hours=1)) for _ in range(2))
    assert first != second and (second >> runlog.ID_BITS) >= (first >> runlog.ID_BITS)
    runlog.update_run(spark, root, first, status="failed", error_message="[API_ERROR] x")
    runlog.update_run(spark, root, first, status="success", record_count=9)
    told = {r.run_id: r for r in runlog.logged_state(spark, root).collect()}
    assert (told[first].status, told[first].record_count, told[first].error_message, told[first].window_start) == ("success", 9, "[API_ERROR] x", at)
    assert (told[second].status, told[second].record_count) == ("pending", 0)
    with pytest.raises(ValueError, match="colour"):
        runlog.update_run(spark, root, first, colour="red")


def test_run_ids_of_many_rows(spark):
    ids = [r.run_id for r in runlog.with_run_ids(spark.range(20_000).repartition(5)).collect()]
    assert len(set(ids)) == 20_000 and min(ids) > 0 and len({i >> runlog.ID_BITS for i in ids}) == 1


def test_snapshots_equal_all_events_in_any_order(spark, tmp_path, monkeypatch):
    import random

    from trafficspark.sources import manifest

    rng, root, base = random.Random(1), str(tmp_path / "log"), dt.datetime(2024, 1, 1)
    every = [(rng.randrange(20), seq, *(rng.choice([None, v]) for v in (base + dt.timedelta(hours=seq), base, base, f"p{seq}", seq, f"s{seq}", f"e{seq}"))) for seq in range(300)]
    rng.shuffle(every)
    parts, publish = [every[i::6] for i in range(6)], manifest.publish

    def add(part):
        runlog.append_run_events(spark.createDataFrame(part, runlog.EVENT).coalesce(1), root)

    def busy(*args):  # another writer adds events, and another snapshot is made, while this one is
        monkeypatch.setattr(manifest, "publish", publish)
        add(parts[3])
        runlog.snapshot_log(spark, root)
        publish(*args)

    for i in (0, 1):
        add(parts[i])
    assert runlog.snapshot_log(spark, root) == 2 and runlog.snapshot_log(spark, root) == 0
    add(parts[2])
    monkeypatch.setattr(manifest, "publish", busy)
    runlog.snapshot_log(spark, root)
    for i in (4, 5):
        add(parts[i])
    whole = runlog.run_state(spark.createDataFrame(every, runlog.EVENT))
    seen = lambda: sorted(map(str, runlog.logged_state(spark, root).select(whole.columns).collect()))
    assert seen() == sorted(map(str, whole.collect()))
    runlog.snapshot_log(spark, root)
    manifest.vacuum(spark, root)
    assert seen() == sorted(map(str, whole.collect())) and not list((tmp_path / "log").glob("*.parquet"))


def test_cleaning_is_counted_in_the_job_that_writes(spark, sf_dir, tmp_path):
    from trafficspark.plans.fixtures import state_view

    cleaned, counted = cleaning.clean_counted(state_view(spark, sf_dir))
    spark.sparkContext.setJobGroup("counted cleaning", "")
    cleaned.write.parquet(str(tmp_path / "clean"))
    got = sorted(map(str, cleaning.counted_audit(spark, counted).collect()))
    assert got == sorted(map(str, cleaning.clean_audit(state_view(spark, sf_dir)).collect()))
    nothing, counted = cleaning.clean_counted(state_view(spark, sf_dir).where("icao24 = 'nobody'"))
    nothing.write.format("noop").mode("overwrite").save()
    assert {r.removed for r in cleaning.counted_audit(spark, counted).collect()} == {0}


def test_models_and_training_runs_are_kept(spark, tmp_path):
    from pyspark.ml import PipelineModel

    df, _, _ = training(spark)
    fit = model.fit_ols(df, ["a", "b"], "y")
    model.save_model(fit, ["a", "b"], str(tmp_path / "model"))
    again = PipelineModel.load(str(tmp_path / "model")).transform(df).select("prediction").collect()
    assert len(again) == 60
    for i in range(2):
        model.log_training_run(spark, str(tmp_path / "runs"), {"window_days": 14, "mae": 0.5 + i})
    assert sorted(r.entries["mae"] for r in spark.read.parquet(str(tmp_path / "runs")).collect()) == ["0.5", "1.5"]


def test_coefficients_rank_by_size(spark):
    table = spark.createDataFrame([("a", 1.0), ("b", -3.0), ("intercept", 99.0)], "term string, coefficient double")
    assert [(r.term, r.sign) for r in model.coefficient_rank(table).collect()] == [("b", -1), ("a", 1)]


def test_keys_keep_series_apart(spark):
    both = hours(spark, 30).withColumn("k", F.lit("x")).unionByName(hours(spark, 26).withColumn("k", F.lit("y")))
    counts = {r.k: r["count"] for r in features.hourly_features(both, keys=("k",)).groupBy("k").count().collect()}
    assert counts == {"x": 6, "y": 2}


def test_calendar_keeps_the_counts_of_a_null_key(spark):
    hours = [(k, dt.datetime(2024, 1, 1 + h // 24, h % 24), 5 + h) for k in ("a", None) for h in range(0, 40, 2)]
    df = spark.createDataFrame(hours, "k string, hour_start timestamp_ntz, flight_count long")
    got = features.calendar_spine(df, keys=("k",)).collect()
    for key in ("a", None):
        mine = {r.hour_start: r.flight_count for r in got if r.k == key}
        assert len(mine) == 39 and sum(mine.values()) == sum(n for k, _, n in hours if k == key)
    assert features.calendar_spine(df, keys=("k",)).columns == ["k", "hour_start", "flight_count"]


@pytest.mark.parametrize("message, category, text", [("[API_ERROR] a\nb", "API_ERROR", "a\nb"), ("[X] \n", "X", ""), ("a\n[X] b", "UNKNOWN", "a\n[X] b"), ("[X]", "X", ""), (None, "UNKNOWN", None)])
def test_categories_of_messages_of_several_lines(spark, message, category, text):
    df = spark.createDataFrame([(message,)], "m string").select(*(c.alias(n) for n, c in zip("ct", S.split_category(F.col("m")), strict=True)))
    assert tuple(df.first()) == (category, text)


@pytest.mark.parametrize("ratio", [0.1, 0.37, 0.9])
@pytest.mark.parametrize("kind", ["long", "timestamp_ntz", "string", "double"])
def test_cut_in_time(spark, kind, ratio):
    numbers = [(i * 7919) % 5003 for i in range(3000)]
    make = {"long": int, "double": float, "string": lambda i: f"{i:05d}", "timestamp_ntz": lambda i: dt.datetime(2024, 1, 1) + dt.timedelta(minutes=i)}[kind]
    df = spark.createDataFrame([(make(i),) for i in numbers], f"hour_start {kind}").repartition(3)
    got = features.time_split(df, test_ratio=ratio)
    assert got.columns == ["hour_start", "split"]
    cut = int(3000 * (1 - ratio))
    assert [r.split for r in got.orderBy("hour_start").collect()] == ["train"] * cut + ["test"] * (3000 - cut)


def test_cut_of_ties_and_nulls(spark):
    got = features.time_split(spark.createDataFrame([(1,)] * 6 + [(None,)] * 4, "hour_start int"), test_ratio=0.5)
    counts = {(r.hour_start, r.split): r["count"] for r in got.groupBy("hour_start", "split").count().collect()}
    assert counts == {(1, "train"): 5, (1, "test"): 1, (None, "test"): 4}


def test_places_over_many_partitions(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("x"), (F.col("id") % 3).alias("k")).repartition(7)
    found = ordered.ordered(df, ["k", "x"])
    got = [(r.k, r.x) for r in found.rows.orderBy("place").collect()]
    assert found.n == 5000 and got == sorted(got)
    assert found.rows.agg(F.min("place"), F.max("place"), F.count_distinct("place")).first()[:] == (1, 5000, 5000)
    assert ordered.ordered(df.where("k > 9"), ["x"]).rows.count() == 0


def test_rows_of_one_value_spread_over_partitions(spark):
    df = spark.range(8000).select(F.lit(1).alias("x"), "id", F.create_map(F.lit("a"), "id").alias("m"))
    places = [{r.id: r.place for r in ordered.ordered(df.repartition(n), ["x"]).rows.collect()} for n in (2, 5)]
    assert places[0] == places[1] and sorted(places[0].values()) == list(range(1, 8001))


@pytest.mark.parametrize("block", [3, 24, 100, 5000])
def test_windows_over_blocks_equal_one_window(spark, monkeypatch, block):
    monkeypatch.setattr(ordered.in_blocks, "__kwdefaults__", {**ordered.in_blocks.__kwdefaults__, "block": block})
    rows = [("a" if i % 3 else None, dt.datetime(2024, 1, 1) + dt.timedelta(hours=i), i * i % 101) for i in range(400)]
    df = spark.createDataFrame(rows, "k string, hour_start timestamp_ntz, flight_count long")
    for keys in ((), ("k",)):
        one, many = (features.hourly_features(df, keys=keys, long=long) for long in (False, True))
        assert sorted(map(str, one.collect())) == sorted(map(str, many.collect()))


def test_one_long_order_has_no_single_task(spark, sf_dir):
    from trafficspark.plans import catalog

    for name in ("hourly_features", "hourly_features_calendar", "train_test_split"):
        plan = catalog.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert "SinglePartition" not in plan, name


def test_sketches_of_hours_merge_to_days(spark):
    rows = [(i % 700 if i % 50 else None, dt.datetime(2024, 1, 1 + i % 3, i % 24)) for i in range(9000)]
    df = spark.createDataFrame(rows, "e long, t timestamp_ntz")
    got = {r.start: r.flight_count for r in agg.merged_counts(agg.hourly_sketches(df, entity="e", time="t")).collect()}
    exact = {}
    for e, t in rows:
        exact.setdefault(t.replace(hour=0), set()).add(e)
    assert got.keys() == exact.keys() and all(abs(got[d] - len(s)) <= 0.02 * len(s) for d, s in exact.items())


def test_quartiles_from_sketches_keep_their_ranks(spark):
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(size=40_000), np.full(20_000, 0.5), rng.exponential(100, 20_000)])
    df = spark.createDataFrame([(float(v), dt.datetime(2024, 1, 1 + i % 20)) for i, v in enumerate(x)] + [(None, dt.datetime(2024, 1, 1)), (float("nan"), dt.datetime(2024, 1, 2))], "v double, t timestamp_ntz").repartition(5)
    sketches = agg.value_sketches(df, "v", time="t")
    assert sketches.agg(F.max(F.length("sketch"))).first()[0] < 40_000  # some 10 bytes for each of k values, whatever the day holds
    for row, values in ((agg.merged_quartiles(sketches, None).first(), x), (agg.box_stats(df, "v").first(), x), (agg.merged_quartiles(sketches).where("start = date'2024-01-08'").first(), x[np.arange(len(x)) % 20 // 7 == 1])):
        assert row.n == len(values)
        for found, share in ((row.q1, 0.25), (row.median, 0.5), (row.q3, 0.75)):
            low, high = (values < found - 1e-6).mean(), (values <= found + 1e-6).mean()
            assert low - agg.RANK_ERROR <= share <= high + agg.RANK_ERROR
    assert agg.box_stats(df.where("v > 1e9 and not isnan(v)"), "v").count() == 0


def daily(spark, days=30, keys=1):
    rng = np.random.default_rng(2)
    rows = [(k, dt.date(2024, 1, 1) + dt.timedelta(days=d), float(a), float(b), float(1000 + 2 * a - b + d * k + e)) for k in range(keys) for d in range(days) if d != 11 for a, b, e in rng.normal(50, 9, (10, 3))]
    return spark.createDataFrame([*rows, (0, dt.date(2024, 1, 5), None, 1.0, 2.0)], "k int, feature_date date, a double, b double, y double")


def test_moving_fits_equal_full_fits(spark, tmp_path):
    df, root = daily(spark, keys=2), str(tmp_path / "sums")
    moving.store_day_sums(df.withColumn("y", F.when(F.col("feature_date") == dt.date(2024, 1, 9), 0.0).otherwise(F.col("y"))), root, ["a", "b"], "y", keys=("k",))
    moving.store_day_sums(df.where("feature_date = date'2024-01-09'"), root, ["a", "b"], "y", keys=("k",))  # a correction
    got = {(r.k, r.feature_date, r.term): r.coefficient for r in moving.moving_fits(spark.read.parquet(root), ["a", "b"], keys=("k",)).collect()}
    pdf = df.toPandas().dropna()
    assert {(k, d) for k, d, _ in got} == set(zip(pdf.k, pdf.feature_date, strict=True))
    for k, day in {(k, d) for k, d, _ in got}:
        own = pdf[(pdf.k == k) & (pdf.feature_date <= day) & (pdf.feature_date > day - dt.timedelta(days=14))]
        exact = np.linalg.lstsq(np.column_stack([np.ones(len(own)), own.a, own.b]), own.y, rcond=None)[0]
        assert np.allclose([got[k, day, t] for t in ("intercept", "a", "b")], exact, rtol=1e-9)


def test_a_refit_reads_its_days_only(spark, tmp_path):
    root = str(tmp_path / "sums")
    moving.store_day_sums(daily(spark), root, ["a", "b"], "y")
    table = spark.read.parquet(root)
    assert table.count() == 29
    plan = moving.added(table.where(F.col("feature_date").between(dt.date(2024, 1, 7), dt.date(2024, 1, 20))), ["a", "b"], ())._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(feature_date" in plan
    assert moving.window_fit(table, dt.date(2024, 1, 20), ["a", "b"]).count() == 3
    with pytest.raises(ValueError):
        moving.window_fit(table, dt.date(2025, 1, 20), ["a", "b"])
