"""Behaviours that are easy to get wrong, on tiny tables."""

from __future__ import annotations

import contextlib
import datetime as dt
import itertools
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from paceline import schema
from paceline.functions import clock, geometry, opening_hours, sun
from paceline.operators import boosting, calendar, checks, cleaning, connections, drift, events, frame, graph, islands, metrics, minutes, models, representation, routes, segments, slices, spatial, splits, surroundings
from paceline.plans import network_queries

ZONE = "Australia/Melbourne"


def t(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def hours(spark, rows, schema="location_id int, ts_utc timestamp_ntz, n long"):
    return spark.createDataFrame(rows, schema)


def test_skipped_and_repeated_hours(spark):
    df = spark.createDataFrame([(1, t("2025-10-05 01:00")), (2, t("2025-10-05 02:00")), (3, t("2025-10-05 03:00")), (4, t("2025-04-06 02:00")), (5, None)], "i int, l timestamp_ntz")
    got = {r.i: r.ts_utc for r in cleaning.localize(df, "l", ZONE).collect()}
    assert got == {1: t("2025-10-04 15:00"), 3: t("2025-10-04 16:00"), 4: t("2025-04-05 15:00")}
    assert [r.i for r in cleaning.skipped_hours(df, "l", ZONE).collect()] == [2]


def test_duplicates_go_all(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (2, 1), (1, 2)], "a int, b int")
    assert sorted(tuple(r) for r in cleaning.drop_ambiguous(df, ["a", "b"]).collect()) == [(1, 2), (2, 1)]


def test_rehour_only_whole_days(spark):
    day, other = t("2020-01-01"), t("2020-01-02")
    rows = [(1, day, 100 - i) for i in range(24)] + [(1, other, i) for i in range(23)]
    out = cleaning.rehour_midnight(spark.createDataFrame(rows, "k int, ts timestamp_ntz, i int"), "k", "ts", "i").collect()
    assert sorted(r.ts.hour for r in out if r.ts.day == 1) == list(range(24))
    assert [r.ts.hour for r in out if r.i == 100] == [23]
    assert all(r.ts == other for r in out if r.i < 23)


def test_fresh_wins_and_old_stays(spark):
    held, fresh = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string")
    assert sorted(tuple(r) for r in cleaning.upsert(held, fresh, ["k"]).collect()) == [(1, "a"), (2, "c"), (3, "d")]


def test_polls_merge_only_when_equal(spark):
    s = "k int, n int, polled_at timestamp_ntz"
    a = spark.createDataFrame([(1, 5, t("2024-01-01 01:00"))], s)
    b = spark.createDataFrame([(1, 5, t("2024-01-01 00:30")), (1, 6, t("2024-01-01 02:00"))], s)
    got = sorted(tuple(r) for r in cleaning.merge_polls(a, b).collect())
    assert got == [(1, 5, t("2024-01-01 00:30")), (1, 6, t("2024-01-01 02:00"))]
    assert cleaning.latest_poll(a.unionByName(b), ["k"], "polled_at").first().n == 6


def test_gap_fill_is_strict(spark):
    s = "ts timestamp_ntz"
    before, after = spark.createDataFrame([(t("2020-01-01"),)], s), spark.createDataFrame([(t("2020-01-04"),)], s)
    middle = spark.createDataFrame([(t(f"2020-01-0{d}"),) for d in range(1, 6)], s)
    assert sorted(r.ts.day for r in cleaning.fill_gap(middle, before, after, "ts").collect()) == [2, 3]


def test_outage_needs_length_and_daytime(spark):
    def run(sensor, start, values):
        return [(sensor, t(start) + dt.timedelta(hours=i), v) for i, v in enumerate(values)]

    df = hours(spark, run(1, "2024-01-01 00:00", [0] * 6) + run(2, "2024-01-01 06:00", [0] * 3) + run(3, "2024-01-01 08:00", [0, 0, 5]) + run(4, "2024-01-01 08:00", [0, 0]) + run(4, "2024-01-01 11:00", [0]))
    out = islands.flag_outages(df, "location_id", "ts_utc", "n", F.hour("ts_utc"))
    assert {r[0] for r in out.where("suspect_outage_zero").select("location_id").collect()} == {2}


@settings(max_examples=25, deadline=None)
@given(st.lists(st.integers(0, 2), min_size=1, max_size=40))
def test_runs_equal_groupby(spark, values):
    df = hours(spark, [(1, t("2024-01-01") + dt.timedelta(hours=i), v) for i, v in enumerate(values)])
    got = [r[0] for r in islands.with_runs(df, "location_id", "ts_utc", F.col("n")).orderBy("ts_utc").select("run").collect()]
    want = [k for k, (_, g) in enumerate(itertools.groupby(values), 1) for _ in g]
    assert got == want


def test_gaps(spark):
    df = hours(spark, [(1, t("2024-01-01 00:00"), 1), (1, t("2024-01-01 04:00"), 1)])
    assert tuple(islands.gaps(df, "location_id", "ts_utc").first()) == (1, t("2024-01-01 01:00"), t("2024-01-01 03:00"), 3)


def test_many_to_one_refuses_twice(spark):
    left, right = spark.createDataFrame([(1,)], "k int"), spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    with pytest.raises(Exception, match="isn.t unique"):
        calendar.many_to_one(left, right, "k").collect()
    assert calendar.many_to_one(left, right.limit(1), "k").first().v == "a"


def test_weather_shift(spark):
    df = spark.createDataFrame([(t("2024-01-01 05:00"),)], "ts timestamp_ntz")
    w = spark.createDataFrame([(t("2024-01-01 05:00"), 20.0, 1.0), (t("2024-01-01 06:00"), 30.0, 2.0)], "ts timestamp_ntz, temp double, rain double")
    assert tuple(calendar.weather_for(df, w, "ts", ["temp"], ["rain"]).first())[1:] == (20.0, 2.0)


def test_calendar_flag_is_unknown_outside(spark):
    df = spark.createDataFrame([(dt.date(2020, 5, 1),), (dt.date(2021, 5, 1),)], "d date")
    got = df.select(clock.covered(F.col("d"), clock.in_ranges(F.col("d"), [("2020-05-01", "2020-05-01")]), [2020])).collect()
    assert [r[0] for r in got] == [True, None]


def test_sun(spark):
    df = spark.createDataFrame([(t("2024-12-21 01:30"),), (t("2024-12-21 14:00"),)], "u timestamp_ntz")
    noon, night = (r[0] for r in df.select(sun.elevation(F.col("u"), -37.8, 145.0)).collect())
    assert 70 < noon < 77
    assert night < 0
    b = [r[0] for r in df.select(sun.sun_bin(sun.elevation(F.col("u"), -37.8, 145.0), sun.azimuth(F.col("u"), -37.8, 145.0))).collect()]
    assert b[1] == -1
    el, az = sun.bin_centre(b[0])
    assert el == 75
    assert 0 <= az < 360


def test_bins_and_labels(spark):
    df = spark.createDataFrame([(None,), (-1.0,), (0.0,), (0.1,), (99.0,)], "v double")
    assert [r[0] for r in df.select(slices.bins(F.col("v"), (0, 0.1, 1), ("dry", "light", "heavy"))).collect()] == ["unknown", "unknown", "dry", "light", "heavy"]
    flags = spark.createDataFrame([(True,), (False,), (None,)], "f boolean")
    assert [r[0] for r in flags.select(slices.flag_label(F.col("f"), "y", "n")).collect()] == ["y", "n", "unknown"]


@pytest.mark.parametrize(("n", "sizes"), [(11, [4, 3, 4]), (14, [5, 4, 5]), (10, [4, 3, 3]), (1, [1, 0, 0])])
def test_tiers(spark, n, sizes):
    df = spark.createDataFrame([(i, float(i % 4)) for i in range(n)], "k int, v double")
    got = {r.tier: r["count"] for r in slices.tiers(df, "k", "v").groupBy("tier").count().collect()}
    assert [got.get(x, 0) for x in ("low", "medium", "high")] == sizes


def test_thin_by_sensors_alone_when_there_is_no_reference(spark):
    df = spark.createDataFrame([("a", s, 1, False) for s in range(5)] + [("b", 1, 0, False), (None, 1, 3, True)], "d string, s int, n int, o boolean")
    got = {r.group: r for r in representation.summarize(df, ["d"], "s", "n", "o").collect()}
    assert set(got) == {"a", "b"}
    assert (got["a"].thin, got["b"].thin) == (False, True)
    assert got["a"].row_share == pytest.approx(5 / 6)


def test_repeated_local_hour_stays_two(spark):
    polls = [(1, t("2025-04-05 15:10")), (1, t("2025-04-05 16:10"))]
    df = spark.createDataFrame([(k, m, 1, 1, 2, m) for k, m in polls], "location_id int, sensing_datetime timestamp_ntz, direction_1 int, direction_2 int, total_of_directions int, polled_at timestamp_ntz")
    m = minutes.archive_minutes(df, ZONE)
    assert m.select("ts_local").distinct().count() == 1
    assert m.select("ts_utc").distinct().count() == 2


def test_venue_hours_are_half_open(spark):
    df = spark.createDataFrame([("v", t("2024-01-01 19:00"), t("2024-01-01 21:00"))], "venue string, s timestamp_ntz, e timestamp_ntz")
    got = {(r.phase, r.hour.hour) for r in events.venue_hours(df, "s", "e").collect()}
    assert got == {("pre", 17), ("pre", 18), ("during", 19), ("during", 20), ("post", 21), ("post", 22)}


def test_predictions_must_be_good(spark):
    for bad in (-1.0, float("nan"), float("inf"), None):
        df = spark.createDataFrame([(1, 1.0, bad)], "s int, y double, p double")
        with pytest.raises(Exception, match="finite and non-negative"):
            metrics.score(df, [], "s", "y", "p").collect()
    df = spark.createDataFrame([(1, -1, 1.0, 1.0)], "s int, fold int, y double, p double")
    with pytest.raises(Exception, match="holdout"):
        metrics.cv_metrics(df, "fold", "s", "y", "p").collect()


def test_calibration_without_predictions_keeps_them(spark):
    df = spark.createDataFrame([(1, 10.0, 5.0, True), (1, 9.0, 4.0, False), (2, 3.0, 0.0, True), (2, 3.0, 7.0, False)], "s int, y double, p double, in_window boolean")
    got = {(r.s, r.p): r.calibrated for r in metrics.calibrate(df, "s", "y", "p").collect()}
    assert got == {(1, 5.0): 10.0, (1, 4.0): 8.0, (2, 0.0): 0.0, (2, 7.0): 7.0}


def test_unknown_weight(spark):
    df = spark.createDataFrame([(1,)], "s int")
    with pytest.raises(ValueError, match="unknown weight"):
        metrics.weights(df, "other", "s")


def test_bootstrap_holds_the_error(spark):
    rng = np.random.default_rng(1)
    df = spark.createDataFrame([("a", int(s), float(y), float(y * (1.1 + s % 3 / 10))) for s, y in zip(np.arange(200) % 25, rng.poisson(20, 200) + 1, strict=True)], "d string, s int, y double, p double")
    r = metrics.slice_errors(df, ["d"], "s", "y", "p", reps=100).first()
    assert 0.1 < r.wape_lo < r.wape < r.wape_hi < 0.3
    assert not r.worse


def test_bootstrap_draws_with_replacement(spark):
    cells = spark.createDataFrame([("d", "solo", 1, 100.0, 30.0), *[("d", "many", i, 100.0, e) for i, e in ((2, 10.0), (3, 50.0), (4, 90.0))]], "dimension string, group string, s int, y double, abs_err double")
    got = {r.group: r for r in metrics.sensor_bootstrap(cells, "s", reps=500, seed=0).collect()}
    assert (got["solo"].wape_lo, got["solo"].wape_hi) == pytest.approx((0.3, 0.3))
    assert got["many"].wape_lo < 0.25 < 0.5 < 0.75 < got["many"].wape_hi
    draws = spark.range(200).select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(49).cast("long"))).alias("nth"), "id").select(metrics.random_number(F.col("id"), F.col("nth"), F.lit(10), 7).alias("n"))
    counts = [r["count"] for r in draws.groupBy("n").count().collect()]
    assert len(counts) == 10
    assert min(counts) > 850
    assert max(counts) < 1150


@settings(max_examples=10, deadline=None)
@given(st.lists(st.floats(0, 1000), min_size=40, max_size=80))
def test_psi_of_itself_is_zero(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert drift.drift(df, df, ["v"]).first().psi == pytest.approx(0, abs=1e-9)


def test_psi_unseen_value_counts(spark):
    ref, cur = spark.createDataFrame([(1.0,), (2.0,)], "v double"), spark.createDataFrame([(1.0,), (9.0,)], "v double")
    e, a = np.array([0.5, 0.5, 1e-4]), np.array([0.5, 1e-4, 0.5])
    assert drift.drift(ref, cur, ["v"]).first().psi == pytest.approx(((a - e) * np.log(a / e)).sum())


def test_no_previous_run_passes(spark):
    now = spark.createDataFrame([(10, 2, 1.0)], "n_rows long, n_sensors long, mean_count double")
    assert {r.passed for r in checks.run_drift(now, now.limit(0)).collect()} == {True}


def test_unknown_operator():
    with pytest.raises(ValueError, match="unknown operator"):
        calendar.condition("a", "~", 1)


def test_contracts(spark):
    with pytest.raises(ValueError, match="unknown use"):
        schema.contract("feature osm: a int")
    with pytest.raises(ValueError, match="named twice"):
        schema.contract("key osm: a int, a int")
    counts = schema.COUNTS_HOURLY
    assert len(counts.fields) == 40
    assert schema.used_as(counts, "key", "label") == ["location_id", "ts_utc", "pedestriancount"]
    assert not {"direction_1", "direction_2", "hour_of_week", "sun_azimuth_deg"} & set(schema.features(counts))
    assert set(schema.features(counts)) - set(schema.features(counts, "portable")) == {"post_metro_tunnel", "slope_pct", "slope_pct_local_mean", "elevation_m"}
    with pytest.raises(ValueError, match="unknown variant"):
        schema.features(counts, "x")
    own = schema.segment_features(("food_drink", "retail"))
    assert {"poi_retail_400", "ang_choice_norm_1600", "clue_jobs_800"} <= set(schema.features(own))
    assert not {"length_m", "bearing_deg", "segment_id"} & set(schema.features(own))
    both = schema.sensor_features(own)
    assert len(both.fields) == len(schema.SENSORS.fields) + len(own.fields) - 2
    small = schema.contract("key a: id int\nmeta a: name string, size int")
    rows = spark.createDataFrame([(1, "x", 2.0, 0), (1, "y", 1.0, 0), (None, "z", 1.0, 0)], "id int, name string, size double, more int")
    assert {tuple(r) for r in schema.check(rows, small).collect()} == {("size", "is double", None), ("more", "extra", None), ("id", "null key", 1), ("id", "repeated key", 1)}
    assert schema.check(schema.conform(rows.where("name = 'x'"), small), small).count() == 0


def test_site_guard():
    with pytest.raises(ValueError, match="no counts"):
        frame.check_site("a", "b")


def brute_betweenness(net: graph.Network, radius: float) -> dict[int, float]:
    """All shortest paths of all pairs, each pair once."""
    out = dict.fromkeys(net.segments, 0.0)
    n = len(net.ids)
    for s in range(n):
        best = dict(net.settle({s: 0.0}, radius))
        for g in range(s + 1, n):
            if g not in best:
                continue
            paths, stack = [], [(g, [])]
            while stack:
                x, used = stack.pop()
                if x == s:
                    paths.append(used)
                    continue
                stack += [(y, [*used, k]) for y, k, w in net.next[x] if y in best and abs(best[y] + w - best[x]) < 1e-9]
            for p in paths:
                for k in p:
                    out[net.segments[k]] += 1 / len(paths)
    return out


def test_betweenness_by_brute_force(spark, sf):
    from paceline.plans.views import v_lattice

    edges = v_lattice(spark, sf)
    want = brute_betweenness(graph.load(edges), 350.0)
    got = {r.segment_id: r.betweenness for r in graph.primal_metrics(edges, 350.0, 3).collect()}
    assert got == pytest.approx(want)


def test_angular_on_a_cross(spark):
    # four arms meet: going straight costs nothing, turning costs one right angle
    arms = [(k, 0, k, 100.0, [(0.0, 0.0), (math.sin(k * math.pi / 2) * 100, math.cos(k * math.pi / 2) * 100)]) for k in range(1, 5)]
    df = spark.createDataFrame(arms, "segment_id long, u long, v long, length_m double, line array<struct<x: double, y: double>>")
    got = graph.angular_metrics(df, 1000.0, 3).collect()
    assert {r.node_count for r in got} == {4.0}
    assert [r.total_depth for r in got] == pytest.approx([2.0] * 4)
    assert [r.choice for r in got] == pytest.approx([0.0] * 4)
    line = [(k, k, k + 1, 100.0, [(k * 100.0, 0.0), (k * 100.0 + 100, 0.0)]) for k in range(4)]
    got = graph.angular_metrics(spark.createDataFrame(line, df.schema), 1000.0, 3)
    assert {r.segment_id: r.choice for r in got.collect()} == pytest.approx({0: 0.0, 1: 2.0, 2: 2.0, 3: 0.0})


def test_keep_bridges_in_order(spark):
    rows = [(1, 1, 2, True), (2, 2, 3, False), (3, 1, 3, False), (4, 3, 4, False)]
    df = spark.createDataFrame(rows, "segment_id long, u long, v long, must_keep boolean")
    assert sorted(r.segment_id for r in graph.keep_bridges(df).collect()) == [1, 2, 4]


def test_preflight(spark):
    df = spark.createDataFrame([(1, 1, 2, 1.0)], "segment_id long, u long, v long, length_m double")
    with pytest.raises(ValueError, match="cut the area"):
        graph.preflight(df, 0)


def test_loop_in_a_way_splits(spark):
    df = spark.createDataFrame([(1, [1, 2, 3, 4, 2])], "way_id long, node_ids array<long>")
    got = sorted((r.u, r.v, r.node_ids) for r in segments.split_ways(df).collect())
    assert got == [(1, 2, [1, 2]), (2, 2, [2, 3, 4, 2])]


def test_complete_linkage_chain():
    groups = splits.complete_linkage(np.array([[0.0, 0], [150, 0], [300, 0], [1000, 0]]), 200)
    assert groups[0] == groups[1] != groups[2]
    assert len(set(groups)) == 3


def test_splits_hold_out_whole_groups(spark):
    pts = spark.createDataFrame([(i, float(i // 2 * 1000 + i % 2 * 50), 0.0) for i in range(20)], "id long, x double, y double")
    got = {r.id: r for r in splits.splits(pts, {"north": [4]}, 3).collect()}
    assert (got[4].holdout, got[5].holdout) == ("north", "neighbour")
    assert got[4].fold == got[5].fold == -1
    assert all(got[i].fold == got[i + 1].fold for i in range(0, 20, 2))
    sizes = np.bincount([r.fold for r in got.values() if r.fold >= 0])
    assert sizes.max() - sizes.min() <= 2


@pytest.mark.parametrize(
    ("text", "open_at", "closed_at"),
    [("Mo-Fr 09:00-17:00", [9, 16], [8, 17, 5 * 24 + 10]), ("Fr 22:00-02:00; Sa 10:00-14:00", [4 * 24 + 23, 5 * 24 + 1, 5 * 24 + 11], [5 * 24 + 2]), ("Su 23:00-03:00", [0, 2, 167], [3]), ("Mo-Su 08:00-20:00; Su off", [8], [6 * 24 + 9]), ("09:00-12:00,13:00-15:00", [9, 14], [12])],
)
def test_opening_hours(text, open_at, closed_at):
    got = opening_hours.week(text)
    assert all(got[h] for h in open_at)
    assert not any(got[h] for h in closed_at)


@pytest.mark.parametrize("text", [None, "", '"by appointment"', "sunrise-sunset", "Mo 9-17", "Mo 10:75-11:00", "Mon 10:00-11:00", "PH", "Mo 10:00-11:00 sometimes", "10:00", "Mo,We-"])
def test_opening_hours_not_understood(text):
    assert opening_hours.week(text) is None


def test_inside_shares_no_edge(spark):
    ring = [(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0)]
    areas = spark.createDataFrame([(1, ring), (2, [(x + 10, y) for x, y in ring])], "id int, ring array<struct<x: double, y: double>>")
    pts = spark.createDataFrame([(1, 5.0, 5.0), (2, 10.0, 5.0), (3, 25.0, 5.0)], "id int, x double, y double")
    assert {r.point_id: r.area_id for r in spatial.containing(pts, areas, 7.0).collect()} == {1: 1, 2: 2, 3: None}
    assert areas.select(geometry.ring_area(F.col("ring"))).first()[0] == 100


def test_clipping_and_hull():
    square = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0)]
    assert surroundings.clipped([(2, 2), (6, 2), (6, 6), (2, 6)], square) == pytest.approx(4)
    assert surroundings.clipped(square, surroundings.capsule(-50, 2, 50, 2, 100)) == pytest.approx(16)
    assert surroundings.clipped([(9, 9), (10, 9), (10, 10)], square) == 0
    assert sorted(surroundings.hull([*square, (2.0, 2.0), (4.0, 2.0)])) == sorted(square)


def test_routes_prefer_short_and_fit(spark, sf):
    from paceline.plans.views import v_lattice

    net = graph.load(v_lattice(spark, sf))
    found = routes.sample_routes(net, [0], {"z": 24}, 10, 0.4, 1)
    assert found
    assert all(len(r.segments) == 8 for r in found[:1])
    every = routes.route_table(spark, found)
    prior = routes.prior_trips(every, spark.createDataFrame([("z", 1.0)], "destination string, weight double"), 100.0, 1.0)
    assert prior.agg(F.sum("trips")).first()[0] == pytest.approx(100)
    sensors = spark.createDataFrame([(i, s) for i, s in enumerate(found[0].segments[:2])], "sensor int, segment long")
    passed = routes.passages(every, sensors)
    assert {(r.sensor, r.lag_m) for r in passed.where("route = 0").collect()} == {(0, 0.0), (1, found[0].offsets[1] - found[0].offsets[0])}
    targets = passed.join(prior, "route").groupBy("sensor").agg(F.sum("trips").alias("total"))
    trips = routes.fitted(passed, targets, prior, 0.1).orderBy("route").collect()
    assert [r.trips for r in trips] == pytest.approx([r.trips for r in prior.orderBy("route").collect()], abs=1e-6)


def test_gates():
    g = models.Gate()
    assert not g.failures(0.8, 1.0, 0.8, 2.0)
    assert len(g.failures(0.95, 1.0, 0.7, 3.0)) == 3
    assert models.beats(0.5, None)
    assert not models.beats(0.5, 0.5)


def test_baseline_learns_levels(spark):
    rows = [(s, h, float(round(math.expm1(1 + s * 0.5 + (h % 3) * 0.2)))) for s in range(6) for h in range(24)]
    df = spark.createDataFrame(rows, "location_id int, hour_of_week int, n double")
    sensors = spark.createDataFrame([(s, math.expm1(s)) for s in range(6)], "location_id int, reach double")
    m = models.fit_baseline(df, sensors, "location_id", "hour_of_week", "n", ["reach"])
    got = models.predict_baseline(m, df, sensors, "location_id", "hour_of_week").agg(metrics.wape("n", "predicted").alias("w")).first().w
    assert got < 0.1
    with pytest.raises(ValueError, match="missing"):
        models.predict(None, df, ["absent"])


def test_tagged_rows_are_those_of_the_query(spark):
    assert network_queries.tagged(spark).count() == 15


def test_all_ways_are_split(spark, tmp_path):
    """No order is left out, however large its key; a way is cut at a node that one with a large key uses too."""
    from paceline.plans import registry

    rows = [(1, 1, 10), (1, 2, 11), (1, 3, 12), (90_000, 1, 20), (90_000, 2, 11), (90_000, 3, 21), (90_001, 1, 30)]
    spark.createDataFrame(rows, "l_orderkey long, l_linenumber long, l_partkey long").write.parquet(f"{tmp_path}/lineitem.parquet")
    got = sorted((r.segment_id, r.u, r.v) for r in registry.QUERIES["split_ways"](spark, str(tmp_path)).collect())
    assert got == [("1-0", 10, 11), ("1-1", 11, 12), ("90000-0", 20, 11), ("90000-1", 11, 21)]


def test_queries_take_the_whole_view(spark, sf):
    """Every site is split and every place is a building; late polls are those of all sensors."""
    from paceline.plans import frame_queries, registry, views

    assert registry.QUERIES["location_splits"](spark, sf).count() == views.v_sites(spark, sf).count()
    assert frame_queries._buildings(spark, sf).count() == views.v_places(spark, sf).count()
    days = {r.day.day for r in registry.QUERIES["late_polls"](spark, sf).collect()}
    assert days >= {4, 8, 12, 16, 20, 24}


def test_all_sites_are_split(spark, tmp_path):
    from paceline.plans import registry

    spark.range(1, 151).withColumnRenamed("id", "s_suppkey").write.parquet(f"{tmp_path}/supplier.parquet")
    assert registry.QUERIES["location_splits"](spark, str(tmp_path)).count() == 150


def test_areas_near_segments(spark):
    ring = [(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0)]
    areas = spark.createDataFrame([(1, ring)], "id long, ring array<struct<x: double, y: double>>")
    rows = [(1, 30.0, 5.0, 40.0, 5.0), (2, -5.0, 5.0, 15.0, 5.0), (3, 4.0, 4.0, 5.0, 5.0), (4, 13.0, 14.0, 13.0, 90.0), (5, 90.0, 5.0, 95.0, 5.0), (6, 900.0, 0.0, 950.0, 0.0), (7, 31.0, 5.0, 40.0, 5.0)]
    segs = spark.createDataFrame(rows, "segment_id long, x1 double, y1 double, x2 double, y2 double")
    got = {r.segment_id: (r.green_dist_m, r.green_adjacent) for r in surroundings.area_distances(segs, {"green": areas}, 50.0).collect()}
    assert got == {1: (20.0, True), 2: (0.0, True), 3: (0.0, True), 4: (5.0, True), 5: (50.0, False), 6: (50.0, False), 7: (21.0, False)}


def test_terrain_where_no_section_is(spark):
    raster = spark.createDataFrame([(r, c, 3.0 * c + 4.0 * r) for r in range(5) for c in range(5) if (r, c) != (4, 4)], "row long, col long, value double")
    sensors = spark.createDataFrame([(1, 25.0, 25.0), (2, 35.0, 35.0), (3, 15.0, 15.0)], "id long, x double, y double")
    done = spark.createDataFrame([(1, None, "none"), (2, None, "none"), (3, 7.0, "section")], "sensor long, slope_pct double, place_source string")
    got = {r.sensor: (r.slope_pct, r.elevation_m, r.place_source) for r in surroundings.fill_from_dem(done, sensors, raster, 10.0).collect()}
    assert got == {1: (50.0, 14.0, "dem"), 2: (50.0, 21.0, "dem"), 3: (7.0, None, "section")}
    edge = spark.createDataFrame([(1, 35.0, 45.0)], "id long, x double, y double")
    assert surroundings.dem_terrain(edge, raster, 10.0).first().slope_pct is None


def test_inferred_crossings_hold_all_conditions(spark, sf):
    """Neither where a crossing is mapped, nor where two edges meet, nor where the sidewalks are joined within three times the link."""
    from paceline.plans import registry

    got = registry.QUERIES["inferred_crossings"](spark, sf).collect()
    assert sorted((r.segment_id, r.length_m) for r in got) == [("xing-110-111", 12.0), ("xing-150-151", 12.0)]


def test_mapped_crossings_near_an_end_of_the_link(spark):
    from paceline.operators import connections

    road = spark.createDataFrame([(1, 10, 0.0, 0.0, 100.0, 0.0)], "road long, junction long, jx double, jy double, nx double, ny double")
    ends = spark.createDataFrame([(1, 5.0, 12.0), (2, 5.0, -12.0)], "id long, x double, y double")
    edges = spark.createDataFrame([(i, 10, 20 + i, 9.0, i > 0) for i in range(3)], "segment_id long, u long, v long, length_m double, in_metric_graph boolean")
    for y, n in ((41.0, 0), (43.0, 1)):
        mapped = spark.createDataFrame([(1, 5.0, y)], "id long, x double, y double")
        assert connections.infer_crossings(road, ends, mapped, edges).count() == n


def test_reasons_for_review(spark):
    cands = [(1, 50, 2.0, 2.0, 1, "footway", 10.0), (1, 51, 9.0, 9.0, 2, "footway", 10.0), (2, 50, 16.0, 16.0, 1, "primary", 90.0), (2, 51, 17.0, 17.0, 2, "footway", 90.0), (3, 50, 16.0, 16.0, 1, "primary", 90.0), (3, 51, 17.0, 17.0, 2, "footway", 0.0)]
    c = spark.createDataFrame(cands, "sensor long, segment long, dist double, score double, rank int, highway string, bearing double")
    s = spark.createDataFrame([(1, 175.0, "Outdoor"), (2, 10.0, "Indoor"), (3, 10.0, "Outdoor"), (4, None, "Outdoor")], "sensor long, axis double, location_type string")
    got = {r.sensor: (r.segment, r.dist, r.bearing_agrees, r.review_reasons, r.needs_review) for r in segments.review_matches(c, s, spark.createDataFrame([(3, 51)], "sensor long, segment long"), ["footway"]).collect()}
    assert got == {
        1: (50, 2.0, True, "", False), 2: (50, 16.0, False, "far; close runner-up; road centreline; bearing disagrees; indoor sensor", True),
        3: (51, 17.0, None, "", False), 4: (None, None, None, "no segment", True),
    }


def test_baseline_counts_all_sensors_or_none(spark, monkeypatch):
    rows = spark.createDataFrame([(i, 0, 3.0 + i) for i in range(4)], "location_id int, hour_of_week int, n double")
    sensors = spark.createDataFrame([(i, float(i)) for i in range(4)], "location_id int, reach double")
    monkeypatch.setattr(models, "MOST_SENSORS", 3)
    with pytest.raises(ValueError, match="more than 3 sensors"):
        models.fit_baseline(rows, sensors, "location_id", "hour_of_week", "n", ["reach"])
    monkeypatch.setattr(models, "MOST_SENSORS", 4)
    assert len(models.fit_baseline(rows, sensors, "location_id", "hour_of_week", "n", ["reach"]).beta) == 2


@pytest.fixture(scope="module")
def counted(spark):
    rng = np.random.default_rng(3)
    x, z = rng.uniform(0, 4, 2000), rng.integers(0, 3, 2000)
    y = rng.poisson(np.exp(0.5 * x + (z == 1)))
    rows = [(i, float(a), None if i % 9 == 0 else float(b), None, int(c), i % 4 - (i % 40 == 0) * 9) for i, (a, b, c) in enumerate(zip(x, z, y, strict=True))]
    return spark.createDataFrame(rows, "id int, x double, z double, empty double, y int, fold int").repartition(3).cache()


def test_boosted_counts_and_quantiles(counted):
    """Poisson trees come near the mean they were drawn from; quantile trees leave their share below."""
    s = boosting.Settings(rounds=15, depth=3, rate=0.3)
    got = boosting.predict(boosting.fit(counted, "y", ["x", "z", "empty"], s), counted)
    r = got.agg(F.avg(F.abs(F.col("predicted") - F.col("y"))).alias("mae"), F.avg("predicted").alias("mean"), F.avg("y").alias("of")).first()
    constant = counted.agg(F.avg(F.abs(F.col("y") - r.of))).first()[0]
    assert r.mae < 0.65 * constant
    assert r.mean == pytest.approx(r.of, rel=0.03)
    for q in (0.1, 0.9):
        low = boosting.predict(boosting.fit(counted, "y", ["x", "z", "empty"], boosting.Settings("quantile", q, 10, 3, 0.5)), counted)
        below, upto = low.agg(F.avg((F.col("y") < F.col("predicted")).cast("int")), F.avg((F.col("y") <= F.col("predicted")).cast("int"))).first()
        assert below - 0.05 < q < upto + 0.05
    with pytest.raises(ValueError, match="features missing"):
        boosting.predict(boosting.Trees(["no"], [], s), counted)
    with pytest.raises(ValueError, match="unknown loss"):
        boosting.Settings("square")
    with pytest.raises(ValueError, match="no rows"):
        boosting.fit(counted.limit(0), "y", ["x"], s)


def test_out_of_fold_models_have_not_seen_their_rows(counted):
    seen = []

    def fit_one(rows):
        seen.append({r.fold for r in rows.select("fold").distinct().collect()})
        return seen[-1]

    got = boosting.oof_predict(counted, "fold", fit_one, lambda m, rows: rows.withColumn("unseen", F.lit(4 - len(m))))
    assert seen == [{0, 1, 2, 3} - {k} for k in range(4)]
    assert got.count() == counted.where("fold >= 0").count()
    s = boosting.Settings(rounds=4, depth=2, rate=0.5, bins=8)
    both = boosting.oof_intervals(counted.where("fold in (0, 1)"), "fold", "y", ["x", "z"], settings=s)
    assert both.where("lower > predicted or predicted > upper").count() == 0
    assert 0.6 < both.agg(F.avg(F.col("y").between(F.col("lower"), F.col("upper")).cast("int"))).first()[0] <= 1


def test_graph_of_ways(spark):
    """Cut at a node that two ways share; an added segment joins the rest; features follow from it."""
    ways = spark.createDataFrame([(1, [1, 2, 3], {"highway": "residential", "sidewalk": "separate"}), (2, [4, 2], {"highway": "steps"}), (3, [8, 9], {"highway": "footway"})], "way_id long, node_ids array<long>, tags map<string, string>")
    nodes = spark.createDataFrame([(1, 0.0, 0.0), (2, 30.0, 40.0), (3, 30.0, 50.0), (4, 0.0, 40.0), (8, 900.0, 0.0), (9, 900.0, 7.0)], "node_id long, x double, y double")
    added = spark.createDataFrame([("d-1", 3, 8, [(30.0, 50.0), (900.0, 0.0)], True)], "segment_id string, u long, v long, line array<struct<x: double, y: double>>, is_detected boolean")
    got = {r.segment_id: r for r in connections.build_graph(ways, nodes).collect()}
    assert {k: (r.u, r.v, r.length_m, r.in_metric_graph, r.is_steps, r.component) for k, r in got.items()} == {
        "1-0": (1, 2, 50.0, False, False, 1), "1-1": (2, 3, 10.0, False, False, 1), "2-0": (4, 2, 30.0, True, True, 1), "3-0": (8, 9, 7.0, True, False, 8),
    }
    joined = connections.build_graph(ways, nodes, added)
    assert {r.component for r in joined.collect()} == {1}
    features = {r.segment_id: r for r in segments.tag_features(joined).collect()}
    assert (features["d-1"].is_detected, features["d-1"].hw_other, features["1-0"].sidewalk_separate, features["2-0"].hw_steps) == (True, True, True, True)


def _copied(spark, sf, tmp_path, times):
    """The sf's places so many times under shifted keys (the shifts keep their points), and its sites as they are."""
    for name, key in (("customer", "c_custkey"), ("supplier", "s_suppkey")):
        t = spark.read.parquet(f"{sf}/{name}.parquet")
        copies = spark.range(times if name == "customer" else 1).select((F.col("id") * 100_000).alias("_shift"))
        t.crossJoin(copies).withColumn(key, F.col(key) + F.col("_shift")).drop("_shift").write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def _most_rows(df):
    """Runs df; its rows, and the most rows that any operator of its plan made."""
    rows = df.collect()
    most, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.metrics().contains("numOutputRows"):
            most = max(most, node.metrics().apply("numOutputRows").value())
        for inner in ("executedPlan", "plan"):
            with contextlib.suppress(Exception):
                todo.append(getattr(node, inner)())
        kids = node.children()
        todo += [kids.apply(i) for i in range(kids.size())]
    return rows, most


def test_shade_of_copied_buildings(spark, sf, tmp_path):
    """Copies of buildings give the same shade, and no more work than one of each."""
    from paceline.plans import registry

    once, n = _most_rows(registry.QUERIES["shade_table"](spark, sf))
    got, m = _most_rows(registry.QUERIES["shade_table"](spark, _copied(spark, sf, tmp_path, 20)))
    assert sorted(map(tuple, got)) == sorted(map(tuple, once))
    assert m <= max(n, 20 * 150)


@pytest.mark.parametrize(("n", "side", "radius"), [(60, 40, 7.0), (60, 12, 5.0), (40, 5, 0.0), (200, 1000, 200.0)])
def test_linkage_by_brute_force(n, side, radius):
    """On a matrix of all distances, ties to the first pair; points on a grid, so that many tie."""
    xy = np.random.default_rng(n + side).integers(0, side, (n, 2)).astype(float)
    d, name = np.sqrt(((xy[:, None] - xy[None]) ** 2).sum(-1)), np.arange(n)
    np.fill_diagonal(d, np.inf)
    while d.min() <= radius:
        i, j = sorted(divmod(int(d.argmin()), n))
        d[i] = d[:, i] = np.maximum(d[i], d[j])
        d[j] = d[:, j] = d[i, i] = np.inf
        name[name == j] = i
    assert splits.complete_linkage(xy, radius).tolist() == np.unique(name, return_inverse=True)[1].tolist()


def test_splits_of_many_sensors(spark):
    """More sensors than a matrix of distances could hold, at few spots and at many; unknown places are near nothing."""
    few = spark.range(12_000).select("id", (F.col("id") % 10 * 1000).cast("double").alias("x"), F.lit(0.0).alias("y"))
    got = splits.splits(few, {"north": [3]}, 3).groupBy("group", "fold", "holdout").count().collect()
    assert {(r.fold, r.holdout, r["count"]) for r in got if r.group == 3} == {(-1, "north", 1), (-1, "neighbour", 1199)}
    assert sorted(sum(r["count"] for r in got if r.fold == k) for k in range(3)) == [3600] * 3
    many = spark.range(6_000).select("id", (F.col("id") * 150).cast("double").alias("x"), F.when(F.col("id") > 3, 0.0).alias("y"))
    got = splits.splits(many, {}, 3).collect()
    assert len(got) == 6_000
    assert len({r.group for r in got}) == 4 + 2998


def test_built_form_of_copied_buildings(spark, sf, tmp_path):
    """Twenty buildings at each place are counted twenty times, and no pairs are made of each of them."""
    from paceline.plans import registry

    once, n = _most_rows(registry.QUERIES["built_form"](spark, sf))
    got, m = _most_rows(registry.QUERIES["built_form"](spark, _copied(spark, sf, tmp_path, 20)))
    assert {r.segment_id: r.building_count for r in got} == {r.segment_id: 20 * r.building_count for r in once}
    assert {r.segment_id: r.green_dist_m for r in got} == {r.segment_id: r.green_dist_m for r in once}
    assert any(r.building_count for r in once)
    assert {r.segment_id: r.building_coverage for r in got} == pytest.approx({r.segment_id: min(1.0, 20 * r.building_coverage) for r in once}, abs=2e-5)
    assert m <= max(n, 20 * 150)


@pytest.fixture(scope="module")
def tangle(spark):
    """A network whose neighbours are far apart in the order of ids, with loops, parallel segments, and lengths from 0 up."""
    rng = np.random.default_rng(5)
    name = rng.permutation(120) * 1_000_003 - 40_000_000
    rows = [(int(k) + 2**60, int(name[a]), int(name[b]), float(w)) for k, (a, b, w) in enumerate(zip(rng.integers(0, 120, 260), rng.integers(0, 120, 260), rng.choice([0.0, 10.0, 20.0, 35.5], 260), strict=True))]
    return spark.createDataFrame([*rows, (9, 77, 77, 5.0)], "segment_id long, u long, v long, length_m double")


@pytest.mark.parametrize("name", ["amenities_in_reach", "edge_betweenness", "network_distance", "reach_within", "segments_in_reach", "weighted_reach"])
def test_searches_hold_no_whole_network(name, spark, sf, monkeypatch):
    from paceline.plans import registry

    monkeypatch.setattr(graph.preflight, "__defaults__", (100,))
    assert registry.QUERIES[name](spark, sf).count() > 0


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(graph._over_blocks, "__defaults__", (None, 20))


def test_reach_in_blocks(tangle, small_blocks):
    net = graph.load(tangle)
    near = {net.ids[s]: net.settle({s: 0.0}, 40.0) for s in range(len(net.ids))}
    got = {(r.source, r.node): r.dist_m for r in graph.reach(tangle, 40.0).collect()}
    assert got == pytest.approx({(s, net.ids[n]): d for s, found in near.items() for n, d in found})
    want = {}
    for s, found in near.items():
        for k, (u, v) in enumerate(net.ends):
            d = min((d for n, d in found if n in (u, v)), default=None)
            if d is not None:
                want[s, net.segments[k]] = d
    assert {(r.source, r.segment_id): r.dist_m for r in graph.reach_segments(tangle, 40.0).collect()} == pytest.approx(want)


def test_distance_in_blocks(spark, tangle, small_blocks):
    net = graph.load(tangle)
    kinds = {"a": net.ids[3:9], "b": net.ids[50:51]}
    sources = spark.createDataFrame([(k, n) for k, ids in kinds.items() for n in ids] + [("c", 1)], "venue string, node long")
    want = {}
    for k, ids in kinds.items():
        near = dict(net.settle({net.at[n]: 0.0 for n in ids}, 60.0))
        want |= {(k, s): min(near.get(u, math.inf), near.get(v, math.inf)) for s, (u, v) in zip(net.segments, net.ends, strict=True) if u in near or v in near}
    assert {(r.venue, r.segment_id): r.dist_m for r in graph.distance_to(tangle, sources, 60.0).collect()} == pytest.approx(want)


def test_betweenness_in_blocks(tangle, small_blocks):
    whole = graph._primal(net := graph.load(tangle), list(range(len(net.ids))), 40.0)
    want = {i: a / 2 for i, a in zip(whole["id"], whole["a"], strict=True) if i in set(net.segments)}
    got = {r.segment_id: r.betweenness for r in graph.primal_metrics(tangle, 40.0, 3).collect()}
    assert len(got) == len(net.segments)
    assert {i: b for i, b in got.items() if b} == pytest.approx({i: b for i, b in want.items() if b})


def test_fold_neighbours_of_copied_places(spark, sf, tmp_path):
    """Twenty places at each spot: the result by brute force, and no row for each pair of them."""
    from paceline.plans import registry, views

    at = _copied(spark, sf, tmp_path, 20)
    points = views.v_places(spark, at).collect()
    spots = {(p.x, p.y) for p in points}
    folds = {s: {p.id % 7 for p in points if math.dist(s, (p.x, p.y)) < 40} for s in spots}
    got, most = _most_rows(registry.QUERIES["fold_neighbours"](spark, at))
    assert sorted(map(tuple, got)) == sorted((f, p.id) for p in points for f in folds[p.x, p.y] if f != p.id % 7)
    assert most <= 7 * len(points)
