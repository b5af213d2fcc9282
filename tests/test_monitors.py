"""Windowed monitors against plain Python over random calls, one area holding a third of them."""

import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from wardlens.operators import monitors as N

START = dt.datetime(2024, 1, 1)
MINUTE = 60_000
STATS = {"A0": ("High Risk", 8.0), "A1": ("Medium Risk", 5.0), "A2": ("Low Risk", 5.0),
         "A9": ("High Risk", 5.0)}
UNITS = ["LAPD-1", "lafd-2", "EMS-3", "XYZ-4", None]
SCHEMA = ("call_id string, ts timestamp, area_name string, is_dispatched boolean, "
          "response_time_minutes double, units_dispatched array<string>")


def make_calls(seed=7, n=1500, hours=4):
    rng = random.Random(seed)
    calls = []
    for i in range(n):
        area = "a0" if i % 3 == 0 else rng.choice(["A1", "a2", "A3", "A0", None])
        minute = rng.random() * hours * 60 if rng.random() < 0.8 else 121 + rng.random() * 3
        units = rng.choice([None, [], [rng.choice(UNITS) for _ in range(rng.randint(1, 4))]])
        calls.append((str(i), START + dt.timedelta(minutes=minute), area,
                      rng.choice([True, True, False, None]),
                      rng.choice([None, 0.0, -1.0, rng.randint(1, 40) / 2]), units))
    return calls


CALLS = make_calls()


@pytest.fixture(scope="module")
def calls(spark):
    return spark.createDataFrame(CALLS, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def stats(spark):
    return spark.createDataFrame([(k, *v) for k, v in STATS.items()],
                                 "area_key string, area_risk_level string, historical_avg_minutes double")


def millis(t):
    return int((t - dt.datetime(1970, 1, 1)).total_seconds() * 1000)


def windows(t, size, slide):
    first = millis(t) // (slide * MINUTE) * slide * MINUTE
    return [first - k * slide * MINUTE for k in range(size // slide)]


def test_unit_utilization(calls):
    expected = defaultdict(lambda: [0, 0, 0])
    for _, t, area, dispatched, _, units in CALLS:
        for unit in (units or []) if dispatched and area else []:
            if unit is not None:
                row = expected[area, windows(t, 15, 15)[0]]
                for i, prefix in enumerate(["LAPD", "LAFD", "EMS"]):
                    row[i] += unit.upper().startswith(prefix)
    got = {(r.area_name, r.window_start): ([r.lapd_units, r.lafd_units, r.ems_units], r.utilization_pct)
           for r in N.unit_utilization(calls).collect()}
    assert got == {k: (v, sum(v) / 50 * 100) for k, v in expected.items()}
    only_unknown = calls.limit(1).withColumns({
        "is_dispatched": F.lit(True), "area_name": F.lit("A1"),
        "units_dispatched": F.array(F.lit("XYZ-1"))})
    assert N.unit_utilization(only_unknown).first().utilization_pct == 0.0


def test_dispatch_failures(calls, stats):
    total, failed = defaultdict(int), defaultdict(int)
    for _, t, area, dispatched, _, _ in CALLS:
        for w in windows(t, 15, 5) if area else []:
            total[area, w] += 1
            failed[area, w] += not dispatched
    expected = {(a, w): (failed[a, w], n, failed[a, w] / n, STATS[a.upper()][0])
                for (a, w), n in total.items()
                if failed[a, w] / n > 0.3 and STATS.get(a.upper(), ("",))[0] in ("High Risk", "Medium Risk")}
    got = {(r.area_name, r.window_start): (r.failure_count, r.total_calls, r.failure_rate,
                                           r.area_risk_level)
           for r in N.dispatch_failures(calls, stats).collect()}
    assert got == expected and len(got) > 20


def test_response_degradation(calls, stats):
    times = defaultdict(list)
    for _, t, area, dispatched, minutes, _ in CALLS:
        if area and dispatched and (minutes or 0) > 0:
            for w in windows(t, 30, 5):
                times[area, w].append(minutes)
    expected = {}
    for (a, w), found in times.items():
        live, historical = sum(found) / len(found), STATS.get(a.upper(), (None, 8.5))[1]
        if live > 1.5 * historical:
            expected[a, w] = (live, historical, live / historical)
    got = {(r.area_name, r.window_start): (r.live_avg_minutes, r.historical_avg_minutes,
                                           r.degradation_ratio)
           for r in N.response_degradation(calls, stats).collect()}
    assert got == expected
    assert {a for a, _ in got} >= {"A3", "A1"}


@pytest.mark.parametrize("start", [None, START, START + dt.timedelta(minutes=55)])
def test_spikes(calls, start):
    slots = defaultdict(int)
    for _, t, area, *_ in CALLS:
        if area:
            slots[area, windows(t, 5, 5)[0]] += 1
    expected = {}
    for (a, w), n in slots.items():
        background = sum(slots.get((a, w - k * 5 * MINUTE), 0) for k in range(12))
        warm = start is None or w >= millis(start) + 60 * MINUTE
        if n > 2 * (background / 12) and warm:
            expected[a, w] = (w + 5 * MINUTE, n, background / 12, n / (background / 12))
    got = {(r.area_name, r.window_start): (r.window_end, r.call_count, r.baseline, r.spike_ratio)
           for r in N.spike_detection(calls, start_ts=start).collect()}
    assert got == expected and len(got) >= 3


def test_other_sizes_and_misaligned_slides(calls):
    got = {(r.area_name, r.window_start): r.total_calls
           for r in N.dispatch_windows(calls, size=20, slide=10).collect()}
    expected = defaultdict(int)
    for _, t, area, *_ in CALLS:
        for w in windows(t, 20, 10) if area else []:
            expected[area, w] += 1
    assert got == expected
    with pytest.raises(ValueError):
        N.dispatch_windows(calls, size=15, slide=10)


def test_result_key(calls):
    row = N.with_result_key(N.unit_utilization(calls)).first()
    assert row.result_key == f"{row.area_name}_{row.window_start}"
