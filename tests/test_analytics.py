from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from conftest import at
from fraudlens.operators import analytics

START = at("2025-01-01T00:00:00")


@pytest.fixture(scope="module")
def make_alerts(spark):
    def make(rows):
        data = [(d, s, START + timedelta(seconds=t)) for d, t, s in rows]
        return spark.createDataFrame(data, "domain string, fraud_score int, created_at timestamp")

    return make


def series(make_alerts, counts, **options):
    rows = [("gaming", 60 * i, 80) for i, n in enumerate(counts) for _ in range(n)]
    return analytics.velocity_ordered(make_alerts(rows), 60, **options).collect()


def test_trend_bounds_are_strict(make_alerts):
    """10 to 15 is exactly 1.5 times and not a spike; 10 to 11 exactly 1.1 and not a trend."""
    got = series(make_alerts, [10, 15, 10, 16, 10, 11, 10, 12])
    assert [r["trend_status"] for r in got] == [
        "BASELINE", "TRENDING_UP", "STABLE", "SPIKE", "STABLE", "STABLE", "STABLE", "TRENDING_UP",
    ]


def test_trend_over_several_buckets(make_alerts):
    got = series(make_alerts, [2, 4, 4, 5], trend_rows=2)
    assert [r["trend_status"] for r in got] == ["BASELINE", "SPIKE", "TRENDING_UP", "TRENDING_UP"]


def test_running_count_and_gaps(make_alerts):
    got = series(make_alerts, [1, 0, 2])
    assert [(r["x"], r["y1_velocity"], r["y3_cumulative"]) for r in got] == [(0.0, 1, 1), (120.0, 2, 3)]


def test_domains_share_the_first_time(make_alerts):
    got = analytics.velocity_ordered(make_alerts([("gaming", 0, 90), ("fintech", 65, 70)]), 60).collect()
    assert [(r["domain"], r["x"], r["trend_status"]) for r in got] == [
        ("fintech", 60.0, "BASELINE"), ("gaming", 0.0, "BASELINE"),
    ]


@pytest.mark.parametrize("scores, mean", [((70, 71), 70.5), ((70, 70, 71), 70.3), ((70,) * 19 + (71,), 70.1)])
def test_mean_rounds_half_up(make_alerts, scores, mean):
    got = analytics.velocity(make_alerts([("gaming", 0, s) for s in scores]), 60).first()
    assert got["y2_avg_score"] == mean


def test_last_points_per_domain_and_summary(make_alerts):
    alerts = make_alerts([("gaming", 60 * i, 80) for i in range(20)] + [("fintech", 0, 80)])
    points = analytics.last_points(analytics.velocity(alerts, 60), 15)
    gaming = points.filter("domain = 'gaming'").agg(F.min("x"), F.count("*")).first()
    assert tuple(gaming) == (300.0, 15)
    assert points.filter("domain = 'fintech'").first()["label"] == "0m"
    total = analytics.velocity_summary(alerts).first()
    assert (total["total_alerts"], total["domains"]) == (21, ["fintech", "gaming"])


def test_no_alerts(make_alerts):
    assert analytics.velocity(make_alerts([])).count() == 0


@pytest.mark.parametrize("trend_rows", [1, 3])
def test_segments_do_not_change_the_series(make_alerts, monkeypatch, trend_rows):
    """With two buckets a segment, with gaps and a domain that starts late, as with one segment."""
    rows = [(d, 60 * (i * i % 97) + late, 70 + i % 30) for d, late in (("gaming", 0), ("fintech", 4000)) for i in range(60)]
    whole = analytics.velocity_ordered(make_alerts(rows), 60, trend_rows=trend_rows).collect()
    monkeypatch.setattr(analytics, "SEGMENT", 2)
    assert analytics.velocity_ordered(make_alerts(rows), 60, trend_rows=trend_rows).collect() == whole
    gaming = [r for r in whole if r["domain"] == "gaming"]
    for i, r in enumerate(gaming):
        before = [x["y1_velocity"] for x in gaming[max(0, i - trend_rows) : i]]
        mean = sum(before) / len(before) if before else None
        expected = (
            "BASELINE" if mean is None else "SPIKE" if r["y1_velocity"] > 1.5 * mean
            else "TRENDING_UP" if r["y1_velocity"] > 1.1 * mean else "STABLE"
        )
        assert (r["trend_status"], r["y3_cumulative"]) == (expected, sum(x["y1_velocity"] for x in gaming[: i + 1]))
