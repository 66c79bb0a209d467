"""The indexes of the stored alerts: what a lookup and a page open, and that they find the same rows."""

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from conftest import at
from fraudlens.operators import alerts as al
from fraudlens.schema import ALERT_COLUMNS, TRANSACTION_COLUMNS
from fraudlens.sources import alert_index as ix, sinks

START = at("2025-01-01T00:00:00")


def scans(frame):
    """(files, rows) that each scan of an executed plan read."""
    frame.collect()
    found = []

    def visit(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return visit(node.executedPlan())
        if name.endswith("QueryStageExec"):
            return visit(node.plan())
        if name == "FileSourceScanExec":
            read = {k: node.metrics().apply(k).value() for k in ("numFiles", "numOutputRows")}
            found.append((read["numFiles"], read["numOutputRows"]))
        children = node.children()
        for i in range(children.size()):
            visit(children.apply(i))

    visit(frame._jdf.queryExecution().executedPlan())
    return found


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """4,000 alerts, many of one time, one with two thirds of all transactions; files of 100 rows, buckets of 250."""
    path = str(tmp_path_factory.mktemp("alerts"))
    rng = random.Random(4)
    rows = [
        (f"A{i}", rng.choice(["gaming", "fintech", "ecommerce"]), rng.choice(["HIGH", "CRITICAL", "LOW"]),
         START + timedelta(minutes=rng.choice([7, rng.randrange(3000)])))
        for i in range(4000)
    ]
    base = spark.createDataFrame(rows, "alert_id string, domain string, severity string, last_seen timestamp")
    alerts = base.select(*[F.col(c) if c in base.columns else F.lit(None).cast("string").alias(c) for c in ALERT_COLUMNS])
    members = [(f"A{i % 4000}" if i % 3 == 0 else "A77", f"T{i}") for i in range(6000)]
    children = spark.createDataFrame(members, "alert_id string, transaction_id string")
    children = children.select(
        "alert_id", *[F.col(c) if c in children.columns else F.lit(None).cast("string").alias(c) for c in TRANSACTION_COLUMNS]
    )
    table = sinks.write_alerts(alerts, path, file_rows=100, bucket_rows=250)
    sinks.write_alert_transactions(children, path, bucket_rows=250)
    return path, table, rows, members


def test_stored_tables_are_whole(spark, stored):
    path, table, rows, members = stored
    by_id = spark.read.parquet(f"{path}/alerts_by_id")
    assert table.count() == by_id.count() == 4000 and by_id.select("of").distinct().collect()[0][0] == 16
    assert by_id.select("bucket").distinct().count() == 16
    children = spark.read.parquet(f"{path}/suspicious_transactions")
    assert children.count() == 6000 and children.filter("alert_id = 'A77'").count() >= 4000


@pytest.mark.parametrize("alert_id", ["A0", "A77", "A3999", "unknown", "", "a'b"])
def test_a_lookup_opens_one_bucket(spark, stored, alert_id):
    path, _, rows, members = stored
    found = ix.with_id(spark.read.parquet(f"{path}/alerts_by_id"), alert_id)
    ((files, read),) = scans(found)
    assert files <= 1 and read <= 4000 / 16 * 2
    assert [r.alert_id for r in found.collect()] == [r[0] for r in rows if r[0] == alert_id]
    detail = ix.lookup(spark, path, alert_id)
    expected = [t for a, t in members if a == alert_id] if any(r[0] == alert_id for r in rows) else []
    got = [r.txn_transaction_id for r in detail.collect()]
    assert sorted(t for t in got if t) == sorted(expected)
    assert len(got) == (max(len(expected), 1) if any(r[0] == alert_id for r in rows) else 0)


def test_buckets_of_different_sizes_lie_side_by_side(spark, tmp_path):
    path = str(tmp_path / "t")
    for low, size in ((0, 10), (100, 1000)):
        rows = spark.range(low, low + 90).select(F.concat(F.lit("A"), F.col("id").cast("string")).alias("alert_id"))
        ix.write_by_id(rows, f"{path}/part={low}", [], size)
    table = spark.read.parquet(path)
    assert sorted({r.of for r in table.select("of").distinct().collect()}) == [1, 16]
    assert [r.alert_id for r in ix.with_id(table, "A5").collect()] == ["A5"]
    assert [r.alert_id for r in ix.with_id(table, "A105").collect()] == ["A105"]


@pytest.mark.parametrize("domain, severity", [(None, None), ("gaming", None), (None, "HIGH"), ("FINTECH", "critical"), ("other", None)])
def test_pages_by_number_equal_the_sorted_pages(spark, stored, domain, severity):
    path, table, rows, _ = stored
    index = spark.read.parquet(f"{path}/alert_pages")
    matching = [r for r in rows if (domain is None or r[1] == domain.lower()) and (severity is None or r[2] == severity.upper())]
    order = [r[0] for r in sorted(matching, key=lambda r: (r[3], r[0]), reverse=True)]
    last = max(1, -(-len(order) // 30))
    for page in {1, 2, last // 2 + 1, last, last + 1}:
        got = ix.page_by_number(table, index, domain, severity, page, 30).collect()
        assert [r.alert_id for r in got] == order[(page - 1) * 30 : page * 30]
        assert all(r.total == len(order) and r.page == page for r in got)


def test_a_late_page_reads_its_own_ranges(spark, stored):
    path, table, rows, _ = stored
    index = spark.read.parquet(f"{path}/alert_pages")
    place = ix.place_of_page(index, None, None, 100, 10)
    inside = sum((place["oldest"]["last_seen"].timestamp(), place["oldest"]["alert_id"]) <= (r[3].timestamp(), r[0]) <= (place["newest"]["last_seen"].timestamp(), place["newest"]["alert_id"]) for r in rows)
    assert inside <= 2 * 150 and place["total"] == 4000
    page = ix.page_by_number(table, index, page=100, limit=10)
    ((files, read),) = scans(page)
    plain = scans(al.alerts_page(table, page=100, limit=10))
    # a file holds a stretch of time of one domain: only those that touch the range have row groups to read
    assert read <= 1200 < max(r for _, r in plain) == 4000


def test_empty_tables(spark, tmp_path):
    base = spark.createDataFrame([], "alert_id string, domain string, severity string, last_seen timestamp")
    alerts = base.select(*[F.col(c) if c in base.columns else F.lit(None).cast("string").alias(c) for c in ALERT_COLUMNS])
    table = sinks.write_alerts(alerts, str(tmp_path))
    assert table.count() == 0
    index = spark.read.parquet(f"{tmp_path}/alert_pages")
    assert ix.page_by_number(table, index).count() == 0 and ix.place_of_page(index, None, None, 1, 10)["total"] == 0
