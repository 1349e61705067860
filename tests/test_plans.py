"""Physical-plan properties the scale design relies on."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF
from tidemark.operators.sequence import keyed_running
from tidemark.plans import registry


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def qs():
    return registry.queries()


def test_daily_filter_and_columns_reach_the_scan(spark, qs):
    p = plan(qs["daily_pv_uv"](spark, SF))
    assert "EqualTo(event_type,view)" in p
    read = [line for line in p.splitlines() if line.startswith("ReadSchema")][0]
    assert "props" not in read and "value" not in read
    # distinct users are pre-aggregated on (day, user) before the per-day count
    assert "partial_count(distinct" in p


def test_top_n_is_limited_before_its_shuffle(spark, qs):
    p = plan(qs["hot_items"](spark, SF))
    assert p.count("WindowGroupLimit") >= 2


def test_sweep_reads_once_and_never_expands(spark, qs):
    """As it ran: both levels of the running sum read one exchange of the change points."""
    df = qs["rolling_uv_segments"](spark, SF)
    df.collect()
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in p
    ran = p.split("== Final Plan ==")[1].split("== Initial Plan ==")[0]
    assert ran.count("FileScan parquet") == 1 and "ReusedExchange" in ran
    assert "Expand" not in ran


def test_keyed_running_broadcasts_only_offsets(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    p = plan(keyed_running(df, ["k"], ["id"], sums=["id"]))
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p


def test_lookup_broadcasts_a_checked_small_dimension(spark, qs):
    p = plan(qs["lookup_enrich"](spark, SF))
    assert "BroadcastHashJoin" in p
