"""A key holding a third of all rows, much of it exact copies."""

import datetime as dt

from pyspark.sql import functions as F

from tests.conftest import rows
from vhist.config import HistoryConfig
from vhist.operators.history import build_history

D0 = dt.date(2024, 1, 1)


def test_hot_key_with_copies(spark):
    days = 6
    # key 0: 2,000 copies per day of one row (a third of all rows); keys 1..4000: one row per day
    base = spark.range(0, 4000 * days).select(
        (F.col("id") % 4000 + 1).alias("k"),
        F.date_add(F.lit(D0), (F.col("id") / 4000).cast("int")).alias("snapshot_date"),
        F.lit("v").alias("v"),
    )
    hot = spark.range(0, 2000 * days).select(
        F.lit(0).cast("long").alias("k"),
        F.date_add(F.lit(D0), (F.col("id") / 2000).cast("int")).alias("snapshot_date"),
        F.when((F.col("id") / 2000).cast("int") >= 3, "b").otherwise("a").alias("v"),
    )
    snaps = base.unionByName(hot)
    h = build_history(snaps, HistoryConfig(key_cols=["k"]))
    assert rows(h.filter("k = 0"), "v", "ValidFrom", "ValidTo") == [
        ("a", D0, D0 + dt.timedelta(days=2)),
        ("b", D0 + dt.timedelta(days=3), dt.date(2999, 12, 31)),
    ]
    assert h.count() == 4000 + 2  # one version per ordinary key, two for the hot key
    plan = h._jdf.queryExecution().executedPlan().toString()
    # the (key, date) de-duplication is combined map-side, before its exchange
    assert "partial_min_by" in plan
