"""Partition settings and buckets follow the size of input and history."""

from pyspark.sql import functions as F


def test_sizing_conf_scales_with_input():
    from vhist.session import sizing_conf

    small = sizing_conf(40 << 20, 8)
    assert small["spark.sql.shuffle.partitions"] == "8"
    big = sizing_conf(100 * (1 << 40), 8000)
    n = int(big["spark.sql.shuffle.partitions"])
    assert n % 8000 == 0 and n * (256 << 20) >= 100 * (1 << 40)
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_buckets_follow_the_history(spark, tmp_path, monkeypatch):
    import pandas as pd

    from tests.conftest import rows
    from vhist.plans import catalog
    from vhist.sources import store

    n = 90
    orders = {
        "o_orderkey": range(n), "o_custkey": [i % 30 for i in range(n)], "o_orderstatus": [("F", "O", "P")[i % 3] for i in range(n)],
        "o_orderdate": [pd.Timestamp(2020, 1 + i // 30, 5) for i in range(n)], "o_orderpriority": [f"{i % 5}-X" for i in range(n)],
    }
    spark.createDataFrame(pd.DataFrame(orders)).withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp_ntz")).write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(i, f"c{i}") for i in range(30)], "c_custkey long, c_name string").write.parquet(f"{tmp_path}/customer.parquet")
    events = {"event_id": range(n), "user_id": [i % 30 for i in range(n)], "event_type": [("error", "view")[i % 2] for i in range(n)], "value": [float(i) for i in range(n)]}
    events["ts"] = [pd.Timestamp(2020, 1, 1 + i // 30) for i in range(n)]
    spark.createDataFrame(pd.DataFrame(events)).withColumn("ts", F.col("ts").cast("timestamp_ntz")).write.parquet(f"{tmp_path}/events.parquet")

    assert [store.buckets_for(r) for r in (0, 1, 3 * store.ROWS_A_BUCKET + 1, 4 * store.ROWS_A_BUCKET)] == [2, 2, 4, 4]
    seen, made = [], store.StoredHistory.create

    def create(self, history):
        seen.append(self.buckets)
        return made(self, history)

    monkeypatch.setattr(store.StoredHistory, "create", create)
    names = ("history_store", "history_store_files", "history_store_forgetting")
    few = [rows(catalog.QUERIES[q](spark, str(tmp_path))) for q in names]
    assert seen == [2] * len(names)
    monkeypatch.setattr(store, "ROWS_A_BUCKET", 20)
    assert [rows(catalog.QUERIES[q](spark, str(tmp_path))) for q in names] == few
    assert seen[len(names) :] == [5] * len(names)
