"""Small hand-made snapshot frames for unit tests."""

from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import types as T

D0 = dt.date(2025, 8, 1)

RANDOM_SCHEMA = T.StructType(
    [
        T.StructField("k", T.LongType()),
        T.StructField("a", T.StringType()),
        T.StructField("b", T.LongType()),
        T.StructField("snapshot_date", T.DateType()),
    ]
)


def subscriptions(spark, days: int = 12, n: int = 90):
    """Subscription snapshots (k, tier a, credits b): a subscriber's tier goes up
    every 13 days, credits are paid out in a rhythm that depends on the
    subscriber, and a third of them take every ninth day off.  Returns the frame
    and its rows."""
    rows_ = []
    for d in range(days):
        for k in range(1, n + 1):
            if k % 3 == 1 and (k + d) % 9 == 4:
                continue
            tier = "abcd"[((k + d) // 13) % 4]
            rows_.append((k, tier, k * 100 + d // (2 + k % 5), D0 + dt.timedelta(days=d)))
    return spark.createDataFrame(rows_, RANDOM_SCHEMA), rows_


def random_snapshots(spark, seed: int, keys: int = 12, days: int = 9, p_present: float = 0.75, gaps: bool = True):
    """Seeded random snapshots with absences, returns, NULLs and '' values.

    With ``gaps`` some calendar days are skipped entirely (no snapshot)."""
    rnd = random.Random(seed)
    data = []
    day_list = []
    d = D0
    for _ in range(days):
        d = d + dt.timedelta(days=rnd.choice([1, 1, 2, 3]) if gaps else 1)
        day_list.append(d)
    state = {}
    for d in day_list:
        for k in range(keys):
            if rnd.random() > p_present:
                continue
            if k not in state or rnd.random() < 0.35:
                state[k] = (rnd.choice(["x", "y", "", None]), rnd.choice([1, 2, None]))
            a, b = state[k]
            data.append((k, a, b, d))
    return spark.createDataFrame(data, RANDOM_SCHEMA), day_list
