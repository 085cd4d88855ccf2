"""build_history and the chain of merges against a brute-force model, on
generated snapshot sets (duplicates, NULL and '', gaps, absences, returns)."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tests.conftest import rows
from tests.model import model_history
from vhist.config import HistoryConfig
from vhist.operators.history import build_history

D0 = dt.date(2025, 1, 1)
SCHEMA = "k long, a string, b long, snapshot_date date"

row_st = st.tuples(
    st.integers(0, 4),
    st.sampled_from([None, "", "x", "y"]),
    st.sampled_from([None, 1, 2]),
    st.integers(0, 10).map(lambda n: D0 + dt.timedelta(days=n)),
)


@settings(max_examples=25, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))
@given(data=st.lists(row_st, min_size=0, max_size=40), mode=st.sampled_from(["full", "incremental"]))
def test_build_history_matches_model(spark, data, mode):
    df = spark.createDataFrame(data, SCHEMA)
    h = build_history(df, HistoryConfig(key_cols=["k"], mode=mode))
    got = rows(h, "k", "a", "b", "ValidFrom", "ValidTo", "IsDeleted", "FirstSnapshot")
    assert got == model_history(data, mode)


@settings(max_examples=8, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))
@given(data=st.lists(row_st, min_size=1, max_size=25), mode=st.sampled_from(["full", "incremental"]))
def test_chain_of_merges_matches_model(spark, data, mode):
    from vhist.operators.merge import merge_snapshots
    from vhist.sources.snapshots import empty_history

    df = spark.createDataFrame(data, SCHEMA)
    cfg = HistoryConfig(key_cols=["k"], mode=mode)
    h = merge_snapshots(empty_history(spark, df.drop("snapshot_date").schema), df, cfg, checkpoint_every=3)
    got = rows(h, "k", "a", "b", "ValidFrom", "ValidTo", "IsDeleted", "FirstSnapshot")
    assert got == model_history(data, mode)


@settings(max_examples=10, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))
@given(data=st.lists(row_st, min_size=1, max_size=30), mode=st.sampled_from(["full", "incremental"]))
def test_forgetting_matches_model(spark, data, mode):
    from tests.model import model_history_forgetting
    from vhist.operators.history import build_history_forgetting

    df = spark.createDataFrame(data, SCHEMA)
    cfg = HistoryConfig(key_cols=["k"], mode=mode, sensitive_cols=["b"], signal_col="a", signal_pattern="^x$")
    cols = ("k", "a", "b", "ValidFrom", "ValidTo", "IsDeleted", "FirstSnapshot", "GDPR_Compliant")
    assert rows(build_history_forgetting(df, cfg), *cols) == model_history_forgetting(data, mode)


@settings(max_examples=10, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))
@given(data=st.lists(row_st, min_size=1, max_size=30), mode=st.sampled_from(["full", "incremental"]))
def test_forgetting_without_dedupe_matches_model(spark, data, mode):
    """Rows unique per key and date: the forget dates come from the build's window."""
    from tests.model import model_history_forgetting
    from vhist.operators.history import build_history_forgetting

    unique = list({(r[0], r[3]): r for r in data}.values())  # last row per (key, date)
    df = spark.createDataFrame(unique, SCHEMA)
    cfg = HistoryConfig(key_cols=["k"], mode=mode, sensitive_cols=["b"], signal_col="a", signal_pattern="^x$")
    cols = ("k", "a", "b", "ValidFrom", "ValidTo", "IsDeleted", "FirstSnapshot", "GDPR_Compliant")
    assert rows(build_history_forgetting(df, cfg, dedupe=False), *cols) == model_history_forgetting(unique, mode)


@settings(max_examples=4, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))
@given(data=st.lists(row_st, min_size=1, max_size=20), mode=st.sampled_from(["full", "incremental"]))
def test_processing_chain_matches_model(spark, data, mode):
    from tests.model import model_history_forgetting
    from vhist.plans.process import process_snapshots
    from vhist.sources.snapshots import empty_history

    df = spark.createDataFrame(data, SCHEMA)
    cfg = HistoryConfig(key_cols=["k"], mode=mode, sensitive_cols=["b"], signal_col="a", signal_pattern="^x$")
    h = process_snapshots(empty_history(spark, df.drop("snapshot_date").schema), df, cfg, checkpoint_every=3)
    cols = ("k", "a", "b", "ValidFrom", "ValidTo", "IsDeleted", "FirstSnapshot", "GDPR_Compliant")
    assert rows(h, *cols) == model_history_forgetting(data, mode)
