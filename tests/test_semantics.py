"""Hand-made frames for the semantic decisions and a
schedule of changes against the model."""

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import rows
from tests.fixtures import D0, subscriptions
from tests.model import model_history
from vhist.config import HistoryConfig
from vhist.functions.columns import OPEN_END
from vhist.functions.hashing import row_hash, with_hash_key
from vhist.operators.classify import change_summary, classify
from vhist.operators.history import build_history
from vhist.operators.merge import merge_snapshot, merge_snapshots, prepare_snapshot
from vhist.sources.snapshots import empty_history

SUB = HistoryConfig(key_cols=["k"])
SUB_INC = HistoryConfig(key_cols=["k"], mode="incremental")
D = "snapshot_date"


def day(n):
    return D0 + dt.timedelta(days=n)


def snaps(spark, data, schema="k long, v string, snapshot_date date"):
    return spark.createDataFrame(data, schema)


# ---------------------------------------------------------------- a schedule against the model

VERSION = ("k", "a", "b", "ValidFrom", "ValidTo", "IsDeleted", "FirstSnapshot")


@pytest.mark.parametrize("cfg", [SUB, SUB_INC], ids=["full", "incremental"])
def test_schedule_equals_model(spark, cfg):
    df, data = subscriptions(spark)
    assert rows(build_history(df, cfg), *VERSION) == model_history(data, cfg.mode)


@pytest.mark.parametrize("n", [1, 4, 9])
def test_daily_changes_equal_model(spark, n):
    df, data = subscriptions(spark)
    hist = build_history(df.filter(F.col(D) < day(n)), SUB)
    today = prepare_snapshot(df.filter(F.col(D) == day(n)), day(n), SUB)
    got = {r["HistoryStatus"]: r["n_keys"] for r in change_summary(classify(today, hist, ["k"])).collect()}
    before = {r[0]: r[1:3] for r in model_history([r for r in data if r[3] < day(n)]) if r[4] == OPEN_END}
    now = {r[0]: r[1:3] for r in data if r[3] == day(n)}
    want = Counter(
        "new" if k not in before else "deleted" if k not in now else "unchanged" if before[k] == now[k] else "updated"
        for k in before.keys() | now.keys()
    )
    assert got == dict(want)


@pytest.mark.parametrize("every", [1, 2, 5, 10, 15])
@pytest.mark.parametrize("cfg", [SUB, SUB_INC], ids=["full", "incremental"])
def test_chain_equals_single_pass(spark, cfg, every):
    df, _ = subscriptions(spark, days=7 if every == 1 else 12)
    one = build_history(df, cfg)
    chain = merge_snapshots(empty_history(spark, df.drop(D).schema), df, cfg, checkpoint_every=every)
    assert rows(one) == rows(chain.select(*one.columns))
    assert len(chain._jdf.queryExecution().optimizedPlan().toString()) < 20_000  # starts at a scan, however many steps


# ---------------------------------------------------------------- D-rules

def test_d1_closed_versions_survive_later_changes(spark):
    df = snaps(spark, [(1, "a", day(0)), (1, "b", day(1)), (1, "c", day(2))])
    h = build_history(df, HistoryConfig(key_cols=["k"]))
    assert rows(h, "v", "ValidFrom", "ValidTo") == [
        ("a", day(0), day(0)),
        ("b", day(1), day(1)),
        ("c", day(2), OPEN_END),
    ]


def test_d3_returning_key_keeps_first_snapshot(spark):
    df = snaps(spark, [(1, "a", day(0)), (2, "z", day(1)), (1, "a", day(2))])
    h = build_history(df, HistoryConfig(key_cols=["k"])).filter("k = 1")
    assert rows(h, "ValidFrom", "ValidTo", "IsDeleted", "FirstSnapshot") == [
        (day(0), day(0), True, day(0)),
        (day(2), OPEN_END, False, day(0)),
    ]
    # the same through a merge
    base = build_history(df.filter(F.col(D) < day(2)), HistoryConfig(key_cols=["k"]))
    m = merge_snapshot(base, df.filter(F.col(D) == day(2)), day(2), HistoryConfig(key_cols=["k"]))
    assert rows(m.filter("k = 1 AND ValidTo = DATE '2999-12-31'"), "FirstSnapshot") == [(day(0),)]


def test_d6_null_number_hashes_under_ansi(spark):
    df = spark.createDataFrame([(1, None)], "a int, b int")
    got = df.select(row_hash(["a", "b"]).alias("h")).first()["h"]
    want = spark.sql("select md5('1||') h").first()["h"]
    assert got == want


def test_d7_compat_and_strict_hash(spark):
    df = spark.createDataFrame([(None, "x"), ("", "x"), ("a|", "b"), ("a", "|b")], "p string, q string")
    compat = [r[0] for r in df.select(row_hash(["p", "q"])).collect()]
    strict = [r[0] for r in df.select(row_hash(["p", "q"], mode="strict")).collect()]
    assert compat[0] == compat[1] and compat[2] == compat[3]  # the known collisions
    assert len(set(strict)) == 4  # none in strict mode
    salted = df.select(row_hash(["p", "q"], salt="s3cret")).first()[0]
    assert salted != compat[0]


def test_d8_half_open_view(spark):
    from vhist.operators.views import half_open

    df = snaps(spark, [(1, "a", day(0)), (1, "b", day(2))])
    h = half_open(build_history(df, HistoryConfig(key_cols=["k"])))
    assert rows(h, "v", "eff_start_date", "eff_end_date", "is_current") == [
        ("a", day(0), day(2), False),
        ("b", day(2), None, True),
    ]


def test_d9_incremental_absence_is_unchanged(spark):
    df = snaps(spark, [(1, "a", day(0)), (2, "z", day(1)), (1, "a", day(2)), (1, "b", day(3))])
    h = build_history(df, HistoryConfig(key_cols=["k"], mode="incremental")).filter("k = 1")
    assert rows(h, "v", "ValidFrom", "ValidTo", "IsDeleted") == [
        ("a", day(0), day(2), False),
        ("b", day(3), OPEN_END, False),
    ]


def test_d10_schema_evolution_backfills(spark):
    cfg = HistoryConfig(key_cols=["k"], hash_cols=["k", "v"])
    base = build_history(snaps(spark, [(1, "a", day(0))]), cfg)
    new = spark.createDataFrame([(1, "a", 7)], "k long, v string, extra int")
    m = merge_snapshot(base, new, day(1), cfg)
    assert dict(m.dtypes)["extra"] == "int"
    assert rows(m, "v", "extra", "ValidTo") == [("a", None, OPEN_END)]  # no spurious version


def test_d15_loaded_empty_snapshot_deletes_all(spark):
    df = snaps(spark, [(1, "a", day(0)), (2, "b", day(0)), (1, "a", day(2))])
    cal = spark.createDataFrame([(day(0),), (day(1),), (day(2),)], "d date")
    h = build_history(df, HistoryConfig(key_cols=["k"]), calendar_dates=cal).filter("k = 1")
    assert rows(h, "ValidFrom", "ValidTo", "IsDeleted") == [
        (day(0), day(0), True),
        (day(2), OPEN_END, False),
    ]
    # without the load log, day(1) is not a processed snapshot: no deletion
    h2 = build_history(df, HistoryConfig(key_cols=["k"])).filter("k = 1")
    assert rows(h2, "ValidFrom", "ValidTo") == [(day(0), OPEN_END)]


def test_d16_duplicates_in_a_snapshot(spark):
    df = snaps(spark, [(1, "a", day(0)), (1, "a", day(0)), (1, "b", day(0)), (1, "b", day(1))])
    cfg = HistoryConfig(key_cols=["k"])
    h = build_history(df, cfg)
    ha = with_hash_key(spark.createDataFrame([(1, "a")], "k long, v string"), ["k"]).first()["RowHashKey"]
    hb = with_hash_key(spark.createDataFrame([(1, "b")], "k long, v string"), ["k"]).first()["RowHashKey"]
    first_v = "a" if ha < hb else "b"
    got = rows(h, "v", "ValidFrom")
    assert got[0] == (first_v, day(0))
    assert h.count() == (2 if first_v == "a" else 1)


def test_d17_system_columns_not_hashed(spark):
    df = spark.createDataFrame([(1, "a", "20250801")], "k long, v string, FK_dimSnapshotID string")
    h1 = with_hash_key(df, ["k"]).first()["RowHashKey"]
    h2 = with_hash_key(df.withColumn("FK_dimSnapshotID", F.lit("20250802")), ["k"]).first()["RowHashKey"]
    assert h1 == h2


def test_d18_forgotten_unchanged_row_opens_no_version(spark):
    from vhist.plans.process import process_snapshot

    cfg = HistoryConfig(key_cols=["k"], sensitive_cols=["name"], signal_col="flag", signal_pattern="^forget$")
    s0 = spark.createDataFrame([(1, "Ann", "", day(0)), (2, "Bob", "", day(0))],
                               "k long, name string, flag string, snapshot_date date")
    h = build_history(s0.drop("flag"), HistoryConfig(key_cols=["k"], hash_cols=["k", "name"]))
    cfg = HistoryConfig(key_cols=["k"], hash_cols=["k", "name"], sensitive_cols=["name"], signal_col="flag",
                        signal_pattern="^forget$")
    s1 = spark.createDataFrame([(1, "Ann", "forget"), (2, "Bob", "")], "k long, name string, flag string")
    status, out = process_snapshot(s1, h.withColumn("flag", F.lit(None).cast("string")), day(1), cfg)
    assert status == "Successful"
    got = rows(out, "k", "name", "GDPR_Compliant", "ValidFrom", "ValidTo")
    assert got == [
        (1, "ANONYMISED", "Yes", day(0), OPEN_END),
        (2, "Bob", "No", day(0), OPEN_END),
    ]
    assert process_snapshot(None, out, day(2), cfg) == ("Skip", out)


def test_merge_by_columns_tells_null_from_empty(spark):
    cfg = HistoryConfig(key_cols=["k"])
    base = build_history(snaps(spark, [(1, None, day(0))]), cfg)
    new = spark.createDataFrame([(1, "")], "k long, v string")
    by_hash = merge_snapshot(base, new, day(1), cfg)
    by_cols = merge_snapshot(base, new, day(1), cfg, compare="columns")
    assert by_hash.count() == 1  # compat hash: NULL == ''
    assert rows(by_cols, "v", "ValidTo") == [(None, day(0)), ("", OPEN_END)]


def test_lag_change_flags_exact_null_rules(spark):
    from vhist.operators.views import lag_change_flags

    df = spark.createDataFrame(
        [(1, "a", "x", day(0)), (1, "a", None, day(1)), (1, "b", None, day(2)), (1, "b", None, day(3))],
        "id long, field1 string, field2 string, snapshot_date date",
    )
    out = lag_change_flags(df, ["id"], ["field1", "field2"])
    assert [tuple(r) for r in out.orderBy(D).select("is_changed", "end_date").collect()] == [
        (True, None),
        (False, day(1)),  # x -> NULL is not a change under plain !=
        (True, None),
        (False, day(3)),
    ]


def test_dedup_versions_keeps_latest_end(spark):
    from vhist.operators.views import dedup_versions

    h = build_history(snaps(spark, [(1, "a", day(0)), (1, "b", day(1))]), HistoryConfig(key_cols=["k"]))
    dup = h.unionByName(h).unionByName(h.filter("v = 'a'").withColumn("ValidTo", F.lit(day(5))))
    out = dedup_versions(dup, ["k"])
    assert rows(out, "v", "ValidTo") == [("a", day(5)), ("b", OPEN_END)]
    # a masked copy wins, whichever comes first
    masked = h.withColumns({"v": F.lit("ANONYMISED"), "GDPR_Compliant": F.lit("Yes")})
    for both in (h.unionByName(masked), masked.unionByName(h)):
        assert {r["v"] for r in dedup_versions(both, ["k"]).collect()} == {"ANONYMISED"}


def test_keys_of_one_joined_text_stay_apart(spark):
    from vhist.operators import parts, report

    schema = "p string, q string, v int, snapshot_date date"
    df = spark.createDataFrame([("a||b", "c", 1, day(0)), ("a", "b||c", 1, day(1)), ("a", "b||c", 2, day(2))], schema)
    for mode in ("compat", "strict"):
        cfg = HistoryConfig(key_cols=["p", "q"], hash_mode=mode)
        hist = build_history(df.filter(F.col(D) < day(2)), cfg)
        today = prepare_snapshot(df.filter(F.col(D) == day(2)), day(2), cfg)
        got = classify(today, hist, cfg.key_cols)
        assert rows(got, "p", "q", "HistoryStatus") == [("a", "b||c", "updated")]
        assert rows(parts.expired_rows(hist, got, cfg.key_cols, day(2)), "q", "ValidTo") == [("b||c", day(1))]
        assert rows(parts.first_snapshot(hist, cfg.key_cols), "q", "FirstSnapshot") == [("b||c", day(1)), ("c", day(0))]
        assert report.multi_version_keys(hist, cfg.key_cols).count() == 0
        texts = hist.select("BusinessKey").distinct().count()
        assert texts == (1 if mode == "compat" else 2)


def test_classify_sql_leaves_no_view(spark):
    from vhist.operators.classify import CLASSIFIED, classify_sql

    df, _ = subscriptions(spark)
    hist = build_history(df.filter(F.col(D) < day(4)), SUB)
    today = prepare_snapshot(df.filter(F.col(D) == day(4)), day(4), SUB)
    before = len(spark.catalog.listTables())
    assert rows(classify_sql(today, hist, ["k"]), *CLASSIFIED) == rows(classify(today, hist, ["k"]), *CLASSIFIED)
    assert len(spark.catalog.listTables()) == before


def test_older_snapshot_raises(spark):
    hist = build_history(snaps(spark, [(1, "a", day(5))]), HistoryConfig(key_cols=["k"]))
    for d in (day(2), day(5)):
        with pytest.raises(Exception, match="not newer than the history"):
            merge_snapshot(hist, spark.createDataFrame([(1, "b")], "k long, v string"), d, HistoryConfig(key_cols=["k"])).collect()


def test_forgotten_row_is_not_a_change_by_columns(spark):
    cfg = HistoryConfig(key_cols=["k"], sensitive_cols=["name"])
    base = build_history(spark.createDataFrame([(1, "Ann", 5, day(0))], "k long, name string, n int, snapshot_date date"), cfg)
    from vhist.operators.privacy import anonymise_history

    hidden = anonymise_history(base, base.select("k"), ["k"], ["name"])
    same = spark.createDataFrame([(1, "Ann", 5)], "k long, name string, n int")
    assert rows(merge_snapshot(hidden, same, day(1), cfg, compare="columns"), "name", "ValidTo") == [("ANONYMISED", OPEN_END)]
    other = spark.createDataFrame([(1, "Ann", 6)], "k long, name string, n int")
    assert merge_snapshot(hidden, other, day(1), cfg, compare="columns").count() == 2


def test_sensitive_key_is_masked_in_the_business_key(spark):
    from vhist.operators.privacy import anonymise_history

    df = spark.createDataFrame([("ann", 1, "x", day(0))], "mail string, n int, v string, snapshot_date date")
    cfg = HistoryConfig(key_cols=["mail", "n"])
    out = anonymise_history(build_history(df, cfg), df.select("mail", "n"), ["mail", "n"], ["mail"]).first()
    assert (out["mail"], out["BusinessKey"], out["v"]) == ("ANONYMISED", "ANONYMISED||1", "x")


def test_reload_over_a_loaded_empty_day(spark):
    from vhist.operators.reload import reload_history

    cfg = HistoryConfig(key_cols=["k"])
    df = snaps(spark, [(1, "a", day(0)), (1, "a", day(1)), (1, "a", day(3))])
    cal = spark.createDataFrame([(day(i),) for i in range(4)], "d date")
    want = build_history(df, cfg, calendar_dates=cal)
    assert want.filter("IsDeleted").count() == 1
    assert rows(reload_history(want, df, day(1), cfg, calendar_dates=cal).select(*want.columns)) == rows(want)


def test_d4_d5_dates_parsed_once_and_typed(spark):
    import tempfile

    from vhist.sources.snapshots import read_snapshots

    root = tempfile.mkdtemp(prefix="vhist-d4-") + "/s"
    spark.createDataFrame([(1, "a", "20250801"), (1, "b", "20250803")], "k long, v string, FK_dimSnapshotID string") \
        .write.parquet(root)
    s = read_snapshots(spark, root)
    assert dict(s.dtypes)["snapshot_date"] == "date"
    h = build_history(s, HistoryConfig(key_cols=["k"]))
    types = dict(h.dtypes)
    assert all(types[c] == "date" for c in ("SnapshotDate", "FirstSnapshot", "ValidFrom", "ValidTo"))
    assert rows(h, "v", "ValidTo") == [("a", day(1)), ("b", OPEN_END)]


def test_d11_forget_ids_match_every_key_column(spark):
    from vhist.operators.privacy import anonymise_history, exposed_rows

    df = spark.createDataFrame(
        [(1, "x", "Ann", day(0)), (1, "y", "Bob", day(0)), (2, "x", "Cid", day(0))],
        "a long, b string, name string, snapshot_date date",
    )
    h = build_history(df, HistoryConfig(key_cols=["a", "b"]))
    ids = spark.createDataFrame([(1, "x")], "a long, b string")
    assert rows(exposed_rows(h, ids, ["a", "b"]), "name") == [("Ann",)]
    out = anonymise_history(h, ids, ["a", "b"], ["name"])
    assert rows(out, "a", "b", "name") == [(1, "x", "ANONYMISED"), (1, "y", "Bob"), (2, "x", "Cid")]


def test_strict_prehash_text_is_injective(spark):
    import itertools
    import random

    from vhist.functions.hashing import prehash_text

    rnd = random.Random(0)
    atoms = ["", "|", "\\", "N", "\\N", "||", "a"]
    def val():
        return None if rnd.random() < 0.2 else "".join(rnd.choice(atoms) for _ in range(rnd.randint(0, 3)))
    data = sorted({(val(), val(), val()) for _ in range(3000)}, key=str)
    df = spark.createDataFrame(data, "p string, q string, r string")
    texts = [r[0] for r in df.select(prehash_text(["p", "q", "r"], mode="strict")).collect()]
    assert len(set(texts)) == len(data)
    compat = [r[0] for r in df.select(prehash_text(["p", "q", "r"])).collect()]
    assert len(set(compat)) < len(data)  # compat mode collides by design (NULL vs '', delimiters)


def test_null_key_parts_are_reported_not_versioned(spark):
    from vhist.operators.checks import duplicate_keys, null_key_rows

    df = spark.createDataFrame(
        [(1, "a", "v", day(0)), (None, "a", "w", day(0)), (1, None, "x", day(0)), (1, "a", "v", day(1)),
         (1, "a", "v", day(1)), (1, "a", "z", day(1))],
        "p long, q string, v string, snapshot_date date",
    )
    cfg = HistoryConfig(key_cols=["p", "q"])
    assert rows(null_key_rows(df, cfg), "v") == [("w",), ("x",)]
    assert rows(duplicate_keys(df, cfg), "p", "q", "snapshot_date", "n_rows", "n_versions") == [
        (1, "a", day(1), 3, 2)
    ]
    with pytest.raises(Exception, match="NULL in key columns p, q"):
        build_history(df, cfg).collect()
    drop = HistoryConfig(key_cols=["p", "q"], null_keys="drop")
    h = build_history(df, drop)
    assert h.filter("p IS NULL OR q IS NULL").count() == 0
    with pytest.raises(Exception, match="NULL in key columns"):
        merge_snapshot(h, df.filter("q IS NULL").drop(D), day(3), cfg).collect()
    assert merge_snapshot(h, df.filter("q IS NULL").drop(D), day(3), drop).filter("q IS NULL").count() == 0


def test_config_from_helper_data():
    c = HistoryConfig.from_helper_data(
        {"BusinessKey": "['a', 'b']", "anonymisationPattern": "^x$", "anonymisationSignalColumn": "s"},
        sensitive_cols=["n"], mode="incremental",
    )
    assert c.key_cols == ("a", "b") and c.signal_col == "s" and c.incremental and c.sensitive_cols == ("n",)
    assert HistoryConfig.from_helper_data({"BusinessKey": "id"}).key_cols == ("id",)
