"""The registered queries on the driver's small tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from vhist.llm import oracles, queries

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_quality_classifier": ["doc_id", "held_out", "score", "predicted"],
    "op2_decontamination": ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
    "op3_bpe": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op4_top_inner_products": ["query_id", "rank", "vec_id", "score"],
    "op5_personal_data": ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
    "op6_warc": ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
    "op7_suffix_dedup": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    "op8_token_counts": ["doc_id", "n_tokens"],
    "op9_ngram_jaccard_join": ["doc_id", "class_id", "n_links"],
    "op10_url_filter": ["page_id", "host", "path", "rule", "verdict"],
    "op11_token_alignment": ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
    "op12_centroid_clusters": ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"],
    "op13_substring_dedup": ["doc_id", "n_words", "n_removed", "kept_sha256"],
}


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_one_query_per_operator():
    assert set(queries.QUERIES) == set(COLUMNS)
    assert set(COLUMNS) | {"pipeline"} <= set(entry.queries())
    assert set(oracles.ORACLES) <= set(entry.oracle_sql())


def test_nothing_else_imports_the_package():
    import pathlib
    import re

    root = pathlib.Path(entry.__file__).parent
    for f in [*root.glob("vhist/**/*.py"), *root.glob("tools/*.py"), *root.glob("tests/*.py"), root / "bench.py"]:
        if "llm" not in f.relative_to(root).parts:
            assert not re.search(r"vhist\.llm|corpus_pipeline", f.read_text()), f


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_rows_per_input_row(spark, tables, name):
    got = entry.queries()[name](spark, SF)
    assert got.columns == COLUMNS[name]
    rows = [tuple(r) for r in got.collect()]
    if name in oracles.ORACLES:
        want = tables.execute(oracles.ORACLES[name])
        order = [[d[0] for d in want.description].index(c) for c in COLUMNS[name]]
        assert sorted(rows, key=repr) == sorted((tuple(r[i] for i in order) for r in want.fetchall()), key=repr)
    elif name != "op4_top_inner_products":
        assert len(rows) == tables.execute("SELECT count(*) FROM documents").fetchone()[0]
        assert len({r[0] for r in rows}) == len(rows)
