"""Registered queries: every operator has one, and the SQL twins agree."""

import duckdb
import pytest

import __spark_entry__ as entry
from parlance.llm.oracles import ORACLES
from parlance.llm.queries import REGISTRY
from tests.conftest import SMALL


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in REGISTRY) == list(range(1, 14))
    assert set(ORACLES) <= set(REGISTRY) <= set(entry.queries())
    assert "pipeline" in entry.queries()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_twin(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "benchmark", "labels", "pages"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    found = REGISTRY[name](spark, SMALL)
    cursor = connection.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    columns = sorted(found.columns)
    assert columns == sorted(names)
    wanted = sorted(repr(tuple(row[names.index(c)] for c in columns)) for row in cursor.fetchall())
    assert sorted(repr(tuple(row[c] for c in columns)) for row in found.collect()) == wanted


@pytest.mark.parametrize(("name", "columns"), [
    ("op2_language", ["doc_id", "held_out", "lang_pred", "score"]),
    ("op3_jaccard_join", ["doc_id", "n_shingles", "component_id"]),
    ("op5_toxicity", ["doc_id", "held_out", "score", "predicted"]),
    ("op8_html_text", ["page_id", "url", "text", "n_chars"]),
    ("op10_quality_classifier", ["doc_id", "held_out", "score", "predicted"]),
    ("op11_align_tokens", ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]),
    ("op13_url_filter", ["page_id", "host", "path", "rule", "verdict", "score"]),
])
def test_columns_and_rows(spark, name, columns):
    found = REGISTRY[name](spark, SMALL)
    assert found.columns == columns
    table = "pages" if "page_id" in columns else "documents"
    assert found.count() == spark.read.parquet(f"{SMALL}/{table}.parquet").count()
