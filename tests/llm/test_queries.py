"""The registered queries: those with SQL against DuckDB, all for their contract's columns."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SF0001
from tests.oracle_check import compare, duck
from ticklake.llm.queries import ORACLE, QUERIES

COLUMNS = {
    "op1": ["doc_id", "n_words", "n_removed", "kept_sha256"],
    "op2": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
    "op3": ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
    "op4": ["doc_id", "n_shingles", "component_id", "kept"],
    "op6": ["query_id", "rank", "vec_id", "score"],
    "op7": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    "op8": ["doc_id", "held_out", "score", "predicted"],
    "op13": ["doc_id", "held_out", "score", "predicted"],
    "op9": ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
}


@pytest.fixture(scope="module")
def con():
    return duck(SF0001)


def test_all_operators_and_the_pipeline_are_registered():
    assert {q.split("_")[0] for q in QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert {*QUERIES, "pipeline"} <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, con, name):
    r = compare(spark, con, name, QUERIES[name], ORACLE[name], SF0001)
    assert r.get("ok"), r


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_returns_its_columns(spark, name):
    df = QUERIES[name](spark, SF0001)
    want = COLUMNS.get(name.split("_")[0])
    assert want is None or df.columns == want
    documents = spark.read.parquet(f"{SF0001}/documents.parquet").count()
    if want and want[0] == "doc_id":
        assert df.select("doc_id").distinct().count() == documents
