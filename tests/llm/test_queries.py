"""The registered queries of the operators, and that the rest does without them."""

import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_module
import corpus_pipeline
from lanecost.llm import queries

SMALL, FOLDER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
ROOT = Path(__file__).resolve().parents[2]
DOCUMENTS = {
    "op1_weak_supervision_pii": {"n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"},
    "op2_distinct_chunks": {"n_tokens", "ids_sha256", "decoded_sha256"},
    "op3_perplexity_bands": {"n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"},
    "op4_forest_duplicates": {"n_shingles", "component_id", "kept"},
    "op5_trusted_perplexity": {"log_perplexity", "threshold", "kept"},
    "op8_length_buckets": {"n_tokens", "bucket", "bucket_length", "batch", "slot", "padding"},
    "op9_jump_shards": {"size", "text_crc32", "law", "shard", "slot", "grown_shard"},
    "op10_huffman_ids": {"start", "n_tokens", "ids_crc32"},
}


@pytest.mark.parametrize("name", sorted(DOCUMENTS))
def test_documents_have_one_row_each(spark, name):
    got = queries.QUERIES[name](spark, SMALL).toPandas()
    assert {"doc_id", *DOCUMENTS[name]} <= set(got.columns)
    assert sorted(got.doc_id) == sorted(r.doc_id for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id").collect())


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_queries_equal_their_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "conversations", "embeddings"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    got = queries.QUERIES[name](spark, FOLDER)
    columns = sorted(got.columns)
    found = sorted(repr(tuple(r[c] for c in columns)) for r in got.collect())
    result = connection.execute(queries.SQL[name])
    order = [d[0] for d in result.description]
    assert sorted(order) == columns
    assert sorted(repr(tuple(row[order.index(c)] for c in columns)) for row in result.fetchall()) == found


def test_all_are_registered():
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry_module.queries())
    assert {int(n[2:].split("_")[0]) for n in queries.QUERIES} == set(range(1, 14))
    assert corpus_pipeline.ORACLE_SQL is None and 4 <= len(corpus_pipeline.STAGES) <= 5


def test_the_rest_works_without_the_subpackage():
    """The entry module in a process that cannot find either folder."""
    code = f"""
import sys
sys.path.insert(0, {str(ROOT)!r})
class Absent:
    def find_spec(self, name, path=None, target=None):
        if name in ("corpus_pipeline", "lanecost.llm") or name.startswith("lanecost.llm."):
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)
sys.meta_path.insert(0, Absent())
import __spark_entry__ as e
names = e.queries()
assert "monthly_logistics" in names and not any(n.startswith("op") or n == "pipeline" for n in names if n != "orphan_keys")
assert set(e.oracle_sql()) <= set(names)
print("fine")
"""
    # overview pages begin with "ov", so "op" is left to the operators
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120)
    assert done.stdout.strip() == "fine", done.stderr


def test_columns_named_like_new_ones_are_replaced(spark):
    from lanecost.llm import pieces, pii, quality, rules

    names = ["n_words", "kept", "low", "threshold", "log_perplexity", "spans", "ids", "symbols", "raw_score", "trusted"]
    rows = [(1, "some words of text", "en", *names), (2, None, None, *names)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, " + ", ".join(f"{n} string" for n in names))
    labels = spark.createDataFrame([(1, 1, "x")], "doc_id long, quality int, kept string")
    for got in (rules.judged(docs), quality.judged(docs, labels), pii.detect(docs), pieces.encode(docs, queries.vocabulary(queries.PIECES))):
        assert len(set(got.columns)) == len(got.columns)
        kept = {r["doc_id"]: r for r in got.collect()}
        assert set(kept) == {1, 2} and kept[1]["symbols"] == "symbols" and kept[2]["trusted"] == "trusted"
    for got in (rules.keep(docs), quality.keep(docs, labels), pii.redact(docs, length=None)):
        assert got.columns == docs.columns and got.count() <= 2
