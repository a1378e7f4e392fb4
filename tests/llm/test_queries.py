from pathlib import Path

import duckdb
import pytest

from formline.llm import queries

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables are absent")
COLUMNS = {
    "op1_packing": {"doc_id": "bigint", "piece": "int", "start": "bigint", "length": "bigint", "ids_crc32": "bigint", "sequence_id": "bigint", "offset": "bigint"},
    "op2_secrets": {"doc_id": "bigint", "n_assign": "bigint", "n_access": "bigint", "n_hex": "bigint", "base_sha256": "string", "spans": "string"},
    "op3_warc": {"page_id": "bigint", "payload_bytes": "bigint", "payload_digest": "string", "record_type": "string", "refers_to": "bigint"},
    "op4_curriculum": {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"},
    "op5_jaccard_join": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint"},
    "op6_licenses": {"doc_id": "bigint", "n_words": "bigint", "n_base": "bigint", "first_word": "bigint", "last_word": "bigint",
                     "base_labels": "string", "labels": "string", "score": "double"},
    "op7_language": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op8_embedding_duplicates": {"vec_id": "bigint", "n_links": "bigint", "component_id": "bigint", "kept": "boolean"},
    "op9_nearest": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "double"},
    "op10_sharding": {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint", "grown_shard": "int"},
    "op11_collocations": {"lang": "string", "rank": "bigint", "phrase": "string", "a": "bigint", "l": "bigint", "r": "bigint", "n": "bigint", "score": "bigint"},
    "op12_prefix_trie": {**dict.fromkeys(["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"], "bigint"), "ends_sha256": "string"},
    "op13_token_counts": {"doc_id": "bigint", "n_bytes": "bigint", "n_tokens": "bigint", "over_limit": "boolean"},
}


@pytest.fixture(scope="module")
def connection():
    found = duckdb.connect()
    for path in Path(FOLDER).glob("*.parquet"):
        found.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return found


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_columns_and_rows(spark, name):
    found = queries.QUERIES[name](spark, FOLDER)
    kinds = dict(found.dtypes)
    assert {c: kinds.get(c) for c in COLUMNS[name]} == COLUMNS[name]
    table = {"op3": "pages", "op8": "embeddings", "op9": "embeddings"}.get(name.split("_")[0], "documents")
    rows = spark.read.parquet(f"{FOLDER}/{table}.parquet")
    if name.startswith("op9"):
        assert found.count() == 5 * rows.filter("vec_id % 50 = 0").count()
    elif name.startswith("op1_"):
        assert found.filter("piece = 0").count() == rows.count()
    elif not name.startswith(("op11", "op12")):
        assert found.count() == rows.count()


@pytest.mark.parametrize("name", list(queries.ORACLE_SQL))
def test_query_equals_sql(spark, connection, name):
    relation = connection.sql(queries.ORACLE_SQL[name])
    found = queries.QUERIES[name](spark, FOLDER).select(*relation.columns)
    assert sorted(map(tuple, found.collect()), key=str) == sorted(relation.fetchall(), key=str)
