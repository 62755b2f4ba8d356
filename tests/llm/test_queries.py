"""The registered queries on the driver's smallest tables: SQL where there is
some, else the shape of the whole result."""

import pytest
from oracle_compare import compare, duck

from tidepool.llm.catalog import ORACLE, QUERIES

COLUMNS = {
    "op2_pii": ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
    "op4_sharding": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
    "op7_language_id": ["doc_id", "held_out", "lang_pred", "score"],
    "op8_mixing": ["doc_id", "n_tokens", "p_high", "p_low", "p_toxic", "rate", "copies"],
    "op12_bpe": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op10_repeated_bytes": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
}


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, sf_small, name):
    ok, msg = compare(spark, duck(sf_small), name, QUERIES[name], ORACLE[name], sf_small)
    assert ok, msg


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_query_covers_every_document(spark, sf_small, name):
    out = QUERIES[name](spark, sf_small)
    assert out.columns[:len(COLUMNS[name])] == COLUMNS[name]
    assert sorted(r.doc_id for r in out.select("doc_id").collect()) == [
        r.doc_id for r in spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id").orderBy("doc_id").collect()]
