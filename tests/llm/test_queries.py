import duckdb
import pytest

from tillsight.llm import queries

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_ann_vp_tree": ["query_id", "rank", "vec_id", "score"],
    "op2_mix_sources": ["doc_id", "size", "source_size", "target", "taken"],
    "op3_lm_score": ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
    "op4_language_id": ["doc_id", "held_out", "lang_pred", "score"],
    "op6_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op7_license_scan": ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
    "op8_simhash": ["doc_id", "fingerprint", "component_id"],
    "op9_bpe": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op10_quality_rules": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    "op11_token_counts": ["doc_id", "n_bytes", "n_tokens", "over_limit"],
    "op12_filter_audit": ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost",
                          "toxic_lost", "shapley"],
    "op13_conversation_repair": ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"],
}


def test_thirteen_queries():
    assert sorted(int(q[2:].split("_")[0]) for q in queries.QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns(spark, name):
    assert queries.QUERIES[name](spark, SF).columns == COLUMNS[name]


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_equals_duckdb(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "labels"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = queries.QUERIES[name](spark, SF).toPandas()
    want = con.sql(queries.ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    rows = lambda df: sorted(map(repr, df[sorted(df.columns)].astype(object).where(df[sorted(df.columns)].notna(), None)
                                 .itertuples(index=False, name=None)))
    assert [r.replace(".0", "") for r in rows(got)] == [r.replace(".0", "") for r in rows(want)]
