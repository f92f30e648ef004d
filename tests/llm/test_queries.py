import pytest
from compare import connect, difference
from conftest import DATA

import __spark_entry__ as entry
from signalwatch.llm.oracles import ORACLES
from signalwatch.llm.queries import QUERIES

CONTRACTS = {
    "op1_minmax_dedup": ["doc_id bigint", "n_shingles bigint", "component_id bigint", "kept boolean"],
    "op2_crf_quality": ["doc_id bigint", "n_words bigint", "word_chars bigint", "n_symbols bigint",
                        "n_dup_lines bigint", "n_repeat_words bigint", "base_failed boolean",
                        "kept boolean"],
    "op3_importance": ["doc_id bigint", "kept boolean"],
    "op4_secret_forest": ["doc_id bigint", "secret boolean"],
    "op5_weak_toxicity": ["doc_id bigint", "held_out boolean", "score double", "predicted int"],
    "op6_spaced_seeds": ["doc_id bigint", "item_id bigint"],
    "op7_arrow_tokens": ["doc_id bigint", "start bigint", "n_tokens bigint", "ids_crc32 bigint"],
    "op8_packing": ["doc_id bigint", "piece int", "start bigint", "length bigint",
                    "ids_crc32 bigint", "sequence_id bigint", "offset bigint"],
    "op9_wrappers": ["page_id bigint", "url string", "text string", "n_chars bigint"],
    "op10_link_trust": ["page_id bigint", "host string", "path string", "rule string",
                        "verdict string"],
    "op11_source_mix": ["doc_id bigint", "size bigint", "source_size bigint", "target double",
                        "taken bigint"],
    "op12_filter_audit": ["part string", "filter_order string", "step int", "kept bigint",
                          "removed bigint", "redundant bigint", "unique_fails bigint",
                          "good_lost bigint", "toxic_lost bigint", "shapley bigint"],
    "op13_lexical_search": ["item_id bigint", "rank int", "doc_id bigint", "score bigint"],
}
ROWS_OF = {"op9_wrappers": "pages", "op10_link_trust": "pages", "op8_packing": None,
           "op4_secret_forest": None, "op6_spaced_seeds": None, "op12_filter_audit": None,
           "op13_lexical_search": None}


def test_all_are_registered():
    assert set(QUERIES) == set(CONTRACTS) and set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(ORACLES) <= set(QUERIES) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", CONTRACTS)
def test_columns_rows_and_sql(spark, name):
    found = QUERIES[name](spark, DATA)
    kinds = [" ".join(x) for x in found.dtypes]
    assert [k for k in CONTRACTS[name] if k not in kinds] == []
    ours = found.toPandas()
    table = ROWS_OF.get(name, "documents")
    if table:
        assert len(ours) == spark.read.parquet(f"{DATA}/{table}.parquet").count()
    if name in ORACLES:
        assert difference(ours, connect(DATA).execute(ORACLES[name]).df()) is None
