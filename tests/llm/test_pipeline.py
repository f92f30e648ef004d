import importlib
import random
import re
import sys

import pytest
from llm import test_minmax_dedup
from llm.tables import documents, sentence

import corpus_pipeline
from signalwatch.llm import spaced_seeds, weak_toxicity
from signalwatch.llm.common import settle

DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """Each stage's input and output on the small tables."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    out = []
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, docs, DATA).write.parquet(path)
        kept = spark.read.parquet(path)
        out.append((name, docs, kept))
        docs = kept
    return out


def texts(df):
    return dict(df.select("doc_id", "text").collect())


def test_order_and_columns(steps):
    assert [s[0] for s in steps] == ["toxicity", "near_duplicates", "decontamination", "secrets",
                                     "packing"]
    for _, before, after in steps[:-1]:
        assert after.columns == before.columns
    assert corpus_pipeline.ORACLE_SQL is None


def test_toxicity_drops_what_is_predicted(spark, steps):
    _, before, after = steps[0]
    model = weak_toxicity.train(before, spark.read.parquet(f"{DATA}/labels.parquet"))
    assert texts(after) == {i: t for i, t in texts(before).items() if model.score(t) < 0.7}


def test_one_of_each_group_stays(steps):
    _, before, after = steps[1]
    component, _ = test_minmax_dedup.brute(texts(before), 5)
    assert set(texts(after)) == {i for i, c in component.items() if i == c}


def test_overlapping_documents_go(spark, steps):
    from llm.test_spaced_seeds import brute, words

    _, before, after = steps[2]
    benchmark = [tuple(r) for r in spark.read.parquet(f"{DATA}/benchmark.parquet")
                 .select("item_id", "text").collect()]
    gone = set(texts(before)) - set(texts(after))
    some = sorted(gone) + random.Random(1).sample(sorted(set(texts(after))), 12)
    found = brute([(i, " ".join(words(texts(before)[i])[:800])) for i in some if i not in gone],
                  benchmark)
    assert not found and gone
    assert gone == {r.doc_id for r in spaced_seeds.overlaps(
        before, spark.read.parquet(f"{DATA}/benchmark.parquet")).collect()}


def test_secrets_are_gone_and_documents_stay(steps):
    _, before, after = steps[3]
    old, new = texts(before), texts(after)
    hexadecimal = re.compile('[0-9a-fA-F]{40}')
    assert old.keys() == new.keys() and any(map(hexadecimal.search, old.values()))
    assert not any(map(hexadecimal.search, new.values()))
    assert all(old[i] == new[i] for i in old if not hexadecimal.search(old[i]))
    assert all(r.n_chars == len(r.text) for r in after.collect())


def test_pieces_of_all_that_is_left(steps):
    _, before, after = steps[4]
    assert {r.doc_id for r in after.select("doc_id").collect()} == set(texts(before))


def test_run_is_the_stages_one_after_the_other(spark, steps):
    found = corpus_pipeline.run(spark, DATA)
    key = ["doc_id", "piece", "ids_crc32"]
    assert sorted(map(tuple, found.select(key).collect())) \
        == sorted(map(tuple, steps[-1][2].select(key).collect()))


def test_rest_of_the_library_does_without(monkeypatch):
    import importlib.util

    find = importlib.util.find_spec
    monkeypatch.setattr(importlib.util, "find_spec", lambda name, *a: None
                        if name.startswith("signalwatch.llm") or name == "corpus_pipeline"
                        else find(name, *a))
    sys.modules.pop("__spark_entry__", None)
    entry = importlib.import_module("__spark_entry__")
    assert not [q for q in entry.queries() if q.startswith("op") or q == "pipeline"]
    assert "fact_sales" in entry.queries() and "fact_sales" in entry.oracle_sql()
    sys.modules.pop("__spark_entry__", None)


def test_awkward_rows_go_through(spark):
    rows = [(1, None), (2, ""), (3, sentence(3)), (3, sentence(3)), (None, sentence(4)),
            (5, sentence(5, 4000))]
    docs = documents(spark, rows)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = settle(stage(spark, docs, DATA), name)
    assert {r.doc_id for r in docs.collect()} == {1, 2, 3, None, 5}
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, DATA)
    pieces = sorted((r.doc_id, r.piece, r.length) for r in packed.collect())
    assert {i for i, *_ in pieces} == {1, 2, 3, 5}  # one without a doc_id cannot be named
    assert [p for p in pieces if p[0] < 3] == [(1, 0, 1), (2, 0, 1)]
    assert len([p for p in pieces if p[0] == 3]) == 2
    none = documents(spark, rows).where("doc_id > 99")
    for name, stage in corpus_pipeline.STAGES:
        none = settle(stage(spark, none, DATA), name)
    assert none.count() == 0
