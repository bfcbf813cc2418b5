import pytest

import __spark_entry__ as entry
import corpus_pipeline
from check import connect, differences
from lumenfold.llm import oracle, queries, simhash, toxicity
from tests.llm.conftest import PASSAGE, make
from tests.llm.test_decontaminate import brute as contaminated
from tests.llm.test_packing import brute_pieces, check_places
from tests.llm.test_secret_scan import expected
from tests.llm.test_simhash import brute_components, brute_fingerprint

FOLDER = "/root/testdata/sf0.001"


def test_queries_are_registered():
    assert {*queries.ALL, "pipeline"} <= entry.queries().keys()
    assert sorted(int(n[2:].split("_")[0]) for n in queries.ALL) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(oracle.ALL))
def test_query_equals_sql(spark, name):
    got = queries.ALL[name](spark, FOLDER).toPandas()
    assert differences(got, connect(FOLDER).execute(oracle.ALL[name]).df()) == ""


@pytest.mark.parametrize("name", ["op2_secret_scan", "op7_quote_links", "op10_decontaminate"])
def test_native_plans_hold_no_python(spark, name):
    plan = queries.ALL[name](spark, FOLDER)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_whole_pipeline_equals_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels, items = spark.read.parquet(f"{FOLDER}/labels.parquet"), spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    model = toxicity.fit(docs, labels)
    rows = [r for r in docs.orderBy("doc_id").collect() if model.expected(model.score(r["text"])) < model.limit]
    assert 0 < len(rows) < docs.count()
    group = brute_components([brute_fingerprint(r["text"]) for r in rows])
    rows = [r for i, r in enumerate(rows) if group[i] == i]
    judged = contaminated([r["text"] for r in rows], [tuple(r) for r in items.select("item_id", "text").collect()])
    rows = [r for r, j in zip(rows, judged, strict=True) if not j[4]]
    texts = []
    for r in rows:
        text, end = r["text"], len(r["text"])
        merged = []
        for a, _, b, _ in expected(text)[1]:
            if merged and a < merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], b)
            else:
                merged.append([a, b])
        for a, b in reversed(merged):
            text = text[:a] + "[SECRET]" + text[b:end]
            end = len(text)
        texts.append(text)
    want = {(rows[d]["doc_id"], k): v for (d, k), v in brute_pieces(texts).items()}
    found = corpus_pipeline.run(spark, FOLDER).collect()
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in found} == want
    assert check_places(found)


def test_stages_keep_the_columns(spark, odd):
    frame = odd
    for _, step in corpus_pipeline.STAGES[:-1]:
        frame = step(spark, frame, FOLDER)
        assert frame.columns == odd.columns
    assert corpus_pipeline.STAGES[-1][1](spark, frame, FOLDER).count() > 0


def test_near_duplicates_broadcast_no_table_that_grows_with_the_documents(spark, monkeypatch):
    """Seventeen rows are made of one place of a fingerprint; Spark's size of them is that of the one."""
    plans, write = {}, simhash.stage

    def watched(df, name):
        plans.setdefault(name, []).append(df._jdf.queryExecution().toString())
        return write(df, name)

    monkeypatch.setattr(simhash, "stage", watched)
    texts = [f"{PASSAGE} {'word ' * (n % 3)}{n % 5}" for n in range(40)]
    kept = corpus_pipeline.near_duplicates(spark, make(spark, texts), "").count()
    assert 0 < kept < 40
    assert "SortMergeJoin" in plans["links"][0]
    assert not [name for name, made in plans.items() for plan in made if "BroadcastExchange" in plan]
