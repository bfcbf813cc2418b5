"""Language identification and toxicity: held-out accuracy, and rows with gaps."""

import numpy as np
from pyspark.sql import functions as F

from lumenfold.llm import language_id, toxicity
from tests.llm.conftest import make

FOLDER = "/root/testdata/sf0.01"


def test_languages_held_out(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    found = language_id.identify(docs.withColumn("held_out", F.lit("x")))
    assert found.columns == ["doc_id", "held_out", "lang_pred", "score"]
    joined = found.join(docs.select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert len(joined) > 200 and (joined.lang == joined.lang_pred).mean() > 0.98
    assert joined.score.between(0, 1).all()


def test_language_odd_rows(spark, odd, none):
    rows = {r["doc_id"]: r for r in language_id.identify(odd).collect()}
    assert rows[0]["lang_pred"] == rows[1]["lang_pred"] == rows[2]["lang_pred"] == "und" and rows[0]["score"] == 0
    assert rows[5]["lang_pred"] == "en" and rows[None]["held_out"] is False
    assert language_id.identify(none).count() == 0
    unlabelled = odd.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in language_id.identify(unlabelled).collect()} == {"und"}


def test_kernel_counts_shared_grams():
    def grams(text):
        marks = np.zeros(language_id.WIDTH, bool)
        language_id.presence(text, marks)
        return set(np.flatnonzero(marks))

    texts = ["the cat", "A cat!", "xyz", "cat the"]
    marks, _ = language_id.present(texts)
    kernel = language_id.kernel(marks, marks.astype(np.float32))
    for i, a in enumerate(texts):
        for j, b in enumerate(texts):
            shared, sizes = len(grams(a) & grams(b)), len(grams(a)) * len(grams(b))
            assert abs(kernel[i, j] - shared / sizes**0.5) < 1e-5


def test_toxicity_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = toxicity.fit(docs, labels.where(~held))
    judged = toxicity.with_severity(docs, model, "severity").join(labels.where(held), "doc_id").select("severity", "toxic").toPandas()
    toxic, clean = judged[judged.toxic == 1].severity, judged[judged.toxic == 0].severity
    assert (toxic >= model.limit).mean() > 0.8 and (clean < model.limit).mean() > 0.98
    assert toxic.mean() > clean.mean() + 0.5
    assert model.thresholds[0] < model.thresholds[1]


def test_expected_severity_follows_the_thresholds():
    model = toxicity.Model({"bad": 3.0, "worse": 6.0}, (2.0, 5.0))
    low, mid, high = (model.expected(np.array([model.score(t)]))[0] for t in ("good", "bad", "Bad, worse"))
    assert low < mid < high < 2 and model.score("bad BAD bad") == 3.0 and model.score(None) == 0


def test_toxicity_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(3, 1, 1), (3, 0, 0), (5, 1, 0), (6, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    assert toxicity.assess(odd, labels).count() == 12
    assert toxicity.keep_clean(odd, labels).columns == odd.columns
    kept = toxicity.keep_clean(odd, labels.limit(0))
    assert kept.count() == 12
    assert toxicity.keep_clean(none, labels).count() == 0
