from brute import table
from pyspark.sql import functions as F

from tidemark.llm import quality

SF = "/root/testdata/sf0.01"


def test_held_out_ranking(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = quality.op8_quality_classifier(spark, SF).join(labels, "doc_id").collect()
    test = [r for r in rows if r.held_out]
    good, bad = ([r.score for r in test if r.quality == q] for q in (1, 0))
    auc = sum((a > b) + (a == b) / 2 for a in good for b in bad) / (len(good) * len(bad))
    assert auc > 0.95
    assert sum(r.predicted == r.quality for r in test) / len(test) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


def test_rules_are_columns(spark):
    rows = quality.with_statistics(table(spark, [(1, "Some words."), (2, "!!!! #### 12 12 12"), (3, None), (4, "")]))
    rule = (("symbols", False, 0.5), ("log_words", True, 3.0))
    out = {r.doc_id: r.x for r in rows.select("doc_id", quality.compiled(rule).alias("x")).collect()}
    assert out == {1: 0.0, 2: 1.0, 3: 0.0, 4: 0.0}


def test_edges(spark):
    docs = table(spark, [(i, f"text {i} " * i) for i in range(20)] + [(None, None), (5, ""), (30, "w " * 100000)])
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    model = quality.fit(quality.training_rows(docs, none))
    assert {r.score for r in quality.score_documents(docs, model).collect()} == {0.5}
    ones = spark.createDataFrame([(i, 1) for i in range(20)] + [(None, 0), (3, None), (4, 0), (4, 1)], "doc_id bigint, quality int")
    model = quality.fit(quality.training_rows(docs, ones))
    out = quality.score_documents(docs, model)
    assert out.count() == docs.count() and out.agg(F.min("score")).first()[0] > 0.5
    assert quality.score_documents(table(spark, []), model).count() == 0
