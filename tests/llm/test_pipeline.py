"""The pipeline: each stage keeps its contract on planted and odd rows, and packing holds every id that is left."""

from pyspark.sql import functions as F

import corpus_pipeline
from tessera.llm.common import read, written

D = "/root/testdata/sf0.01"


def test_stages_in_turn(spark):
    docs = read(spark, D, "documents", "*")
    benchmark = read(spark, D, "benchmark", "item_id", "text").orderBy("item_id").limit(2).collect()
    copied = docs.orderBy("doc_id").filter("length(text) > 800").first()
    words = copied["text"].split(" ")
    near = " ".join([*words[:20], "changed", *words[21:]])
    odd = [(10**6, copied["text"]), (10**6 + 1, near), (10**6 + 2, benchmark[0]["text"] + " Then more."), (10**6 + 3, None), (None, "No id at all."),
           (10**6 + 4, "Please write to someone@example.org soon, it is fine."), (10**6 + 4, "Please write to someone@example.org soon, it is fine.")]
    extra = spark.createDataFrame(odd, "doc_id long, text string").select(
        "doc_id", "text", F.lit(None).cast("string").alias("lang"), F.lit("src").alias("source"), F.length("text").cast("long").alias("n_chars"))
    docs = written(docs.unionByName(extra).withColumn("_key", F.lit("clash")).withColumn("_score", F.lit(0.0)), "test-docs")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = written(stage(spark, docs, D), name)
        if name != "packing":
            assert out.columns == docs.columns
            seen[name] = {(r.doc_id, r.text) for r in out.select("doc_id", "text").collect()}
            docs = out
    ids = lambda name: [i for i, _ in seen[name]]
    group = {copied["doc_id"], 10**6, 10**6 + 1}
    assert group <= set(ids("quality")) and len(group & set(ids("near_duplicates"))) == 1
    assert 10**6 + 2 in ids("near_duplicates") and 10**6 + 2 not in ids("decontaminate")
    assert ids("near_duplicates").count(10**6 + 4) == 1
    assert (10**6 + 3, None) in seen["personal_data"] and (None, "No id at all.") in seen["personal_data"]
    assert (10**6 + 4, "Please write to [email] soon, it is fine.") in seen["personal_data"]
    pieces = out.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("all")).collect()
    assert {r.doc_id for r in pieces} == set(ids("personal_data")) and all(r.n == r["all"] for r in pieces)


def test_empty_documents(spark):
    docs = read(spark, D, "documents", "*").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, D), "empty-stage")
        assert docs.count() == 0
