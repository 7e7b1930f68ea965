"""The corpus pipeline: every stage against brute force on its own input."""

from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline
from stockyard.llm import decontaminate, line_dedup, near_dup, packing, toxicity
from tests.llm.test_operators_spark import encoded


def test_stages(spark, sf_dir, documents, tmp_path):
    docs, seen = documents.withColumn("extra", F.lit("e")), {}
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
        out = stage(spark, docs, sf_dir)
        out.write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        if name != "packing":
            assert out.columns == columns
            after = {r.doc_id: r.text for r in out.select("doc_id", "text").collect()}
        if name == "toxicity":
            model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
            low = {r.doc_id for r in toxicity.score(docs, model).where(F.col("score") < toxicity.THRESHOLD).collect()}
            assert after == {i: t for i, t in before.items() if i in low}
        elif name == "line_dedup":
            assert after == dict(line_dedup.brute_force(list(before.items())))
            assert out.where("n_chars <> length(text)").count() == documents.where("n_chars <> length(text)").count()
        elif name == "near_dedup":
            assert set(after) == {i for i, _, c in near_dup.brute_force(list(before.items())) if i == c}
        elif name == "decontamination":
            items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
            gone = set(before) - set(after)
            assert all(decontaminate.brute_force(before[i], items)[0] for i in gone)
            assert all(not decontaminate.brute_force(t, items)[0] for t in [t for t in after.values() if len(t) < 500][:30])
        else:
            held = Counter()
            for r in out.collect():
                held[r.doc_id] += r.length
            assert held == {i: len(encoded(t)) for i, t in before.items()}
        docs, seen[name] = out, out.count()
    assert corpus_pipeline.run(spark, sf_dir).count() == seen["packing"] > 0


def test_stages_on_odd_rows(spark, sf_dir, odd, none, tmp_path):
    for docs, label in ((odd, "odd"), (none, "none")):
        for name, stage in corpus_pipeline.STAGES:
            stage(spark, docs, sf_dir).write.parquet(str(tmp_path / f"{label}-{name}"))
            docs = spark.read.parquet(str(tmp_path / f"{label}-{name}"))
        assert docs.columns == [f.split()[0] for f in packing.SCHEMA.split(", ")]
