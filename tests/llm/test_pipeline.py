import corpus_pipeline
from linkloom.llm import dartmin, decontam, substring, toxicity


def test_stages(spark, data, docs, tmp_path):
    """Each stage's rows are what its operator says of the rows it was given."""
    given = docs
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, given, data).write.parquet(f"{tmp_path}/{i}")
        out = spark.read.parquet(f"{tmp_path}/{i}")
        ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
        if i < 4:
            assert out.columns == docs.columns
        if name == "toxicity":
            model = toxicity.train(docs, toxicity.toxic_labels(spark, data))
            assert ids(out) == ids(toxicity.score(given, model).filter("predicted = 0"))
        elif name == "near_dedup":
            assert ids(out) == ids(dartmin.classes(given).filter("doc_id = class_id"))
        elif name == "substring_dedup":
            want = {r.doc_id: r.kept for r in substring.dedup(given).filter("n_removed < n_words or n_words = 0").collect()}
            assert {r.doc_id: r.text for r in out.collect()} == want
        elif name == "decontamination":
            assert ids(out) == ids(given) - ids(decontam.find_leaks(given, spark.read.parquet(f"{data}/benchmark.parquet")))
        else:
            assert out.filter("copies < 1 or taken <> copies * size").count() == 0 and out.count() > 0
        given = out


def test_run(spark, data):
    assert corpus_pipeline.run(spark, data).columns == ["doc_id", "source", "text", "size", "copies", "taken"]
