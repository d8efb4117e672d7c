"""The pipeline's stages against brute force on a small fixture."""

import corpus_pipeline
from farespan.llm import quality
from tests.llm.test_operators import brute_components


def test_stages_follow_each_other(spark, docs, corpus, tmp_path):
    spark.createDataFrame([(1, " ".join(corpus[9][1].split()[5:35]))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    now, sf = spark.read.parquet(f"{tmp_path}/documents.parquet"), str(tmp_path)
    steps = dict(corpus_pipeline.STAGES)
    good = steps["quality_rules"](spark, now, sf)
    left = [tuple(r) for r in good.select(*docs.columns).collect()]
    assert {r[0] for r in left} == {r.doc_id for r in quality.judge(now).collect() if r.kept}
    single = steps["near_duplicates"](spark, good, sf)
    ids = sorted((r.doc_id for r in single.collect()), key=str)
    assert ids == sorted({c for _, _, c in brute_components(left)}, key=str)
    clean = steps["test_leaks"](spark, single, sf)
    assert sorted((r.doc_id for r in clean.collect()), key=str) == [x for x in ids if x != 9]
    assert good.columns == single.columns == clean.columns == docs.columns
    mixed = steps["source_mix"](spark, clean, sf)
    out = corpus_pipeline.run(spark, sf)
    assert out.count() == mixed.count()
