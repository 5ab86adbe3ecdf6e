"""The pipeline's stages on a small table, each against what it should do."""

import random

import corpus_pipeline
from tests_llm_data import documents, marks


def test_stages_keep_columns_and_clean_documents(spark, tmp_path):
    rnd = random.Random(1)
    docs = documents(spark, rnd)
    marks(spark).write.parquet(str(tmp_path / "labels.parquet"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    now, seen = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, str(tmp_path))
        seen[name] = now.toPandas()
        if name != "packing":
            assert now.columns == docs.columns
    ids = {k: set(x.doc_id) for k, x in seen.items()}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "secrets", "packing"]
    assert not any(k % 10 == 0 and k < 200 for k in ids["quality"]) and len(ids["quality"]) >= 0.97 * sum(k % 10 > 0 for k in range(200))
    assert 201 not in ids["near_dedup"] and 200 in ids["near_dedup"] and ids["quality"] - ids["near_dedup"] == {201}
    assert ids["secrets"] == ids["near_dedup"] == ids["packing"]
    assert "hunter22" not in " ".join(seen["secrets"].text) and seen["secrets"].text.str.len().eq(seen["secrets"].n_chars).all()
    whole = corpus_pipeline.run(spark, str(tmp_path)).toPandas()
    cols = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, whole[cols].values)) == sorted(map(tuple, seen["packing"][cols].values))


def test_an_empty_table_passes_through(spark, tmp_path):
    docs = documents(spark, random.Random(2)).where("false")
    marks(spark).where("false").write.parquet(str(tmp_path / "labels.parquet"))
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
    assert docs.isEmpty()
