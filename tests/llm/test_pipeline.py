"""The pipeline's stages on the smallest driver tables."""

from pathlib import Path

import pytest
from test_dedup import fold, shingles

import corpus_pipeline

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="driver tables absent")


def test_stages_one_after_the_other(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = {r[0]: r[1] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").select("doc_id", "quality").collect()}
    after = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, FOLDER)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.schema.simpleString() == docs.schema.simpleString()
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        after[name] = docs.collect()
    ids = {name: [r["doc_id"] for r in kept] for name, kept in after.items()}
    assert not [i for i in labels if labels[i] == 0 and i in set(ids["quality"])]
    assert [i for i in labels if labels[i] == 1 and i not in set(ids["quality"])] == []
    texts = [fold(r["text"]) for r in after["exact_dedup"]]
    assert len(texts) == len(set(texts)) == len({fold(r["text"]) for r in after["quality"]})
    sets = [shingles(r["text"]) for r in after["near_dedup"]]
    assert not [1 for i, a in enumerate(sets) for b in sets[:i] if a and 100 * len(a & b) >= 75 * len(a | b)]
    assert set(ids["mixing"]) <= set(ids["near_dedup"]) and max(map(ids["mixing"].count, set(ids["mixing"]))) <= 2
    assert sorted(ids["bpe"]) == sorted(ids["mixing"])


def test_run_is_the_stages(spark):
    assert corpus_pipeline.run(spark, FOLDER).columns == ["doc_id", "n_tokens", "ids", "ends"]
