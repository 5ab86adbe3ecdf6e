"""The pipeline's near_dedup stage links from a similarity of 0.80, op9 from 0.85."""

import random

import corpus_pipeline
from lodestrata.llm import near_dedup


def copies(rnd, n, tail):
    """Texts that share all but their last words; their similarity."""
    base = [f"w{rnd.randrange(10**9)}" for _ in range(n)]
    x, y = (base + [f"{p}{rnd.randrange(10**9)}" for _ in range(tail)] for p in "xy")
    sets = [{tuple(t[k : k + 5]) for k in range(len(t) - 4)} for t in (x, y)]
    return " ".join(x), " ".join(y), len(sets[0] & sets[1]) / len(sets[0] | sets[1])


def test_the_stage_removes_pairs_from_80(spark, tmp_path):
    rnd = random.Random(13)
    rows, far = [], []
    for k in range(20):
        x, y, s = copies(rnd, 300, 32)
        assert 0.80 <= s < 0.85
        rows += [(2 * k, x), (2 * k + 1, y)]
    for k in range(20, 30):
        x, y, s = copies(rnd, 300, 42)
        assert s < 0.80
        rows += [(2 * k, x), (2 * k + 1, y)]
        far += [2 * k, 2 * k + 1]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(r.doc_id for r in corpus_pipeline.dedup(spark, docs, str(tmp_path)).collect())
    assert got == [*range(0, 40, 2), *far]
    assert near_dedup.link(docs).where("kept").count() == len(rows)


def test_pruning_stays_five_deviations_below():
    assert near_dedup.likely_from(85) == 0.74 and near_dedup.likely_from(80) == 0.67
