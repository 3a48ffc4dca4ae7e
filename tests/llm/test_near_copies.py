"""Near copies that only their fingerprints bring together."""

import numpy as np
import pyarrow as pa

import corpus_pipeline
from quillsieve.llm import jaccard


def pair(i):
    """Two texts of 13 words with 8 of 10 shingles in common."""
    head = " ".join(f"{c}{i}" for c in "sbcdefghijkl")
    return [f"{head} m", f"{head} n"]


def test_near_copies_meet_by_fingerprints(spark):
    """Pairs at 0.8 that no band holds go by their fingerprints; a pair below 0.8 stays."""
    texts = [*pair(437507), *pair(439836), "a b c d e f g h", "a b c d e f g i j"]
    cells = np.asarray(jaccard.sketch(pa.array(texts))[2].values).reshape(len(texts), jaccard.BANDS)
    assert not (cells[0] == cells[1]).any() and not (cells[2] == cells[3]).any()
    df = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    assert {r.doc_id for r in corpus_pipeline.near_copies(spark, df, "").collect()} == {0, 2, 4, 5}
