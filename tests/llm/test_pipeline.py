"""The pipeline, stage by stage, against brute force."""

import random
import re

import corpus_pipeline
from test_operators import brute_components

from driftline.llm import decontamination, quality


def test_stages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    d = "/root/testdata/sf0.001"
    first = corpus_pipeline.STAGES[0][1](spark, docs, d)
    kept = {r["doc_id"] for r in quality.judge(spark, docs).where("quality.kept").collect()}
    assert {r["doc_id"] for r in first.collect()} == kept and first.columns == docs.columns
    second = corpus_pipeline.STAGES[1][1](spark, first, d)
    rows = [(r["doc_id"], r["text"]) for r in first.collect()]
    assert {r["doc_id"] for r in second.collect()} == {c for _, c in brute_components(rows).values()}
    third = corpus_pipeline.STAGES[2][1](spark, second, d)
    fourth = corpus_pipeline.STAGES[3][1](spark, third, d)
    assert fourth.columns == docs.columns and fourth.count() == third.count() <= second.count()
    assert not any(re.search(r"token = \"[0-9a-f]{40}", r["text"]) for r in fourth.collect())
    last = corpus_pipeline.run(spark, d)
    assert last.count() == fourth.count() and {"ids", "n_tokens"} <= set(last.columns)


def test_null_and_repeated_ids(spark):
    """A row goes for its own text only, whatever rows share its doc_id."""
    rnd = random.Random(3)
    a, b, c, d = (" ".join(f"w{rnd.randrange(10**6)}" for _ in range(60)) for _ in range(4))
    rows = [(1, a), (1, b), (1, b), (2, b), (3, c), (None, c), (None, d), (None, None), (4, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    near = [(r["doc_id"], r["text"]) for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()]
    texts = [t for k, t in near if k is not None]
    assert sorted(t or "" for t in texts) == sorted(["", a, b, c]) and sum(k is None for k, _ in near) == 2
    assert set(near) <= set(rows)
    benchmark = spark.createDataFrame([(1, " ".join(b.split()[10:40])), (2, d)], "item_id long, text string")
    left = decontamination.remove(docs, benchmark)
    assert left.columns == docs.columns
    assert sorted(map(str, map(tuple, left.collect()))) == sorted(map(str, [(1, a), (3, c), (None, c), (None, None), (4, None)]))
