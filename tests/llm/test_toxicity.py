"""Terms that clean documents quote, and texts without long words."""

import random

from millrace.llm import toxicity


def tables(spark, texts):
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(texts)], "doc_id bigint, toxic int")
    return docs, labels


def test_short_quoted_terms_are_learned(spark):
    rng = random.Random(6)
    fill = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(n))
    texts = [(f"{fill(4)} you scumbo {fill(4)}", 1) for _ in range(60)]
    texts += [(f'{fill(4)} he said "scumbo" {fill(4)}', 0) for _ in range(12)]
    texts += [(fill(10), 0) for _ in range(600)]
    docs, labels = tables(spark, texts)
    model = toxicity.train(docs, labels)
    assert "scumbo" in model.words + model.stems
    scores = {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(docs, model).collect()}
    assert all(scores[i] >= 0.7 for i in range(60))
    assert all(scores[i] < 0.5 for i in range(60, len(texts)))
