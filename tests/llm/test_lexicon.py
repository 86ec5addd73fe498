"""The lexicon of I-Match."""

from millrace.llm import fingerprints


def test_lexicon_is_the_whole_band(spark):
    """9,000 terms, each in two of 20 documents: more than the 8,192 that were kept."""
    terms = [f"t{i}" for i in range(9000)]
    rows = [(k, " ".join(t for i, t in enumerate(terms) if i % 10 == k % 10)) for k in range(20)]
    docs = spark.createDataFrame([*rows, (20, "none of them")], "doc_id bigint, text string")
    lexicon = fingerprints.lexicon(docs)
    assert len(lexicon) == 9000
    marks = {r["doc_id"]: r["fingerprint"] for r in fingerprints.fingerprints(docs, lexicon).collect()}
    for k in range(10):
        assert marks[k] == marks[k + 10] and marks[k][8:16] != "0" * 8
    assert marks[20][8:] == "0" * 8 * 31
