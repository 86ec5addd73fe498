"""Nulls, empty and long texts, repeated rows, empty tables and clashing columns for every operator."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from millrace.llm import attribution, fingerprints, jaccard, line_quality, packing, pieces, pii, records
from millrace.llm import secret_scan, toxicity

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")
LONG = "one two three. " * 20_000
TEXTS = [
    (1, "Mail a.b@c.de now, please; it is about the last of them all."),
    (2, None),
    (3, ""),
    (4, " \n\t"),
    (5, LONG),
    (6, "same words in each of these rows here, ten of them."),
    (6, "same words in each of these rows here, ten of them."),
    (7, "same words in each of these rows here, ten of them."),
    (None, "no id"),
]
SCHEMA = "doc_id bigint, text string, ids int, start int, row string, doc string, h int, kept int, node int"


def records_of(docs):
    from millrace.sources.shared import new_path

    spark = docs.sparkSession
    out = new_path(spark, "records")
    records.write_records(docs, out, WORD_BPE)
    return records.read_records(records.read_index(spark, out), out)


OPERATORS = {
    "packing": lambda d: packing.pack(d, WORD_BPE),
    "attribution": lambda d: attribution.section_tokens(d, attribution.windows(F.col("text"), 1000), WORD_BPE),
    "secrets": secret_scan.find_secrets,
    "jaccard": jaccard.jaccard_components,
    "pii": pii.find_pii,
    "records": records_of,
    "fingerprints": lambda d: fingerprints.fingerprints(d, fingerprints.lexicon(d)),
    "lines": line_quality.clean_lines,
    "toxicity": lambda d: toxicity.score_toxicity(d, toxicity.Model(["trash"], ["vequ"], [], [-5.0, 5.0, 3.0, 0.0])),
    "pieces": lambda d: pieces.decode_pieces(pieces.encode_pieces(d, PIECE_BPE), PIECE_BPE),
}


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, 1, 1, "x", "y", 1, 1, 1) for i, t in TEXTS]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("name", OPERATORS)
def test_edges(spark, docs, name):
    rows = OPERATORS[name](docs).collect()
    ids = sorted({-1 if r["doc_id"] is None else r["doc_id"] for r in rows})
    assert ids == [-1, 1, 2, 3, 4, 5, 6, 7]
    if name in ("packing", "attribution"):
        return
    assert len(rows) == len(TEXTS)
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append(r.asDict())
    twice = [{k: v for k, v in x.items() if k not in ("start", "at")} for x in by[6]]
    assert twice[0] == twice[1]
    if name == "jaccard":
        assert {i: x[0]["component_id"] for i, x in by.items()} == {**{i: i for i in by}, 7: 6}
        assert by[2][0]["n_shingles"] == by[4][0]["n_shingles"] == 0 and by[None][0]["n_shingles"] == 1
    if name == "pii":
        assert [tuple(s) for s in by[1][0]["base"]] == [("email", 5, 13)] and "[EMAIL]" in by[1][0]["redacted"]
    if name == "lines":
        assert by[5][0]["n_repeat_words"] == 60_000 and not by[2][0]["kept"] and by[6][0]["kept"]
    if name == "pieces":
        assert all(r["decoded"] == r["text"] for r in rows)
    if name == "records":
        assert by[2][0]["n_tokens"] == 1


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, docs, name):
    assert OPERATORS[name](docs.limit(0)).count() == 0
