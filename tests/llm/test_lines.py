"""Clean documents of short lines, and junk."""

from millrace.llm import line_quality


def test_clean_short_lines_stay(spark):
    prose = [
        "Sales rose 5% in May.\nIt costs $50 for two people.\nMarks & Spencer opened a shop here.",
        "« Oui », dit-elle.\n« Non », dit-il, et il ferma la porte.",
        "She wrote her first page in JavaScript when she was twelve, and years later, when nobody in the town "
        "remembered the old machine, she showed it to her children, who laughed.",
    ]
    junk = ["Home | About | Contact | Log in\n" * 4, "## $$ ** && ## $$ ** && ## $$ ** &&", "Read our privacy policy.\n" * 4]
    docs = spark.createDataFrame(list(enumerate(prose + junk)), "doc_id bigint, text string")
    rows = {r["doc_id"]: r for r in line_quality.clean_lines(docs).collect()}
    for i, text in enumerate(prose):
        assert rows[i]["kept"] and rows[i]["clean_text"] == text
    assert all(not rows[i]["kept"] for i in range(len(prose), len(prose + junk)))
