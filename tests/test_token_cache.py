"""The registered cache holds as many ids as the reference's default."""

from pyspark.sql import functions as F

from millrace.queries import QUERIES


def test_cache_length(spark):
    rows = QUERIES["token_cache"](spark, "/root/testdata/sf0.001")
    assert [r[0] for r in rows.select("max_len").distinct().collect()] == [512]
    assert rows.agg(F.max(F.size(F.split("ids", r"[^0-9]+")))).first()[0] > 64
