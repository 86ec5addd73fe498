import json

import pytest
from pyspark.sql import functions as F

from millrace.operators.numbering import with_row_ids
from millrace.operators.words import word_counts
from millrace.plans.prepare import prepare_jsonl
from millrace.sources.files import RAW_JSONL, read_jsonl
from millrace.streaming import incremental
from millrace.streaming.incremental import stream_prepare, stream_word_counts

SCHEMA = "row_id bigint, " + RAW_JSONL


def batch(spark, first, n):
    rows = [(i, f"a{i} • b", f"Text {i % 5} one  two") for i in range(first, first + n)]
    return spark.createDataFrame(rows, SCHEMA)


def test_prepare_in_two_goes(spark, tmp_path):
    src, out, ck = (str(tmp_path / p) for p in ("in", "out", "ck"))
    one, two = batch(spark, 0, 40), batch(spark, 40, 25)
    one.write.json(src)
    assert stream_prepare(spark, src, out, ck).count() == 40
    two.write.mode("append").json(src)
    got = stream_prepare(spark, src, out, ck)  # picks up only the new files
    want = prepare_jsonl(one.unionByName(two))
    key = lambda df: sorted(map(tuple, df.select("row_id", "ingredients", "recipe", "split").collect()))
    assert key(got) == key(want)


def test_word_counts_grow(spark, tmp_path):
    src, out, ck = (str(tmp_path / p) for p in ("in", "out", "ck"))
    one, two = batch(spark, 0, 40), batch(spark, 40, 25)
    one.write.json(src)
    stream_word_counts(spark, src, SCHEMA, "recipe", out, ck)
    two.write.mode("append").json(src)
    got = stream_word_counts(spark, src, SCHEMA, "recipe", out, ck)
    want = word_counts(one.unionByName(two), F.col("recipe"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def files_of(folder, n, lines=7):
    """n files of JSON lines without ids, names in order; gives the texts in that order."""
    folder.mkdir(exist_ok=True)
    texts = [[f"Text {f} {k} one  two" * (1 + k % 3) for k in range(lines + f % 3)] for f in range(n)]
    for f, part in enumerate(texts):
        rows = [json.dumps({"ingredients": f"a{f} b{k}", "recipe": t}) for k, t in enumerate(part)]
        (folder / f"part-{f:03d}.json").write_text("\n".join(rows) + "\n")
    return [t for part in texts for t in part]


def test_ids_do_not_depend_on_the_splits(spark, tmp_path):
    texts = files_of(tmp_path / "in", 5)
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    found = []
    try:
        for size in ("128m", "200", "30"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "1")
            df = read_jsonl(spark, str(tmp_path / "in"))
            found.append((df.rdd.getNumPartitions(), sorted((r["row_id"], r["recipe"]) for r in with_row_ids(df).collect())))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert [rows for _, rows in found] == [list(enumerate(texts))] * 3
    assert found[0][0] < found[1][0] < found[2][0] and found[2][0] > 32


def test_stream_of_raw_lines_equals_batch(spark, tmp_path):
    src, out, ck = (tmp_path / p for p in ("in", "out", "ck"))
    files_of(src, 4)
    schema = RAW_JSONL
    first = stream_prepare(spark, str(src), str(out), str(ck), schema, files_per_batch=1)
    key = lambda df: sorted(map(tuple, df.select("row_id", "ingredients", "recipe", "split").collect()))
    assert key(first) == key(prepare_jsonl(read_jsonl(spark, str(src))))
    files_of(src, 6)
    (src / "part-000.json").touch()
    again = stream_prepare(spark, str(src), str(out), str(ck), schema)
    assert key(again) == key(prepare_jsonl(read_jsonl(spark, str(src))))
    assert key(stream_prepare(spark, str(src), str(out), str(ck), schema)) == key(again)  # nothing new


@pytest.mark.parametrize("compact", [0, 1, 2, 16])
def test_counts_survive_a_loss_between_batches(spark, tmp_path, monkeypatch, compact):
    src, out, ck = (tmp_path / p for p in ("in", "out", "ck"))
    files_of(src, 5)
    run = lambda: stream_word_counts(spark, str(src), RAW_JSONL, "recipe", str(out), str(ck), 1, compact)
    whole, calls = incremental.word_counts, []

    def failing(rows, text):
        calls.append(1)
        if len(calls) == 4:
            raise RuntimeError("lost")
        return whole(rows, text)

    monkeypatch.setattr(incremental, "word_counts", failing)
    with pytest.raises(Exception, match="lost"):
        run()
    # the batch that was lost had half of its table written, with the wrong rows
    spark.createDataFrame([("wrong", 99)], incremental.COUNTS).write.mode("overwrite").parquet(f"{out}/counts/batch=3")
    monkeypatch.setattr(incremental, "word_counts", whole)
    want = sorted(map(tuple, whole(read_jsonl(spark, str(src)), F.col("recipe")).collect()))
    assert sorted(map(tuple, run().collect())) == want
    assert sorted(map(tuple, run().collect())) == want  # a start without new files
