import csv
import json

import pytest
from pyspark.sql import functions as F

from millrace.operators.bpe import Vocabulary
from millrace.plans import evaluate, prepare, vocabulary
from millrace.sources import files
from millrace.sources.shared import new_path, shared_folder, spread


def test_csv_cells(spark, tmp_path):
    path = tmp_path / "raw.csv"
    rows = [
        ["Cake, \"big\"", "['1 c. flour', '2 eggs']", '["Mix.\\u00e9", "Bake"]', "flour\nx", "no"],
        ["", "", "", "", ""],
    ]
    with path.open("w", newline="", encoding="utf-8") as f:
        w = csv.writer(f)
        w.writerow(["title", "ingredients", "directions", "NER", "other"])
        w.writerows(rows)
    got = [tuple(r) for r in files.read_recipes_csv(spark, str(path)).collect()]
    assert got == [tuple(r[:4]) for r in rows]
    renamed = files.read_recipes_csv(spark, str(path), title_col="other", ner_col=None).first()
    assert renamed["title"] == "no" and renamed["ner"] == ""
    missing = files.read_recipes_csv(spark, str(path), title_col="absent").first()
    assert missing["title"] == ""


def test_prepare_csv(spark, tmp_path):
    cells = [("Cake", "['1 c. butter or margarine', '2 eggs']", "['Mix.', 'http://x.y', 'Bake.']", "['sugar']"),
             ("Nothing", "cloves", "['x']", ""), ("", "salt", "", "")]
    raw = spark.createDataFrame(cells, "title string, ingredients string, directions string, ner string")
    got = prepare.prepare_csv(raw).collect()
    assert [(r["title"], r["ingredients"], r["recipe"]) for r in got] == [
        ("Cake", "butter, eggs, margarine, sugar", "Title: Cake\nStep 1: Mix.\nStep 3: Bake."),
    ]
    for flag in (True, False):  # the flag changes nothing
        again = prepare.prepare_csv(raw, keep_quantities=flag).first()
        assert again["ingredients"] == got[0]["ingredients"]
    shown = prepare.prepare_csv(raw, show_quantities=True).first()
    assert shown["ingredients"] == "1 c butter or margarine, 2 eggs, sugar"
    with pytest.raises(ValueError):
        prepare.prepare_csv(raw, train=0.5)


def test_jsonl(spark, tmp_path):
    path = tmp_path / "raw.jsonl"
    path.write_text('{"ingredients": " Ab  c", "recipe": "x\\ny", "z": 1}\n\n{"recipe": "q"}\n', encoding="utf-8")
    raw = files.read_jsonl(spark, str(path))
    assert raw.count() == 2
    got = prepare.prepare_jsonl(raw, lower_ingredients=True).collect()
    assert [(r["ingredients"], r["recipe"]) for r in got] == [("ab c", "x y")]
    path.write_text('{"ingredients": "a", "recipe": \n', encoding="utf-8")
    with pytest.raises(Exception):
        files.read_jsonl(spark, str(path)).collect()


def test_splits_roundtrip(spark, tmp_path):
    rows = [(i, "t", f"é{i}", "r\nr", "train" if i % 3 else "val") for i in range(30)]
    df = spark.createDataFrame(rows, files.PROCESSED)
    files.write_splits(df, str(tmp_path / "out"))
    back = files.read_splits(spark, str(tmp_path / "out"))
    assert sorted(map(tuple, back.select(*df.columns).collect())) == rows
    assert "é" in next((tmp_path / "out" / "split=val").glob("*.json")).read_text(encoding="utf-8")
    assert files.read_splits(spark, str(tmp_path / "out"), ("test",)).count() == 0
    with pytest.raises(FileNotFoundError):
        files.read_splits(spark, str(tmp_path / "out"), ("test",), strict=True)


def test_token_cache(spark, tmp_path):
    vocab = Vocabulary(list("abĠ:"), [])
    rows = spark.createDataFrame([(1, "t", "a", "b", "train"), (2, "", "b", "a", "val")], files.PROCESSED)
    path = str(tmp_path / "cache")
    vocabulary.cache_tokens(rows, vocab, path, max_len=8)
    got = files.read_token_cache(spark, path, 8, 0, vocab.fingerprint()).collect()
    assert {r["split"] for r in got} == {"train", "val"}
    assert all(len(r["ids"]) == 8 and r["ids"][0] == 1 for r in got)
    with pytest.raises(ValueError):
        files.read_token_cache(spark, path, 16, 0, vocab.fingerprint())


def test_run_logs(spark, tmp_path):
    log = spark.createDataFrame([(1, 2.0, 3.0, 20.0, 1e-3, 5.0)], files.RUN_LOG)
    more = spark.createDataFrame([(2, 1.0, 2.0, 7.0, 1e-3, 5.0)], files.RUN_LOG)
    for run in ("a", "b"):
        files.append_run_log(log, str(tmp_path), run)
        files.append_run_log(more, str(tmp_path), run)
    got = files.read_run_logs(spark, str(tmp_path)).orderBy("run_id", "epoch").collect()
    assert [(r["run_id"], r["epoch"], r["val_loss"]) for r in got] == [
        ("a", 1, 3.0), ("a", 2, 2.0), ("b", 1, 3.0), ("b", 2, 2.0),
    ]


def test_vocabulary_roundtrip(spark, tmp_path):
    vocab = Vocabulary(["a", "b", "ab"], [("a", "b")], lower=False, nfkc=True)
    files.write_vocabulary(vocab, spark, str(tmp_path / "v"))
    assert files.read_vocabulary(spark, str(tmp_path / "v")) == vocab


def test_evaluate(spark, tmp_path):
    rows = [(i, "i", "the cat sat on the mat", "the catĠsat on a mat") for i in range(5)]
    pairs = spark.createDataFrame(rows, "row_id long, ingredients string, reference string, hypothesis string")
    m = evaluate.evaluate(pairs, "val", limit=3, out=str(tmp_path)).first()
    assert m["N"] == 3 and m["split"] == "val"
    assert m["rougeL_f1"] == pytest.approx(100 * 2 * 5 / 12)
    stored = next((tmp_path / "val" / "metrics").glob("*.json")).read_text()
    assert json.loads(stored)["N"] == 3
    assert evaluate.evaluate(pairs, "val", limit=0, shuffle=True).first()["N"] == 5
    none = evaluate.evaluate(pairs.where("row_id < 0"), "val").first()
    assert (none["N"], none["rougeL_f1"], none["bleu"]) == (0, 0.0, 0.0)


def test_shared_folder(spark):
    assert new_path(spark, "x").startswith(shared_folder(spark))


def test_spread(spark, tmp_path):
    df = spark.range(100)
    df.coalesce(1).write.parquet(str(tmp_path / "one"))
    one = spark.read.parquet(str(tmp_path / "one"))
    assert spread(one, "id").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert spread(one, "id").agg(F.sum("id")).first()[0] == 4950


def test_csv_keeps_blanks_and_refuses_other_headers(spark, tmp_path):
    from millrace.sources import files

    rows = [(" a ", "\n c", "d ", "x")]
    df = spark.createDataFrame(rows, "title string, ingredients string, directions string, NER string")
    files.write_csv(df, str(tmp_path / "one"))
    got = files.read_recipes_csv(spark, str(tmp_path / "one")).first()
    assert tuple(got) == rows[0]
    (tmp_path / "two").mkdir()
    (tmp_path / "two" / "a.csv").write_text("title,ingredients\nt,i\n")
    (tmp_path / "two" / "b.csv").write_text("ingredients,title\ni,t\n")
    with pytest.raises(Exception, match="(?i)header"):
        files.read_recipes_csv(spark, str(tmp_path / "two")).collect()


def test_ordered_splits_and_manifest(spark, tmp_path):
    rows = [(i, "", f"a{i}", f"r{i}", ["train", "train", "val"][i % 3]) for i in range(500)]
    df = spark.createDataFrame(rows, files.PROCESSED).repartition(5)
    path = str(tmp_path / "out")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        files.write_splits(df, path, ordered=True)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert files.split_rows(spark, path) == {"train": 334, "val": 166}
    parts = sorted((tmp_path / "out" / "split=train").glob("part-*.json"))
    lines = [json.loads(x)["row_id"] for p in parts for x in p.read_text().splitlines()]
    assert len(parts) > 1 and lines == [i for i, *_, s in rows if s == "train"]
    assert files.read_splits(spark, path, ("train", "val"), strict=True).count() == 500
    for p in parts:
        p.unlink()  # the strict check reads the manifest alone
    files.read_splits(spark, path, ("train",), strict=True)
    with pytest.raises(FileNotFoundError):
        files.read_splits(spark, path, ("train", "test"), strict=True)
    files.write_splits(df.where("split = 'val'"), path, "append")
    assert files.split_rows(spark, path) == {"train": 334, "val": 332}


def test_many_run_logs_at_once(spark, tmp_path):
    rows = [(f"r {i % 3}/x", i, 0.1 * i, 1.0, None, None, 2.0) for i in range(30)]
    logs = spark.createDataFrame(rows, "run_id string, " + files.RUN_LOG)
    files.write_run_logs(logs, str(tmp_path / "logs"))
    got = files.read_run_logs(spark, str(tmp_path / "logs")).collect()
    assert sorted((r["epoch"], r["train_loss"]) for r in got) == sorted((i, x) for _, i, x, *_ in rows)
    assert len({r["run_id"] for r in got}) == 3


def test_tasks_grow_with_the_table(spark):
    """Raw JSON lines and spread tables have at least as many parts as the scan has splits."""
    from millrace.queries import _raw_jsonl
    from millrace.sources.tables import documents, table

    folder, size = "/root/testdata/sf0.01", spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200k")
    try:
        splits = table(spark, folder, "documents").rdd.getNumPartitions()
        assert splits > 4
        path, rows = _raw_jsonl(spark, folder, 4)
        written = spark.read.json(path)
        assert documents(spark, folder, "doc_id").rdd.getNumPartitions() >= splits
        assert len(written.inputFiles()) >= splits and written.count() == rows.count()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
