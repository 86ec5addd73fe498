from pyspark.sql import functions as F

from millrace.functions import text as X


def test_clean(apply):
    texts = ["  • see http://a.b c\n* d  ", "http://a.b c", None, "-\n- a", "a \n b"]
    assert apply(X.clean, texts) == ["see c d", " c", "", "a", "a b"]


def test_collapse_commas(apply):
    assert apply(X.collapse_commas, ["a ,, b,", " ,a,  ,  ,b", "a, , ,b ,"]) == ["a, b"] * 3


def test_format_target(spark):
    rows = [
        (" Cake ", ["Mix.", "http://x.y", "Bake."]), ("Cake", []), ("", ["a", "", "b"]), (None, None),
    ]
    df = spark.createDataFrame(rows, "t string, s array<string>")
    got = [r[0] for r in df.select(X.format_target(F.col("t"), F.col("s"))).collect()]
    assert got == [
        "Title: Cake\nStep 1: Mix.\nStep 3: Bake.", "Title: Cake", "Step 1: a\nStep 3: b", "",
    ]


def test_title_prompt_sample(spark):
    df = spark.createDataFrame([("a, b", " T \nStep 1: x")], "i string, r string")
    r = df.select(
        X.title_line(F.col("r")).alias("title"),
        X.prompt(F.col("i")).alias("basic"),
        X.prompt(F.col("i"), "title_then_steps").alias("steps"),
        X.prompt(F.col("i"), "title_step1").alias("unknown"),
        X.sample_text(F.col("i"), F.col("r")).alias("sample"),
        X.corpus_text(F.col("i"), F.col("r")).alias("corpus"),
        X.corpus_text(F.col("i"), F.col("r"), ("recipe",)).alias("one"),
        X.corpus_text(F.lit(""), F.lit("")).alias("none"),
    ).first()
    assert r["title"] == "T"
    assert r["basic"] == r["unknown"] == "Ingredients: a, b\nRecipe:"
    assert r["steps"] == "Ingredients: a, b\nRecipe:\nTitle:"
    assert r["sample"] == "Ingredients: a, b\nRecipe:  T \nStep 1: x"
    assert r["corpus"] == "<TITLE> T <ING> a, b <REC>  T \nStep 1: x"
    assert r["one"] == "<REC>  T \nStep 1: x"
    assert r["none"] == ""


def test_readable(apply):
    assert apply(X.readable, [" aĠb   c "]) == ["a b c"]
