from pyspark.sql import functions as F

from moodstream.functions import text


def one(spark, fn, s):
    return spark.createDataFrame([(s,)], "s string").select(fn(F.col("s")).alias("o")).first()["o"]


def test_arabic_normaliser(spark):
    norm = lambda t: one(spark, text.normalize_arabic, t)
    assert norm("كِتَـــابٌ قَدِيـم") == "كتاب قديم"                       # vowel signs and stretched letters
    assert norm("اقرأ https://site.org/p?q=1 مع @sara_9 الآن") == "اقرأ [رابط] مع [مستخدم] الآن"
    assert norm("طويييييل") == "طوييل"                                  # at most two of a letter
    assert norm("\t صباح النور \n") == "صباح النور"


def test_tweet_cleaning_chain(spark):
    assert one(spark, text.clean_text, "a..b. c.") == "a.b c"
    assert one(spark, text.clean_text, "a.b") == "a.b"
    out = one(spark, text.clean_text, "Hello #World @user_1 see https://t.co/x\nNow &amp then")
    assert out == "hello world @ see www now then"


def test_py_strip_unicode_space(spark):
    assert one(spark, text.py_strip, "  x  ") == "x"


def test_white_space_is_unicode_everywhere(spark):
    assert one(spark, text.clean_text, "a\u00a0\u00a0b\u3000c\u001cd  e\u2009") == "a b c d e"
    assert one(spark, text.clean_text, "go https://x.y/z\u00a0now") == "go www now"
    assert one(spark, text.normalize_arabic, "see www.x.y\u3000and @me\u00a0ok\u001c") == "see [رابط]\u3000and [مستخدم]\u00a0ok"


def test_percent(spark):
    assert [one(spark, lambda c, v=v: text.percent(F.lit(v)), "x") for v in (0.334, 0.125, 1.0, 0.0)] == ["33%", "12%", "100%", "0%"]


def test_clean_texts_match_oracle_sql_on_fixture(spark, tmp_dir):
    import duckdb

    from moodstream.catalog import ORACLE_SQL, q_clean_texts

    texts = ["a\u00a0\u00a0b", "x https://t.co/1\u3000y", "p\u001cq\u2028r", "one..two. #Tag @Me &amp http", "", None, "\u0085z\u205f"]
    spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").write.parquet(f"{tmp_dir}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_dir}/documents.parquet/*.parquet')")
    assert {tuple(r) for r in q_clean_texts(spark, tmp_dir).collect()} == set(con.execute(ORACLE_SQL["clean_texts"]).fetchall())


def test_pad_tokens(spark):
    df = spark.createDataFrame([("abc",)], "s string")
    ids = df.select(text.token_ids("s", 5).alias("i")).first()["i"]
    assert ids == [97, 98, 99, 0, 0]
    long = spark.createDataFrame([("x" * 200,)], "s string") \
        .select(text.token_ids("s", 120).alias("i")).first()["i"]
    assert len(long) == 120
    mask = df.select(text.attention_mask(text.token_ids("s", 5)).alias("m")).first()["m"]
    assert mask == [1, 1, 1, 0, 0]


def test_arabic_normaliser_matches_oracle_sql_on_fixture(spark, tmp_dir):
    import duckdb

    from moodstream.catalog import ORACLE_SQL, q_normalized_texts

    texts = ["طويييييل جدييييد", "٣٣٣٣ 7777 ووووو", "كِتَـــابٌ www.site.org/p؟ مع @sara_9 الآن",
             " صباح النور  ", "", "🎈🎈🎈🎈 ok", "zzzy\tyyyy https://site.org/k\x0bq", None]
    rows = [(i, 1, "user", t, i) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, n_tokens long") \
        .write.parquet(f"{tmp_dir}/conversations.parquet")
    got = {(r["conv_id"], r["normalized"]) for r in q_normalized_texts(spark, tmp_dir).collect()}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_dir}/conversations.parquet/*.parquet')")
    want = {(c, n) for c, _, n in con.execute(ORACLE_SQL["normalized_texts"]).fetchall()}
    assert got == want
    assert dict(got)[0] == "طوييل جدييد"
