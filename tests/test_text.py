from pyspark.sql import functions as F

from spendlens.functions import text as T


def _one(spark, col, value):
    return spark.createDataFrame([(value,)], "x string").select(col.alias("r")).first()["r"]


def test_normalize_whitespace_and_case(spark):
    assert _one(spark, T.normalize_text("x"), "  A  B\tC  ") == "a b c"


def test_normalize_null_and_unicode_spaces(spark):
    assert _one(spark, T.normalize_text("x"), None) == ""
    assert _one(spark, T.normalize_text("x"), "\n Foo  BAR　") == "foo bar"


def test_build_text_with_missing_description(spark):
    df = spark.createDataFrame([("Zoom Subscription", None)], "a string, b string")
    assert df.select(T.build_text("a", "b").alias("t")).first()["t"] == "zoom subscription"


def test_is_blank(spark):
    df = spark.createDataFrame([(None,), ("",), (" \t ",), (" x ",)], "x string")
    assert [r[0] for r in df.select(T.is_blank("x")).collect()] == [True, True, True, False]


def test_strip_accents_keeps_sharp_s(spark):
    assert _one(spark, T.strip_accents(F.col("x")), "café ñandú ß ÉÈ") == "cafe nandu ß EE"
    assert _one(spark, T.strip_accents(F.col("x")), "ế ό й ﬁ Ａ ĳ ½") == "e ο и fi A ij 1⁄2"
    assert _one(spark, T.strip_accents(F.col("x")), None) is None


def test_word_tokens_and_bigrams(spark):
    toks = _one(spark, T.word_ngrams(T.word_tokens(F.col("x"))), "a bb c_d 12 x")
    assert toks == ["bb", "c_d", "12", "bb c_d", "c_d 12"]
    assert _one(spark, T.word_ngrams(T.word_tokens(F.col("x"))), "") == []
    assert _one(spark, T.word_ngrams(T.word_tokens(F.col("x"))), "single") == ["single"]


def test_char_wb_short_words_emitted_once(spark):
    grams = _one(spark, T.char_wb_ngrams(F.col("x")), "a ab")
    assert grams == [" a ", " ab", "ab ", " ab "]


def test_char_wb_long_word(spark):
    grams = _one(spark, T.char_wb_ngrams(F.col("x")), "abcd")
    # padded " abcd " (6 chars): 4 trigrams, 3 four-grams, 2 five-grams
    assert len(grams) == 9 and grams[:4] == [" ab", "abc", "bcd", "cd "]


def test_last_word_of_a_long_document_is_a_term(spark, tmp_path):
    from spendlens.plans.catalog import QUERIES
    text = "first line\n" + "filler words " * 10_000 + "lastword"
    rows = [(1, text, "en", "s", 1), (2, "other\nlastword here", "en", "s", 1)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(
        str(tmp_path / "documents.parquet"))
    got = {(r["row_id"], r["term"]) for r in QUERIES["tfidf_word"](spark, str(tmp_path)).collect()}
    assert (1, "lastword") in got and (2, "lastword") in got


def test_counted_terms_equal_the_column_expressions(spark):
    from spendlens.operators import tfidf as TF
    text = "a ab the then the naïve_x 12 ünder  été"
    words = _one(spark, T.word_ngrams(T.word_tokens(T.strip_accents(F.col("x")))), text)
    grams = _one(spark, T.char_wb_ngrams(F.col("x")), text)
    assert sorted(TF.counted_terms(text, TF.WORD).elements()) == sorted(words)
    assert sorted(TF.counted_terms(text, TF.CHAR).elements()) == sorted(grams)
