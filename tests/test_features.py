import math

import pytest
from pyspark.sql import functions as F

from spendlens.operators import features as FE
from spendlens.operators import tfidf as T


def test_tfidf_three_docs(spark):
    docs = spark.createDataFrame([(1, "shared alpha alpha"), (2, "shared beta"), (3, "shared")],
                                 "row_id int, text string")
    block = T.TextBlock("w", "text", "word", min_df=1, strip_accents=True, ngram_max=1)
    w = {(r["row_id"], r["term"]): r["weight"] for r in T.tfidf(docs, block).collect()}
    idf_shared = math.log(4 / 4) + 1
    idf_alpha = math.log(4 / 2) + 1
    a = (1 + math.log(2)) * idf_alpha
    assert w[(1, "alpha")] == pytest.approx(a / math.hypot(a, idf_shared))
    assert w[(3, "shared")] == pytest.approx(1.0)
    unseen = spark.createDataFrame([(9, "gamma shared")], "row_id int, text string")
    out = T.tfidf(docs, block, unseen).collect()
    assert [(r["term"], round(r["weight"], 9)) for r in out] == [("shared", 1.0)]


def test_min_df_cut(spark):
    docs = spark.createDataFrame([(1, "aa bb"), (2, "aa cc")], "row_id int, text string")
    vocab = {r["term"] for r in T.fit_vocabulary(docs, T.WORD).collect()}
    assert vocab == {"aa"}


def test_bins_constant_and_two_values(spark):
    const = spark.createDataFrame([(float(3),)] * 5, "amount_log double")
    edges = FE.bin_edges(const)
    assert edges == [3.0]
    assert {r[0] for r in const.select(FE.bin_index("amount_log", edges)).collect()} == {0}
    two = spark.createDataFrame([(1.0,)] * 5 + [(2.0,)] * 5, "amount_log double")
    e2 = FE.bin_edges(two)
    assert len(e2) - 1 <= 10
    got = {r[0] for r in two.select(FE.bin_index("amount_log", e2)).collect()}
    assert got == {0, len(e2) - 2}


def test_maxabs_zero_column(spark):
    df = spark.createDataFrame([(0.0,), (0.0,)], "amount_log double")
    m = FE.max_abs(df)
    assert m == 0.0
    assert [r[0] for r in df.select(FE.scale_max_abs("amount_log", m)).collect()] == [0.0, 0.0]


def test_vendor_index_alphabetical(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("a",)], "vendor_id string")
    got = {r[0]: r[1] for r in FE.vendor_index(df).collect()}
    assert got == {"a": 0, "b": 1, "c": 2}


def test_broadcast_and_joined_vocabulary_give_the_same_vectors(spark, monkeypatch):
    rows = [("a", "alpha beta beta", "alpha", "v1", 1.0), ("a", "alpha beta beta", "alpha", "v1", 1.0),
            (None, "gamma", "", "v2", 0.0), ("b", "", "", "v3", 2.0), ("c", "beta delta alpha", "beta", "v1", 3.0)]
    df = spark.createDataFrame(rows, "row_id string, text string, item_key string, vendor_id string, amount_log double")
    ff = FE.fit_features(df.where("row_id is null or row_id <> 'b'"))
    held = FE.feature_arrays(ff, df, ["row_id"]).collect()
    ff.held = None
    monkeypatch.setattr(FE, "MAX_HELD_TERMS", -1)
    joined = FE.feature_arrays(ff, df, ["row_id"]).collect()

    def norm(x):
        return sorted((str(r["row_id"]), r["idx"], [round(v, 9) for v in r["val"]]) for r in x)

    assert len(held) == 5 and norm(held) == norm(joined)


def _brute_weights(rows, vocab_rows, block):
    import math
    from collections import defaultdict
    df = defaultdict(int)
    for _, text in vocab_rows:
        for t in T.counted_terms(text, block):
            df[t] += 1
    idf = {t: math.log((len(vocab_rows) + 1) / (n + 1)) + 1 for t, n in df.items() if n >= block.min_df}
    own, q = [], defaultdict(float)
    for i, text in rows:
        for t, tf in T.counted_terms(text, block).items():
            if t in idf:
                w = (1 + math.log(tf)) * idf[t]
                own.append((i, t, w))
                q[i] += w * w
    return sorted((-1 if i is None else i, t, round(w / math.sqrt(q[i]), 9)) for i, t, w in own)


def test_weights_in_place_equal_joined_weights_with_repeated_and_null_ids(spark):
    rows = [(1, "red pen red ink"), (2, "blue pen"), (2, "red ink"), (None, "red pen"), (None, None), (None, "blue"), (3, "")]
    df = spark.createDataFrame(rows, "row_id bigint, text string")
    for block in (T.WORD, T.CHAR):
        vocab = T.fit_vocabulary(df, block)
        held = T.held_vocabulary(vocab)
        want = _brute_weights(rows[:3] + [(None, "red pen"), (None, "blue")], rows, block)
        for got in (T.weigh_in_place(df, block, held), T.weigh(T.term_counts(df, block), vocab)):
            assert sorted((-1 if r[0] is None else r[0], r[1], round(r[2], 9)) for r in got.collect()) == want


def test_a_held_vocabulary_shuffles_no_entry(spark):
    df = spark.createDataFrame([(1, "red pen"), (2, "blue pen")], "row_id bigint, text string")
    plan = T.tfidf(df, T.CHAR)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan


def test_entries_leave_a_worker_in_pieces(spark):
    texts = [f"w{i} x{i} y{i} z{i}" for i in range(3000)]
    df = spark.createDataFrame(list(enumerate(texts)), "row_id bigint, text string").coalesce(1)
    counts = T.term_counts(df, T.CHAR)
    assert counts.count() == sum(len(T.counted_terms(t, T.CHAR)) for t in texts)
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan  # no row carries the entries of its whole text
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) <= 8 << 20


def test_frequencies_summed_in_parts_equal_counts(spark):
    texts = [f"pen n{i % 7} n{i % 5}" for i in range(200)] + [None, ""]
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    want = {}
    for t in texts:
        for x in T.counted_terms(t, T.WORD):
            want[x] = want.get(x, 0) + 1
    assert {r["term"]: r["df"] for r in T.term_frequencies(df, T.WORD).collect()} == want


def test_term_stores_are_read_and_mapped_in_bounded_pieces(spark):
    rows = [(i, f"alpha n{i % 3} beta", "alpha", "v1", float(i)) for i in range(40)] + [(None, None, None, None, None)]
    df = spark.createDataFrame(rows, "row_id bigint, text string, item_key string, vendor_id string, amount_log double")
    store = FE.term_store(df)
    assert int(spark.conf.get("spark.sql.parquet.columnarReaderBatchSize")) <= 256
    ff = FE.fit_features(df.where("row_id is not null"))
    by_text, by_store = ({(r["row_id"], tuple(r["idx"]), tuple(r["val"])) for r in FE.feature_arrays(ff, x, ["row_id"]).collect()}
                         for x in (df, store))
    assert by_text == by_store and len(by_text) == 41
    ff.release()
    assert ff.held is None and FE.feature_arrays(ff, store, ["row_id"]).count() == 41


def test_frequencies_of_parts_from_texts_and_stores(spark):
    rows = [(i, f"alpha n{i % 3}", "alpha", "v", 1.0, i % 2 == 0) for i in range(9)]
    df = spark.createDataFrame(rows, "row_id bigint, text string, item_key string, vendor_id string, amount_log double, even boolean")
    df = df.withColumn("all", F.lit(True))
    want = {}
    for _, text, item, _, _, even in rows:
        for b, key, _ in zip(*FE._counted(text, item)):
            e = want.setdefault((int(b), int(key)), [0, 0])
            e[0] += 1
            e[1] += even
    for x in (df, FE.term_store(df)):
        got = {(r["b"], r["key"]): r["df"] for r in FE.document_frequencies(x, ["all", "even"]).collect()}
        assert got == want
