import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from spendlens.llm.queries import ORACLE_SQL
from tests.llm.fixtures import components, deduped_lines, hits, simhash

DIR = "/root/testdata/sf0.001"


def _rows(df):
    return [(r.doc_id, r.text, r.lang) for r in df.select("doc_id", "text", "lang").collect()]


def test_each_stage_by_brute_force(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "line_dedup", "simhash_dedup", "decontamination", "packing"]
    stage = dict(corpus_pipeline.STAGES)
    one = stage["language_id"](spark, docs, DIR)
    assert one.columns == docs.columns and 0.95 * docs.count() < one.count() <= docs.count()
    two = stage["line_dedup"](spark, one, DIR)
    rows = _rows(one)
    assert sorted((i, t) for i, t, _ in _rows(two)) == sorted((i, t) for i, _, _, t in deduped_lines(rows))
    assert all(r.n_chars == len(r.text) for r in two.collect())
    three = stage["simhash_dedup"](spark, two, DIR)
    rows = _rows(two)
    fps = {i: simhash(t) for i, t, _ in rows}
    roots = components(sorted(fps), lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 3)
    assert sorted(i for i, _, _ in _rows(three)) == sorted(set(roots.values()))
    four = stage["decontamination"](spark, three, DIR)
    items = [tuple(r) for r in spark.read.parquet(f"{DIR}/benchmark.parquet").select("item_id", "text").collect()]
    texts = dict((i, t) for i, t, _ in _rows(four))
    gone = 0
    for i, t, _ in _rows(three):
        hit, _found = hits(items, t)
        if not any(hit):
            assert texts[i] == t
        elif i in texts:
            assert sum(hit) <= 0.8 * len(hit) and len(texts[i]) < len(t)
        else:
            gone += 1
            assert sum(hit) > 0.8 * len(hit)
    assert four.columns == docs.columns and len(texts) + gone == three.count()
    five = stage["packing"](spark, four, DIR)
    assert {r.doc_id for r in five.select("doc_id").distinct().collect()} == set(texts)


def test_pipeline_keeps_extra_columns_and_survives_odd_rows(spark):
    rows = [(1, None, "en", "a", 3), (2, "", None, "a", 0), (3, "Some words of the text and the rest", "en", None, 35),
            (3, "Some words of the text and the rest", "en", None, 35), (None, "Le chat et la maison de la rue", "fr", "b", 30)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, th string, n_chars bigint")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(0), DIR).collect() == []
        out = stage(spark, docs, DIR)
        assert out.columns == docs.columns, name
        out.collect()


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "conversations", "embeddings"):
        con.sql(f"create view {t} as select * from '{DIR}/{t}.parquet'")
    expected = con.sql(ORACLE_SQL[name])
    got = entry.queries()[name](spark, DIR)
    assert sorted(got.columns) == sorted(expected.columns)
    rows = [tuple(r) for r in got.select(*expected.columns).collect()]
    assert sorted(rows, key=str) == sorted(expected.fetchall(), key=str)


def test_all_queries_are_registered():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry.queries()
