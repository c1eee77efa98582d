import json

import pytest

from pyspark.sql import functions as F

from spendlens.operators import lookup as LK
from spendlens.operators import split as S
from spendlens.operators import train as TR
from spendlens.operators.clean import clean_expenses, inference_rows
from spendlens.plans.catalog import expenses
from spendlens.sources import sinks as SK
from spendlens.sources.raw import read_expense_json, to_raw_json_rows
from spendlens.sources.views import raw_view
from spendlens.streaming.score import score_batch, start_scoring_stream, write_epoch

from conftest import SF_SMALL


def test_json_array_source(spark, tmp_path):
    recs = [
        {"_id": {"$oid": "a1"}, "vendorId": "v1", "itemName": " Zoom  Pro ", "itemDescription": None,
         "accountId": "x", "accountName": "Software", "itemTotalAmount": 12.5},
        {"_id": {"$oid": "a2"}, "vendorId": "v2", "itemName": "Taxi", "accountName": "Travel",
         "itemTotalAmount": "abc"},
        {"_id": {"$oid": "a3"}, "vendorId": "v2", "itemName": "Lunch", "accountName": None,
         "itemTotalAmount": -3},
    ]
    path = tmp_path / "expenses.json"
    path.write_text(json.dumps(recs))
    raw = read_expense_json(spark, str(path))
    out = {r["row_id"]: r for r in clean_expenses(raw).collect()}
    assert set(out) == {"a1", "a2"}           # the NULL label is dropped
    assert out["a1"]["text"] == "zoom pro" and out["a1"]["item_key"] == "zoom pro"
    assert out["a1"]["item_total_amount"] == 12.5
    assert out["a2"]["item_total_amount"] == 0.0 and out["a2"]["amount_log"] == 0.0


def test_inference_rows_missing_keys(spark):
    df = spark.createDataFrame([("Taxi ride", None, " 7 ")], "itemName string, vendorId string, itemTotalAmount string")
    r = inference_rows(df).first()
    assert r["vendor_id"] == "" and r["item_key"] == "taxi ride" and r["item_total_amount"] == 7.0


class StreamStop:
    """Fails after the first epoch is written, before Spark has committed it."""
    calls = 0

    def __call__(self, epoch):
        self.calls += 1
        if self.calls == 1:
            raise RuntimeError("lost after the write")


def test_model_roundtrip_and_stream(spark, tmp_path):
    s = S.group_split(expenses(spark, SF_SMALL))
    train, test = s.where("split = 'train'"), s.where("split = 'test'")
    tm = TR.fit_model(train)
    SK.save_model(tm, str(tmp_path / "model"), TR.fit_calibration(tm), LK.vendor_account_map(train))
    loaded, calibration, vendor_map, threshold = SK.load_model(spark, str(tmp_path / "model"))
    assert threshold == 0.5 and len(calibration["a"]) == len(tm.labels) and vendor_map.count() > 0
    a = {r["row_id"]: r["predicted"] for r in TR.score(tm, test).collect()}
    b = {r["row_id"]: r["predicted"] for r in TR.score(loaded, test).collect()}
    assert a == b and len(a) == test.count()
    # stream: the test rows as raw JSON files, scored by foreachBatch
    raw = raw_view(spark, SF_SMALL).join(test.select("row_id"), "row_id")
    to_raw_json_rows(raw).repartition(3).write.json(str(tmp_path / "in"))
    q = start_scoring_stream(spark, loaded, str(tmp_path / "in"), str(tmp_path / "out"),
                             str(tmp_path / "ckpt"))
    q.awaitTermination()
    scored = spark.read.parquet(str(tmp_path / "out"))
    assert scored.count() == test.count()
    got = {r["row_id"]: r["predicted"] for r in scored.collect()}
    assert got == {str(k): v for k, v in a.items()}
    # a batch that runs again after a failure replaces its own epoch and nothing else
    epoch = scored.where("epoch = 0").drop("epoch").cache()
    n = epoch.count()
    for _ in range(2):
        write_epoch(epoch, str(tmp_path / "out"), 0)
    write_epoch(epoch, str(tmp_path / "out"), 7)
    again = spark.read.parquet(str(tmp_path / "out"))
    assert again.count() == test.count() + n and again.where("epoch <> 7").count() == test.count()
    # a query that dies in the middle of an epoch's write and starts anew leaves every row once
    done = StreamStop()
    with pytest.raises(Exception):
        start_scoring_stream(spark, loaded, str(tmp_path / "in"), str(tmp_path / "out2"),
                             str(tmp_path / "ckpt2"), after_write=done).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out2")).count() > 0
    start_scoring_stream(spark, loaded, str(tmp_path / "in"), str(tmp_path / "out2"), str(tmp_path / "ckpt2"),
                         after_write=done).awaitTermination()
    ids = [r["row_id"] for r in spark.read.parquet(str(tmp_path / "out2")).collect()]
    assert sorted(ids) == sorted(str(k) for k in a) and done.calls > 1
    # null, repeated and absent ids: rows out = rows in
    raw = [("x", "Taxi"), ("x", "Lunch"), (None, "Taxi"), (None, "Taxi"), ("y", None)]
    odd = spark.createDataFrame(raw, "row_id string, itemName string")
    for batch in (odd, odd.drop("row_id")):
        out = score_batch(loaded, batch, vendor_map, calibration, threshold).collect()
        assert len(out) == 5 and all(r["predicted"] in tm.labels for r in out)


def test_export_csv_and_splits(spark, tmp_path):
    df = expenses(spark, SF_SMALL).drop("text")
    SK.export_csv(df, str(tmp_path / "csv"))
    assert spark.read.option("header", True).option("multiLine", True).csv(str(tmp_path / "csv")).count() == 200
    for _ in range(2):  # a rerun replaces its own rows
        SK.export_splits(S.random_split(df), str(tmp_path / "splits"), "r1", "random")
    SK.export_splits(S.random_split(df).limit(0), str(tmp_path / "splits"), "r2", "random")
    back = spark.read.option("header", True).option("multiLine", True).csv(str(tmp_path / "splits"))
    got = {r["split"]: r["count"] for r in back.groupBy("split").count().collect()}
    assert got == {"train": 160, "test": 40}
