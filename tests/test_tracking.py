import pytest

from spendlens.operators import profile as P
from spendlens.operators import tracking as TK


def test_validator_errors_and_nulls(spark):
    df = spark.createDataFrame([(1, "x"), (2, "y"), (3, None)], "a int, b string")
    with pytest.raises(ValueError):
        P.validate_dataset(df, ["a", "missing"])
    with pytest.raises(ValueError):
        P.validate_dataset(df, ["a"], min_rows=4)
    got = {r["column_name"]: r["null_count"] for r in P.validate_dataset(df, ["a", "b"]).collect()}
    assert got == {"a": 0, "b": 1}


def test_metric_card_rows_and_nulls(spark):
    evals = spark.createDataFrame([("baseline", 0.7, 0.5), ("random", 0.9, 0.8)],
                                  "key string, accuracy double, macro_f1 double")
    card = TK.metric_card(evals).orderBy("position").collect()
    assert len(card) == 6 and card[0]["macro_f1"] is None and card[1]["accuracy"] == 0.9
    assert card[5]["accuracy"] is None


def test_flat_metrics_skip_nulls(spark):
    evals = spark.createDataFrame([("random", 0.9, None)], "key string, accuracy double, macro_f1 double")
    assert [r["metric"] for r in TK.flat_metrics(evals).collect()] == ["random_accuracy"]


def test_registry_champion_is_latest(spark, tmp_path):
    reg = str(tmp_path / "versions")
    for run in ["r1", "r2", "r3"]:
        TK.register_version(spark, reg, "m", run, f"/models/{run}")
    champ = TK.champion(spark.read.parquet(reg)).first()
    assert champ["version"] == 3 and champ["run_id"] == "r3"


def test_two_writers_get_two_versions(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor
    reg = str(tmp_path / "versions")
    with ThreadPoolExecutor(max_workers=6) as pool:
        got = list(pool.map(lambda i: TK.register_version(spark, reg, "m/x", f"run{i}", f"/models/{i}"), range(6)))
    assert sorted(got) == [1, 2, 3, 4, 5, 6]
    rows = spark.read.parquet(reg).collect()
    assert {(r["version"], r["run_id"]) for r in rows} == {(v, f"run{i}") for i, v in enumerate(got)}
    # a claim whose writer failed is passed over
    assert TK.claim_version(spark, reg, "m/x", 7) == 7
    assert TK.register_version(spark, reg, "m/x", "later", "/models/later") == 8


def test_digest_counts_equal_rows(spark, tmp_path):
    def digest(rows):
        return tuple(P.fingerprint(spark.createDataFrame(rows, "a int, b string"), ["a", "b"]).first())
    base = [(1, "x"), (2, "y")]
    assert digest(base) == digest(base[::-1])
    # a pair of equal rows is not the same as another pair, nor as none
    assert len({digest([*base, (3, v), (3, v)]) for v in ("p", "q", None)} | {digest(base)}) == 4
    assert digest([(1, None)]) != digest([(1, "")])
    assert digest([]) == (0, 0)
    df = spark.createDataFrame(base, "a int, b string")
    for context in ("training", "evaluation"):
        P.log_dataset(df, str(tmp_path / "datasets"), "expenses", ["a", "b"], "b", context)
    rows = spark.read.parquet(str(tmp_path / "datasets")).collect()
    assert {r["context"] for r in rows} == {"training", "evaluation"} and {r["digest"] for r in rows} == {digest(base)[1]}
    assert rows[0]["schema"] == "struct<a:int,b:string>" and rows[0]["targets"] == "b"


def test_logged_names_and_missing_numbers(spark):
    evals = spark.createDataFrame([
        ("baseline", 0.74, None, None), ("random", 0.9, 0.8, 0.05), ("group_item", None, 0.7, None),
        ("group_item_tuned", 0.9, 0.77, 0.1), ("balanced_holdout", 0.83, 0.79, None),
        ("calibrated_fallback_balanced", 0.84, float("nan"), None), ("something_else", 1.0, 1.0, 1.0)],
        "key string, accuracy double, macro_f1 double, accuracy_gap double")
    got = {r["metric"]: r["value"] for r in TK.named_metrics(evals).collect()}
    assert got == {
        "baseline_lookup_accuracy": 0.74, "holdout_random_accuracy": 0.9, "holdout_random_macro_f1": 0.8,
        "holdout_random_train_test_gap": 0.05, "holdout_group_item_macro_f1": 0.7,
        "holdout_group_item_tuned_accuracy": 0.9, "holdout_group_item_tuned_macro_f1": 0.77,
        "holdout_group_item_tuned_train_test_gap": 0.1, "balanced_holdout_accuracy": 0.83,
        "balanced_holdout_macro_f1": 0.79, "calibrated_fallback_balanced_accuracy": 0.84}
    assert set(TK.CHAMPION_METRICS) - set(got) == {"holdout_group_item_accuracy"}


def test_summary_round_trip(spark, tmp_path):
    from spendlens.plans import summary as SM
    from spendlens.plans.catalog import expenses
    from conftest import SF_SMALL
    evals = spark.createDataFrame([("baseline", 0.7, None, None), ("random", 0.9, 0.8, 0.05), ("balanced_holdout", 0.8, None, None)],
                                  "key string, accuracy double, macro_f1 double, accuracy_gap double")
    df = expenses(spark, SF_SMALL)
    tuned = SM.config_of({"C": 4.0, "class_weight": "None", "oversample_min_count": 5})
    SM.write_summary(evals, df, tuned, str(tmp_path / "s"))
    back = {r["key"]: tuple(r)[1:] for r in SM.read_summary(spark, str(tmp_path / "s")).collect()}
    assert len(back) == 6 and back["group_item_tuned"] == (None, None, None)
    assert {k: back[k] for k in ("baseline", "random", "balanced_holdout")} == {
        r["key"]: tuple(r)[1:] for r in evals.collect()}
    doc = spark.read.schema(SM.SUMMARY_SCHEMA).json(str(tmp_path / "s")).first()
    assert doc["dataset"]["record_count"] == df.count()
    assert tuple(doc["hyperparameter_tuning"]) == (4.0, "None", 5)


def test_appends_at_once_lose_no_row(spark, tmp_path):
    """Writers of one folder leave each other's files under way alone."""
    from concurrent.futures import ThreadPoolExecutor
    reg, metrics = str(tmp_path / "versions"), str(tmp_path / "metrics")

    def one(i):
        TK.log_metrics(spark.createDataFrame([(f"run{i}", "accuracy", 0.5)], "run_id string, metric string, value double"),
                       f"run{i}", metrics)
        return TK.register_version(spark, reg, "m/y", f"run{i}", f"/models/{i}")
    with ThreadPoolExecutor(max_workers=12) as pool:
        got = list(pool.map(one, range(48)))
    assert sorted(got) == list(range(1, 49))
    assert sorted(r["version"] for r in spark.read.parquet(reg).collect()) == list(range(1, 49))
    assert {r["run_id"] for r in spark.read.parquet(metrics).collect()} == {f"run{i}" for i in range(48)}
