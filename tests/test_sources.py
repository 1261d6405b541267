import json

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from offeranalytics.functions.scalars import typed_events
from offeranalytics.sources import readers, writers

LINES = ['{"id": "a", "age": 118, "gender": "M", "income": 50000.0, "became_member_on": 20180101}', "{broken",
         "", '{"id": "b", "age": 30, "gender": null, "income": null, "became_member_on": 20170101}']


def write(path, text):
    path.write_text(text)
    return str(path)


def test_json_lines_with_a_bad_line(spark, tmp_path):
    good, bad = readers.read_json(spark, write(tmp_path / "p.json", "\n".join(LINES)), readers.PROFILE_SCHEMA)
    assert [r["id"] for r in good.orderBy("id").collect()] == ["a", "b"]
    assert [r["line"] for r in bad.collect()] == ["{broken"]


def test_json_array(spark, tmp_path):
    rows = [json.loads(LINES[0]), json.loads(LINES[3])]
    good, bad = readers.read_json(spark, write(tmp_path / "p.json", json.dumps(rows, indent=1)), readers.PROFILE_SCHEMA)
    assert good.count() == 2 and bad.count() == 0


def test_schema_is_inferred_when_not_given(spark, tmp_path):
    good, _ = readers.read_json(spark, write(tmp_path / "p.json", "\n".join(LINES)))
    assert set(good.columns) == {"id", "age", "gender", "income", "became_member_on"} and good.count() == 2


def test_missing_file(spark):
    with pytest.raises(FileNotFoundError):
        readers.read_json(spark, "/tmp/not-there.json", readers.PROFILE_SCHEMA)


def test_three_datasets_and_payload_keys(spark, tmp_path):
    write(tmp_path / "portfolio.json", '{"id": "o1", "offer_type": "bogo", "difficulty": 5, "reward": 5, "duration": 7, "channels": ["web"]}')
    write(tmp_path / "profile.json", LINES[0])
    events = [{"person": "a", "event": "offer received", "time": 0, "value": {"offer id": "o1"}},
              {"person": "a", "event": "offer completed", "time": 6, "value": {"offer id": "", "offer_id": "o1", "reward": 5}},
              {"person": "a", "event": "transaction", "time": 6, "value": {"amount": 1.25}}]
    write(tmp_path / "transcript.json", "\n".join(map(json.dumps, events)))
    data = readers.load_datasets(spark, str(tmp_path))
    assert [df.count() for df in data] == [1, 1, 3]
    typed = typed_events(data.transcript).orderBy("time", "event").collect()
    assert [(r["offer_id"], r["amount"]) for r in typed] == [("o1", None), ("o1", None), (None, 1.25)]
    assert readers.read_json_lines(spark, str(tmp_path / "profile.json"), readers.PROFILE_SCHEMA).count() == 1


def test_tables_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("o1", 1.5, ["a", "b"])], "id string, v double, channels array<string>")
    paths = writers.save_features({"offers": df, "none": None}, str(tmp_path))
    assert readers.read_table(spark, paths["offers"]).collect() == df.collect()
    csv = writers.save_rules({"offers": df}, str(tmp_path), "csv")["offers"]
    assert readers.read_table(spark, csv, "id string, v double, channels string").first()["channels"] == "a;b"
    assert set(writers.save_segments(df, df, str(tmp_path))) == {"customer_clusters", "cluster_profiles"}


def test_broken_array_is_read_by_lines_with_rejects(spark, tmp_path):
    text = '[\n{"id": "a", "age": 1},\n{"id": "b", "age": },\n  {"id": "c", "age": 3}\n]\n'
    good, bad = readers.read_json(spark, write(tmp_path / "p.json", text), readers.PROFILE_SCHEMA)
    assert sorted(r["id"] for r in good.collect()) == ["a", "c"]
    assert [r["line"] for r in bad.collect()] == ['{"id": "b", "age": }']


def test_report_and_manifest(spark, tmp_path):
    df = spark.createDataFrame([("a", 1, 2.0), ("b", 3, None)], "name string, n int, v double")
    path = writers.write_report({"s": df}, str(tmp_path / "report"), {"s": "name"})
    back = {(r["key"], r["metric"]): r["value"] for r in spark.read.schema("section string, key string, metric string, value double").json(path).collect()}
    assert back == {("a", "n"): 1.0, ("a", "v"): 2.0, ("b", "n"): 3.0, ("b", "v"): None}
    assert [tuple(r) for r in writers.export_manifest({"s": df}).collect()] == [("s", 2, 3)]


def test_model_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1.0, 2.0)], "a double, b double")
    model = Pipeline(stages=[VectorAssembler(inputCols=["a", "b"], outputCol="v")]).fit(df)
    table = df.select(F.lit("m").alias("model"))
    path = writers.save_models(table, table, model, str(tmp_path))["model"]
    assert writers.load_model(path).transform(df).first()["v"].toArray().tolist() == [1.0, 2.0]


def test_export_is_whole_or_absent(spark, tmp_path):
    """Numbers come from the writes; a table that fails leaves the earlier export as it was."""
    base = str(tmp_path / "export")
    one, two = spark.range(5).withColumn("x", F.lit("a")), spark.range(3)
    assert sorted(tuple(r) for r in writers.export_tables({"one": one, "two": two}, base).collect()) == [("one", 5, 2), ("two", 3, 1)]
    assert readers.read_table(spark, f"{base}/one").count() == 5
    broken = spark.range(2).select(F.raise_error(F.lit("broken")).alias("x"))
    with pytest.raises(Exception, match="broken"):
        writers.export_tables({"one": spark.range(9), "two": broken}, base)
    assert readers.read_table(spark, f"{base}/one").count() == 5
    assert tuple(writers.export_tables({"one": spark.range(9)}, base).first()) == ("one", 9, 1)
    assert readers.read_table(spark, f"{base}/one").count() == 9 and [p.name for p in tmp_path.iterdir() if "staging" in p.name] == []


def test_export_makes_shared_inputs_once(spark, monkeypatch):
    """Effects, lift and rates go into several exported tables: all of them are stored, and activity is counted once for all its uses."""
    from types import SimpleNamespace

    from offeranalytics.operators import features as ft
    from offeranalytics.plans import star_plans as sp

    stored, given, built = [], [], []
    plain, activity = sp.durable, ft.customer_activity
    monkeypatch.setattr(sp, "durable", lambda df: stored.append(plain(df)) or stored[-1])
    monkeypatch.setattr(ft, "customer_activity", lambda *a: built.append(1) or activity(*a))
    monkeypatch.setattr(sp.star, "export_tables", lambda *a: given.extend(a))
    profile = spark.createDataFrame([("1", 30, "M", 50000.0, 20170101), ("2", 40, "F", 60000.0, 20170201)], "id string, age int, gender string, income double, became_member_on int")
    portfolio = spark.createDataFrame([("0", "bogo", 5, 5, 7.0, ["email"])], "id string, offer_type string, difficulty int, reward int, duration double, channels array<string>")
    events = spark.createDataFrame([("1", "offer received", 0, "0", None), ("1", "offer completed", 6, "0", None), ("2", "transaction", 3, None, 9.5)],
                                   "person string, event string, time int, offer_id string, amount double")
    clusters = profile.select("id", F.lit(1).alias("cluster"))
    rules = spark.createDataFrame([(1, "bogo", None)], "cluster int, primary_offer string, secondary_offer string")
    sp._exports(SimpleNamespace(profile=profile, portfolio=portfolio, events=events, clusters=clusters, rules=rules))
    effects, lift, by_type = given[6:9]
    assert len(built) == 1 and all(any(t is s for s in stored) for t in (given[2], effects, lift, by_type))
    assert lift.first()["rule_based_completion_rate"] == 0.5 and by_type.first()["completion_rate"] == 1.0
