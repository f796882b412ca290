import os

from pyspark.sql import functions as F

from pasarlens.plans import etl
from pasarlens.sources import csv, model_store, recs_store, sinks, tables
from pasarlens.streaming.ingest import ingest_new
from pasarlens.streaming.serving import serve_stream
from tests.conftest import plan_of


def test_csv_parts_cap_and_single_file(spark, tmp_path):
    for name, numbers in (("b", (3, 4)), ("a", (1, 2)), ("c", (5, 6))):
        (tmp_path / f"{name}.csv").write_text("n,t\n" + "".join(f"{n},x{n}\n" for n in numbers))
    (tmp_path / "readme.txt").write_text("n,t\n99,no\n")
    schema = "n int, t string"
    assert sorted(r["n"] for r in csv.read_csv_parts(spark, str(tmp_path), schema).collect()) == [1, 2, 3, 4, 5, 6]
    assert [r["n"] for r in csv.read_csv_parts(spark, str(tmp_path), schema, nrows=3).collect()] == [1, 2, 3]
    assert csv.read_csv_parts(spark, str(tmp_path / "b.csv"), schema).count() == 2


def test_pruned_scan_reads_two_columns(spark, folder):
    plan = plan_of(tables.read_parquet(spark, f"{folder}/lineitem.parquet", ["l_orderkey", "l_partkey"]))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint>" in plan


def test_partitioned_sink(spark, tmp_path):
    df = spark.range(1000).select("id", F.when(F.col("id") % 3 == 0, "big").otherwise(F.concat(F.lit("p"), F.col("id") % 4)).alias("p"))
    path = str(tmp_path / "out")
    sinks.write_partitioned(df, path, ["p"], 4)
    sinks.write_partitioned(df, path, ["p"], 4)  # overwrites
    assert spark.read.parquet(path).count() == 1000
    assert {d for d in os.listdir(path) if d.startswith("p=")} == {"p=big", "p=p0", "p=p1", "p=p2", "p=p3"}


def put(spark, rows):
    return spark.createDataFrame(rows, "user_id string, recommendations array<long>, timestamp string")


def test_recs_last_write_wins(spark, tmp_path):
    path = str(tmp_path / "recs")
    recs_store.put_recs(put(spark, [("a", [1], "2024-01-02"), ("b", [2], "2024-01-01")]), path, 0)
    for _ in range(2):  # a repeated batch changes nothing
        recs_store.put_recs(put(spark, [("a", [3], "2024-01-01"), ("b", [4], "2024-01-03"), ("c", [], "2024-01-01")]), path, 1)
    want = {("a", (1,)), ("b", (4,)), ("c", ())}
    assert {(r["user_id"], tuple(r["recommendations"])) for r in recs_store.read_recs(spark, path).collect()} == want
    compacted = str(tmp_path / "compacted")
    recs_store.compact_recs(spark, path, compacted)
    assert {(r["user_id"], tuple(r["recommendations"])) for r in recs_store.read_recs(spark, compacted).collect()} == want
    old, new = put(spark, [("a", [1], "1")]), put(spark, [("a", [2], "1"), ("b", [3], "1")])
    assert {(r["user_id"], tuple(r["recommendations"])) for r in recs_store.upsert_recs(old, new).collect()} == {("a", (2,)), ("b", (3,))}


def test_ingest_takes_every_file_once(spark, tmp_path):
    source, target, progress = (str(tmp_path / p) for p in ("in", "out", "progress"))
    for start in (0, 10):
        spark.range(start, start + 10).write.mode("append").parquet(source)
        ingest_new(spark, source, target, progress, "id long")
    ingest_new(spark, source, target, progress, "id long")
    assert sorted(r["id"] for r in spark.read.parquet(target).collect()) == list(range(20))


def test_request_stream(spark, tmp_path):
    paths = {p: str(tmp_path / p) for p in ("in", "answers", "store", "progress")}
    lists = spark.createDataFrame([(1, [5, 6, 7]), (2, [8])], "user_id long, recommendations array<long>")
    batches = ([(1, '{"user_id": 1, "n": 2}'), (2, "broken")], [(3, '{"user_id": 1, "n": 1}'), (4, '{"user_id": 2}')])
    for i, rows in enumerate(batches):
        df = spark.createDataFrame(rows, "request_id long, body string")
        stamped = df.withColumn("requested_at", F.lit(f"2024-01-0{i + 1} 00:00:00").cast("timestamp_ntz"))
        stamped.coalesce(1).write.mode("append").parquet(paths["in"])
        serve_stream(spark, paths["in"], lists, paths["answers"], paths["store"], paths["progress"], "2024-02-01")
    answers = {r["request_id"]: r["status"] for r in spark.read.parquet(paths["answers"]).collect()}
    assert answers == {1: 200, 2: 400, 3: 200, 4: 200}
    stored = {(r["user_id"], tuple(r["recommendations"])) for r in recs_store.read_recs(spark, paths["store"]).collect()}
    assert stored == {("1", (5,)), ("2", (8,))}


def test_model_store_and_registry(spark, tmp_path):
    from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel

    from pasarlens.operators.prep import assemble

    df = assemble(spark.createDataFrame([(0.0, 0), (1.0, 0), (2.0, 1), (3.0, 1)], "x double, label int"), ["x"])
    model = LogisticRegression().fit(df)
    root = str(tmp_path / "models")
    path = model_store.save_model(spark, model, "m", {"auc": 0.5, "none": None}, root, "20240101_000000", {"f": ["x"]})
    assert LogisticRegressionModel.load(path).coefficients == model.coefficients
    line = model_store.saved_models(spark, root).first()
    assert (line["name"], line["metrics"], line["path"]) == ("m", {"auc": 0.5}, path)
    registry = model_store.model_registry(spark, [{"task": "t", "model": "m", "key_metric": "AUC = 0.5", "path": path}])
    model_store.write_registry(registry, f"{root}/registry")
    assert model_store.read_registry(spark, f"{root}/registry").first()["key_metric"] == "AUC = 0.5"


def test_pair_matrix_sides(spark):
    ui = spark.createDataFrame(
        [(1, 1, 1, "view", 1, "2024-01-01 00:00:00"), (2, 1, 2, "purchase", 7, "2024-01-02 00:00:00")],
        "interaction_id long, user_id long, product_id long, interaction_type string, implicit_score int, timestamp string",
    ).withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    th = spark.createDataFrame(
        [(1, 1, 2, "paid", 10.0, 2), (2, 1, 3, "paid", 5.0, 1), (3, 1, 1, "pending", 9.0, 1)],
        "transaction_id long, user_id long, product_id long, payment_status string, total_idr double, quantity int",
    ).withColumn("timestamp", F.lit("2024-01-03 00:00:00").cast("timestamp_ntz"))
    got = {r["product_id"]: r for r in etl.user_product_matrix(ui, th, "2024-01-11").collect()}
    assert set(got) == {1, 2}
    assert (got[1]["n_transactions"], got[1]["last_purchase_ts"], got[1]["has_purchased"]) == (0, None, 0)
    assert (got[2]["total_spend_on_product"], got[2]["days_since_last"], got[2]["has_purchased"]) == (10.0, 9, 1)
    full = etl.user_product_matrix(ui, th, "2024-01-11", how="full")
    assert {r["product_id"] for r in full.collect()} == {1, 2, 3}


def test_csv_text_with_quotes_commas_and_line_breaks(spark, tmp_path):
    import pandas as pd

    rows = [(1, 'he said "good", ok', 5), (2, "two\nlines, one \"\"", 4), (3, "back\\slash", 3), (4, None, 2)]
    whole = pd.DataFrame(rows, columns=["id", "text", "rating"])
    whole.iloc[:2].to_csv(tmp_path / "a.csv", index=False)
    whole.iloc[2:][["rating", "text", "id"]].assign(extra=1).to_csv(tmp_path / "b.csv", index=False)
    whole.iloc[:1][["id"]].assign(id=9).to_csv(tmp_path / "c.csv", index=False)
    got = csv.read_csv_parts(spark, str(tmp_path), "id int, text string, rating int")
    assert sorted(map(tuple, got.collect())) == rows + [(9, None, None)]
    first = csv.read_csv_parts(spark, str(tmp_path), "id int, text string, rating int", nrows=3)
    assert sorted(r["id"] for r in first.collect()) == [1, 2, 3]
    assert csv.read_csv_parts(spark, str(tmp_path), "id int", nrows=99).count() == 5
