"""Store and governance: ids, refusals, recovery after a crash, promotion by model."""

import os
import subprocess
import sys

import pytest
from conftest import ROOT, SF_SMALL
from pyspark.sql import functions as F

from churnlens import session
from churnlens.operators import evaluate as E
from churnlens.operators import governance as G
from churnlens.operators.preprocess import DropFirstOneHot
from churnlens.plans import scoring
from churnlens.session import scratch_path
from churnlens.sources import store
from churnlens.sources.fixture import scored_predictions


def test_create_tables_leaves_other_tables_alone(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS elsewhere_db")
    spark.range(3).write.mode("overwrite").saveAsTable("elsewhere_db.predictions")
    root = scratch_path(spark, "store")
    store.create_tables(spark, root)
    store.create_tables(spark, root)
    assert spark.table("elsewhere_db.predictions").count() == 3
    spark.sql("DROP DATABASE elsewhere_db CASCADE")


def test_rows_written_are_those_of_the_append(spark):
    path = scratch_path(spark, "rows")
    assert store.insert_dataframe(spark.range(5), path, "append") == 5
    assert store.insert_dataframe(spark.range(7), path, "append") == 7
    assert store.insert_dataframe(spark.range(2), path, "replace") == 2


def test_ids_are_consecutive(spark):
    df = spark.createDataFrame([(i, "x") for i in (5, 3, 9)], "k int, v string")
    assert sorted((r["k"], r["id"]) for r in store.with_ids(df, "k", start=10).collect()) == [(3, 11), (5, 12), (9, 13)]


def test_scoring_recovers_after_a_crash_before_marking(spark):
    path, marked = scratch_path(spark, "predictions"), scratch_path(spark, "marked")
    store.insert_dataframe(scored_predictions(spark, SF_SMALL), path, "replace", table="predictions")
    test = store.test_data(spark, SF_SMALL)
    scoring.score_and_append(spark, test, path, scoring.rule_scorer)  # stops here
    again = scoring.batch_scoring(spark, test, path, marked)
    assert again.rows_appended == 0
    left = again.test_data.where("is_scored = 0").select("customer_id")
    written = spark.read.parquet(path).where(F.col("model_version") == scoring.RULE_MODEL_VERSION).select("customer_id")
    assert written.count() > 0 and left.join(written, "customer_id").count() == 0


def test_promotion_stays_within_the_model(spark):
    schema = "model_name string, version int, run_id string, f1 double, stage string"
    registry = spark.createDataFrame([("other", 9, "a", 0.9, "Production"), ("m", 1, "b", 0.7, "Production"), ("m", 2, "c", 0.6, "Staging")], schema)
    new = spark.createDataFrame([("d", 0.95)], "run_id string, f1 double")
    rows = {(r["model_name"], r["version"]): r["stage"] for r in G.promote(registry, new, "m", manual_review=False).collect()}
    assert rows == {("other", 9): "Production", ("m", 1): "Archived", ("m", 2): "Staging", ("m", 3): "Production"}
    held = {(r["model_name"], r["version"]): r["stage"] for r in G.promote(registry, new, "m", manual_review=True).collect()}
    assert held[("m", 3)] == "Staging" and held[("m", 1)] == "Production"


def test_first_deployment(spark):
    row = E.champion_challenger(None, spark.createDataFrame([(0.625,)], "f1 double")).first()
    assert (row["current_f1"], row["improvement"], row["accepted"]) == (0.0, 0.625, 1)


def test_one_hot_of_a_single_category(spark):
    df = spark.createDataFrame([("a",), ("a",)], "c string")
    out = DropFirstOneHot(inputCol="c", outputCol="o").fit(df).transform(df)
    assert {r["o"].size for r in out.collect()} == {0}


def test_no_scratch_on_one_machine_of_a_cluster():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default):
                return default

    with pytest.raises(ValueError):
        session.checkpoint_dir(Session())


def test_workers_get_the_package(tmp_path):
    """From a foreign folder, with the package on the driver's path only."""
    code = (
        f"import sys; sys.path.insert(0, {ROOT!r})\n"
        "from churnlens.session import get_session\nimport __spark_entry__ as e\n"
        "s = get_session('local[2]', 2)\n"
        f"print('ROWS', e.queries()['ecdf'](s, {SF_SMALL!r}).count())\n"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "ROWS" in done.stdout, done.stderr[-2000:]


def test_append_counts_its_own_rows_and_snapshots_survive_a_broken_write(spark):
    import os

    from churnlens.sources import files

    path = scratch_path(spark, "counted")
    assert store.insert_dataframe(spark.range(5), path, "append") == 5
    spark.range(100).write.mode("append").parquet(path)  # another writer
    assert store.insert_dataframe(spark.range(3), path, "append") == 3
    assert spark.read.parquet(path).count() == 108
    assert not [f for f in os.listdir(path.removeprefix("file:")) if f.startswith("_append")]

    root = scratch_path(spark, "snapshots")
    assert files.latest_snapshot(spark, root) is None
    files.write_snapshot(spark.range(4), root)
    second = files.write_snapshot(spark.range(6), root)
    assert files.latest_snapshot(spark, root).removeprefix("file:") == second.removeprefix("file:")
    third = files.write_snapshot(spark.range(8), root)
    os.remove(f"{third.removeprefix('file:')}/_SUCCESS")  # stopped before it was whole
    assert spark.read.parquet(files.latest_snapshot(spark, root)).count() == 6
