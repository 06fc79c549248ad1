"""Fitted preprocessing invariants, persistence round trip, scoring idempotence, stream == batch."""

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from churnlens.operators import preprocess as PP
from churnlens.operators import ranking as R
from churnlens.plans import scoring as SC
from churnlens.session import scratch_path
from churnlens.sources import store
from churnlens.sources.fixture import bank_customers, scored_predictions

from conftest import SF_SMALL


def _split(spark):
    return PP.with_label(R.stratified_split(bank_customers(spark, SF_SMALL)))


def test_scaler_population_mean_zero_std_one(spark):
    df = PP.ProdFeatures().transform(_split(spark)).where("split = 'train'")
    out = [f"{c}_s" for c in PP.PROD_SCALED]
    t = PP.ColumnScaler(inputCols=list(PP.PROD_SCALED), outputCols=out).fit(df).transform(df)
    r = t.agg(*[F.avg(c).alias(f"m_{c}") for c in out], *[F.stddev_pop(c).alias(f"s_{c}") for c in out]).first()
    for c in out:
        assert abs(r[f"m_{c}"]) < 1e-9
        assert abs(r[f"s_{c}"] - 1) < 1e-9 or r[f"s_{c}"] == 0


def test_zero_variance_divides_by_one(spark):
    df = spark.createDataFrame([(5.0,), (5.0,)], "x double")
    out = PP.ColumnScaler(inputCols=["x"], outputCols=["y"]).fit(df).transform(df)
    assert [r.y for r in out.collect()] == [0.0, 0.0]


def test_one_hot_unseen_category_is_all_zero(spark):
    from pyspark.ml import Pipeline

    train = spark.createDataFrame([("France", "Male"), ("Spain", "Female")], "Geography string, Gender string")
    test = spark.createDataFrame([("Mars", "Male")], "Geography string, Gender string")
    m = Pipeline(stages=PP.one_hot_stages(["Geography", "Gender"])).fit(train)
    r = m.transform(test).select(vector_to_array("Geography_ohe").alias("g"), vector_to_array("Gender_ohe").alias("s")).first()
    assert r.g == [0.0, 0.0] and r.s == [0.0, 1.0]


def test_prod_matrix_shape_and_onehot_sums(spark):
    df = _split(spark)
    m = PP.prod_preprocessor().fit(df.where("split = 'train'"))
    arr = m.transform(df).select(vector_to_array("features").alias("f")).toPandas()["f"]
    mat = np.vstack(arr.to_numpy())
    assert mat.shape[1] == 17
    assert (mat[:, 9:12].sum(axis=1) <= 1).all() and (mat[:, 12:14].sum(axis=1) <= 1).all()


def test_v2_pipeline_names_and_persistence(spark):
    df = _split(spark)
    m = PP.v2_preprocessor().fit(df.where("split = 'train'"))
    names = PP.feature_names(m)
    assert len(names) == 28 and names[-1] == "RiskScore_scaled"
    path = scratch_path(spark, "pp-test")
    m.write().overwrite().save(path)
    back = PipelineModel.load(path)
    a = np.vstack(m.transform(df).orderBy("CustomerId").select(vector_to_array("features").alias("f")).toPandas()["f"])
    b = np.vstack(back.transform(df).orderBy("CustomerId").select(vector_to_array("features").alias("f")).toPandas()["f"])
    assert np.allclose(a, b)


def test_batch_scoring_idempotent(spark):
    path = scratch_path(spark, "pred-test")
    store.insert_dataframe(scored_predictions(spark, SF_SMALL), path, "replace", table="predictions")
    td = store.test_data(spark, SF_SMALL)
    first = SC.batch_scoring(spark, td, path, scratch_path(spark, "td"))
    assert first.rows_appended > 0
    assert first.alerts.where("churn_probability <= 0.7").count() == 0
    assert first.test_data.where("is_scored = 1").count() == first.rows_appended
    second = SC.batch_scoring(spark, td, path, scratch_path(spark, "td"))
    assert second.rows_appended == 0


def test_stream_equals_batch_on_event_customers(spark):
    from churnlens.plans.registry import QUERIES, load_all

    load_all()
    streamed = QUERIES["stream_scoring"](spark, SF_SMALL).select("customer_id", "churn_probability")
    batch = QUERIES["batch_scoring"](spark, SF_SMALL).select("customer_id", "churn_probability")
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet").select(F.col("user_id").alias("customer_id")).distinct()
    expected = batch.join(events, "customer_id", "left_semi")
    assert sorted(streamed.collect()) == sorted(expected.collect())


def test_stream_scores_customers_whose_events_arrive_late(spark):
    # A file with recent events is consumed before one with much older events: the older file's
    # customers must still be scored (no event is dropped as late).
    import time

    from churnlens.streaming.scoring import EVENTS_SCHEMA, stream_scoring

    path = scratch_path(spark, "predictions")
    store.insert_dataframe(scored_predictions(spark, SF_SMALL), path, "replace", table="predictions")
    customers = store.test_data(spark, SF_SMALL)
    new_ids = [r.customer_id for r in SC.fetch_new(customers, spark.read.parquet(path)).orderBy("customer_id").limit(3).collect()]
    events_dir = scratch_path(spark, "events")
    # Three micro-batches: a stateful late-row filter only takes effect from the third one.
    times = ("2030-01-01 00:00:00", "2030-01-02 00:00:00", "2001-01-01 00:00:00")
    for cid, ts in zip(new_ids, times):
        row = spark.createDataFrame([(1, ts, cid, "view", 1.0, "")], "event_id long, ts string, user_id long, event_type string, value double, props string")
        row.select(*[F.col(f.name).cast(f.dataType) for f in EVENTS_SCHEMA.fields]).coalesce(1).write.mode("append").parquet(events_dir)
        time.sleep(1.5)  # distinct modification times fix the consumption order
    stream_scoring(spark, events_dir, customers, path, scratch_path(spark, "stream-ckpt"), files_per_trigger=1)
    scored = {r.customer_id for r in spark.read.parquet(path).where(F.col("customer_id").isin(new_ids)).collect()}
    assert scored == set(new_ids)


def test_stream_repeats_no_batch_after_a_crash(spark):
    # The last micro-batch was appended but its commit got lost: a restart runs it again and adds nothing.
    import os

    from churnlens.streaming.scoring import EVENTS_SCHEMA, stream_scoring

    path, events_dir, ckpt = (scratch_path(spark, n) for n in ("predictions", "events", "stream-ckpt"))
    store.insert_dataframe(scored_predictions(spark, SF_SMALL), path, "replace", table="predictions")
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").select(*[F.col(f.name).cast(f.dataType) for f in EVENTS_SCHEMA.fields])
    ev.repartition(3).write.parquet(events_dir)
    run = lambda: stream_scoring(spark, events_dir, store.test_data(spark, SF_SMALL), path, ckpt, files_per_trigger=1)
    run()
    once = spark.read.parquet(path)
    n = once.count()
    assert once.select("customer_id").distinct().count() == scored_predictions(spark, SF_SMALL).select("customer_id").union(once.select("customer_id")).distinct().count()
    commits = ckpt.removeprefix("file:") + "/commits"
    last = max((f for f in os.listdir(commits) if f.isdigit()), key=int)
    for f in (last, f".{last}.crc"):
        if os.path.exists(f"{commits}/{f}"):
            os.remove(f"{commits}/{f}")
    run()
    again = spark.read.parquet(path)
    assert again.count() == n and again.select("id").distinct().count() == n


def test_stream_passes_a_customers_first_event_only(spark):
    # Thirty events of one customer in two files: one reaches the keyed state, the customer is scored once.
    from churnlens.streaming.scoring import EVENTS_SCHEMA, stream_scoring

    path, events_dir = scratch_path(spark, "predictions"), scratch_path(spark, "events")
    store.insert_dataframe(scored_predictions(spark, SF_SMALL), path, "replace", table="predictions")
    customers = store.test_data(spark, SF_SMALL)
    cid = SC.fetch_new(customers, spark.read.parquet(path)).first()["customer_id"]
    row = spark.range(30).select(F.col("id").alias("event_id"), F.lit("2030-01-01").alias("ts"), F.lit(cid).alias("user_id"),
                                 F.lit("view").alias("event_type"), F.lit(1.0).alias("value"), F.lit("").alias("props"))
    row.select(*[F.col(f.name).cast(f.dataType) for f in EVENTS_SCHEMA.fields]).repartition(2).write.parquet(events_dir)
    q = stream_scoring(spark, events_dir, customers, path, scratch_path(spark, "stream-ckpt"), files_per_trigger=1)
    operators = [o for p in q.recentProgress for o in p["stateOperators"] if o["operatorName"].startswith("dedupe")]
    assert sum(o["customMetrics"]["numDroppedDuplicateRows"] for o in operators) == 29
    assert spark.read.parquet(path).where(F.col("customer_id") == cid).count() == 1


def test_store_write_then_logistic_regression_scoring(spark):
    # A store write followed by logistic-regression scoring in the same session must work
    # (nothing on the write path may leave unserializable state on the session).
    from pyspark.ml.classification import LogisticRegression

    path = scratch_path(spark, "predictions")
    assert store.insert_dataframe(scored_predictions(spark, SF_SMALL), path, "replace", table="predictions") > 0
    df = _split(spark)
    feats = PP.prod_preprocessor().fit(df.where("split = 'train'")).transform(df)
    model = LogisticRegression(maxIter=5).fit(feats.where("split = 'train'"))
    assert model.transform(feats).select(vector_to_array("probability")[1].alias("p")).where("p >= 0 AND p <= 1").count() == feats.count()


def test_models_train_and_score(spark):
    from churnlens.operators import models as ML
    from pyspark.ml.classification import GBTClassifier

    df = _split(spark)
    pre = PP.prod_preprocessor().fit(df.where("split = 'train'"))
    feats = pre.transform(df)
    model = GBTClassifier(maxIter=5, maxDepth=3, seed=42).fit(feats.where("split = 'train'"))
    m = {r.split: r for r in ML.evaluate_model(model, feats).collect()}
    assert m["train"].roc_auc_prob > 0.5
    p = ML.positive_score(model.transform(feats)).agg(F.min("score"), F.max("score")).first()
    assert 0.0 <= p[0] <= p[1] <= 1.0
    again = GBTClassifier(maxIter=5, maxDepth=3, seed=42).fit(feats.where("split = 'train'"))
    assert ML.evaluate_model(again, feats).orderBy("split").collect() == ML.evaluate_model(model, feats).orderBy("split").collect()


def test_entry_smoke(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 5 and df.columns == ["segment", "size", "churn_pct", "lift"]
