"""Incremental scoring of customers as their events arrive (Structured Streaming with keyed state).

The state holds one row for each customer that has no prediction yet: what the scorer reads of it.  It is
filled once, from one pass over customers and predictions, when the query starts from nothing.  An event
looks up its own key: a customer still in the state is passed on and leaves it, any other event adds
nothing, so only a customer's first event reaches the state's processor.  A micro-batch therefore reads
neither the customer table nor the predictions; it scores and appends the customers that were passed on,
with ids that continue from the last batch.

Events are never dropped as late: files arrive in modification-time order, not event-time order, so a
watermark would lose customers whose events all stand in a late file.  The customers' state only shrinks;
the ids whose first event has passed, one long each, are kept beside it.

After a restart the first micro-batch may repeat one whose rows were already appended, so that batch
alone is checked against the predictions of its own ids.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from churnlens.plans.scoring import RULE_MODEL_VERSION, Scorer, fetch_new, rule_scorer, to_prediction_rows
from churnlens.session import ship_package
from churnlens.sources import store

EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])


def arriving_customers(spark: SparkSession, events_dir: str, files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(EVENTS_SCHEMA)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    events = reader.parquet(events_dir)
    return events.where(F.col("user_id").isNotNull()).select(F.col("user_id").alias("customer_id"))


#: Keyed state of any size lives in RocksDB on the executors and is backed up to the checkpoint folder.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Unscored(StatefulProcessor):
    """Passes a customer on at its first event, if it is among those without a prediction.

    Keys come as plain rows: a frame for each customer would cost many times what the state does."""

    def __init__(self, schema: T.StructType):
        self.schema = schema

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.row = handle.getValueState("customer", self.schema)

    def handleInitialState(self, key, initialState: Row, timerValues) -> None:
        self.row.update(tuple(initialState))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        for _ in rows:
            pass
        found = self.row.get()
        if found is not None:
            self.row.clear()
            yield Row(**dict(zip(self.schema.names, found)))

    def close(self) -> None:
        pass


def stream_scoring(spark: SparkSession, events_dir: str, customers: DataFrame, predictions_path: str,
                   checkpoint: str, scorer: Scorer = rule_scorer, model_version: str = RULE_MODEL_VERSION,
                   files_per_trigger: int | None = None):
    """Run until all available events are consumed (``availableNow``); returns the finished query.

    ``customers`` is one row a customer (``customer_id`` and what the scorer reads); those that the
    predictions do not hold when the query first starts are the ones that it will score."""
    ship_package(spark)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    predictions = spark.read.parquet(predictions_path)
    # One pass at the start: customers without a prediction, and the last id given.
    waiting = fetch_new(customers, predictions)
    progress = {"last": predictions.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0], "checked": False}

    def per_batch(batch: DataFrame, epoch_id: int) -> None:
        new = batch.persist()
        if not progress["checked"]:
            ids = new.select("customer_id")
            new = fetch_new(new, spark.read.parquet(predictions_path).select("customer_id").join(ids, "customer_id", "left_semi"))
            progress["checked"] = True
        rows = to_prediction_rows(scorer(new), progress["last"], model_version)
        progress["last"] += store.insert_dataframe(rows, predictions_path, "append", table="predictions")
        batch.unpersist()

    passed = (
        arriving_customers(spark, events_dir, files_per_trigger)
        .dropDuplicates(["customer_id"])  # later events of a customer add nothing
        .groupBy("customer_id")
        .transformWithState(
            statefulProcessor=Unscored(customers.schema), outputStructType=customers.schema, outputMode="Append", timeMode="None",
            initialState=waiting.select(*customers.columns).groupBy("customer_id"),
        )
    )
    q = (
        passed.writeStream.foreachBatch(per_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return q
