"""Evaluation and governance queries on the deterministic risk-score rule model.

The rule (predict churn iff RiskScore >= threshold, score = RiskScore) makes every metric exactly
reproducible in SQL; fitted models use the same operators in ``q_models``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from churnlens.functions import features as FX
from churnlens.operators import evaluate as E
from churnlens.operators import governance as G
from churnlens.operators import ranking as R
from churnlens.plans.oracle_base import with_ctes
from churnlens.plans.registry import query
from churnlens.session import scratch_path
from churnlens.sources import files, store
from churnlens.sources.fixture import bank_customers

RULE_THRESHOLD = 4.0
CHALLENGER_THRESHOLD = 3.0
CANDIDATE_THRESHOLDS = (2.0, 3.0, 4.0, 5.0, 6.0)
RUN_EPOCH = 1704067200  # 2024-01-01 00:00:00 UTC; run k starts k*10 minutes later


def scored(spark, sf_dir, threshold: float = RULE_THRESHOLD):
    df = FX.risk_score(R.stratified_split(bank_customers(spark, sf_dir)))
    return df.select(
        "CustomerId", "split", F.col("Exited").alias("label"), F.col("RiskScore").alias("score"),
        (F.col("RiskScore") >= threshold).cast("int").alias("prediction"),
    )


def candidates(spark, sf_dir):
    """Leaderboard: the rule at several thresholds, scored on the test split in one pass."""
    s = FX.risk_score(R.stratified_split(bank_customers(spark, sf_dir))).where(F.col("split") == "test")
    fanned = s.select(
        F.col("Exited").alias("label"),
        F.col("RiskScore").alias("score"),
        F.explode(F.array(*[F.lit(t) for t in CANDIDATE_THRESHOLDS])).alias("threshold"),
    ).withColumn("prediction", (F.col("score") >= F.col("threshold")).cast("int"))
    m = E.classification_metrics(fanned, keys=["threshold"])
    idx = F.array_position(F.array(*[F.lit(t) for t in CANDIDATE_THRESHOLDS]), F.col("threshold"))
    return m.select(
        F.concat(F.lit("rule_t"), F.format_number("threshold", 1)).alias("run_id"),
        F.date_format(F.timestamp_seconds(F.lit(RUN_EPOCH) + idx * 600), "yyyy-MM-dd HH:mm:ss").alias("start_time"),
        "threshold", "n", "accuracy", "precision", "recall", "f1", "roc_auc",
    )


def _scored_sql(threshold: float = RULE_THRESHOLD) -> str:
    return f"""scored AS (
  SELECT r.CustomerId, s.split, r.Exited AS label, r.RiskScore AS score, CAST(r.RiskScore >= {threshold} AS INT) AS prediction
  FROM risk r JOIN split_customers s ON s.CustomerId = r.CustomerId)"""


def _cm_sql(src: str, keys: str = "") -> str:
    sel = f"{keys}, " if keys else ""
    grp = f" GROUP BY {keys}" if keys else ""
    return f"""SELECT {sel}CAST(count_if(label = 0 AND prediction = 0) AS BIGINT) AS tn, CAST(count_if(label = 0 AND prediction = 1) AS BIGINT) AS fp,
       CAST(count_if(label = 1 AND prediction = 0) AS BIGINT) AS fn, CAST(count_if(label = 1 AND prediction = 1) AS BIGINT) AS tp FROM {src}{grp}"""


def _metrics_sql(src: str, keys: str = "") -> str:
    sel = f"{keys}, " if keys else ""
    return f"""SELECT {sel}CAST(tn + fp + fn + tp AS BIGINT) AS n,
  round(CASE WHEN tn + fp + fn + tp = 0 THEN 0.0 ELSE (tp + tn) / (tn + fp + fn + tp) END, 6) AS accuracy,
  round(CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END, 6) AS precision,
  round(CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END, 6) AS recall,
  round(CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE 2 * tp / (2 * tp + fp + fn) END, 6) AS f1,
  round(CASE WHEN tp + fn = 0 OR tn + fp = 0 THEN 0.0 ELSE (tp / (tp + fn) + tn / (tn + fp)) / 2 END, 6) AS roc_auc
FROM ({_cm_sql(src, keys)}) cm"""


_SC = _scored_sql()


@query("confusion_matrix", with_ctes(_cm_sql("scored", "split"), "SPLIT", "RISK", extra=_SC))
def q_confusion_matrix(spark, sf_dir):
    return E.confusion(scored(spark, sf_dir), keys=["split"])


@query("classification_metrics", with_ctes(_metrics_sql("scored", "split"), "SPLIT", "RISK", extra=_SC))
def q_classification_metrics(spark, sf_dir):
    return E.classification_metrics(scored(spark, sf_dir), keys=["split"])


@query(
    "roc_auc_prob",
    with_ctes(
        """SELECT split, round(sum(pos * (cum_neg - neg + 0.5 * neg)) / (sum(pos) * sum(neg)), 6) AS roc_auc
FROM (SELECT split, score, pos, neg, sum(neg) OVER (PARTITION BY split ORDER BY score) AS cum_neg
      FROM (SELECT split, score, CAST(count_if(label = 1) AS BIGINT) AS pos, CAST(count_if(label = 0) AS BIGINT) AS neg FROM scored GROUP BY split, score) c) t
GROUP BY split""",
        "SPLIT",
        "RISK",
        extra=_SC,
    ),
)
def q_roc_auc_prob(spark, sf_dir):
    return E.auc_from_scores(scored(spark, sf_dir), keys=["split"])


@query(
    "roc_curve",
    with_ctes(
        """SELECT split, threshold, round(sum(fp_at) OVER w / sum(fp_at) OVER (PARTITION BY split), 6) AS fpr,
       round(sum(tp_at) OVER w / sum(tp_at) OVER (PARTITION BY split), 6) AS tpr
FROM (SELECT split, score AS threshold, CAST(count_if(label = 1) AS BIGINT) AS tp_at, CAST(count_if(label = 0) AS BIGINT) AS fp_at FROM scored GROUP BY split, score) c
WINDOW w AS (PARTITION BY split ORDER BY threshold DESC)""",
        "SPLIT",
        "RISK",
        extra=_SC,
    ),
)
def q_roc_curve(spark, sf_dir):
    return E.roc_curve(scored(spark, sf_dir), keys=["split"])


def _report_sql() -> str:
    return with_ctes(
        """SELECT class, round(p, 4) AS precision, round(r, 4) AS recall, round(f, 4) AS f1_score, CAST(s AS BIGINT) AS support
FROM (SELECT *, tn + fp + fn + tp AS n,
        CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END AS p1, CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END AS r1,
        CASE WHEN tn + fn = 0 THEN 0.0 ELSE tn / (tn + fn) END AS p0, CASE WHEN tn + fp = 0 THEN 0.0 ELSE tn / (tn + fp) END AS r0,
        CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE 2 * tp / (2 * tp + fp + fn) END AS f1_1,
        CASE WHEN 2 * tn + fn + fp = 0 THEN 0.0 ELSE 2 * tn / (2 * tn + fn + fp) END AS f1_0,
        tp + fn AS s1, tn + fp AS s0 FROM cm) c,
LATERAL (SELECT '0' AS class, p0 AS p, r0 AS r, f1_0 AS f, s0 AS s
         UNION ALL SELECT '1', p1, r1, f1_1, s1
         UNION ALL SELECT 'accuracy', (tp + tn) / n, (tp + tn) / n, (tp + tn) / n, n
         UNION ALL SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f1_0 + f1_1) / 2, n
         UNION ALL SELECT 'weighted avg', (p0 * s0 + p1 * s1) / n, (r0 * s0 + r1 * s1) / n, (f1_0 * s0 + f1_1 * s1) / n, n) x""",
        "SPLIT",
        "RISK",
        extra=_SC + ",\ncm AS (" + _cm_sql("(SELECT * FROM scored WHERE split = 'test')") + ")",
    )


@query("classification_report", _report_sql())
def q_classification_report(spark, sf_dir):
    return E.classification_report(scored(spark, sf_dir).where(F.col("split") == "test"))


@query(
    "business_metrics",
    with_ctes(
        """SELECT tn AS true_negatives, fp AS false_positives, fn AS false_negatives, tp AS true_positives,
  round((tp + fn) / (tn + fp + fn + tp), 6) AS actual_churn_rate, round((tp + fp) / (tn + fp + fn + tp), 6) AS predicted_churn_rate,
  round(CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END, 6) AS churn_capture_rate,
  round(CASE WHEN fp + tn = 0 THEN 0.0 ELSE fp / (fp + tn) END, 6) AS false_alarm_rate,
  round(CASE WHEN tp + fn = 0 THEN 0.0 ELSE fn / (tp + fn) END, 6) AS missed_churn_rate
FROM cm""",
        "SPLIT",
        "RISK",
        extra=_SC + ",\ncm AS (" + _cm_sql("(SELECT * FROM scored WHERE split = 'test')") + ")",
    ),
)
def q_business_metrics(spark, sf_dir):
    return E.business_metrics(scored(spark, sf_dir).where(F.col("split") == "test"))


_GAP = _SC + ",\nm AS (" + _metrics_sql("scored", "split") + """),
g AS (SELECT max(f1) FILTER (WHERE split = 'train') AS train_f1, max(f1) FILTER (WHERE split = 'test') AS test_f1,
             max(accuracy) FILTER (WHERE split = 'train') AS train_acc, max(accuracy) FILTER (WHERE split = 'test') AS test_acc FROM m)"""


@query(
    "train_test_gap",
    with_ctes(
        """SELECT train_f1, test_f1, round(abs(train_f1 - test_f1), 6) AS f1_gap, round(abs(train_acc - test_acc), 6) AS accuracy_gap,
       CAST(abs(train_f1 - test_f1) > 0.5 OR abs(train_acc - test_acc) > 0.5 AS INT) AS is_overfit FROM g""",
        "SPLIT",
        "RISK",
        extra=_GAP,
    ),
)
def q_train_test_gap(spark, sf_dir):
    return E.train_test_gap(E.classification_metrics(scored(spark, sf_dir), keys=["split"]))


@query(
    "quality_gates",
    with_ctes(
        """SELECT test_f1, round(abs(train_f1 - test_f1), 6) AS f1_gap, CAST(test_f1 >= 0.6 AS INT) AS passed,
       CAST(round(abs(train_f1 - test_f1), 6) > 0.05 AS INT) AS overfit_warning FROM g""",
        "SPLIT",
        "RISK",
        extra=_GAP,
    ),
)
def q_quality_gates(spark, sf_dir):
    return E.quality_gates(E.train_test_gap(E.classification_metrics(scored(spark, sf_dir), keys=["split"])))


_CC = (
    _scored_sql(RULE_THRESHOLD)
    + ",\nscored_new AS (SELECT CustomerId, split, label, score, CAST(score >= "
    + str(CHALLENGER_THRESHOLD)
    + " AS INT) AS prediction FROM scored),\n"
    + "cur AS ("
    + _metrics_sql("(SELECT * FROM scored WHERE split = 'test')")
    + "),\nnew AS ("
    + _metrics_sql("(SELECT * FROM scored_new WHERE split = 'test')")
    + ")"
)


@query(
    "champion_challenger",
    with_ctes(
        """SELECT new.f1 AS new_f1, cur.f1 AS current_f1, round(new.f1 - cur.f1, 6) AS improvement,
       CASE WHEN cur.f1 IS NULL OR new.f1 - cur.f1 > 0.02 THEN 1 ELSE 0 END AS accepted FROM new LEFT JOIN cur ON true""",
        "SPLIT",
        "RISK",
        extra=_CC,
    ),
)
def q_champion_challenger(spark, sf_dir):
    by_rule = candidates(spark, sf_dir).select("threshold", "f1")  # one split, one pass for all thresholds
    current, new = (by_rule.where(F.col("threshold") == t) for t in (RULE_THRESHOLD, CHALLENGER_THRESHOLD))
    return E.champion_challenger(current, new)


def _cand_sql() -> str:
    rows = []
    for i, t in enumerate(CANDIDATE_THRESHOLDS, start=1):
        rows.append(
            f"SELECT 'rule_t{t:.1f}' AS run_id, strftime(TIMESTAMP '2024-01-01 00:00:00' + INTERVAL ({i * 10}) MINUTE, '%Y-%m-%d %H:%M:%S') AS start_time, "
            f"CAST({t} AS DOUBLE) AS threshold, m.* FROM ({_metrics_sql(f'(SELECT label, CAST(score >= {t} AS INT) AS prediction FROM scored WHERE split = {chr(39)}test{chr(39)})')}) m"
        )
    return "cand AS (" + "\nUNION ALL ".join(rows) + ")"


_CAND = _SC + ",\n" + _cand_sql()


@query("best_model", with_ctes("SELECT *, row_number() OVER (ORDER BY f1 DESC, run_id) AS rank FROM cand", "SPLIT", "RISK", extra=_CAND))
def q_best_model(spark, sf_dir):
    return G.best_model(candidates(spark, sf_dir))


@query(
    "latest_run",
    with_ctes("SELECT run_id, start_time, run_id AS best_model FROM cand ORDER BY start_time DESC, run_id DESC LIMIT 1", "SPLIT", "RISK", extra=_CAND),
)
def q_latest_run(spark, sf_dir):
    runs = candidates(spark, sf_dir).select("run_id", "start_time", F.col("run_id").alias("best_model"))
    return G.latest_run(runs)


_LOGGED = (("threshold", "param"), *((m, "metric") for m in ("accuracy", "precision", "recall", "f1", "roc_auc")))


@query(
    "experiment_log",
    with_ctes(
        "\nUNION ALL ".join(
            f"SELECT run_id, start_time, '{k}' AS key, '{kind}' AS kind, CAST({k} AS VARCHAR) AS value FROM cand" for k, kind in _LOGGED
        ),
        "SPLIT",
        "RISK",
        extra=_CAND,
    ),
)
def q_experiment_log(spark, sf_dir):
    """The runs appended to a log table, read back."""
    names = {kind: [k for k, of in _LOGGED if of == kind] for kind in ("param", "metric")}
    path = scratch_path(spark, "experiment_log")
    store.insert_dataframe(G.run_log(candidates(spark, sf_dir), names["param"], names["metric"]), path, "append")
    return spark.read.parquet(path)


@query(
    "promote_model",
    with_ctes(
        """SELECT 'AttritionRule' AS model_name, CAST(row_number() OVER (ORDER BY threshold) AS INT) AS version, run_id, f1,
       'None' AS stage FROM cand
UNION ALL
SELECT * FROM (SELECT 'AttritionRule', CAST((SELECT count(*) FROM cand) + 1 AS INT), run_id, f1, 'Staging'
               FROM cand ORDER BY f1 DESC, run_id LIMIT 1) b""",
        "SPLIT",
        "RISK",
        extra=_CAND,
    ),
)
def q_promote_model(spark, sf_dir):
    from pyspark.sql import Window

    cand = candidates(spark, sf_dir)
    # The registry before this run: one version per earlier candidate (bounded, tiny frame).
    registry = cand.select(
        F.lit("AttritionRule").alias("model_name"),
        F.row_number().over(Window.orderBy("threshold")).cast("int").alias("version"),
        "run_id", "f1", F.lit("None").alias("stage"),
    )
    best = G.best_model(cand).where(F.col("rank") == 1)
    return G.promote(registry, best, "AttritionRule", manual_review=True)


@query(
    "promote_production",
    with_ctes(
        """SELECT 'AttritionRule' AS model_name, CAST(row_number() OVER (ORDER BY threshold) AS INT) AS version, run_id, f1,
       CASE WHEN threshold > 2.0 THEN 'Staging' WHEN (SELECT max(f1) FROM cand) >= 0.2 THEN 'Archived' ELSE 'Production' END AS stage FROM cand
UNION ALL
SELECT 'EarlierRule', CAST(9 AS INT), run_id, f1, 'Production' FROM cand WHERE threshold = 2.0
UNION ALL
SELECT * FROM (SELECT 'AttritionRule', CAST((SELECT count(*) FROM cand) + 1 AS INT), run_id, f1,
                      CASE WHEN f1 >= 0.2 THEN 'Production' ELSE 'Staging' END
               FROM cand ORDER BY f1 DESC, run_id LIMIT 1) b""",
        "SPLIT",
        "RISK",
        extra=_CAND,
    ),
)
def q_promote_production(spark, sf_dir):
    """Promotion without manual review: the new version goes live and archives the model's own earlier
    one.  The bar is set where the rule passes it; ``promote``'s default is the reference's 0.60."""
    from pyspark.sql import Window

    cand = candidates(spark, sf_dir)
    first = F.col("threshold") == 2.0
    # The registry before this run: one version per earlier candidate (bounded, tiny frame), and another model.
    own = cand.select(
        F.lit("AttritionRule").alias("model_name"),
        F.row_number().over(Window.orderBy("threshold")).cast("int").alias("version"),
        "run_id", "f1", F.when(first, "Production").otherwise("Staging").alias("stage"),
    )
    other = cand.where(first).select(
        F.lit("EarlierRule").alias("model_name"), F.lit(9).alias("version"), "run_id", "f1", F.lit("Production").alias("stage")
    )
    best = G.best_model(cand).where(F.col("rank") == 1)
    return G.promote(own.unionByName(other), best, "AttritionRule", manual_review=False, threshold=0.2)


@query(
    "evaluation_report",
    with_ctes(
        """SELECT x.section, x.metric, x.value FROM new LEFT JOIN cur ON true,
LATERAL (SELECT 'trained_model' AS section, 'f1_score' AS metric, new.f1 AS value UNION ALL SELECT 'trained_model', 'precision', new.precision
  UNION ALL SELECT 'trained_model', 'recall', new.recall UNION ALL SELECT 'trained_model', 'accuracy', new.accuracy
  UNION ALL SELECT 'trained_model', 'roc_auc', new.roc_auc
  UNION ALL SELECT 'production_model', 'f1_score', CASE WHEN cur.f1 > 0 THEN cur.f1 END
  UNION ALL SELECT 'production_model', 'exists', CASE WHEN cur.f1 IS NULL THEN 0.0 ELSE 1.0 END
  UNION ALL SELECT 'comparison', 'improvement', round(new.f1 - cur.f1, 6) UNION ALL SELECT 'comparison', 'threshold', 0.02
  UNION ALL SELECT 'comparison', 'is_accepted', CASE WHEN cur.f1 IS NULL OR new.f1 - cur.f1 > 0.02 THEN 1.0 ELSE 0.0 END) x""",
        "SPLIT",
        "RISK",
        extra=_CC,
    ),
)
def q_evaluation_report(spark, sf_dir):
    """The report of a challenger against the model in production, written and read back."""
    by_rule = candidates(spark, sf_dir)
    current, new = (by_rule.where(F.col("threshold") == t) for t in (RULE_THRESHOLD, CHALLENGER_THRESHOLD))
    path = scratch_path(spark, "evaluation_report")
    files.write_report(G.evaluation_report(current, new), path)
    return files.read_report(spark, path, G.EVALUATION_REPORT_SCHEMA)


@query(
    "log_model_metadata",
    with_ctes(
        """SELECT CAST(1 AS BIGINT) AS id, 'BankChurnRule' AS model_name, 'rule_t4.0' AS model_version, 'risk_score_rule' AS algorithm,
       f1 AS f1_score, precision AS precision_score, recall AS recall_score, roc_auc AS roc_auc_score,
       n AS training_records, 'training' AS status FROM m""",
        "SPLIT",
        "RISK",
        extra=_SC + ",\nm AS (" + _metrics_sql("(SELECT * FROM scored WHERE split = 'test')") + ")",
    ),
)
def q_log_model_metadata(spark, sf_dir):
    m = E.classification_metrics(scored(spark, sf_dir).where(F.col("split") == "test"))
    path = scratch_path(spark, "model_metadata")
    row = store.model_metadata_row(spark, m, "BankChurnRule", "rule_t4.0", "risk_score_rule")
    store.insert_dataframe(row, path, "append", table="model_metadata")
    return spark.read.parquet(path).select("id", "model_name", "model_version", "algorithm", "f1_score", "precision_score", "recall_score",
                      "roc_auc_score", "training_records", "status")
