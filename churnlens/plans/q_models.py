"""Fitted preprocessing (value-checked against SQL where the fit is SQL-expressible) and models."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from churnlens import schema as S
from churnlens.functions import features as FX
from churnlens.operators import evaluate as E
from churnlens.operators import models as ML
from churnlens.operators import preprocess as PP
from churnlens.operators import ranking as R
from churnlens.operators import search as SR
from churnlens.operators import stattests as ST
from churnlens.operators import trees as TR
from churnlens.plans.oracle_base import with_ctes
from churnlens.plans.registry import query
from churnlens.session import checkpoint_dir, scratch_path
from churnlens.sources.fixture import bank_customers

_PF = """pf AS (
  SELECT *, ln(1 + CAST(Age AS DOUBLE)) AS Age_log, Balance / (EstimatedSalary + 1) AS Balance_Salary_Ratio,
         CAST(NumOfProducts AS DOUBLE) / (Tenure + 1) AS Products_Per_Tenure, CAST(IsActiveMember * HasCrCard AS INT) AS Active_CreditCard,
         ln(1 + Balance) AS Balance_log1p, Balance / greatest(NumOfProducts, 1) AS BalancePerProduct
  FROM split_customers)"""


def _split(spark, sf_dir):
    return R.stratified_split(bank_customers(spark, sf_dir))


def _scaled_sql(cols, suffix="_scaled", src="pf", extra_stats="") -> tuple[str, str]:
    stats = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in cols)
    sel = ", ".join(
        f"round(({c} - m_{c}) / CASE WHEN s_{c} > 0 THEN s_{c} ELSE 1 END, 6) AS {c}{suffix}" for c in cols
    )
    return f"st AS (SELECT {stats} FROM {src} WHERE split = 'train')", sel


def _r6(cols):
    return [F.round(F.col(c), 6).alias(c) for c in cols]


_M1_ST, _M1_SEL = _scaled_sql(PP.PROD_SCALED)


@query("standard_scale", with_ctes(f"SELECT CustomerId, split, {_M1_SEL} FROM pf, st", "SPLIT", extra=_PF + ",\n" + _M1_ST))
def q_standard_scale(spark, sf_dir):
    df = PP.ProdFeatures().transform(_split(spark, sf_dir))
    out = [f"{c}_scaled" for c in PP.PROD_SCALED]
    model = PP.ColumnScaler(inputCols=list(PP.PROD_SCALED), outputCols=out).fit(df.where("split = 'train'"))
    return model.transform(df).select("CustomerId", "split", *_r6(out))


_GEO = ["France", "Germany", "Spain"]
_GEN = ["Female", "Male"]


def _one_hot_frame(spark, sf_dir):
    df = _split(spark, sf_dir)
    model = Pipeline(stages=PP.one_hot_stages(PP.PROD_ONE_HOT)).fit(df.where("split = 'train'"))
    out = model.transform(df)
    labels = model.stages[0].labelsArray
    cols = []
    for c, labs in zip(PP.PROD_ONE_HOT, labels):
        arr = vector_to_array(f"{c}_ohe")
        cols += [arr[i].alias(f"{c}_{v}") for i, v in enumerate(labs)]
    return out, cols


@query(
    "one_hot_full",
    with_ctes(
        "SELECT CustomerId, "
        + ", ".join(f"CASE WHEN Geography = '{g}' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS Geography_{g}" for g in _GEO)
        + ", "
        + ", ".join(f"CASE WHEN Gender = '{g}' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS Gender_{g}" for g in _GEN)
        + " FROM split_customers",
        "SPLIT",
    ),
)
def q_one_hot_full(spark, sf_dir):
    out, cols = _one_hot_frame(spark, sf_dir)
    return out.select("CustomerId", *cols)


def _once(df):
    """``df`` written to the shared folder and read back: fits pass over it many times."""
    path = scratch_path(df.sparkSession, "customers")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _prod_frame(spark, sf_dir):
    df = PP.with_label(R.stratified_split(_once(bank_customers(spark, sf_dir))))
    model = PP.prod_preprocessor().fit(df.where("split = 'train'"))
    return model, model.transform(df).select("CustomerId", "split", "features", "label")


# The 17-column production matrix as flat SQL columns f_00..f_16 (9 scaled, 5 one-hot, 3 binary).
_PROD_COLS_SQL = (
    ", ".join(f"round(({c} - m_{c}) / CASE WHEN s_{c} > 0 THEN s_{c} ELSE 1 END, 6) AS f_{i:02d}" for i, c in enumerate(PP.PROD_SCALED))
    + ", "
    + ", ".join(
        f"CASE WHEN {col} = '{v}' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS f_{9 + i:02d}"
        for i, (col, v) in enumerate([("Geography", g) for g in _GEO] + [("Gender", g) for g in _GEN])
    )
    + ", "
    + ", ".join(f"CAST({c} AS DOUBLE) AS f_{14 + i:02d}" for i, c in enumerate(PP.PROD_BINARY))
)
_PROD_SQL = with_ctes(
    f"SELECT CustomerId, split, CAST(Exited AS DOUBLE) AS label, {_PROD_COLS_SQL} FROM pf, st", "SPLIT", extra=_PF + ",\n" + _M1_ST
)


def _flat(vec: str, prefix: str, k: int):
    arr = vector_to_array(vec)
    return [F.round(arr[i], 6).alias(f"{prefix}{i:02d}") for i in range(k)]


@query("preprocess_prod", _PROD_SQL)
def q_preprocess_prod(spark, sf_dir):
    _, feats = _prod_frame(spark, sf_dir)
    return feats.select("CustomerId", "split", "label", *_flat("features", "f_", 17))


# hstack of the production matrix with the v2 flags, interactions and ratios (29 columns).
_CONCAT_EXTRA = list(PP.V2_CUSTOM_FLAGS) + list(PP.V2_CUSTOM_SCALED)


@query(
    "feature_concat",
    with_ctes(
        f"SELECT CustomerId, split, {_PROD_COLS_SQL.replace(' AS f_', ' AS c_')}, "
        + ", ".join(f"round(CAST({c} AS DOUBLE), 6) AS c_{17 + i:02d}" for i, c in enumerate(_CONCAT_EXTRA))
        + " FROM pfr, st",
        "SPLIT",
        "RISK",
        extra=_PF + ",\n" + _M1_ST + """,
pfr AS (SELECT p.*, """ + ", ".join(f"r.{c}" for c in PP.V2_CUSTOM_FLAGS) + """, p.Age_log AS Age_Log, r.RiskScore
        FROM pf p JOIN risk r ON r.CustomerId = p.CustomerId)""",
    ),
)
def q_feature_concat(spark, sf_dir):
    """Same-row column concatenation (the matrix ``hstack``): production matrix + engineered columns."""
    from pyspark.ml.feature import VectorAssembler

    from churnlens.functions import features as FX

    df = PP.with_label(_split(spark, sf_dir))
    pre = PP.prod_preprocessor().fit(df.where("split = 'train'"))
    eng = FX.risk_score(FX.ratio_features(pre.transform(df)))
    out = VectorAssembler(inputCols=["features", *_CONCAT_EXTRA], outputCol="combined").transform(eng)
    return out.select("CustomerId", "split", *_flat("combined", "c_", 17 + len(_CONCAT_EXTRA)))


@query(
    "robust_scale",
    with_ctes(
        "SELECT CustomerId, round((Age - med) / CASE WHEN q3 - q1 > 0 THEN q3 - q1 ELSE 1 END, 6) AS Age_robust FROM split_customers, q",
        "SPLIT",
        extra="q AS (SELECT quantile_cont(Age, 0.25) AS q1, quantile_cont(Age, 0.5) AS med, quantile_cont(Age, 0.75) AS q3 FROM split_customers WHERE split = 'train')",
    ),
)
def q_robust_scale(spark, sf_dir):
    df = _split(spark, sf_dir)
    m = PP.ColumnScaler(inputCols=["Age"], outputCols=["Age_robust"], method="robust").fit(df.where("split = 'train'"))
    return m.transform(df).select("CustomerId", *_r6(["Age_robust"]))


@query(
    "age_quantile_bins",
    with_ctes(
        "SELECT CustomerId, CAST(b AS DOUBLE) AS Age_bin, "
        + ", ".join(f"CASE WHEN b = {i} THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS Age_bin_{i}" for i in range(5))
        + " FROM (SELECT CustomerId, CAST(Age >= e1 AS INT) + CAST(Age >= e2 AS INT) + CAST(Age >= e3 AS INT) + CAST(Age >= e4 AS INT) AS b FROM split_customers, q) t",
        "SPLIT",
        extra="q AS (SELECT quantile_cont(Age, 0.2) AS e1, quantile_cont(Age, 0.4) AS e2, quantile_cont(Age, 0.6) AS e3, quantile_cont(Age, 0.8) AS e4 FROM split_customers WHERE split = 'train')",
    ),
)
def q_age_quantile_bins(spark, sf_dir):
    from pyspark.ml.feature import OneHotEncoder

    df = _split(spark, sf_dir)
    binner = PP.QuantileBinner(inputCol="Age", outputCol="Age_bin", numBins=5).fit(df.where("split = 'train'"))
    binned = binner.transform(df)
    ohe = OneHotEncoder(inputCol="Age_bin", outputCol="Age_bin_ohe", dropLast=False).fit(binned)
    out = ohe.transform(binned)
    k = len(binner.getSplits()) - 1
    arr = vector_to_array("Age_bin_ohe")
    return out.select("CustomerId", "Age_bin", *[arr[i].alias(f"Age_bin_{i}") for i in range(k)])


_M6_ST, _M6_SEL = _scaled_sql(["Balance_log1p"])


@query(
    "log_scale_balance",
    with_ctes(f"SELECT CustomerId, {_M6_SEL.replace('Balance_log1p_scaled', 'Balance_log_scaled')} FROM pf, st", "SPLIT", extra=_PF + ",\n" + _M6_ST),
)
def q_log_scale_balance(spark, sf_dir):
    df = _split(spark, sf_dir).withColumn("Balance_log1p", F.log1p(F.col("Balance")))
    m = PP.ColumnScaler(inputCols=["Balance_log1p"], outputCols=["Balance_log_scaled"]).fit(df.where("split = 'train'"))
    return m.transform(df).select("CustomerId", *_r6(["Balance_log_scaled"]))


@query(
    "one_hot_drop_first",
    with_ctes(
        "SELECT CustomerId, CASE WHEN Geography = 'Germany' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS Geography_Germany, "
        "CASE WHEN Geography = 'Spain' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS Geography_Spain, "
        "CASE WHEN Gender = 'Male' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS Gender_Male FROM split_customers",
        "SPLIT",
    ),
)
def q_one_hot_drop_first(spark, sf_dir):
    df = _split(spark, sf_dir)
    train = df.where("split = 'train'")
    cols = []
    out = df
    for c in ("Geography", "Gender"):
        m = PP.DropFirstOneHot(inputCol=c, outputCol=f"{c}_drop1").fit(train)
        out = m.transform(out)
        labs = m.stages[0].labels[1:]
        arr = vector_to_array(f"{c}_drop1")
        cols += [arr[i].alias(f"{c}_{v}") for i, v in enumerate(labs)]
    return out.select("CustomerId", *cols)


@query(
    "one_hot_products",
    with_ctes(
        "SELECT CustomerId, " + ", ".join(f"CASE WHEN NumOfProducts = {i} THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS NumOfProducts_{i}" for i in range(1, 5))
        + " FROM split_customers",
        "SPLIT",
    ),
)
def q_one_hot_products(spark, sf_dir):
    df = _split(spark, sf_dir)
    m = Pipeline(stages=PP.one_hot_stages(["NumOfProducts"])).fit(df.where("split = 'train'"))
    labs = m.stages[0].labelsArray[0]
    arr = vector_to_array("NumOfProducts_ohe")
    return m.transform(df).select("CustomerId", *[arr[i].alias(f"NumOfProducts_{v}") for i, v in enumerate(labs)])


_RISK_PF = """rpf AS (
  SELECT s.CustomerId, s.split, ln(1 + CAST(s.Age AS DOUBLE)) AS Age_Log, s.Balance / greatest(s.NumOfProducts, 1) AS BalancePerProduct, r.RiskScore
  FROM split_customers s JOIN risk r ON r.CustomerId = s.CustomerId)"""
_M9_ST, _M9_SEL = _scaled_sql(PP.V2_CUSTOM_SCALED, src="rpf")


@query("scale_custom", with_ctes(f"SELECT CustomerId, {_M9_SEL} FROM rpf, st", "SPLIT", "RISK", extra=_RISK_PF + ",\n" + _M9_ST))
def q_scale_custom(spark, sf_dir):
    df = PP.V2Features().transform(_split(spark, sf_dir))
    out = [f"{c}_scaled" for c in PP.V2_CUSTOM_SCALED]
    m = PP.ColumnScaler(inputCols=list(PP.V2_CUSTOM_SCALED), outputCols=out).fit(df.where("split = 'train'"))
    return m.transform(df).select("CustomerId", *_r6(out))


@query(
    "class_weights",
    with_ctes(
        """SELECT Exited AS label, count(*) AS n_c, (SELECT count(*) FROM split_customers WHERE split = 'train') / (2.0 * count(*)) AS weight,
       (SELECT CAST(count_if(Exited = 0) AS BIGINT) FROM split_customers WHERE split = 'train') / CAST((SELECT CAST(count_if(Exited = 1) AS BIGINT) FROM split_customers WHERE split = 'train') AS DOUBLE) AS scale_pos_weight
FROM split_customers WHERE split = 'train' GROUP BY Exited""",
        "SPLIT",
    ),
)
def q_class_weights(spark, sf_dir):
    train = _split(spark, sf_dir).where("split = 'train'").withColumn("label", F.col("Exited"))
    return ML.class_weights(train)


def _v2(spark, sf_dir):
    df = PP.with_label(R.stratified_split(_once(bank_customers(spark, sf_dir))))
    model = PP.v2_preprocessor().fit(df.where("split = 'train'"))
    return model, model.transform(df)




def _v2_oracle(body: str) -> str:
    d = "CAST({} AS DOUBLE)"

    def z(c, m, sd):
        return f"round(({c} - {m}) / CASE WHEN {sd} > 0 THEN {sd} ELSE 1 END, 6)"

    b = "(CAST(Age >= e1 AS INT) + CAST(Age >= e2 AS INT) + CAST(Age >= e3 AS INT) + CAST(Age >= e4 AS INT))"
    one = "CAST(1 AS DOUBLE)"
    zero = "CAST(0 AS DOUBLE)"
    cols = [
        z("CreditScore", "m_cs", "s_cs") + " AS CreditScore_std",
        "round((Age - med) / CASE WHEN q3 - q1 > 0 THEN q3 - q1 ELSE 1 END, 6) AS Age_robust",
        *[f"CASE WHEN {b} = {i} THEN {one} ELSE {zero} END AS Age_bin_{i}" for i in range(5)],
        z("Balance_log1p", "m_bl", "s_bl") + " AS Balance_log_scaled",
        f"CASE WHEN Geography = 'Germany' THEN {one} ELSE {zero} END AS Geography_Germany",
        f"CASE WHEN Geography = 'Spain' THEN {one} ELSE {zero} END AS Geography_Spain",
        f"CASE WHEN Gender = 'Male' THEN {one} ELSE {zero} END AS Gender_Male",
        *[f"CASE WHEN NumOfProducts = {i} THEN {one} ELSE {zero} END AS NumOfProducts_{i}" for i in range(1, 5)],
        d.format("IsActiveMember") + " AS IsActiveMember",
        *[d.format(f) + f" AS {f}" for f in PP.V2_CUSTOM_FLAGS],
        z("Age_Log", "m_al", "s_al") + " AS Age_Log_scaled",
        z("BalancePerProduct", "m_bp", "s_bp") + " AS BalancePerProduct_scaled",
        z("RiskScore", "m_rs", "s_rs") + " AS RiskScore_scaled",
    ]
    extra = f"""v AS (
  SELECT s.CustomerId, s.split, CAST(s.Exited AS DOUBLE) AS label, s.CreditScore, s.Age, ln(1 + s.Balance) AS Balance_log1p,
         s.Geography, s.Gender, s.NumOfProducts, s.IsActiveMember, {', '.join('r.' + f for f in PP.V2_CUSTOM_FLAGS)},
         ln(1 + CAST(s.Age AS DOUBLE)) AS Age_Log, s.Balance / greatest(s.NumOfProducts, 1) AS BalancePerProduct, r.RiskScore
  FROM split_customers s JOIN risk r ON r.CustomerId = s.CustomerId),
st AS (
  SELECT avg(CreditScore) AS m_cs, stddev_pop(CreditScore) AS s_cs, avg(Balance_log1p) AS m_bl, stddev_pop(Balance_log1p) AS s_bl,
         avg(Age_Log) AS m_al, stddev_pop(Age_Log) AS s_al, avg(BalancePerProduct) AS m_bp, stddev_pop(BalancePerProduct) AS s_bp,
         avg(RiskScore) AS m_rs, stddev_pop(RiskScore) AS s_rs,
         quantile_cont(Age, 0.25) AS q1, quantile_cont(Age, 0.5) AS med, quantile_cont(Age, 0.75) AS q3,
         quantile_cont(Age, 0.2) AS e1, quantile_cont(Age, 0.4) AS e2, quantile_cont(Age, 0.6) AS e3, quantile_cont(Age, 0.8) AS e4
  FROM v WHERE split = 'train')"""
    extra += f",\nvf AS (SELECT CustomerId, split, label, {', '.join(cols)} FROM v, st)"
    return with_ctes(body, "SPLIT", "RISK", extra=extra)


@query("churn_feature_pipeline", _v2_oracle("SELECT * FROM vf"))
def q_churn_feature_pipeline(spark, sf_dir):
    model, out = _v2(spark, sf_dir)
    names = PP.feature_names(model)
    arr = vector_to_array("features")
    return out.select("CustomerId", "split", "label", *[F.round(arr[i], 6).alias(n) for i, n in enumerate(names)])


@query(
    "final_feature_correlation",
    _v2_oracle(
        """SELECT a.feature AS var1, b.feature AS var2,
       CASE WHEN a.feature = b.feature THEN 1.0 WHEN stddev_pop(a.value) = 0 OR stddev_pop(b.value) = 0 THEN NULL
            ELSE round(corr(a.value, b.value), 6) + 0.0 END AS corr
FROM (UNPIVOT (SELECT * EXCLUDE (split) FROM vf WHERE split = 'train') ON COLUMNS(* EXCLUDE (CustomerId)) INTO NAME feature VALUE value) a
JOIN (UNPIVOT (SELECT * EXCLUDE (split) FROM vf WHERE split = 'train') ON COLUMNS(* EXCLUDE (CustomerId)) INTO NAME feature VALUE value) b
  ON a.CustomerId = b.CustomerId
GROUP BY a.feature, b.feature"""
    ),
)
def q_final_feature_correlation(spark, sf_dir):
    """Every feature of the fitted pipeline, and the label, against every other on the train split."""
    train = q_churn_feature_pipeline(spark, sf_dir).where("split = 'train'")
    return ST.feature_correlation(train, [c for c in train.columns if c not in ("CustomerId", "split")])


@query(
    "feature_names",
    _v2_oracle(
        """SELECT CAST(row_number() OVER () - 1 AS INT) AS position, column_name AS feature
FROM (DESCRIBE vf) d WHERE column_name NOT IN ('CustomerId', 'split', 'label')"""
    ),
)
def q_feature_names(spark, sf_dir):
    model, _ = _v2(spark, sf_dir)
    names = PP.feature_names(model)
    return spark.createDataFrame(list(enumerate(names)), "position int, feature string")


_MATRIX_NAMES = [*(f"{c}_scaled" for c in PP.PROD_SCALED), *(f"Geography_{g}" for g in _GEO), *(f"Gender_{g}" for g in _GEN), *PP.PROD_BINARY]
_UNROUNDED = _PROD_COLS_SQL.replace("round((", "((").replace(", 6) AS", ") AS")


def _matrix_sql(entry: str, skip: str = "''", label: str = "") -> str:
    """CTEs up to ``mat(m, feats)``: the k x k matrix of ``entry(a.v, b.v)`` over the train rows."""
    return (
        _PF + ",\n" + _M1_ST + f""",
long AS (UNPIVOT (SELECT CustomerId, {_UNROUNDED}{label} FROM pf, st WHERE split = 'train') ON COLUMNS(* EXCLUDE (CustomerId)) INTO NAME f VALUE v),
cells AS (SELECT a.f AS i, b.f AS j, {entry} AS g FROM long a JOIN long b ON a.CustomerId = b.CustomerId
  WHERE a.f <> {skip} AND b.f <> {skip} GROUP BY a.f, b.f),
mat AS (SELECT list(r ORDER BY i) AS m, list(i ORDER BY i) AS feats FROM (SELECT i, list(g ORDER BY j) AS r FROM cells GROUP BY i))"""
    )


# The inverse of the Gram matrix by the sweep operator, a column a step.  One of the two gender columns
# is left out, and the one-hot columns are collinear by construction.
_VIF_SQL = with_ctes(
    f"""SELECT ([{', '.join(f"'{n}'" for n in [*_MATRIX_NAMES, 'label'])}])[CAST(substr(feats[pos], 3) AS INT) + 1] AS feature,
  CASE WHEN CAST(substr(feats[pos], 3) AS INT) BETWEEN 9 AND 13 THEN NULL ELSE round(g[pos][pos] * inv[pos][pos], 4) END AS vif,
  CAST(CAST(substr(feats[pos], 3) AS INT) BETWEEN 9 AND 13 AS INT) AS collinear
FROM (SELECT m AS inv FROM sweep WHERE k = (SELECT len(feats) FROM mat)), (SELECT m AS g, feats FROM mat), (SELECT unnest(range(1, 18)) AS pos)
UNION ALL SELECT 'Gender_{_GEN[1]}', NULL, 1""",
    "SPLIT",
    extra=_matrix_sql("sum(a.v * b.v)", "'f_13'", ", CAST(Exited AS DOUBLE) AS f_17") + """,
sweep AS (SELECT 0 AS k, m FROM mat UNION ALL
  SELECT k + 1, list_transform(m, lambda r, i: CASE
    WHEN i = k + 1 THEN list_transform(r, lambda x, j: CASE WHEN j = k + 1 THEN 1 / x ELSE x / m[k + 1][k + 1] END)
    ELSE list_transform(r, lambda x, j: CASE WHEN j = k + 1 THEN -x / m[k + 1][k + 1] ELSE x - r[k + 1] * m[k + 1][j] / m[k + 1][k + 1] END) END)
  FROM sweep WHERE k < len(m))""",
).replace("WITH ", "WITH RECURSIVE ", 1)


@query("vif", _VIF_SQL)
def q_vif(spark, sf_dir):
    """VIF of each production column and the label; null and flagged where it is infinite."""
    _, feats = _prod_frame(spark, sf_dir)
    arr = vector_to_array("features")
    flat = feats.where("split = 'train'").select(*[arr[i].alias(n) for i, n in enumerate(_MATRIX_NAMES)], "label")
    finite = F.col("vif") < float("inf")
    return ST.vif(flat, [*_MATRIX_NAMES, "label"]).select("feature", F.when(finite, F.round("vif", 4)).alias("vif"), (~finite).cast("int").alias("collinear"))


# Eigenvalues of the covariance matrix by cyclic Jacobi rotations, one a step, ten sweeps.
_PCA_SQL = with_ctes(
    """SELECT CAST(row_number() OVER (ORDER BY ev DESC) AS INT) AS component, round(ev / sum(ev) OVER (), 6) + 0.0 AS explained_variance_ratio,
  round(sum(ev) OVER (ORDER BY ev DESC ROWS UNBOUNDED PRECEDING) / sum(ev) OVER (), 6) AS cumulative_ratio
FROM (SELECT m[pos][pos] AS ev FROM jacobi, (SELECT unnest(range(1, 18)) AS pos) WHERE step = 1360)""",
    "SPLIT",
    extra=_matrix_sql("covar_samp(a.v, b.v)") + """,
turns AS (SELECT list({'p': a, 'q': b} ORDER BY a, b) AS t FROM range(1, 18) x(a), range(1, 18) y(b) WHERE a < b),
jacobi AS (SELECT 0 AS step, m FROM mat UNION ALL
  SELECT step + 1, list_transform(h, lambda r, i: CASE
    WHEN i = p THEN list_transform(r, lambda x, j: c * x - s * h[q][j])
    WHEN i = q THEN list_transform(r, lambda x, j: s * h[p][j] + c * x) ELSE r END)
  FROM (SELECT step, p, q, c, s, list_transform(m, lambda r: list_transform(r, lambda x, j: CASE
      WHEN j = p THEN c * x - s * r[q] WHEN j = q THEN s * r[p] + c * x ELSE x END)) AS h
    FROM (SELECT *, tn / sqrt(1 + tn * tn) AS s, 1 / sqrt(1 + tn * tn) AS c
      FROM (SELECT *, CASE WHEN m[p][q] = 0 THEN 0 ELSE CASE WHEN z < 0 THEN -1 ELSE 1 END / (abs(z) + sqrt(1 + z * z)) END AS tn
        FROM (SELECT *, CASE WHEN m[p][q] = 0 THEN 0 ELSE (m[q][q] - m[p][p]) / (2 * m[p][q]) END AS z
          FROM (SELECT step, m, t[1 + step % 136].p AS p, t[1 + step % 136].q AS q FROM jacobi, turns WHERE step < 1360))))))""",
).replace("WITH ", "WITH RECURSIVE ", 1)


@query("pca_variance", _PCA_SQL)
def q_pca_variance(spark, sf_dir):
    _, feats = _prod_frame(spark, sf_dir)
    ratios = ("explained_variance_ratio", "cumulative_ratio")
    return ST.pca_variance(feats.where("split = 'train'")).select("component", *[(F.round(c, 6) + 0.0).alias(c) for c in ratios])


@query("feature_store", _PROD_SQL)
def q_feature_store(spark, sf_dir):
    """Store the transformed matrix as ``(CustomerId, split, features, label)`` partitioned by split,
    read it back and return the flat export (one column per matrix column)."""
    _, feats = _prod_frame(spark, sf_dir)
    path = scratch_path(spark, "feature_store")
    feats.write.mode("overwrite").partitionBy("split").parquet(path)
    back = spark.read.parquet(path)
    return back.select("CustomerId", "split", "label", *_flat("features", "f_", 17))


@query("pipeline_persist", with_ctes("SELECT count(*) AS rows, CAST(0 AS DOUBLE) AS max_abs_diff, 1 AS allclose FROM bank_customers"))
def q_pipeline_persist(spark, sf_dir):
    from pyspark.ml import PipelineModel

    df = PP.with_label(_split(spark, sf_dir))
    model = PP.v2_preprocessor().fit(df.where("split = 'train'"))
    path = scratch_path(spark, "preprocessor")
    model.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    a = model.transform(df).select("CustomerId", vector_to_array("features").alias("a"))
    b = loaded.transform(df).select("CustomerId", vector_to_array("features").alias("b"))
    diff = a.join(b, "CustomerId").select(
        "CustomerId", F.aggregate(F.zip_with("a", "b", lambda x, y: F.abs(x - y)), F.lit(0.0), lambda acc, d: F.greatest(acc, d)).alias("max_abs_diff")
    )
    return diff.agg(F.count(F.lit(1)).alias("rows"), F.max("max_abs_diff").alias("max_abs_diff")).withColumn(
        "allclose", (F.col("max_abs_diff") <= 1e-8).cast("int")
    )


# ---- models -------------------------------------------------------------------------------
#
# Model queries return ``model, part, name, value``: parts ``train`` and ``test`` hold the metrics of a
# split, part ``coefficient`` or ``importance`` what was fitted, by column of the matrix.

_METRICS = ("accuracy", "precision", "recall", "f1", "roc_auc", "roc_auc_prob")


def _long(metrics, model: str, names=_METRICS):
    """Metric rows of a (split, metrics) frame."""
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).cast("double").alias("value")) for n in names])).alias("m")
    return metrics.select(F.lit(model).alias("model"), F.col("split").alias("part"), pairs).select("model", "part", "m.name", "m.value")


def _rows(spark, rows):
    return spark.createDataFrame(rows, "model string, part string, name string, value double")


def _settled(result, *persisted):
    """The (small) result, checkpointed, so that the frames it was computed from can be released."""
    checkpoint_dir(result.sparkSession)
    out = result.checkpoint(eager=True)
    for df in persisted:
        df.unpersist()
    return out


def _importances(model) -> list[tuple[str, float]]:
    """Each column's share of all gains."""
    gains = [0.0] * len(_MATRIX_NAMES)
    for _, _, column, _, gain, _ in model.nodes():
        if column >= 0:
            gains[column] += gain
    return [(n, round(g / sum(gains), 6) if sum(gains) else 0.0) for n, g in zip(_MATRIX_NAMES, gains)]


def _fitted_rows(spark, name: str, model):
    if hasattr(model, "trees"):
        return _rows(spark, [(name, "importance", n, v) for n, v in _importances(model)])
    if model.map is None:
        values = zip([*_MATRIX_NAMES, "intercept"], model.coefficients.tolist())
        return _rows(spark, [(name, "coefficient", n, round(v, 4) + 0.0) for n, v in values])
    return _rows(spark, [(name, "landmarks", "directions", float(len(model.coefficients) - 1))])


def _model_query(spark, sf_dir, name: str):
    _, feats = _prod_frame(spark, sf_dir)
    feats = ML.persist(feats)
    model = SR.fit(feats.where("split = 'train'"), [SR.NAMED[name]])[0]
    found = _long(SR.metrics(model.transform(feats)), name)
    if not hasattr(model, "trees"):  # the last digits of sums of doubles follow the order of the rows
        found = found.withColumn("value", F.round("value", 4))
    return _settled(found.unionByName(_fitted_rows(spark, name, model)), feats)


_MATRIX_DOUBLES = ", ".join(f"f_{i:02d}" for i in range(17))


def _newton_ctes(c: float, rounds: int = 15) -> str:
    """``scored(split, y, score)`` and ``newton(turn, b)``: a balanced logistic regression by Newton's
    method, one step a recursion; the linear system is solved by Gauss-Jordan elimination."""
    return _PF + ",\n" + _M1_ST + f""",
matrix AS (SELECT split, CAST(Exited AS DOUBLE) AS y, [{_MATRIX_DOUBLES}, CAST(1 AS DOUBLE)] AS v
  FROM (SELECT split, Exited, {_UNROUNDED} FROM pf, st)),
trained AS MATERIALIZED (SELECT v, y, count(*) OVER () / (2.0 * count(*) OVER (PARTITION BY y)) AS w FROM matrix WHERE split = 'train'),
newton AS (SELECT 0 AS turn, list_transform(range(18), lambda i: CAST(0 AS DOUBLE)) AS b UNION ALL
  SELECT turn + 1, list_transform(b, lambda x, i: x + solved[i][19]) FROM (
    SELECT turn, b, list_reduce(range(1, 19), lambda m, k: list_transform(m, lambda r, i: CASE
      WHEN i = k THEN list_transform(r, lambda x: x / r[k])
      ELSE list_transform(r, lambda x, j: x - r[k] * m[k][j] / m[k][k]) END), system) AS solved
    FROM (SELECT turn, b, list(line ORDER BY i) AS system FROM (
      SELECT turn, b, i, list_append(list(h ORDER BY j), any_value(g)) AS line FROM (
        SELECT turn, b, i, j, {c} * sum(w * p * (1 - p) * v[i] * v[j]) + CASE WHEN i = j AND i < 18 THEN 1 ELSE 0 END AS h,
          {c} * sum(w * (y - p) * v[i]) - CASE WHEN i < 18 THEN b[i] ELSE 0 END AS g
        FROM (SELECT turn, b, v, y, w, 1 / (1 + exp(-list_inner_product(v, b))) AS p FROM newton, trained WHERE turn < {rounds}),
          range(1, 19) x(i), range(1, 19) z(j)
        GROUP BY turn, b, i, j) GROUP BY turn, b, i) GROUP BY turn, b))),
solution AS MATERIALIZED (SELECT b FROM newton WHERE turn = {rounds}),
scored AS MATERIALIZED (SELECT split, CAST(y AS INT) AS label, 1 / (1 + exp(-list_inner_product(v, b))) AS score, CAST(list_inner_product(v, b) > 0 AS INT) AS prediction
  FROM matrix, solution),
cells AS (SELECT split, count(*) FILTER (label = 0 AND prediction = 0) AS tn, count(*) FILTER (label = 0 AND prediction = 1) AS fp,
  count(*) FILTER (label = 1 AND prediction = 0) AS fn, count(*) FILTER (label = 1 AND prediction = 1) AS tp FROM scored GROUP BY split),
measured AS (SELECT split, (tp + tn) / (tp + tn + fp + fn) AS accuracy, CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END AS "precision",
  CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END AS recall, CASE WHEN tp + fp + fn = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn) END AS f1,
  CASE WHEN tp + fn = 0 OR tn + fp = 0 THEN 0 ELSE (tp / (tp + fn) + tn / (tn + fp)) / 2 END AS roc_auc FROM cells),
ranked AS (SELECT split, sum(CASE WHEN label = 1 THEN place END) AS s, count(*) FILTER (label = 1) AS p, count(*) FILTER (label = 0) AS n
  FROM (SELECT split, label, (rank() OVER w + (count(*) OVER (PARTITION BY split, score) - 1) / 2.0) AS place FROM scored WINDOW w AS (PARTITION BY split ORDER BY score))
  GROUP BY split)"""


def _newton_sql(name: str) -> str:
    spec = SR.NAMED[name]
    measures = "\nUNION ALL ".join(
        f"SELECT '{name}' AS model, split AS part, '{m}' AS name, round(round(CAST({m if m != 'precision' else chr(34) + m + chr(34)} AS DOUBLE), 6), 4) AS value FROM measured" for m in _METRICS[:-1]
    )
    body = f"""{measures}
UNION ALL SELECT '{name}', split, 'roc_auc_prob', round(round((s - p * (p + 1) / 2.0) / (p * n), 6), 4) FROM ranked
UNION ALL SELECT '{name}', 'coefficient', ({[*_MATRIX_NAMES, 'intercept']})[i], round(b[i], 4) + 0.0 FROM solution, range(1, 19) r(i)"""
    return with_ctes(body, "SPLIT", extra=_newton_ctes(spec.c)).replace("WITH ", "WITH RECURSIVE ", 1)


def _register_model(name: str):
    @query(name, _newton_sql(name) if name.startswith("logreg") else None)
    def _q(spark, sf_dir, _name=name):
        return _model_query(spark, sf_dir, _name)

    return _q


for _name in SR.NAMED:
    _register_model(_name)


@query("soft_voting")
def q_soft_voting(spark, sf_dir):
    """The vote of three families, metrics per split."""
    _, feats = _prod_frame(spark, sf_dir)
    feats = ML.persist(feats)
    models = SR.fit(feats.where("split = 'train'"), [SR.NAMED[n] for n in _BAKEOFF])
    return _settled(_long(SR.metrics(SR.soft_voting(models, feats)), "soft_voting"), feats)


_BAKEOFF = ("logreg_baseline", "rf_baseline", "gbt_baseline")


@query("model_bakeoff")
def q_model_bakeoff(spark, sf_dir):
    """Three families on the same engineered features, judged on the test split."""
    _, out = _v2(spark, sf_dir)
    feats = ML.persist(out.select("CustomerId", "split", "features", "label"))
    test = feats.where("split = 'test'")
    models = SR.fit(feats.where("split = 'train'"), [SR.NAMED[n] for n in _BAKEOFF])
    parts = [_long(SR.metrics(m.transform(test)), n, ("accuracy", "f1", "roc_auc_prob")) for n, m in zip(_BAKEOFF, models)]
    return _settled(parts[0].unionByName(parts[1]).unionByName(parts[2]), feats)


_TRIALS = "trial int, family string, params string, score double, best int, test_accuracy double, test_f1 double"


def _trials(spark, feats, trials):
    """All trials, the best marked and judged on the test split after a fit on all training rows."""
    best = SR.best_of(trials)
    model = SR.fit(feats.where("split = 'train'"), [SR.spec_of(best.family, best.params)])[0]
    m = E.classification_metrics(model.transform(feats.where("split = 'test'"))).first()
    rows = [
        (t.number, t.family, t.described(), round(t.score, 6), int(t is best), *((m["accuracy"], m["f1"]) if t is best else (None, None)))
        for t in trials
    ]
    return spark.createDataFrame(rows, _TRIALS)


def _register_search(name: str, run):
    @query(name)
    def _q(spark, sf_dir):
        _, feats = _prod_frame(spark, sf_dir)
        feats = ML.persist(feats)
        out = _trials(spark, feats, run(feats.where("split = 'train'")))
        feats.unpersist()
        return out

    return _q


_register_search("grid_search_cv", lambda train: SR.grid_search(train, "RandomForest"))
_register_search("grid_search_boosting", lambda train: SR.grid_search(train, "GradientBoosting"))
_register_search("grid_search_xgb", lambda train: SR.grid_search(train, "XGBoost"))
_register_search("random_search", SR.random_search)
_register_search("parzen_study_accuracy", lambda train: SR.study(train, SR.ACCURACY_SPACE, SR.accuracy, 3))
_register_search("parzen_study_f1", lambda train: SR.study(train, SR.F1_SPACE, SR.f1, 5))


@query("kfold_score")
def q_kfold_score(spark, sf_dir):
    """Per fold its held-out rows, positives, F1 and accuracy, and their means."""
    _, feats = _prod_frame(spark, sf_dir)
    held = SR.Folds(feats.where("split = 'train'"), 5)
    cells = held.confusions([SR.NAMED["rf_baseline"]])[0]
    held.close()
    rows = [(str(k), sum(c), c[2] + c[3], SR.f1(c), SR.accuracy(c)) for k, c in enumerate(cells)]
    _, ns, ps, f1s, accs = zip(*rows)
    rows.append(("mean", sum(ns), sum(ps), sum(f1s) / 5, sum(accs) / 5))
    out = spark.createDataFrame(rows, "fold string, n long, positives long, f1 double, accuracy double")
    return out.withColumns({c: F.round(c, 6) for c in ("f1", "accuracy")})


@query("score_raw")
def q_score_raw(spark, sf_dir):
    """Raw rows through preprocessor and model: probability of churn, tier and label per customer."""
    customers = _once(bank_customers(spark, sf_dir))
    df = PP.with_label(R.stratified_split(customers))
    train = df.where("split = 'train'")
    pre = PP.prod_preprocessor().fit(train)
    model = SR.fit(pre.transform(train), [SR.NAMED["gbt_production"]])[0]
    raw = customers.select("CustomerId", *S.FEATURE_COLUMNS)
    p = F.col("score")
    return model.transform(pre.transform(raw)).select(
        "CustomerId", F.round(p, 6).alias("churn_probability"), FX.risk_tier(p).alias("risk_category"), FX.churn_label_text(p).alias("prediction")
    )


def _champion_sql() -> str:
    """F1 on the test rows of two regularizations, and the decision."""
    parts = []
    for name in ("logreg_l2", "logreg_baseline"):
        inner = with_ctes("SELECT round(CAST(f1 AS DOUBLE), 6) AS f1 FROM measured WHERE split = 'test'", "SPLIT", extra=_newton_ctes(SR.NAMED[name].c))
        parts.append(f"({inner.replace('WITH ', 'WITH RECURSIVE ', 1)})")
    return f"""SELECT c.f1 AS current_f1, n.f1 AS new_f1, round(n.f1 - c.f1, 6) AS improvement, CAST(n.f1 - c.f1 > {E.CHAMPION_MARGIN} AS INT) AS accepted
FROM {parts[0]} c, {parts[1]} n"""


@query("champion_challenger_models", _champion_sql())
def q_champion_challenger_models(spark, sf_dir):
    """The champion (C = 0.1) and a challenger (C = 1), both fitted, on one holdout."""
    _, feats = _prod_frame(spark, sf_dir)
    feats = ML.persist(feats)
    models = SR.fit(feats.where("split = 'train'"), [SR.NAMED["logreg_l2"], SR.NAMED["logreg_baseline"]])
    test = feats.where("split = 'test'")
    current, new = (E.classification_metrics(m.transform(test)).select("f1") for m in models)
    return _settled(E.champion_challenger(current, new), feats)


# ---- trees, node by node ------------------------------------------------------------------

_TREE_COLUMNS = ["CreditScore", "Age", "Tenure", "Balance", "NumOfProducts", "HasCrCard", "IsActiveMember", "EstimatedSalary", "IsGermany", "IsFemale"]
_BOOSTED = TR.TreeSpec("boost", 3, 2, rate=0.3, l2=1.5, l1=0.5, gamma=0.2, min_child=2.0, weighting="pos_scale")
_GROWN = TR.TreeSpec("forest", 1, 3, min_leaf=4, min_split=20, weighting="balanced")


def _tree_sql(spec: TR.TreeSpec, name: str) -> str:
    """The trees of ``spec`` in SQL: bins, then for each tree and level the histograms and best splits."""
    scale, boost = f"CAST({TR.SCALE} AS DOUBLE)", spec.kind == "boost"
    balanced = "CASE WHEN y = 1 THEN n / (2.0 * n1) ELSE n / (2.0 * n0) END"
    weight = f"CAST({'CASE WHEN y = 1 THEN CAST(n0 AS DOUBLE) / n1 ELSE 1 END' if boost else balanced} AS DOUBLE)"

    def score(a: str, b: str) -> str:
        a, b = f"(({a}) / {scale})", f"(({b}) / {scale})"
        if boost:
            return f"CASE WHEN {b} + {spec.l2} > 0 THEN pow(sign({a}) * greatest(abs({a}) - {spec.l1}, 0), 2) / ({b} + {spec.l2}) ELSE 0 END"
        return f"CASE WHEN {b} > 0 THEN -2 * {a} * ({b} - {a}) / {b} ELSE 0 END"

    def value(a: str, b: str) -> str:
        a, b = f"(({a}) / {scale})", f"(({b}) / {scale})"
        return f"-{spec.rate} * (sign({a}) * greatest(abs({a}) - {spec.l1}, 0)) / ({b} + {spec.l2})" if boost else f"{a} / {b}"

    parts = [f"""raw AS (SELECT CustomerId AS id, Exited AS y, *, CAST(Geography = 'Germany' AS INT) AS IsGermany, CAST(Gender = 'Female' AS INT) AS IsFemale
  FROM split_customers WHERE split = 'train')""",
        "long AS (" + " UNION ALL ".join(f"SELECT id, {i} AS c, CAST({c} AS DOUBLE) AS v FROM raw" for i, c in enumerate(_TREE_COLUMNS)) + ")",
        f"""placed AS (SELECT id, c, least(CAST(floor((v - low) * CAST({TR.CELLS} AS DOUBLE) / CASE WHEN high > low THEN high - low ELSE 1 END) AS INT), {TR.CELLS - 1}) AS cell
  FROM long JOIN (SELECT c, min(v) AS low, max(v) AS high FROM long GROUP BY c) USING (c))""",
        f"""cells AS (SELECT c, cell, CAST((sum(n) OVER (PARTITION BY c ORDER BY cell) - n) * {TR.BINS} // sum(n) OVER (PARTITION BY c) AS INT) AS bin
  FROM (SELECT c, cell, count(*) AS n FROM placed GROUP BY c, cell))""",
        "binned AS MATERIALIZED (SELECT id, c, bin FROM placed JOIN cells USING (c, cell))",
        f"""m0 AS (SELECT id, y, {weight} AS w, CAST(0 AS DOUBLE) AS m
  FROM raw, (SELECT count(*) AS n, count(*) FILTER (y = 0) AS n0, count(*) FILTER (y = 1) AS n1 FROM raw))"""]
    for t in range(spec.trees):
        a, b = ("w * (p - y)", "w * p * (1 - p)") if boost else ("w * y", "w")
        parts += [f"""s{t} AS MATERIALIZED (SELECT id, CAST(round_even({a} * {scale}, 0) AS BIGINT) AS a, CAST(round_even({b} * {scale}, 0) AS BIGINT) AS b
  FROM (SELECT *, 1 / (1 + exp(-m)) AS p FROM m{t}))""", f"at{t}_0 AS (SELECT id, '' AS path FROM s{t})"]
        for level in range(spec.depth):
            parts += [f"""h{t}_{level} AS (SELECT path, c, bin, CAST(sum(a) AS DOUBLE) AS a, CAST(sum(b) AS DOUBLE) AS b, count(*) AS n
  FROM at{t}_{level} JOIN s{t} USING (id) JOIN binned USING (id) GROUP BY path, c, bin)""",
                f"""b{t}_{level} AS MATERIALIZED (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY path ORDER BY gain DESC, c, bin) AS place FROM (
    SELECT *, {score("la", "lb")} + {score("ta - la", "tb - lb")} - ({score("ta", "tb")}) AS gain FROM (
      SELECT path, c, bin, sum(a) OVER w AS la, sum(b) OVER w AS lb, sum(n) OVER w AS ln,
        sum(a) OVER (PARTITION BY path, c) AS ta, sum(b) OVER (PARTITION BY path, c) AS tb, sum(n) OVER (PARTITION BY path, c) AS tn
      FROM h{t}_{level} WINDOW w AS (PARTITION BY path, c ORDER BY bin))
    WHERE least(ln, tn - ln) >= {spec.min_leaf} AND least(lb, tb - lb) >= {spec.min_child} * {scale} AND tn >= {max(spec.min_split, 2 * spec.min_leaf) if level else 0}
      {"" if boost or not level else "AND ta > 0 AND ta < tb"}))
  WHERE place = 1 AND gain > {TR.MIN_GAIN} AND gain >= {spec.gamma})""",
                f"""at{t}_{level + 1} AS (SELECT id, path || CASE WHEN b.bin <= s.bin THEN 'L' ELSE 'R' END AS path
  FROM at{t}_{level} JOIN b{t}_{level} s USING (path) JOIN binned b USING (id, c))"""]
        reached = " UNION ALL ".join(f"SELECT id, path FROM at{t}_{level}" for level in range(spec.depth + 1))
        splits = " UNION ALL ".join(f"SELECT path, c, bin, gain FROM b{t}_{level}" for level in range(spec.depth))
        parts += [f"""v{t} AS MATERIALIZED (SELECT path, {value("CAST(sum(a) AS DOUBLE)", "CAST(sum(b) AS DOUBLE)")} AS value FROM ({reached}) JOIN s{t} USING (id) GROUP BY path)""",
            f"n{t} AS (SELECT {t} AS tree, path, c, bin, gain, value FROM v{t} LEFT JOIN ({splits}) USING (path))",
            f"""m{t + 1} AS (SELECT id, y, w, m + value AS m FROM m{t} JOIN (SELECT id, arg_max(path, len(path)) AS path FROM ({reached}) GROUP BY id) USING (id) JOIN v{t} USING (path))"""]
    body = "\nUNION ALL ".join(
        f"""SELECT '{name}' AS model, CAST(tree AS INT) AS tree, path, ({_TREE_COLUMNS})[c + 1] AS "column", bin AS cut, round(gain, 6) AS gain, round(value, 6) + 0.0 AS value FROM n{t}"""
        for t in range(spec.trees)
    )
    return with_ctes(body, "SPLIT", extra=",\n".join(parts))


def _node_query(spark, sf_dir, spec: TR.TreeSpec, name: str):
    df = _split(spark, sf_dir).where("split = 'train'").withColumns({
        "IsGermany": (F.col("Geography") == "Germany").cast("int"), "IsFemale": (F.col("Gender") == "Female").cast("int"), "label": F.col(S.TARGET),
    })
    feats = VectorAssembler(inputCols=_TREE_COLUMNS, outputCol="features").transform(df)
    model = TR.fit(feats, [spec])[0]
    rows = [
        (name, t.number, path, *((_TREE_COLUMNS[c], cut, round(gain, 6)) if c >= 0 else (None, None, None)), round(v, 6) + 0.0)
        for t in model.trees for path, c, cut, gain, v in zip(TR.paths(t), *(v.tolist() for v in (t.column, t.cut, t.gain, t.value)))
    ]
    return spark.createDataFrame(rows, "model string, tree int, path string, column string, cut int, gain double, value double")


@query("boosted_nodes", _tree_sql(_BOOSTED, "boosted"))
def q_boosted_nodes(spark, sf_dir):
    """Every node of three second-order trees with both penalties, least gain and child weight."""
    return _node_query(spark, sf_dir, _BOOSTED, "boosted")


@query("tree_nodes", _tree_sql(_GROWN, "grown"))
def q_tree_nodes(spark, sf_dir):
    """Every node of one weighted classification tree on all rows and columns."""
    return _node_query(spark, sf_dir, _GROWN, "grown")
