"""Fitted preprocessing as ``pyspark.ml`` stages (fit on train, transform anything).

Spark's ``StandardScaler`` divides by the *sample* std and ``RobustScaler`` uses approximate
quantiles, so scaling is a small Estimator/Model pair here: ``fit`` runs one aggregate (or the exact
two-phase quantile) and keeps k numbers; ``transform`` is a narrow projection with literals.
One-hot encoding uses the built-in ``StringIndexer`` / ``OneHotEncoder``.
All stages persist with the standard ML writers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel, Transformer
from pyspark.ml.feature import Bucketizer, OneHotEncoder, StringIndexer, VectorAssembler, VectorSlicer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasInputCols, HasOutputCol, HasOutputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens import schema as S
from churnlens.functions import features as FX
from churnlens.functions.prefix import exact_quantiles


class _ScalerParams(HasInputCols, HasOutputCols):
    method = Param(Params._dummy(), "method", "'standard' (mean, population std) or 'robust' (median, IQR)",
                   typeConverter=TypeConverters.toString)

    def __init__(self):
        super().__init__()
        self._setDefault(method="standard")


class ColumnScaler(Estimator, _ScalerParams, DefaultParamsReadable, DefaultParamsWritable):
    """(x - center) / scale per column; zero scale divides by 1 (sklearn behaviour)."""

    @keyword_only
    def __init__(self, inputCols=None, outputCols=None, method="standard"):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "ColumnScalerModel":
        cols = self.getInputCols()
        if self.getOrDefault("method") == "standard":
            row = df.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)],
                         *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(cols)]).first()
            centers = [float(row[f"m{i}"]) for i in range(len(cols))]
            scales = [float(row[f"s{i}"]) for i in range(len(cols))]
        else:
            from churnlens.operators.explore import stack_columns

            long = stack_columns(df, cols, as_string=False)
            q = {r["feature"]: r for r in exact_quantiles(long, ["feature"], "value", {"q1": 0.25, "med": 0.5, "q3": 0.75}).collect()}
            centers = [float(q[c]["med"]) for c in cols]
            scales = [float(q[c]["q3"] - q[c]["q1"]) for c in cols]
        scales = [s if s and s > 0 else 1.0 for s in scales]
        return self._copyValues(ColumnScalerModel(centers=centers, scales=scales))


class ColumnScalerModel(Model, _ScalerParams, DefaultParamsReadable, DefaultParamsWritable):
    centers = Param(Params._dummy(), "centers", "fitted centers", typeConverter=TypeConverters.toListFloat)
    scales = Param(Params._dummy(), "scales", "fitted scales", typeConverter=TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, centers=None, scales=None, inputCols=None, outputCols=None, method="standard"):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        cs, ss = self.getOrDefault("centers"), self.getOrDefault("scales")
        return df.withColumns({
            o: (F.col(i).cast("double") - F.lit(c)) / F.lit(s)
            for i, o, c, s in zip(self.getInputCols(), self.getOutputCols(), cs, ss)
        })


class QuantileBinner(Estimator, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Quantile bins (exact linear percentiles of the fit data), duplicate edges merged,
    left-closed inner edges, out-of-range values clipped to the end bins."""

    numBins = Param(Params._dummy(), "numBins", "number of bins", typeConverter=TypeConverters.toInt)

    @keyword_only
    def __init__(self, inputCol=None, outputCol=None, numBins=5):
        super().__init__()
        self._setDefault(numBins=5)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> Bucketizer:
        k = self.getOrDefault("numBins")
        col = self.getInputCol()
        probs = {f"p{i}": i / k for i in range(k + 1)}
        row = exact_quantiles(df.select(F.col(col).cast("double").alias("v")), [], "v", probs).first()
        edges = [float(row[f"p{i}"]) for i in range(k + 1)]
        kept = [edges[0]] + [e for prev, e in zip(edges, edges[1:]) if e - prev > 1e-8]
        inner = kept[1:-1]
        return Bucketizer(splits=[float("-inf"), *inner, float("inf")], inputCol=col, outputCol=self.getOutputCol())


class ProdFeatures(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Production derived columns (same code at fit and at scoring)."""

    def _transform(self, df: DataFrame) -> DataFrame:
        return FX.prod_features(df)


class V2Features(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Flags, interactions, log/ratio features, risk score and log1p(Balance)."""

    def _transform(self, df: DataFrame) -> DataFrame:
        out = FX.risk_score(FX.ratio_features(df))
        return out.withColumn("Balance_log1p", F.log1p(F.col("Balance").cast("double")))


class NonFiniteCleaner(Transformer, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """NaN, +/-Inf and null -> 0.0 in place, before assembling."""

    @keyword_only
    def __init__(self, inputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: FX.clean_nonfinite(F.col(c)) for c in self.getInputCols()})


class DropFirstOneHot(Estimator, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """One-hot with the alphabetically first category dropped; unseen categories -> all zeros."""

    @keyword_only
    def __init__(self, inputCol=None, outputCol=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> PipelineModel:
        c, o = self.getInputCol(), self.getOutputCol()
        idx = StringIndexer(inputCol=c, outputCol=f"{o}__idx", stringOrderType="alphabetAsc", handleInvalid="keep").fit(df)
        n = len(idx.labels)
        ohe = OneHotEncoder(inputCol=f"{o}__idx", outputCol=f"{o}__full", dropLast=True).fit(idx.transform(df))
        if n < 2:  # the only category is the dropped one: an empty block
            return PipelineModel([idx, ohe, VectorAssembler(inputCols=[], outputCol=o)])
        slicer = VectorSlicer(inputCol=f"{o}__full", outputCol=o, indices=list(range(1, n)))
        return PipelineModel([idx, ohe, slicer])


def one_hot_stages(cols: Sequence[str], suffix: str = "_ohe", drop_last: bool = True):
    """sklearn-style full one-hot: sorted categories, unknown -> zeros (keep slot dropped)."""
    idx = StringIndexer(inputCols=list(cols), outputCols=[f"{c}__idx" for c in cols], stringOrderType="alphabetAsc", handleInvalid="keep")
    ohe = OneHotEncoder(inputCols=[f"{c}__idx" for c in cols], outputCols=[f"{c}{suffix}" for c in cols], dropLast=drop_last)
    return [idx, ohe]


# Production column groups of the 17-column matrix.
PROD_SCALED = ("CreditScore", "Age", "Age_log", "Tenure", "Balance", "Balance_Salary_Ratio", "NumOfProducts",
               "Products_Per_Tenure", "EstimatedSalary")
PROD_ONE_HOT = ("Geography", "Gender")
PROD_BINARY = ("HasCrCard", "IsActiveMember", "Active_CreditCard")

# v2 column groups.
V2_CUSTOM_FLAGS = ("HasBalance", "IsSenior", "Has3PlusProducts", "IsInactive", "IsGermany", "IsFemale",
                   "Germany_Female", "Senior_Inactive", "Germany_Senior")
V2_CUSTOM_SCALED = ("Age_Log", "BalancePerProduct", "RiskScore")


def prod_preprocessor() -> Pipeline:
    """17 features: 9 standard-scaled, 5 one-hot (Geography, Gender), 3 binary passthrough."""
    scaled = [f"{c}_scaled" for c in PROD_SCALED]
    return Pipeline(stages=[
        ProdFeatures(),
        ColumnScaler(inputCols=list(PROD_SCALED), outputCols=scaled),
        *one_hot_stages(PROD_ONE_HOT),
        VectorAssembler(inputCols=scaled + [f"{c}_ohe" for c in PROD_ONE_HOT] + list(PROD_BINARY), outputCol="features"),
    ])


def v2_preprocessor(age_bins: int = 5) -> Pipeline:
    """28 features: 16 from the column transformer + 12 engineered (scaled where numeric)."""
    custom_scaled = [f"{c}_scaled" for c in V2_CUSTOM_SCALED]
    cols = (["CreditScore_std", "Age_robust", "Age_bin_ohe", "Balance_log_scaled", "Geography_drop1", "Gender_drop1",
             "NumOfProducts_ohe", "IsActiveMember"] + list(V2_CUSTOM_FLAGS) + custom_scaled)
    return Pipeline(stages=[
        V2Features(),
        ColumnScaler(inputCols=["CreditScore"], outputCols=["CreditScore_std"]),
        ColumnScaler(inputCols=["Age"], outputCols=["Age_robust"], method="robust"),
        QuantileBinner(inputCol="Age", outputCol="Age_bin", numBins=age_bins),
        OneHotEncoder(inputCol="Age_bin", outputCol="Age_bin_ohe", dropLast=False),
        ColumnScaler(inputCols=["Balance_log1p"], outputCols=["Balance_log_scaled"]),
        DropFirstOneHot(inputCol="Geography", outputCol="Geography_drop1"),
        DropFirstOneHot(inputCol="Gender", outputCol="Gender_drop1"),
        *one_hot_stages(["NumOfProducts"]),
        ColumnScaler(inputCols=list(V2_CUSTOM_SCALED), outputCols=custom_scaled),
        NonFiniteCleaner(inputCols=["CreditScore_std", "Age_robust", "Balance_log_scaled", *custom_scaled]),
        VectorAssembler(inputCols=cols, outputCol="features"),
    ])


def feature_names(model: PipelineModel) -> list[str]:
    """Output names of a fitted preprocessor, in vector order (error when not fitted)."""
    if not isinstance(model, PipelineModel):
        raise ValueError("preprocessor is not fitted")
    assembler = [s for s in model.stages if isinstance(s, VectorAssembler)][-1]
    names: list[str] = []
    labels: dict[str, list[str]] = {}
    bins: dict[str, int] = {}
    for s in model.stages:
        if isinstance(s, PipelineModel):  # DropFirstOneHot
            idx, _, slicer = s.stages
            labels[slicer.getOutputCol()] = [f"{idx.getInputCol()}_{v}" for v in idx.labels[1:]]
        elif type(s).__name__ == "StringIndexerModel":
            for c, lab in zip(s.getInputCols(), s.labelsArray):
                labels[f"{c}_ohe"] = [f"{c}_{v}" for v in lab]
        elif isinstance(s, Bucketizer):
            bins[f"{s.getOutputCol()}_ohe"] = len(s.getSplits()) - 1
    for c in assembler.getInputCols():
        if c in labels:
            names.extend(labels[c])
        elif c in bins:
            names.extend(f"{c.replace('_ohe', '')}_{i}" for i in range(bins[c]))
        else:
            names.append(c)
    return names


def with_label(df: DataFrame, target: str = S.TARGET) -> DataFrame:
    return df.withColumn("label", F.col(target).cast("double"))
