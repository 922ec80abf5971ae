"""The numeric matrix that the unsupervised detectors work on."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..config import DEFAULTS, ScaleLimits
from .context import CONTEXT_COLUMNS
from .sequence import SEQUENCE_COLUMNS
from .skew import checkpointed, lookup, running_total
from .users import PROFILE_COLUMNS

# Order and choice of the numeric and the label-encoded features.
NUMERIC_FEATURES = [
    "amount", "amount_raw", "hour", "day_of_week", "month", "day_of_month", "amount_log", "amount_rounded",
    *[c for c in PROFILE_COLUMNS if not c.endswith("_time")],
    *SEQUENCE_COLUMNS,
    *[c for c in CONTEXT_COLUMNS if c not in ("location_device", "hour_type")],
]
CATEGORICAL_FEATURES = [
    "location_filled", "device_filled", "transaction_type_filled", "currency_filled", "device_brand",
    "transaction_group", "hour_category",
]
UNKNOWN = "unknown"


def label_table(df: DataFrame, columns: list[str], limits: ScaleLimits = DEFAULTS.limits) -> DataFrame:
    """(feature, value, label): labels number the sorted distinct values of each column from 0."""
    pairs = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.coalesce(F.col(c).cast("string"), F.lit(UNKNOWN)).alias("value"))
        for c in columns]))).distinct()
    return running_total(
        pairs.withColumn("_one", F.lit(1)), "feature", "value", "_one", limits, inclusive=False,
    ).select("feature", "value", F.col("_sum").cast("double").alias("label"))


def encode(
    df: DataFrame, labels: DataFrame, columns: list[str], limits: ScaleLimits = DEFAULTS.limits
) -> DataFrame:
    """Add ``<column>_encoded``; a value that was not seen in fitting is encoded as ``unknown``."""
    known = labels.groupBy("feature").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.when(F.col("value") == UNKNOWN, F.col("label"))).alias("unknown"))
    facts = {r["feature"]: (r["n"], r["unknown"] or 0.0) for r in known.collect()}
    for c in columns:
        table = labels.filter(F.col("feature") == c).select(
            F.col("value").alias("_value"), F.col("label").alias(f"{c}_encoded"))
        df = df.withColumn("_value", F.coalesce(F.col(c).cast("string"), F.lit(UNKNOWN)))
        rows, unknown = facts.get(c, (0, 0.0))
        df = lookup(df, table, ["_value"], rows, limits).drop("_value").withColumn(
            f"{c}_encoded", F.coalesce(F.col(f"{c}_encoded"), F.lit(unknown)))
    return df


def _finite(c: Column) -> Column:
    v = c.cast("double")
    return F.when(v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")), 0.0).otherwise(v)


@dataclass(frozen=True)
class MatrixModel:
    """Column choice, label encoding and scaling, as fitted on one table."""

    numeric: list[str]
    categorical: list[str]
    means: list[float]
    stds: list[float]
    labels: DataFrame | None
    limits: ScaleLimits = DEFAULTS.limits

    @property
    def names(self) -> list[str]:
        return self.numeric + [f"{c}_encoded" for c in self.categorical]

    def raw(self, df: DataFrame) -> DataFrame:
        return _raw_matrix(df, self.numeric, self.categorical, self.labels, self.limits)

    def transform(self, df: DataFrame, id_column: str = "tx_id") -> DataFrame:
        """(id, features): z-scores with the population std; a constant column becomes 0."""
        raw = self.raw(df)
        scaled = [
            (F.col(n) - F.lit(m)) / F.lit(s) if s > 0 else F.lit(0.0)
            for n, m, s in zip(self.names, self.means, self.stds)]
        return raw.select(F.col(id_column), F.array(*scaled).alias("features"))


def _raw_matrix(df, numeric, categorical, labels, limits):
    out = encode(df, labels, categorical, limits) if categorical else df
    return out.withColumns({n: _finite(F.col(n)) for n in numeric})


def fit_matrix(df: DataFrame, numeric_only: bool = False, limits: ScaleLimits = DEFAULTS.limits) -> MatrixModel:
    """Fit on the feature table ``df``. Only the mean and std of each column reach the driver."""
    numeric = [c for c in NUMERIC_FEATURES if c in df.columns]
    categorical = [] if numeric_only else [c for c in CATEGORICAL_FEATURES if c in df.columns]
    labels = checkpointed(label_table(df, categorical, limits)) if categorical else None
    raw = _raw_matrix(df, numeric, categorical, labels, limits)
    names = numeric + [f"{c}_encoded" for c in categorical]
    # One pair of aggregates over (column, value): a pair for each column makes a method too large to be compiled.
    cells = raw.select(F.posexplode(F.array(*[F.col(n).cast("double") for n in names])).alias("i", "v"))
    facts = {r["i"]: (r["m"], r["s"]) for r in cells.groupBy("i").agg(F.avg("v").alias("m"), F.stddev_pop("v").alias("s")).collect()}
    means = [facts.get(i, (None, None))[0] or 0.0 for i in range(len(names))]
    stds = [facts.get(i, (None, None))[1] or 0.0 for i in range(len(names))]
    # A spread that is only rounding noise of a constant column counts as none.
    stds = [s if s > 1e-12 * max(1.0, abs(m)) else 0.0 for s, m in zip(stds, means)]
    return MatrixModel(numeric, categorical, means, stds, labels, limits)


def vector_matrix(df: DataFrame, id_column: str, vector_column: str, scale: bool = True) -> DataFrame:
    """The same (id, features) shape from a table that already holds vectors."""
    x = df.select(F.col(id_column).alias("tx_id"), F.col(vector_column).cast("array<double>").alias("features"))
    if not scale:
        return x
    dims = x.select(F.max(F.size("features"))).first()[0]
    row = x.agg(*[F.avg(F.col("features")[i]).alias(f"m{i}") for i in range(dims)],
                *[F.stddev_pop(F.col("features")[i]).alias(f"s{i}") for i in range(dims)]).first()
    return x.withColumn("features", F.array(*[
        (F.col("features")[i] - F.lit(row[f"m{i}"])) / F.lit(row[f"s{i}"]) if row[f"s{i}"] else F.lit(0.0)
        for i in range(dims)]))


def principal_components(matrix: DataFrame, k: int = 2) -> tuple[DataFrame, list[float]]:
    """Project the matrix on its first ``k`` principal components; also their shares of variance."""
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import array_to_vector, vector_to_array

    vectors = matrix.withColumn("_v", array_to_vector("features"))
    model = PCA(k=k, inputCol="_v", outputCol="_c").fit(vectors)
    parts = model.transform(vectors).withColumn("_c", vector_to_array("_c"))
    out = parts.select("tx_id", *[F.col("_c")[i].alias(f"component_{i + 1}") for i in range(k)])
    return out, [float(v) for v in model.explainedVariance]
