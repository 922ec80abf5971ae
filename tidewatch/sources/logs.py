"""Raw log input."""

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

#: A quote inside a quoted field is doubled.
CSV = {"header": True, "quote": '"', "escape": '"'}
RAW_SCHEMA = T.StructType([T.StructField("raw_log", T.StringType(), True)])


def with_line_ids(df: DataFrame, id_column: str = "tx_id") -> DataFrame:
    """Number the lines by partition. Store the result before using the ids in several jobs."""
    return df.withColumn(id_column, F.monotonically_increasing_id())


def read_logs(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """CSV with a header and the column ``raw_log``; the schema is fixed, nothing is inferred.

    ``multi_line`` allows line breaks inside quotes; each file is then read by one task.
    """
    return with_line_ids(spark.read.options(**CSV, multiLine=multi_line).schema(RAW_SCHEMA).csv(path))


def validate_schema(df: DataFrame, required: list[str] = ("raw_log",)) -> DataFrame:
    """The same table, or an error before any job runs."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def read_uploaded_logs(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """CSV whose header is checked, and whose content must hold at least one usable line."""
    from ..operators.parse import log_class

    if not path.lower().endswith(".csv"):
        raise ValueError("only CSV files are accepted")
    header = spark.read.options(**CSV, multiLine=multi_line).csv(path).columns
    if "raw_log" not in header:
        raise ValueError("missing columns: raw_log")
    fields = T.StructType([T.StructField(c, T.StringType(), True) for c in header])
    logs = spark.read.options(**CSV, multiLine=multi_line).schema(fields).csv(path).select("raw_log")
    if logs.filter(log_class(F.col("raw_log")) == "log").isEmpty():
        raise ValueError("no usable log lines")
    return with_line_ids(logs)
