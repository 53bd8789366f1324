"""Readers and sinks for sales, holidays and derived tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .schemas import HOLIDAYS_RAW, RETAIL_RAW


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None, fmt: str = "parquet",
               timestamp_format: str | None = None, check_header: bool = False) -> DataFrame:
    """Typed read of a CSV file with header or of a Parquet table; CSV columns go by position."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    if fmt == "csv":
        if schema is None:
            raise ValueError("a CSV source needs a declared schema")
        reader = reader.option("header", True).option("escape", '"').option("enforceSchema", not check_header)
        if timestamp_format:
            reader = reader.option("timestampNTZFormat", timestamp_format)
    return reader.format(fmt).load(path)


def read_sales(spark: SparkSession, path: str, fmt: str = "csv", timestamp_format: str | None = None) -> DataFrame:
    """Raw sale lines.

    In CSV, ids may be written as ``17850.0``, prices keep four decimals, and
    values that cannot be read become NULL.
    """
    if fmt != "csv":
        return read_table(spark, path, RETAIL_RAW, fmt)
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in RETAIL_RAW])
    raw = read_table(spark, path, text, "csv", check_header=True)
    return raw.select(
        "InvoiceNo", "StockCode", "Description",
        whole_number("Quantity").alias("Quantity"),
        parse_timestamp("InvoiceDate", timestamp_format, coerce=True).alias("InvoiceDate"),
        F.col("UnitPrice").try_cast("decimal(14,4)").alias("UnitPrice"),
        whole_number("CustomerID").alias("CustomerID"),
        "Country",
    )


def whole_number(col: str):
    """Text to BIGINT; NULL for what is no number, no whole one, or too large."""
    number = F.col(col).try_cast("decimal(38,6)")
    return F.when(number == F.floor(number), number).try_cast("bigint")


def parse_timestamp(col: str, fmt: str | None = None, coerce: bool = False):
    """Text to TIMESTAMP_NTZ; with ``coerce`` unreadable text gives NULL instead of an error."""
    if fmt is None:
        return F.col(col).try_cast("timestamp_ntz") if coerce else F.col(col).cast("timestamp_ntz")
    parse = F.try_to_timestamp if coerce else F.to_timestamp
    return parse(F.col(col), F.lit(fmt)).cast("timestamp_ntz")


def read_holidays(spark: SparkSession, path: str, fmt: str = "csv", timestamp_format: str | None = None) -> DataFrame:
    """The raw calendar. Columns of a CSV file go by the names in its header, in any order; one that is missing fails.

    A first column without a name is the row number.
    """
    if fmt != "csv":
        return read_table(spark, path, HOLIDAYS_RAW, fmt)
    header = spark.read.option("header", True).option("escape", '"').csv(path).columns  # the first line alone is read
    names = [HOLIDAYS_RAW[0].name if c == "_c0" else c for c in header]
    absent = sorted(set(HOLIDAYS_RAW.names) - set(names))
    if absent:
        raise ValueError(f"the calendar lacks {', '.join(absent)}; its header has {', '.join(header)}")
    found = T.StructType([HOLIDAYS_RAW[c] if c in HOLIDAYS_RAW.names else T.StructField(c, T.StringType()) for c in names])
    return read_table(spark, path, found, fmt, timestamp_format).select(*[f"`{c}`" for c in HOLIDAYS_RAW.names])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The declared columns of ``df`` in their order and types; a missing one fails."""
    return df.select(*[F.col(f.name).cast(f.dataType) for f in schema])


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: str | None = None,
                backup_path: str | None = None) -> None:
    """Overwrite ``path``; a partitioned sink is rebalanced so that a hot partition value is split.

    The backup is a copy of the written table: what made it does not run again.
    CSV keeps quotes, but an empty text is read back as NULL.
    """
    def save(rows, target):
        writer = rows.write.mode("overwrite").format(fmt)
        if fmt == "csv":
            writer = writer.option("header", True).option("escape", '"')
        if partition_by is not None:
            writer = writer.partitionBy(partition_by)
        writer.save(target)

    save(df if partition_by is None else df.hint("rebalance", partition_by), path)
    if backup_path:
        # files hold the partition column last, and CSV goes by position
        ordered = [c for c in df.columns if c != partition_by] + [partition_by] * (partition_by is not None)
        save(read_table(df.sparkSession, path, df.select(ordered).schema, fmt), backup_path)
