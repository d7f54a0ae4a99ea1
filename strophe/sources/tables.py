"""Reading and writing tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_table(
    spark: SparkSession, path: str, schema: StructType | str | None = None, *,
    fmt: str | None = None, skip_initial_space: bool = False,
) -> DataFrame:
    """A Parquet or CSV table; CSV has a header, quoted multi-line text and doubled quotes."""
    fmt = fmt or ("csv" if path.rstrip("/").endswith((".csv", ".csv.gz")) else "parquet")
    reader = spark.read if schema is None else spark.read.schema(schema)
    if fmt == "csv":
        if schema is None:
            raise ValueError("a CSV table needs a schema")
        reader = (reader.option("header", True).option("multiLine", True).option("quote", '"')
                  .option("escape", '"').option("ignoreLeadingWhiteSpace", skip_initial_space))
    return reader.format(fmt).load(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True).option("quote", '"').option("escape", '"')
    writer.save(path)
