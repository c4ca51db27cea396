"""Reading reviews and intents, writing intents and labelled output."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from review_topics import schemas

REVIEW_COLUMNS = {
    "id": "id",
    "Airline Name": "Airline_Name",
    "Overall_Rating": "Overall_Rating",
    "Review_Title": "Review_Title",
    "Review": "Review",
}


def read_table(spark: SparkSession, name_or_path: str) -> DataFrame:
    """Catalog table by its (up to three-part) name, or Parquet files when the argument is a path."""
    if "/" in name_or_path:
        return spark.read.parquet(name_or_path)
    return spark.table(name_or_path)


def read_reviews(spark: SparkSession, name_or_path: str, mapping: dict[str, str] | None = None) -> DataFrame:
    """Reviews with the columns of ``mapping`` (source name -> our name); other columns are pruned at the scan."""
    table = read_table(spark, name_or_path)
    mapping = mapping or {source: ours for source, ours in REVIEW_COLUMNS.items() if source in table.columns}
    return table.select(*[F.col(f"`{source}`").alias(ours) for source, ours in mapping.items()])


def read_intents(spark: SparkSession, name_or_path: str) -> DataFrame:
    """Intents table with its ten typed columns."""
    table = read_table(spark, name_or_path)
    return table.select(*schemas.intents_columns(table))


def _write(df: DataFrame, target: str, mode: str, table_format: str, partition_by: list[str] | None) -> None:
    writer = df.write.mode(mode).format(table_format)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if "/" in target:
        writer.save(target)
    else:
        writer.saveAsTable(target)


def write_intents(df: DataFrame, target: str, table_format: str = "parquet") -> None:
    """Replace the intents table."""
    _write(df, target, "overwrite", table_format, None)


def write_labels(
    df: DataFrame, target: str, table_format: str = "parquet", partition_by: list[str] | None = None
) -> None:
    """Write the labelled output; fails when the target already exists."""
    _write(df, target, "errorifexists", table_format, partition_by)
