"""Cost response pages (column names and positional rows) to typed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PAGE = "properties struct<columns: array<struct<name: string>>, rows: array<array<string>>, nextLink: string>"
# Names that the cost column goes by.
COST_NAMES = ["cost", "pretaxcost", "totalcost"]


def parse_cost_pages(pages: DataFrame, resource_group: str, month: str) -> DataFrame:
    """One row for each positional row: month, usage_date, resource_group, service_name, resource_type, cost, currency.
    Columns are found by name, whatever their case; missing optional ones are null; a page without a cost column fails."""
    names = F.transform("properties.columns", lambda c: F.lower(c["name"]))
    at = lambda n: F.array_position(names, F.lit(n))
    cost_at = F.greatest(*[F.coalesce(F.nullif(at(n), F.lit(0)), F.lit(0)) for n in COST_NAMES])
    checked = F.when(cost_at > 0, cost_at).otherwise(F.raise_error(F.concat(F.lit("no cost column in "), F.array_join(names, ", "))).cast("bigint"))
    placed = pages.select(F.explode("properties.rows").alias("r"), checked.alias("c"), *[at(n).alias(n) for n in ("usagedate", "currency", "servicename", "resourcetype")])
    cell = lambda i: F.when(F.col(i) > 0, F.try_element_at("r", F.col(i).cast("int")))
    return placed.select(
        F.lit(month).alias("month"),
        F.to_date(cell("usagedate").cast("decimal(20,0)").cast("string"), "yyyyMMdd").alias("usage_date"),
        F.lit(resource_group).alias("resource_group"),
        cell("servicename").alias("service_name"),
        cell("resourcetype").alias("resource_type"),
        cell("c").cast("double").alias("cost"),
        cell("currency").alias("currency"),
    )


def read_cost_pages(spark: SparkSession, path: str, resource_group: str, month: str) -> DataFrame:
    return parse_cost_pages(spark.read.schema(PAGE).option("multiLine", "true").json(path), resource_group, month)


def fetched_at() -> Column:
    return F.current_timestamp()
