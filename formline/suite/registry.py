"""Registry of the named queries, and how results are published for comparison."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, DoubleType, FloatType, IntegralType


class Tables:
    """The Parquet tables of a folder as attributes."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Tables], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.build(Tables(spark, folder))


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    def register(build: Callable[[Tables], DataFrame]):
        QUERIES[name] = Query(name, build, sql)
        return build

    return register


def publish(df: DataFrame, default: int = 4, **digits: int) -> DataFrame:
    """One type per kind of value: BIGINT, rounded DOUBLE, text, and ISO text for dates."""
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (IntegralType, BooleanType)):
            column = column.cast("long")
        elif isinstance(field.dataType, (DoubleType, FloatType)):
            column = rounded_column(column, digits.get(field.name, default))
        elif isinstance(field.dataType, DateType):
            column = F.date_format(column, "yyyy-MM-dd")
        columns.append(column.alias(field.name))
    return df.select(*columns)


# Engines differ in how they round a value that ends in a 5, and a last bit may decide which side of
# a tie a computed value is on. Both sides therefore use the same arithmetic, with ties off the edge.
HALF = 0.501


def rounded_column(column: Column, digits: int) -> Column:
    # Whole part apart from fraction, in doubles: no value saturates, and NaN and infinity stay what they are.
    scale = F.lit(float(10 ** digits))
    usual = F.abs(column) < F.lit(float(2 ** 53 / 10 ** digits))
    return F.when(usual, F.floor(column * scale + F.lit(HALF)) / scale).otherwise(column.cast("double"))


# ------------------------------------------------------------------------- pieces of SQL text
def rounded(expression: str, digits: int = 4) -> str:
    return f"(floor(({expression}) * 1e{digits} + {HALF}::DOUBLE) / 1e{digits})"


def whole(expression: str) -> str:
    return f"CAST({expression} AS BIGINT)"


def day_text(expression: str) -> str:
    return f"strftime({expression}, '%Y-%m-%d')"


def with_ctes(ctes: list[str], body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body
