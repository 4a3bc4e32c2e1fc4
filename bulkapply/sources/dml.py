"""User-supplied statements: bind record fields to named parameters, then run one statement over the whole batch."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession


def bind(df: DataFrame, bindings: Mapping[str, Column]) -> DataFrame:
    """One column per parameter, every record kept."""
    if not bindings:
        raise ValueError("a statement needs at least one bound parameter")
    return df.select(*[value.alias(name) for name, value in bindings.items()])


def run_statement(spark: SparkSession, statement: str, bound: DataFrame) -> None:
    """Run a data-changing statement of the session's catalog that reads the bound rows as ``{batch}``."""
    if "{batch}" not in statement:
        raise ValueError("the statement must read the bound rows as {batch}")
    spark.sql(statement, batch=bound)
