"""Database targets: Spark's JDBC writer moves the rows, one set-based transaction applies them.

The JDBC driver of the target must be on the driver's and the executors' class path.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from contextlib import suppress
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bulkapply.functions.convert import to_sql_types
from bulkapply.operators.changelog import OP, collapse, is_upsert
from bulkapply.operators.split import range_predicates, value_predicates
from bulkapply.options import SinkOptions, TargetSpec
from bulkapply.retry import with_retry
from bulkapply.sources import statements as sql
from bulkapply.sources.dml import bind

STAGED_UPSERT = "staged_upsert"

Save = Callable[[DataFrame, str], None]
Execute = Callable[[Sequence[str]], None]


@dataclass(frozen=True)
class JdbcTarget:
    """Where the table is. ``user`` and ``password`` go together."""

    url: str
    spec: TargetSpec
    user: str | None = None
    password: str | None = field(default=None, repr=False)
    driver: str | None = None
    properties: Mapping[str, str] = field(default_factory=dict)

    def __post_init__(self):
        if not self.url:
            raise ValueError("a database target needs a url")
        if (self.user is None) != (self.password is None):
            raise ValueError("give both user and password, or neither")

    def login(self) -> dict[str, str]:
        given = {"user": self.user, "password": self.password, "driver": self.driver}
        return {**self.properties, **{k: v for k, v in given.items() if v is not None}}


def save_with(target: JdbcTarget, options: SinkOptions, mode: str = "overwrite") -> Save:
    """Rows into a table over parallel connections, ``max_rows`` per round trip."""

    def save(df: DataFrame, table: str) -> None:
        rows = df if options.parallelism is None else df.repartition(options.parallelism)
        writer = rows.write.format("jdbc").mode(mode).options(**target.login())
        # A stage that Spark creates gets the column types of the database's own dialect.
        writer.option("url", target.url).option("dbtable", table).option("batchsize", options.max_rows).save()

    return save


def execute_with(spark: SparkSession, target: JdbcTarget) -> Execute:
    """Statements in one transaction, over one connection of the driver process."""

    def execute(statements: Sequence[str]) -> None:
        properties = spark._jvm.java.util.Properties()
        for name, value in target.login().items():
            properties.setProperty(name, value)
        connection = spark._jvm.java.sql.DriverManager.getConnection(target.url, properties)
        try:
            connection.setAutoCommit(False)
            statement = connection.createStatement()
            for text in statements:
                statement.execute(text)
            connection.commit()
        except Exception:
            connection.rollback()
            raise
        finally:
            connection.close()

    return execute


def stage_name(spec: TargetSpec, batch_id: int | str | None) -> str:
    """One stage per batch; a batch without an id of its own gets a name no other job uses."""
    return f"{spec.table}_stage_{uuid.uuid4().hex[:16] if batch_id is None else batch_id}"


def _through_stage(
    rows: DataFrame, stage: str, statements: Sequence[str], options: SinkOptions, save: Save, execute: Execute
) -> None:
    """Fill a stage table, then change the target in one transaction. A failed attempt leaves the target as it was."""

    def attempt() -> None:
        save(rows, stage)
        execute([*statements, sql.drop(stage)])

    try:
        with_retry(attempt, options)
    except Exception:
        with suppress(Exception):
            execute([sql.drop(stage)])
        raise


def append_rows(
    df: DataFrame,
    target: JdbcTarget,
    options: SinkOptions = SinkOptions(),
    batch_id: int | str | None = None,
    save: Save | None = None,
    execute: Execute | None = None,
) -> None:
    """Append. With retries the rows go through a stage, so a half-written attempt never reaches the target."""
    spec = target.spec
    rows = to_sql_types(df.select(*spec.columns))
    if options.max_retries == 0:
        (save or save_with(target, options, "append"))(rows, spec.table)
        return
    stage = stage_name(spec, batch_id)
    _through_stage(
        rows,
        stage,
        [sql.insert_staged(spec.table, stage, spec.columns)],
        options,
        save or save_with(target, options),
        execute or execute_with(df.sparkSession, target),
    )


def apply_rows(
    changes: DataFrame,
    target: JdbcTarget,
    sequence_by: Sequence[str],
    options: SinkOptions = SinkOptions(),
    batch_id: int | str | None = None,
    op_col: str = OP,
    save: Save | None = None,
    execute: Execute | None = None,
) -> None:
    """Collapse a changelog, stage one row per key, then upsert and delete by key in one transaction."""
    spec = target.spec
    options.check_target(spec)
    last = collapse(changes, spec.keys, sequence_by, op_col)
    rows = to_sql_types(last.select(*spec.columns, is_upsert(F.col(op_col)).alias(STAGED_UPSERT)))
    stage = stage_name(spec, batch_id)
    steps = [
        sql.upsert_staged(spec.table, stage, spec.columns, spec.keys, STAGED_UPSERT),
        sql.delete_staged(spec.table, stage, spec.keys, f"NOT {STAGED_UPSERT}"),
    ]
    _through_stage(
        rows, stage, steps, options,
        save or save_with(target, options), execute or execute_with(changes.sparkSession, target),
    )


def run_custom(
    df: DataFrame,
    target: JdbcTarget,
    statement: str,
    bindings: Mapping[str, Column],
    options: SinkOptions = SinkOptions(),
    batch_id: int | str | None = None,
    save: Save | None = None,
    execute: Execute | None = None,
) -> None:
    """Any statement over the bound records, which it reads as the table ``{batch}``."""
    if "{batch}" not in statement:
        raise ValueError("the statement must read the bound rows as {batch}")
    stage = stage_name(target.spec, batch_id)
    _through_stage(
        to_sql_types(bind(df, bindings)), stage, [statement.replace("{batch}", stage)], options,
        save or save_with(target, options), execute or execute_with(df.sparkSession, target),
    )


def read_back(spark: SparkSession, target: JdbcTarget) -> DataFrame:
    """The target's columns; filters and column choice are pushed to the database."""
    reader = spark.read.format("jdbc").options(**target.login()).option("url", target.url)
    return reader.option("dbtable", target.spec.table).load().select(*target.spec.columns)


def read_ranges(spark: SparkSession, target: JdbcTarget, column: str, ranges: Sequence[tuple[int, int]]) -> DataFrame:
    """One partition and one query per range."""
    return spark.read.jdbc(
        target.url, target.spec.table, predicates=range_predicates(column, ranges), properties=target.login()
    )


def read_values(spark: SparkSession, target: JdbcTarget, column: str, values: Sequence[str]) -> DataFrame:
    """One partition and one query per value."""
    return spark.read.jdbc(
        target.url, target.spec.table, predicates=value_predicates(column, values), properties=target.login()
    )
