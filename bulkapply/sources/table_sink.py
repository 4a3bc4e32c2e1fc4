"""A database table declared by options, columns and an optional key, written from bounded or streaming DataFrames.

The declaration decides the path: a key means upsert and delete by key, no key means append, and append with
``sink.use-copy-protocol`` means COPY.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from bulkapply.functions.convert import to_declared
from bulkapply.functions.schema import validate_schema
from bulkapply.operators.changelog import OP, ChangelogError
from bulkapply.options import SinkOptions, TargetSpec
from bulkapply.sources import jdbc
from bulkapply.sources.copyload import copy_load
from bulkapply.streaming.sink import apply_stream, copy_load_stream, feed_name


@dataclass(frozen=True)
class TableSink:
    """``save`` and ``execute`` replace the database access; None means the database at the declared url."""

    target: jdbc.JdbcTarget
    options: SinkOptions
    schema: T.StructType
    connect: str | None = None
    save: jdbc.Save | None = None
    execute: jdbc.Execute | None = None

    @classmethod
    def declare(
        cls,
        options: Mapping[str, object],
        schema: T.StructType | str,
        keys: Sequence[str] = (),
        connect: str | None = None,
        save: jdbc.Save | None = None,
        execute: jdbc.Execute | None = None,
    ) -> TableSink:
        """Check a declaration. ``connect`` names the DB-API connect function that COPY uses, as ``module:function``."""
        missing = [name for name in ("url", "table-name") if not options.get(name)]
        if missing:
            raise ValueError(f"missing options: {missing}")
        columns = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        validate_schema(columns)
        spec = TargetSpec(str(options["table-name"]), columns.names, tuple(keys))
        delivery = SinkOptions.from_map(options)
        delivery.check_target(spec)
        if delivery.bulk and connect is None:
            raise ValueError("COPY needs the connect function of a database driver")
        user, password = options.get("username"), options.get("password")
        target = jdbc.JdbcTarget(
            str(options["url"]), spec, None if user is None else str(user), None if password is None else str(password)
        )
        return cls(target, delivery, columns, connect, save, execute)

    def _typed(self, df: DataFrame, more: Sequence[str]) -> DataFrame:
        declared = {f.name: f.dataType for f in self.schema.fields}
        extra = {c: df.schema[c].dataType for c in more if c not in declared}
        return to_declared(df, declared | extra)

    def write(
        self, df: DataFrame, sequence_by: Sequence[str] = (), op_col: str | None = None, batch_id: str | None = None
    ) -> None:
        """Write one batch. With a key, rows without a kind column count as writes.

        ``batch_id`` names the stage table; the same id again replaces what a failed attempt left.
        """
        spec = self.target.spec
        if not spec.keys:
            if op_col is not None:
                raise ChangelogError(f"{spec.table} declares no key, so it takes no updates and deletes")
            rows = self._typed(df, ())
            if self.options.bulk:
                copy_load(rows, spec, self.connect, batch_id or uuid.uuid4().hex[:16], self.options)
            else:
                jdbc.append_rows(rows, self.target, self.options, batch_id, self.save, self.execute)
            return
        changes = df if op_col is not None else df.withColumn(OP, F.lit("+U"))
        kind = op_col or OP
        rows = self._typed(changes, [*sequence_by, kind])
        jdbc.apply_rows(rows, self.target, sequence_by, self.options, batch_id, kind, self.save, self.execute)

    def write_stream(
        self,
        stream: DataFrame,
        checkpoint: str,
        sequence_by: Sequence[str] = (),
        op_col: str | None = None,
        output_mode: str = "append",
        available_now: bool = False,
    ) -> StreamingQuery:
        """Write every micro-batch; it is flushed before the checkpoint counts it as done."""
        if not self.target.spec.keys and (op_col is not None or output_mode != "append"):
            raise ChangelogError(f"{self.target.spec.table} declares no key, so it takes no updates and deletes")
        if self.options.bulk:
            rows = self._typed(stream, ())
            return copy_load_stream(rows, self.target.spec, self.connect, checkpoint, self.options, available_now)
        once = replace(self.options, max_retries=0)
        feed = feed_name(checkpoint)
        return apply_stream(
            stream,
            lambda rows, batch_id: self.write(rows, sequence_by, op_col, f"{feed}_{batch_id}"),
            checkpoint,
            once,
            output_mode,
            available_now,
        )
