"""``df.write.format("copyload")``: executors stream encoded lines into a stage table by COPY, the commit moves them.

Every line carries the mark of the task attempt that sent it. The commit takes only attempts Spark reported as
successful, so the rows of lost or repeated attempts never reach the target. Needs a DB-API driver with
``cursor.copy_expert(statement, file)``, named by the option ``connect`` as ``module:function``.

``writeStream`` with the same format keeps one stage for a stream and moves an epoch's rows, empties the stage and notes the
epoch in one transaction, so an epoch that is repeated after a failure or a restart is moved once.
"""

from __future__ import annotations

import importlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceStreamArrowWriter, WriterCommitMessage

from bulkapply.functions.copycsv import encode_lines
from bulkapply.options import SinkOptions, TargetSpec
from bulkapply.retry import with_retry
from bulkapply.sources import statements as sql
from bulkapply.sources.copyfiles import copy_statement

FORMAT = "copyload"
_ATTEMPT = "load_attempt"
_MARK = "load_mark"
_ATTEMPTS_PER_STATEMENT = 1000
# Fixed value: the property by which Spark tells tasks the id that a streaming query keeps in its checkpoint.
_QUERY_ID = "sql.streaming.queryId"


@dataclass
class Loaded(WriterCommitMessage):
    attempt: int
    rows: int


@dataclass
class LoadedEpoch(WriterCommitMessage):
    mark: str
    rows: int
    query_id: str


class LineReader:
    """Arrow batches of lines as the file object that a COPY call reads."""

    def __init__(self, batches: Iterator[pa.RecordBatch], attempt: int | str):
        self._batches, self._prefix, self.rows = batches, pa.scalar(f"{attempt},", pa.large_string()), 0
        self._text, self._at = memoryview(b""), 0

    def _fill(self) -> bool:
        """Put the attempt in front of each line of the next batch, in one buffer; false at the end."""
        for batch in self._batches:
            if batch.num_rows:
                self.rows += batch.num_rows
                text = pa.large_string()
                lines = pc.binary_join_element_wise(
                    self._prefix, batch.column(0).cast(text), pa.scalar("\n", text), pa.scalar("", text))
                ends = pa.Array.from_buffers(pa.int64(), len(lines) + 1, [None, lines.buffers()[1]], offset=lines.offset)
                self._text, self._at = memoryview(lines.buffers()[2])[ends[0].as_py():ends[len(lines)].as_py()], 0
                return True
        return False

    def read(self, size: int = 65536) -> bytes:
        if self._at >= len(self._text) and not self._fill():
            return b""
        piece = self._text[self._at:self._at + size] if size >= 0 else self._text[self._at:]
        self._at += len(piece)
        return bytes(piece)


class _Target:
    """The table that is loaded and a connection to it for each step."""

    def __init__(self, options: dict[str, str]):
        self.connect_name = options["connect"]
        self.table = options["dbtable"]
        self.columns = options["columns"].split(",")
        self.stage = f"{self.table}_load_{options['batch']}"

    def _connect(self):
        module, _, function = self.connect_name.partition(":")
        return getattr(importlib.import_module(module), function)()

    def _run(self, *statements: str) -> None:
        connection = self._connect()
        try:
            cursor = connection.cursor()
            for statement in statements:
                cursor.execute(statement)
            connection.commit()
        finally:
            connection.close()

    def _send(self, lines: LineReader, marked_by: str) -> int:
        connection = self._connect()
        try:
            connection.cursor().copy_expert(copy_statement(self.stage, [marked_by, *self.columns]), lines)
            connection.commit()
        finally:
            connection.close()
        return lines.rows

    def _moves(self, marked_by: str, marks: list[str]) -> list[str]:
        """The statements that move the rows with these marks, given as literals."""
        return [
            sql.insert_staged(
                self.table, self.stage, self.columns, f"{marked_by} IN ({', '.join(marks[at:at + _ATTEMPTS_PER_STATEMENT])})")
            for at in range(0, len(marks), _ATTEMPTS_PER_STATEMENT)
        ]


class CopyLoadWriter(_Target, DataSourceArrowWriter):
    def __init__(self, options: dict[str, str]):
        super().__init__(options)
        names = ", ".join(self.columns)
        self._run(
            sql.drop(self.stage),
            f"CREATE TABLE {self.stage} AS SELECT CAST(0 AS BIGINT) AS {_ATTEMPT}, {names} FROM {self.table} WHERE false",
        )

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Loaded:
        attempt = TaskContext.get().taskAttemptId()
        return Loaded(attempt, self._send(LineReader(iterator, attempt), _ATTEMPT))

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        attempts = [str(m.attempt) for m in messages if m is not None and m.rows]
        self._run(*self._moves(_ATTEMPT, attempts), sql.drop(self.stage))

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        self._run(sql.drop(self.stage))


class CopyStreamWriter(_Target, DataSourceStreamArrowWriter):
    """One stage for all epochs of a stream. An attempt's mark is random, as attempt numbers begin anew with each application.

    The noted epoch is kept under the id that the query has in its checkpoint, so a stream that begins anew with another
    checkpoint is another stream. What lost attempts sent stays in the stage until the next epoch empties it.
    """

    def __init__(self, options: dict[str, str]):
        super().__init__(options)
        self.epochs = f"{self.table}_load_epochs"
        self.retry = SinkOptions(max_retries=int(options["retries"]), retry_interval=float(options["retry_interval"]))
        names = ", ".join(self.columns)
        self._run(
            f"CREATE TABLE IF NOT EXISTS {self.stage} AS "
            f"SELECT CAST('' AS VARCHAR(32)) AS {_MARK}, {names} FROM {self.table} WHERE false",
            f"CREATE TABLE IF NOT EXISTS {self.epochs} (stream VARCHAR(64), epoch BIGINT, PRIMARY KEY (stream, epoch))",
        )

    def write(self, iterator: Iterator[pa.RecordBatch]) -> LoadedEpoch:
        mark = uuid.uuid4().hex
        query_id = TaskContext.get().getLocalProperty(_QUERY_ID)
        if query_id is None:
            raise RuntimeError("the task does not know its streaming query")
        return LoadedEpoch(mark, self._send(LineReader(iterator, mark), _MARK), query_id)

    def commit(self, messages: list[WriterCommitMessage | None], batchId: int) -> None:
        with_retry(lambda: self._show([m for m in messages if m is not None], batchId), self.retry)

    def _show(self, messages: list[LoadedEpoch], epoch: int) -> None:
        """Move an epoch that is not noted yet; repeating it changes nothing."""
        if not messages:
            return
        stream = f"stream = '{messages[0].query_id}'"
        connection = self._connect()
        try:
            cursor = connection.cursor()
            cursor.execute(f"SELECT max(epoch) FROM {self.epochs} WHERE {stream}")
            noted = cursor.fetchone()[0]
            if noted is None or noted < epoch:
                for statement in (
                    *self._moves(_MARK, [f"'{m.mark}'" for m in messages if m.rows]),
                    f"INSERT INTO {self.epochs}(stream, epoch) VALUES ('{messages[0].query_id}', {int(epoch)})",
                    f"DELETE FROM {self.epochs} WHERE {stream} AND epoch < {int(epoch)}",
                ):
                    cursor.execute(statement)
            cursor.execute(f"DELETE FROM {self.stage}")
            connection.commit()
        finally:
            connection.close()

    def abort(self, messages: list[WriterCommitMessage | None], batchId: int) -> None:
        """Nothing of the epoch is in the target; the next one empties the stage."""


class CopyLoad(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema, overwrite: bool) -> CopyLoadWriter:
        return CopyLoadWriter(dict(self.options))

    def streamWriter(self, schema, overwrite: bool) -> CopyStreamWriter:
        return CopyStreamWriter(dict(self.options))


def copy_load(
    df: DataFrame, spec: TargetSpec, connect: str, batch: str, options: SinkOptions = SinkOptions(bulk=True)
) -> None:
    """Bulk-append through COPY. ``connect`` is imported on the executors; ``batch`` names the stage table.

    A failed load is repeated as the options say, each time into a stage made anew, so nothing of it is in the target twice.
    """
    options.check_target(spec)
    df.sparkSession.dataSource.register(CopyLoad)
    rows = df if options.parallelism is None else df.repartition(options.parallelism)
    lines = encode_lines(rows, spec.columns, options.timestamp_digits)
    named = {"connect": connect, "dbtable": spec.table, "columns": ",".join(spec.columns), "batch": batch}
    with_retry(lambda: lines.write.format(FORMAT).mode("append").options(**named).save(), options)
