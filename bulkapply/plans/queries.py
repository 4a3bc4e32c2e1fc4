"""The registered queries: each operator over whole tables. Each callable takes (spark, folder of the tables)."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import suppress

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bulkapply.functions import convert, copycsv, schema
from bulkapply.operators import changelog, flush, keyed, split
from bulkapply.operators.kept_aggregate import KeptAggregate
from bulkapply.options import SinkOptions
from bulkapply.sources import copyfiles, copyranges, dml, tables
from bulkapply.sources.keyed_table import DuplicateKeyError, KeyedTable
from bulkapply.storage import is_folder, scratch_path
from bulkapply.streaming import sink
from bulkapply.streaming.changelog_table import ChangelogTable, Tiers

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)
LINE_KEY = ["l_orderkey", "l_linenumber"]
EVENT_ORDER = ["ts", "event_id"]
MIDDLE = "2024-01-16"
YEAR = "1998-01-01"


def writers(spark: SparkSession) -> int:
    """Writers and buckets of a large table: as many as the session's shuffle partitions, which a cluster sets by its data."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def load(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


# --- append -----------------------------------------------------------------------------------------------------------


def append_orders(spark, folder):
    path = scratch_path(spark, "append_orders")
    tables.append(load(spark, folder, "orders"), path)
    return tables.read_table(spark, path)


def append_twice(spark, folder):
    """The second load shifts the ids, as two loads with the same ids would break a target's key."""
    path = scratch_path(spark, "append_twice")
    orders = load(spark, folder, "orders")
    tables.append(orders, path)
    tables.append(orders.withColumn("o_orderkey", F.col("o_orderkey") + 100_000_000_000), path)
    return tables.read_table(spark, path)


def append_parallel(spark, folder):
    path = scratch_path(spark, "append_parallel")
    tables.append(load(spark, folder, "lineitem"), path, SinkOptions(parallelism=writers(spark)))
    return tables.read_table(spark, path)


def partitioned_append(spark, folder):
    path = scratch_path(spark, "partitioned_append")
    tables.append_by_writer(load(spark, folder, "orders"), path, "o_orderstatus")
    return tables.read_table(spark, path)


def append_keyed_writers(spark, folder):
    """Lines by supplier, one writer per supplier: how many rows each has, and over how many writers."""
    path = scratch_path(spark, "append_keyed")
    tables.append_keyed(load(spark, folder, "lineitem"), path, ["l_suppkey"], writers(spark))
    return tables.read_table(spark, path).groupBy("l_suppkey").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("writer").alias("n_writers"))


def append_unique(spark, folder):
    """Orders in two loads that may hold no key twice; the second load is tried again and refused."""
    orders = load(spark, folder, "orders")
    table = KeyedTable(spark, scratch_path(spark, "append_unique"), orders.schema, ["o_orderkey"])
    table.insert(orders.filter("o_orderstatus <=> 'F'"))
    later = orders.filter("not o_orderstatus <=> 'F'")
    table.insert(later)
    with suppress(DuplicateKeyError):
        table.insert(later)
    return table.read()


def batch_agg_sink(spark, folder):
    path = scratch_path(spark, "batch_agg_sink")
    sold = load(spark, folder, "lineitem").groupBy(F.col("l_partkey").alias("product")).agg(
        F.count(F.lit(1)).alias("sales_count")
    )
    tables.append(sold, path)
    return tables.read_table(spark, path)


# --- keyed ------------------------------------------------------------------------------------------------------------


def upsert_last_wins(spark, folder):
    events = load(spark, folder, "events")
    split_at = F.lit(MIDDLE).cast("timestamp_ntz")
    early = F.coalesce(F.col("ts") < split_at, F.lit(False))
    target = changelog.latest(events.filter(early), ["user_id"], EVENT_ORDER)
    return keyed.upsert(target, events.filter(~early), ["user_id"], EVENT_ORDER)


def _line_sides(spark, folder):
    lines = load(spark, folder, "lineitem")
    closed = changelog.latest(lines.filter("l_linestatus <=> 'F'"), LINE_KEY, ["l_shipdate"])
    return closed, lines.filter("not l_linestatus <=> 'F'")


def upsert_lineitem(spark, folder):
    target, rows = _line_sides(spark, folder)
    return keyed.upsert(target, rows, LINE_KEY, ["l_shipdate"])


def upsert_keyed_layout(spark, folder):
    """The same upsert onto a target saved by key: the target is read in place."""
    target, rows = _line_sides(spark, folder)
    path = scratch_path(spark, "keyed_layout")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    buckets = writers(spark)
    tables.save_keyed(target, name, path, LINE_KEY, buckets)
    return keyed.upsert(spark.table(name), rows, LINE_KEY, ["l_shipdate"], buckets)


def upsert_settled(spark, folder):
    """The same upsert with its rows written first, as for a target too large to shuffle."""
    target, rows = _line_sides(spark, folder)
    return keyed.upsert_settled(target, keyed.settle_rows(target, rows, LINE_KEY, ["l_shipdate"]), LINE_KEY)


def upsert_other_key_type(spark, folder):
    """The same upsert with the rows' order key held as a decimal and the line number as a text."""
    target, rows = _line_sides(spark, folder)
    rows = rows.withColumns({"l_orderkey": F.col("l_orderkey").cast("decimal(20,0)"), "l_linenumber": F.col("l_linenumber").cast("string")})
    return keyed.upsert(target, rows, LINE_KEY, ["l_shipdate"])


def insert_if_absent(spark, folder):
    pairs = load(spark, folder, "lineitem").select("l_partkey", "l_suppkey", "l_linestatus")
    target = pairs.filter("l_linestatus <=> 'F'").drop("l_linestatus").distinct()
    return keyed.insert_if_absent(target, pairs.filter("not l_linestatus <=> 'F'").drop("l_linestatus"))


def insert_settled(spark, folder):
    """The same with the new pairs written first, as for a target too large to shuffle."""
    pairs = load(spark, folder, "lineitem").select("l_partkey", "l_suppkey", "l_linestatus")
    target = pairs.filter("l_linestatus <=> 'F'").drop("l_linestatus").distinct()
    rows = pairs.filter("not l_linestatus <=> 'F'").drop("l_linestatus")
    keys = ["l_partkey", "l_suppkey"]
    return keyed.insert_settled(target, keyed.settle_rows(target, rows, keys, []), keys)


def delete_by_key(spark, folder):
    finished = load(spark, folder, "orders").filter("o_orderstatus = 'F'")
    gone = keyed.key_rows(finished.withColumnRenamed("o_custkey", "c_custkey"), ["c_custkey"])
    return keyed.delete_by_key(load(spark, folder, "customer"), gone, ["c_custkey"])


def delete_other_key_type(spark, folder):
    """Keys given in quarters: only the whole ones name a customer."""
    quarters = load(spark, folder, "orders").select((F.col("o_custkey") / F.lit(4)).cast("decimal(20,2)").alias("c_custkey"))
    return keyed.delete_by_key(load(spark, folder, "customer"), quarters, ["c_custkey"])


def key_projection(spark, folder):
    return keyed.key_rows(load(spark, folder, "lineitem"), LINE_KEY)


def _returned(spark, folder):
    return load(spark, folder, "lineitem").filter("l_returnflag = 'R'").select(
        F.col("l_orderkey").alias("o_orderkey"),
        F.col("l_linestatus").alias("o_orderstatus"),
        F.concat(F.lit("RETURNED-"), F.col("l_linenumber")).alias("o_orderpriority"),
        "l_shipdate",
    )


def update_by_key(spark, folder):
    """Orders take priority and status from their last returned line."""
    return keyed.update_by_key(
        load(spark, folder, "orders"), _returned(spark, folder), ["o_orderkey"], ["o_orderstatus", "o_orderpriority"],
        ["l_shipdate"],
    )


def update_settled(spark, folder):
    """The same with the last returned lines written first."""
    orders = load(spark, folder, "orders")
    settled = keyed.settle_rows(orders, _returned(spark, folder), ["o_orderkey"], ["l_shipdate"])
    return keyed.update_settled(orders, settled, ["o_orderkey"], ["o_orderstatus", "o_orderpriority"])


def lookup_by_key(spark, folder):
    asked = load(spark, folder, "nation").filter("n_regionkey = 1").select(F.col("n_nationkey").alias("c_nationkey"))
    return keyed.lookup_by_key(
        load(spark, folder, "customer"), asked, ["c_nationkey"], ["c_custkey", "c_name", "c_nationkey"]
    )


def row_exists(spark, folder):
    asked = load(spark, folder, "customer").select("c_custkey", "c_name")
    orders = load(spark, folder, "orders").withColumnRenamed("o_custkey", "c_custkey")
    return keyed.row_exists(asked, orders, ["c_custkey"], "has_order")


def limit_rows(spark, folder):
    return keyed.limit_rows(load(spark, folder, "orders"), 100, ["o_orderkey"])


def limit_rows_ties(spark, folder):
    """Ordered by a column with many equal values; the other columns decide among them."""
    return keyed.limit_rows(load(spark, folder, "orders"), 100, ["o_orderstatus"])


# --- changelog --------------------------------------------------------------------------------------------------------


def event_changes(events: DataFrame) -> DataFrame:
    kind = F.col("event_type")
    return events.withColumn(
        changelog.OP,
        F.when(kind == "signup", "+I").when(kind.isin("purchase", "click"), "+U").when(kind == "view", "-U")
        .when(kind == "error", "-D"),
    )


def line_changes(lines: DataFrame) -> DataFrame:
    flag = F.col("l_returnflag")
    return lines.withColumn(
        changelog.OP,
        F.when(flag == "N", "+I").when(flag == "A", "+U").when(F.col("l_linestatus") == "F", "-D").otherwise("-U"),
    )


def rowkind_flag(spark, folder):
    changes = event_changes(load(spark, folder, "events"))
    return changes.select("event_id", changelog.OP, changelog.is_upsert(F.col(changelog.OP)).alias("is_upsert"))


def changelog_collapse(spark, folder):
    return changelog.collapse(event_changes(load(spark, folder, "events")), ["user_id"], EVENT_ORDER)


def changelog_collapse_lines(spark, folder):
    return changelog.collapse(line_changes(load(spark, folder, "lineitem")), LINE_KEY, ["l_shipdate"])


def _line_target(changes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Lines shipped before a date are the target, later ones arrive as changes."""
    split_at = F.lit(YEAR).cast("timestamp_ntz")
    early = F.coalesce(F.col("l_shipdate") < split_at, F.lit(False))
    before = changelog.collapse(changes.filter(early), LINE_KEY, ["l_shipdate"])
    target = before.filter(changelog.is_upsert(F.col(changelog.OP))).drop(changelog.OP)
    return target, changes.filter(~early)


def changelog_apply(spark, folder):
    target, later = _line_target(line_changes(load(spark, folder, "lineitem")))
    return changelog.apply_changes(target, later, LINE_KEY, ["l_shipdate"])


def changelog_apply_settled(spark, folder):
    """The same with the collapsed changes written first, as for a target too large to shuffle."""
    target, later = _line_target(line_changes(load(spark, folder, "lineitem")))
    return changelog.apply_settled(target, changelog.settle(later, LINE_KEY, ["l_shipdate"]), LINE_KEY)


def _keyed_lines(spark, folder, *dates):
    """A table of lines in key buckets, and the changelog of later lines in parts that end at each date and at the end."""
    lines = line_changes(load(spark, folder, "lineitem")).withColumn("quantity", F.col("l_quantity").cast("decimal(12,2)"))
    table = KeyedTable(spark, scratch_path(spark, "keyed_lines"), lines.drop(changelog.OP).schema, LINE_KEY)
    part = F.lit(0)
    for date in dates:
        part = part + F.coalesce((F.col("l_shipdate") >= F.lit(date).cast("timestamp_ntz")).cast("int"), F.lit(0))
    return table, [lines.filter(part == i) for i in range(len(dates) + 1)]


def changelog_apply_touched(spark, folder):
    """The same onto a table in buckets by key: only those of changed keys are read and written."""
    table, parts = _keyed_lines(spark, folder, YEAR)
    for number, part in enumerate(parts):
        table.apply(part, ["l_shipdate"], batch_id=number)
    return table.read().drop("quantity")


def changelog_agg_upsert(spark, folder):
    """Lines per supplier, kept up to date from what each part of the changelog writes and removes."""
    table, parts = _keyed_lines(spark, folder, "1995-01-01", YEAR)
    kept = KeptAggregate(
        table, scratch_path(spark, "kept_aggregate"), ["l_suppkey"], ["quantity"], ["l_shipdate"], ["l_extendedprice"])
    for number, part in enumerate(parts):
        table.apply(part, ["l_shipdate"], batch_id=number)
        kept.refresh()
    return kept.read()


def changelog_violations(spark, folder):
    events = event_changes(load(spark, folder, "events"))
    broken = events.select(
        F.when(F.col("event_type") != "error", F.col(changelog.OP)).alias(changelog.OP),
        F.nullif(F.col("event_type"), F.lit("signup")).alias("subject"),
    )
    return changelog.violations(broken, ["subject"])


# --- flush ------------------------------------------------------------------------------------------------------------


def _flushed_events(spark, folder):
    """Five writers, one per event type: each holds a fifth of all rows."""
    return flush.flush_batches(load(spark, folder, "events"), ["event_type"], EVENT_ORDER, SinkOptions().max_rows)


def flush_batches(spark, folder):
    return _flushed_events(spark, folder).groupBy("event_type", "flush_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("event_id").alias("first_event"), F.max("ts").alias("last_ts")
    )


def distinct_keys_per_flush(spark, folder):
    return flush.distinct_keys(
        _flushed_events(spark, folder), ["event_type", "flush_id"], {"user_key": F.col("user_id")}
    )


def changelog_collapse_per_flush(spark, folder):
    changes = event_changes(_flushed_events(spark, folder))
    return changelog.collapse(changes, ["user_id"], EVENT_ORDER, within=["event_type", "flush_id"])


def flush_windows(spark, folder):
    return flush.flush_windows(load(spark, folder, "events"), "ts", "1 hour")


def flush_windows_per_writer(spark, folder):
    return flush.flush_windows(load(spark, folder, "events"), "ts", "1 hour", ["event_type"])


# --- custom statements ------------------------------------------------------------------------------------------------


def _bound_orders(spark, folder):
    return dml.bind(
        load(spark, folder, "orders"),
        {
            "id": F.col("o_orderkey"),
            "buyer": F.concat(F.lit("C"), F.col("o_custkey")),
            "amount": F.col("o_totalprice").cast("decimal(12,2)"),
            "ordered_on": F.col("o_orderdate").cast("date"),
        },
    )


def custom_dml_bind(spark, folder):
    return _bound_orders(spark, folder)


def custom_dml_sql(spark, folder):
    path = scratch_path(spark, "custom_dml")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    spark.sql(
        f"CREATE TABLE {name} (id BIGINT, buyer STRING, doubled DECIMAL(13,2), ordered_on DATE) "
        f"USING parquet LOCATION '{path}'"
    )
    dml.run_statement(
        spark,
        f"INSERT INTO {name} SELECT id, upper(buyer), CAST(amount * 2 AS DECIMAL(13,2)), ordered_on FROM {{batch}}",
        _bound_orders(spark, folder),
    )
    return spark.table(name)


# --- COPY text --------------------------------------------------------------------------------------------------------


def copy_encode_docs(spark, folder):
    return copycsv.encode_lines(load(spark, folder, "documents"), keep=["doc_id"])


def copy_encode_pages(spark, folder):
    return copycsv.encode_lines(load(spark, folder, "pages"), keep=["page_id"])


def copy_encode_lineitem(spark, folder):
    return copycsv.encode_lines(load(spark, folder, "lineitem"), timestamp_digits=3)


def copy_encode_events(spark, folder):
    return copycsv.encode_lines(load(spark, folder, "events"), keep=["event_id"])


def copy_encode_nulls(spark, folder):
    """Customers beside their orders; a customer without one has nulls.

    Two joins that adaptive execution can split on either side, as a left join of a customer with a third of all orders
    could not: customers with their orders, and customers without any.
    """
    customers, orders = load(spark, folder, "customer"), load(spark, folder, "orders")
    bought = F.col("c_custkey") == F.col("o_custkey")
    columns = ["c_custkey", "c_name", "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate"]
    served = customers.join(orders, bought).select(*columns)
    buyers = orders.select("o_custkey").distinct()
    idle = customers.join(buyers, bought, "left_anti").select(
        *[F.col(c) if c in customers.columns else F.lit(None).cast(orders.schema[c].dataType).alias(c) for c in columns])
    return copycsv.encode_lines(served.unionByName(idle), columns, timestamp_digits=0)


COPY_TYPES = {
    "flag": "boolean", "line_number": "tinyint", "quantity": "smallint", "tax": "float", "price": "decimal(12,2)", "shipped": "date",
    "code": "binary",
}


def _lines_of_every_type(spark, folder):
    """Line columns in types that the tables do not have; TIME is behind a setting of the session. Taxes are counted in halves, so that each is exact as a float."""
    lines = load(spark, folder, "lineitem")
    columns = {
        "flag": F.col("l_linestatus") == "O",
        "line_number": F.col("l_linenumber"),
        "quantity": F.col("l_quantity"),
        "tax": F.floor(F.col("l_tax") * 100) / F.lit(2),
        "price": F.col("l_extendedprice"),
        "shipped": F.col("l_shipdate"),
        "code": F.encode(F.concat(F.col("l_returnflag"), F.col("l_linestatus")), "UTF-8"),
    }
    return lines.select("l_orderkey", "l_linenumber", *[c.cast(COPY_TYPES[n]).alias(n) for n, c in columns.items()])


def copy_encode_types(spark, folder):
    return copycsv.encode_lines(_lines_of_every_type(spark, folder), list(COPY_TYPES), keep=["l_orderkey", "l_linenumber"])


def copy_roundtrip_types(spark, folder):
    """Written and read back, bytes shown in hexadecimal digits."""
    lines = _lines_of_every_type(spark, folder)
    path = scratch_path(spark, "copy_types")
    copyfiles.write_copy_files(lines, path)
    return copyranges.read_copy_ranges(spark, path, lines.schema).withColumn("code", F.lower(F.hex("code")))


def copy_roundtrip(spark, folder):
    documents = load(spark, folder, "documents")
    path = scratch_path(spark, "copy_roundtrip")
    copyfiles.write_copy_files(documents, path)
    return copyranges.read_copy_ranges(spark, path, documents.schema)


# --- schema -----------------------------------------------------------------------------------------------------------


ORDER_TYPES = {
    "o_orderkey": T.IntegerType(),
    "o_custkey": T.DecimalType(18, 0),
    "o_totalprice": T.DecimalType(12, 2),
    "o_orderdate": T.DateType(),
    "o_orderpriority": T.StringType(),
}
NARROW_ORDER_TYPES = {
    "o_orderkey": T.ShortType(),
    "o_totalprice": T.DecimalType(7, 2),
    "o_orderpriority": T.VarcharType(8),
    "o_orderdate": T.TimestampNTZType(),
}


def convert_types(spark, folder):
    return convert.to_declared(load(spark, folder, "orders"), ORDER_TYPES)


def schema_report(spark, folder):
    return schema.schema_report({table: load(spark, folder, table) for table in TABLES})


def schema_conformance(spark, folder):
    return schema.conformance(load(spark, folder, "orders"), NARROW_ORDER_TYPES)


# --- streams ----------------------------------------------------------------------------------------------------------


def _stream(spark, folder, table, files_per_batch=4):
    """The table's own files as a stream, ``files_per_batch`` of them per micro-batch; nothing is copied first."""
    rows = load(spark, folder, table)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files_per_batch)
    path = f"{folder}/{table}.parquet"
    if is_folder(spark, path):
        return stream.parquet(path)
    return stream.option("pathGlobFilter", f"{table}.parquet").parquet(folder)


def stream_append(spark, folder):
    path = scratch_path(spark, "stream_append")
    events = _stream(spark, folder, "events")
    sink.append_stream(events, f"{path}/data", f"{path}/checkpoint", available_now=True).awaitTermination()
    return tables.read_table(spark, f"{path}/data")


def stream_custom_dml(spark, folder):
    """A statement per micro-batch; it overwrites the batch's own partition, so a repeated batch adds nothing."""
    path = scratch_path(spark, "stream_dml")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    spark.sql(
        f"CREATE TABLE {name} (id BIGINT, status STRING, batch BIGINT) USING parquet PARTITIONED BY (batch) LOCATION '{path}/data'"
    )
    sink.statement_stream(
        _stream(spark, folder, "orders"),
        f"INSERT OVERWRITE {name} PARTITION (batch = {{batch_id}}) SELECT id, lower(status) FROM {{batch}}",
        {"id": F.col("o_orderkey"), "status": F.col("o_orderstatus")},
        f"{path}/checkpoint", available_now=True,
    ).awaitTermination()
    return spark.table(name).select("id", "status")


def stream_copy_files(spark, folder):
    path = scratch_path(spark, "stream_copy")
    documents = _stream(spark, folder, "documents")
    sink.copy_stream(documents, f"{path}/data", f"{path}/checkpoint", available_now=True).awaitTermination()
    return copyranges.read_copy_ranges(spark, f"{path}/data", documents.schema)


def _fed(spark, label, stream, keys, order, arrival_order, output_mode="append", tiers=None):
    table = ChangelogTable(spark, scratch_path(spark, label), stream.schema, keys, order, arrival_order)
    query = table.feed(stream, output_mode=output_mode, available_now=True, tiers=tiers)
    query.awaitTermination()
    return table


def stream_upsert(spark, folder):
    events = _stream(spark, folder, "events").withColumn(changelog.OP, F.lit("+U"))
    return _fed(spark, "stream_upsert", events, ["user_id"], EVENT_ORDER, False).state()


def stream_changelog(spark, folder):
    changes = line_changes(_stream(spark, folder, "lineitem"))
    return _fed(spark, "stream_changelog", changes, LINE_KEY, ["l_shipdate"], False).state()


def stream_compacted(spark, folder):
    """The same changelog, its batches merged in tiers, and at the end into a base bucketed by key."""
    changes = line_changes(_stream(spark, folder, "lineitem"))
    table = _fed(spark, "stream_compacted", changes, LINE_KEY, ["l_shipdate"], False, tiers=Tiers())
    table.compact()
    table.remove_replaced()
    return table.state()


def stream_replay(spark, folder):
    """The first attempt of every batch writes and then fails, so each batch is written twice."""
    changes = line_changes(_stream(spark, folder, "lineitem"))
    path = scratch_path(spark, "stream_replay")
    table = ChangelogTable(spark, path, changes.schema, LINE_KEY, ["l_shipdate"], False)
    seen: set[int] = set()

    def fail_once(rows: DataFrame, batch_id: int) -> None:
        table.write_batch(rows, batch_id)
        if batch_id not in seen:
            seen.add(batch_id)
            raise RuntimeError(f"batch {batch_id} is made to fail once")

    query = sink.apply_stream(
        changes, fail_once, f"{path}/checkpoint", SinkOptions(max_retries=1, retry_interval=0.01), available_now=True
    )
    query.awaitTermination()
    return table.state()


def stream_agg_upsert(spark, folder):
    """A running count per type; each batch replaces the counts that moved."""
    counts = (
        _stream(spark, folder, "events").groupBy("event_type")
        .agg(F.count(F.lit(1)).alias("n_events"), F.max("ts").alias("last_ts"))
        .withColumn(changelog.OP, F.lit("+U"))
    )
    return _fed(spark, "stream_agg", counts, ["event_type"], [], True, "update").state()


# --- split reads ------------------------------------------------------------------------------------------------------


def split_read_range(spark, folder):
    orders = load(spark, folder, "orders")
    lower, upper = orders.agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    return split.split_evenly(orders, "o_orderkey", lower, upper, 4)


def split_read_values(spark, folder):
    """A split per priority that the data has; a null is in the remaining split, -1."""
    return split.split_each_value(load(spark, folder, "orders"), "o_orderpriority")


def split_read_balanced(spark, folder):
    """Lines in splits of about as many rows each by part; every row is in one of them."""
    lines = load(spark, folder, "lineitem")
    parts = split.split_balanced(lines, "l_partkey", split.balanced_bounds(lines, "l_partkey", writers(spark)))
    return parts.where("split >= -1").drop("split")


_REGISTERED = (
    append_orders, append_twice, append_parallel, partitioned_append, append_keyed_writers, append_unique, batch_agg_sink,
    upsert_last_wins, upsert_lineitem, upsert_keyed_layout, upsert_settled, upsert_other_key_type, insert_if_absent, insert_settled,
    delete_by_key, delete_other_key_type, key_projection,
    update_by_key, update_settled, lookup_by_key, row_exists, limit_rows, limit_rows_ties,
    rowkind_flag, changelog_collapse, changelog_collapse_lines, changelog_apply, changelog_apply_settled,
    changelog_apply_touched, changelog_agg_upsert, changelog_violations,
    flush_batches, distinct_keys_per_flush, changelog_collapse_per_flush, flush_windows, flush_windows_per_writer,
    custom_dml_bind, custom_dml_sql,
    copy_encode_docs, copy_encode_pages, copy_encode_lineitem, copy_encode_events, copy_encode_nulls, copy_encode_types, copy_roundtrip,
    copy_roundtrip_types,
    convert_types, schema_report, schema_conformance,
    stream_append, stream_custom_dml, stream_copy_files, stream_upsert, stream_changelog, stream_compacted, stream_replay,
    stream_agg_upsert, split_read_range, split_read_values, split_read_balanced,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {query.__name__: query for query in _REGISTERED}
