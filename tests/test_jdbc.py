"""Database targets. Spark's JDBC writer needs a server, which these tests do not start: the rows a stage would get are
loaded into the SQL engine of the checks, and the statements run there."""

import datetime as dt
from decimal import Decimal

import duckdb
import pytest
from pyspark.sql import functions as F

from bulkapply import SinkOptions, TargetSpec
from bulkapply.functions.schema import SchemaError
from bulkapply.sources import jdbc

QUICK = SinkOptions(max_retries=2, retry_interval=0.001)


class Warehouse:
    def __init__(self, ddl):
        self.con = duckdb.connect()
        self.con.execute(ddl)
        self.broken = 0
        self.saves = 0

    def save(self, df, table):
        self.saves += 1
        staged = df.toArrow()  # noqa: F841
        self.con.execute(f"CREATE OR REPLACE TABLE {table} AS SELECT * FROM staged")

    def execute(self, statements):
        self.con.execute("BEGIN")
        try:
            for n, text in enumerate(statements):
                if n == 1 and self.broken:
                    self.broken -= 1
                    raise OSError("connection lost")
                self.con.execute(text)
        except Exception:
            self.con.execute("ROLLBACK")
            raise
        self.con.execute("COMMIT")

    def rows(self, table):
        return sorted(self.con.execute(f"SELECT * FROM {table}").fetchall())

    def tables(self):
        return sorted(r[0] for r in self.con.execute("SELECT table_name FROM information_schema.tables").fetchall())


BOOKS = [
    (1, "Harbour lights", "Ines Ode", 12.5, 4),
    (2, "Slow rivers", "Marek Toll", 7.25, 90),
    (3, "Slow rivers II", "Marek Toll", None, 1),
]
BOOK_DDL = "CREATE TABLE books (id INTEGER PRIMARY KEY, title VARCHAR, author VARCHAR, price DOUBLE, qty INTEGER)"
BOOK_COLUMNS = ["id", "title", "author", "price", "qty"]


@pytest.fixture
def books(spark):
    return spark.createDataFrame(BOOKS, "id int, title string, author string, price double, qty int")


def books_target(keys=()):
    return jdbc.JdbcTarget("jdbc:none", TargetSpec("books", BOOK_COLUMNS, keys))


def test_two_loads_with_other_ids(spark, books):
    db = Warehouse(BOOK_DDL)
    jdbc.append_rows(books, books_target(), QUICK, 1, db.save, db.execute)
    assert db.rows("books") == sorted(BOOKS)
    second = books.withColumns({"id": -F.col("id"), "author": F.upper("author")})
    jdbc.append_rows(second, books_target(), QUICK, 2, db.save, db.execute)
    assert [r[0] for r in db.rows("books")] == [-3, -2, -1, 1, 2, 3]
    assert db.tables() == ["books"]


def test_append_of_a_present_key_is_the_target_s_error(spark, books):
    db = Warehouse(BOOK_DDL)
    jdbc.append_rows(books, books_target(), QUICK, 1, db.save, db.execute)
    with pytest.raises(duckdb.Error, match="(?i)constraint"):
        jdbc.append_rows(books, books_target(), SinkOptions(max_retries=1, retry_interval=0.001), 2, db.save, db.execute)


def test_failed_transaction_is_retried_without_doubling(spark, books):
    db = Warehouse(BOOK_DDL)
    db.broken = 2
    jdbc.append_rows(books, books_target(), QUICK, 1, db.save, db.execute)
    assert db.saves == 3
    assert db.rows("books") == sorted(BOOKS)


def test_retries_run_out(spark, books):
    db = Warehouse(BOOK_DDL)
    db.broken = 9
    with pytest.raises(OSError):
        jdbc.append_rows(books, books_target(), QUICK, 1, db.save, db.execute)
    assert db.saves == 3 and db.rows("books") == [] and db.tables() == ["books"]


def test_without_retries_rows_go_straight_in(spark, books):
    seen = []
    jdbc.append_rows(books, books_target(), SinkOptions(max_retries=0), save=lambda df, table: seen.append(table))
    assert seen == ["books"]


def test_later_flush_replaces_what_an_earlier_one_wrote(spark):
    """Two sensors; the second flush brings a newer reading of one of them."""
    db = Warehouse("CREATE TABLE gauges (sensor VARCHAR PRIMARY KEY, level DECIMAL(9,3), samples INTEGER, seen TIMESTAMP)")
    target = jdbc.JdbcTarget("jdbc:none", TargetSpec("gauges", ["sensor", "level", "samples", "seen"], ["sensor"]))
    dawn = dt.datetime(2031, 5, 17, 4, 45)
    flushes = [
        [("north", Decimal("0.125"), 60, dawn), ("weir", Decimal("2.750"), 58, dawn)],
        [("weir", Decimal("2.900"), 61, dawn + dt.timedelta(minutes=7))],
    ]
    schema = "sensor string, level decimal(9,3), samples int, seen timestamp_ntz, _op string"
    for n, flush in enumerate(flushes):
        rows = spark.createDataFrame([(*r, "+U") for r in flush], schema)
        jdbc.apply_rows(rows, target, ["seen"], QUICK, n, save=db.save, execute=db.execute)
    assert db.rows("gauges") == [flushes[0][0], flushes[1][0]]


def test_changelog_to_database(spark):
    db = Warehouse("CREATE TABLE t (k INTEGER PRIMARY KEY, v VARCHAR)")
    db.con.execute("INSERT INTO t VALUES (1, 'a'), (2, 'b'), (3, 'c')")
    target = jdbc.JdbcTarget("jdbc:none", TargetSpec("t", ["k", "v"], ["k"]))
    changes = spark.createDataFrame(
        [(1, 1, "A", "+U"), (2, 1, None, "-D"), (3, 1, None, "-D"), (3, 2, "again", "+I"), (4, 1, "d", "+I"), (9, 1, None, "-D")],
        "k int, seq int, v string, _op string",
    )
    db.broken = 1
    for batch in (0, 0):
        jdbc.apply_rows(changes, target, ["seq"], QUICK, batch, save=db.save, execute=db.execute)
    assert db.rows("t") == [(1, "A"), (3, "again"), (4, "d")]
    assert db.tables() == ["t"]


def test_all_key_table(spark):
    db = Warehouse("CREATE TABLE p (a INTEGER, b INTEGER, PRIMARY KEY (a, b))")
    target = jdbc.JdbcTarget("jdbc:none", TargetSpec("p", ["a", "b"], ["a", "b"]))
    changes = spark.createDataFrame([(1, 1, "+I"), (1, 1, "+I"), (1, 2, "+I")], "a int, b int, _op string")
    for batch in (0, 1):
        jdbc.apply_rows(changes, target, [], QUICK, batch, save=db.save, execute=db.execute)
    assert db.rows("p") == [(1, 1), (1, 2)]


def test_custom_statement(spark, books):
    db = Warehouse(BOOK_DDL)
    jdbc.run_custom(
        books, books_target(),
        "INSERT INTO books(id, title, qty) SELECT book, upper(name), pieces * 2 FROM {batch}",
        {"book": F.col("id"), "name": F.col("title"), "pieces": F.col("qty")},
        QUICK, 1, db.save, db.execute,
    )
    assert db.rows("books")[0] == (1, "HARBOUR LIGHTS", None, None, 8)
    with pytest.raises(ValueError, match="batch"):
        jdbc.run_custom(books, books_target(), "DELETE FROM books", {"a": F.col("id")})


def test_unsupported_column_is_refused_before_any_write(spark):
    df = spark.sql("SELECT 1 AS k, array(1) AS v")
    with pytest.raises(SchemaError):
        jdbc.append_rows(df, jdbc.JdbcTarget("jdbc:none", TargetSpec("t", ["k", "v"])), save=None)


def test_bulk_with_key_is_refused(spark, books):
    with pytest.raises(ValueError, match="bulk"):
        jdbc.apply_rows(books, books_target(["id"]), ["id"], SinkOptions(bulk=True))


def test_stages_do_not_meet():
    spec = TargetSpec("t", ["a"])
    assert jdbc.stage_name(spec, 7) == "t_stage_7"
    assert jdbc.stage_name(spec, None) != jdbc.stage_name(spec, None)
