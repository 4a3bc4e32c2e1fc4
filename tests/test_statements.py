"""Statement text, run by the SQL engine of the checks."""

import duckdb
import pytest

from bulkapply.sources import statements as sql


@pytest.fixture
def con():
    c = duckdb.connect()
    c.execute("CREATE TABLE t (k INTEGER PRIMARY KEY, a VARCHAR, b INTEGER)")
    c.execute("INSERT INTO t VALUES (1, 'x', 10), (2, 'y', 20)")
    c.execute("CREATE TABLE s (k INTEGER, a VARCHAR, b INTEGER, up BOOLEAN)")
    c.execute("INSERT INTO s VALUES (2, 'Y', 21, true), (3, 'Z', 30, true), (1, NULL, NULL, false)")
    return c


def state(con):
    return con.execute("SELECT * FROM t ORDER BY k").fetchall()


def test_staged_upsert_and_delete(con):
    con.execute(sql.upsert_staged("t", "s", ["k", "a", "b"], ["k"], "up"))
    con.execute(sql.delete_staged("t", "s", ["k"], "NOT up"))
    assert state(con) == [(2, "Y", 21), (3, "Z", 30)]


def test_staged_insert_and_drop(con):
    con.execute(sql.insert_staged("t", "s", ["k", "a"], "k = 3"))
    con.execute(sql.drop("s"))
    con.execute(sql.drop("s"))
    assert state(con)[-1] == (3, "Z", None)


def test_do_nothing_keeps_the_first(con):
    con.execute("CREATE TABLE p (k INTEGER, l INTEGER, PRIMARY KEY (k, l))")
    con.execute("CREATE TABLE q AS SELECT 1 AS k, 2 AS l")
    for _ in range(2):
        con.execute(sql.upsert_staged("p", "q", ["k", "l"], ["k", "l"]))
    assert con.execute("SELECT * FROM p").fetchall() == [(1, 2)]
