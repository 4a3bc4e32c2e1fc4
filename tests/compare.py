"""Order-free comparison of a Spark result with SQL run by DuckDB on the same files."""

import duckdb
import pandas as pd

from bulkapply.plans.queries import TABLES


def connection(folder):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    return con


def normalized(arrow):
    frame = arrow.to_pandas(types_mapper=None)
    frame = frame[sorted(frame.columns)]
    for column in frame.columns:
        if str(frame[column].dtype).startswith("datetime"):
            frame[column] = frame[column].astype("datetime64[us]")
        elif frame[column].dtype == object:
            frame[column] = frame[column].map(lambda v: v if v is None else str(v))
    return frame.sort_values(list(frame.columns), ignore_index=True)


def assert_same(spark_result, con, sql):
    got = normalized(spark_result.toArrow())
    wanted = normalized(con.execute(sql).to_arrow_table())
    assert list(got.columns) == list(wanted.columns)
    assert len(got) == len(wanted)
    pd.testing.assert_frame_equal(got, wanted, check_dtype=False, check_exact=True)
