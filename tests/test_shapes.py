"""Registered queries on tables of another shape: a hot key, nulls, many files and batches."""

import os

import duckdb
import pytest
from test_entry import FOLDER, TABLES, plain

import __spark_entry__ as entry_points
from millrace.plans import queries

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")

# A third of all rows goes to one key, some keys are null.
SKEWED = {
    "events": "SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN 1 WHEN event_id % 50 = 1 THEN NULL ELSE user_id END "
    "AS user_id) FROM '{source}'",
    "orders": "SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 1 WHEN o_orderkey % 50 = 1 THEN NULL "
    "ELSE o_custkey END AS o_custkey) FROM '{source}'",
    "part": "SELECT * REPLACE (CASE WHEN p_partkey % 3 = 0 THEN 'hot' ELSE p_name END AS p_name, "
    "CASE WHEN p_partkey % 3 = 0 THEN 7 WHEN p_partkey % 11 = 1 THEN NULL ELSE p_size END AS p_size) FROM '{source}'",
}
FILES = 3


@pytest.fixture(scope="module")
def tables(tmp_path_factory):
    """The tables as folders of several files, and DuckDB's view of them."""
    folder = tmp_path_factory.mktemp("shapes")
    con = duckdb.connect()
    for name in TABLES:
        source = SKEWED.get(name, "SELECT * FROM '{source}'").format(source=f"{FOLDER}/{name}.parquet")
        (folder / f"{name}.parquet").mkdir()
        share = con.execute(f"SELECT count(*) // {FILES} + 1 FROM ({source})").fetchall()[0][0]
        for number in range(FILES):
            part = folder / f"{name}.parquet" / f"part-{number}.parquet"
            rows = f"SELECT * FROM ({source}) LIMIT {share} OFFSET {share * number}"
            con.execute(f"COPY ({rows}) TO '{part}' (FORMAT parquet)")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet/*.parquet'")
    return str(folder), con


@pytest.mark.parametrize(
    "name",
    [
        "stream_stream_inner",
        "stream_interval_left",
        "stream_interval_full",
        "batch_interval_full",
        "ss_static_inner",
        "join_inner",
        "join_full",
        "mode_append_rows",
        "mode_update_agg",
        "stream_count_by",
        "win_top1_per_day",
        "win_sliding_sum",
        "wm_count",
        "sink_upsert",
        "json_build",
        "proc_time_chars",
    ],
)
def test_query_equals_sql(spark, tables, monkeypatch, name):
    monkeypatch.setattr(queries, "BATCH_BYTES", 1)  # one file per micro-batch
    folder, con = tables
    frame = entry_points.queries()[name](spark, folder)
    columns = sorted(frame.columns)
    result = con.execute(entry_points.oracle_sql()[name])
    places = [[entry[0] for entry in result.description].index(c) for c in columns]
    expected = sorted(tuple(plain(row[i]) for i in places) for row in result.fetchall())
    assert sorted(tuple(plain(row[c]) for c in columns) for row in frame.collect()) == expected


def test_the_hot_key_is_found(spark, tables):
    from millrace.operators import hot_keys
    from millrace.sources import table

    assert 1 in hot_keys(table(spark, tables[0], "events"), "user_id", 0.2)
