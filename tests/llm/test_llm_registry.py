"""Every query of this subpackage with SQL against DuckDB, over whole small tables."""

import glob
import os
import re

import duckdb
import pytest

import __spark_entry__ as entry
from clickflow.llm import sql

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path).removesuffix('.parquet')} AS SELECT * FROM '{path}'")
    return connection


def test_every_operator_is_registered_once():
    numbers = sorted(int(re.match(r"op(\d+)_", name)[1]) for name in entry.queries() if name.startswith("op"))
    assert numbers == list(range(1, 14))
    assert "pipeline" in entry.queries()


@pytest.mark.parametrize("name", sorted(sql.oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    found = entry.queries()[name](spark, SF_DIR)
    result = duck.execute(entry.oracle_sql()[name])
    columns = [column[0] for column in result.description]
    assert sorted(found.columns) == sorted(columns)
    order = sorted(columns)
    expected = [dict(zip(columns, row)) for row in result.fetchall()]
    assert sorted(repr([r[c] for c in order]) for r in found.collect()) == sorted(repr([r[c] for c in order]) for r in expected)


def test_url_filter_matches_its_sql_on_pages_with_links(spark, tmp_path):
    """The given pages have no links, so here every writing leads to or from a blocked url."""
    writings = [
        '<link rel="canonical" href="/es/x">', "<link rel=canonical href=//b.net/es/x>", '<META content="0;url=http://b.net/fr/" http-equiv="refresh">',
        """<meta http-equiv=refresh content="0;url='http://b.net/es/y'">""", '<link rel="alternate canonical" href="http://c.net/fr/v?a&amp;b">',
        '<link rel="canonical" href="../es/./on">', '<link rel="canonical" href="next">', '<link rel="canonical" href="#top">',
        '<link rel="canonical" href="?q=2">', '<link rel="canonical" href="mailto:x@b.net">', "none", None,
    ]
    rows = [(i, f"http://site{i}.{top}/dir/page{i}", html) for top in ("org", "net") for i, html in enumerate(writings)]
    rows += [(100, "http://site0.net/es/x", None), (101, "no host", writings[1]), (102, None, writings[1]), (103, "http://other.org/", '<link rel="canonical" href="http://site7.org/dir/page7">')]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    found = entry.queries()["op8_url_filter"](spark, str(tmp_path))
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    columns = ["page_id", "host", "path", "rule", "verdict"]
    wanted = duck.execute(f"SELECT {', '.join(columns)} FROM ({entry.oracle_sql()['op8_url_filter']})").fetchall()
    assert sorted(map(repr, (tuple(r[c] for c in columns) for r in found.collect()))) == sorted(map(repr, wanted))
    blocked = [row for row in wanted if row[4] == "block" and row[3] is None]
    assert len(blocked) > 5
