"""Every registered query with SQL gives the rows that DuckDB gives, over the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

from marlstone.plans import queries as plans

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no tables")


def rows(frame):
    def plain(x):
        if x is None or x is pytest or (isinstance(x, float) and math.isnan(x)) or str(x) in ("NaT", "<NA>"):
            return "null"
        return f"{x:.9g}" if isinstance(x, float) else f"{float(x):.9g}" if not isinstance(x, (str, bool)) and hasattr(x, "__float__") and not hasattr(x, "year") else str(x)

    return sorted(tuple(plain(x) for x in r) for r in frame[sorted(frame.columns)].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(plans.oracle_sql()))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    ours, theirs = plans.queries()[name](spark, SF).toPandas(), con.execute(plans.oracle_sql()[name]).fetchdf()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert rows(ours) == rows(theirs)


@pytest.mark.parametrize("name", sorted(set(plans.queries()) - set(plans.oracle_sql())))
def test_runs(spark, name):
    assert plans.queries()[name](spark, SF).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 5 and set(plans.queries()) <= set(__spark_entry__.queries())
