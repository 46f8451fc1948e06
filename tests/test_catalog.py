"""Every registered variant query against its SQL, on the smallest tables."""

import duckdb
import pytest

from helixframe.plans import catalog

SF = "/root/testdata/sf0.001"


def plain(rows):
    return sorted(tuple(f"{x:.9g}" if isinstance(x, float) else str(x) for x in r) for r in rows)


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_query_equals_sql(spark, name):
    df = catalog.QUERIES[name](spark, SF)
    names = sorted(df.columns)
    con = duckdb.connect()
    for t in ("lineitem", "orders", "supplier"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    cur = con.execute(catalog.SQL[name])
    at = [[d[0] for d in cur.description].index(c) for c in names]
    assert plain(tuple(r) for r in df.select(*names).collect()) == plain(tuple(r[i] for i in at) for r in cur.fetchall())
