import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from churnspark.session import get_session
    s = get_session("local[4]", shuffle_partitions=8)
    # tests own the session: a private checkpoint folder is set only here
    if not s.conf.get("spark.checkpoint.dir", None):
        d = tempfile.mkdtemp(prefix="churnspark-test-ckpt-")
        s.sparkContext.setCheckpointDir(d)
    yield s


@pytest.fixture(scope="session")
def duck():
    import duckdb
    from churnspark.sources.tables import TABLE_NAMES, table_path
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLE_NAMES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SF01, t)}')")
    return con


def rows(df_or_rows, cols=None):
    """Order-insensitive, float-rounded rows for comparisons."""
    import math
    if hasattr(df_or_rows, "collect"):
        cols = df_or_rows.columns
        data = [tuple(r) for r in df_or_rows.collect()]
    else:
        data = df_or_rows

    def n(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else round(v, 6)
        if isinstance(v, (list, tuple)):
            return tuple(n(x) for x in v)
        return v
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(n(r[i]) for i in order) for r in data), key=repr)
