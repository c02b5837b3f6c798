import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF = "/root/testdata/sf0.001"
#: Extra columns whose names the operators use themselves.
CLASH = ["key", "shard", "fp", "rank", "bin", "uid", "doc", "place", "score", "stack", "secret_spans"]


@pytest.fixture(scope="session")
def spark():
    from churnspark.session import get_session
    return get_session("local[4]", shuffle_partitions=8)


def messy_rows() -> list[tuple]:
    """Nulls, empty and very long texts, ties, repeated rows and copies."""
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(2, 9)))
    line = lambda n: " ".join(word() for _ in range(n)).capitalize() + "."
    shared = line(60)
    rows = [(i, "\n".join(line(r.randint(3, 40)) for _ in range(r.randint(1, 6)))) for i in range(40)]
    rows += [(100 + i, line(10) + "\n" + shared + "\n" + line(10)) for i in range(6)]
    rows += [(200, rows[0][1]), (201, rows[0][1]), (202, rows[1][1] + " end"), (3, rows[3][1]), (3, rows[3][1]), (4, "other text for four")]
    rows += [(300, None), (301, ""), (302, " \n\t "), (303, "x"), (None, "no id at all"), (None, None), (None, "no id at all")]
    rows += [(400, line(20000)), (401, "ab" * 30000), (402, "the " * 5000), (403, "é\u200bü \u2028 ß" * 50)]
    return rows


@pytest.fixture(scope="session")
def messy(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame(messy_rows(), "doc_id long, text string").repartition(3)
    return df.withColumns({c: F.lit(f"x-{c}") for c in CLASH})


@pytest.fixture(scope="session")
def empty(messy):
    return messy.where("1 = 0")


@pytest.fixture(scope="session")
def sample():
    import pyarrow.parquet as pq
    return pq.read_table(f"{SF}/documents.parquet").to_pylist()
