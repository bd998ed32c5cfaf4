import os

import duckdb
import pytest

SF = "/root/testdata/sf0.001"
TABLES = "documents pages labels embeddings benchmark".split()

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(n, seed):
    """``n`` words, different for each seed."""
    return " ".join(f"{WORDS[(i * 7 + seed * 13 + i * i * (seed + 1)) % len(WORDS)]}{(i * 31 + seed * 17) % 97}" for i in range(n))


#: Nulls, empty and very long texts, repeated rows and repeated ids.
EDGE = [
    (1, prose(60, 1), "en", "a"), (2, prose(60, 1), "en", "a"), (3, prose(60, 1) + " tail", "en", "a"), (4, prose(60, 4), "en", "b"),
    (4, prose(60, 4), "en", "b"), (5, None, "en", "a"), (6, "", None, None), (7, " \t\n ", "de", "a"), (None, prose(60, 1), "en", "a"),
    (8, prose(40_000, 8), "en", "a"), (9, "one", "en", None), (10, "one", None, "b"), (11, "é" * 300 + "\u0085x y", "fr", "b"),
    (None, None, None, None), (12, prose(59, 1), "en", "a"),
]
SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="session")
def edge(spark):
    """The edge rows with columns whose names clash with the operators' own."""
    clash = "1 as rank, 'x' as kept, 2 as score, 'y' as bucket, 'z' as component_id, 'm' as mix, 3 as copies, 0 as n_words, 'v' as fence"
    return spark.createDataFrame(EDGE, SCHEMA).repartition(3).selectExpr("*", *clash.split(", "))


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def con():
    if not os.path.isdir(SF):
        pytest.skip("driver test data not present")
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.fixture(scope="session")
def texts(con):
    return con.sql("SELECT doc_id, text, lang, source FROM documents ORDER BY doc_id").fetchall()
