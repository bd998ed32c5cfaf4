import datetime as dt
import os
import sys
import tempfile
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from freightlens.session import get_session  # noqa: E402
from freightlens.sources import schemas  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[4]", app="freightlens-tests", shuffle_partitions=4,
                    extra={"spark.sql.autoBroadcastJoinThreshold": "10485760"})
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="fl-ckpt-"))
    yield s


def D(x):
    return None if x is None else Decimal(str(x))


def d(s):
    return dt.date.fromisoformat(s)


def make(spark, table, rows):
    """DataFrame of a core table from dicts; missing columns are NULL."""
    schema = schemas.TABLES[table]
    data = [tuple(r.get(f.name) for f in schema.fields) for r in rows]
    # relax nullability so fixtures can hold NULL keys
    from pyspark.sql.types import StructField, StructType
    relaxed = StructType([StructField(f.name, f.dataType, True) for f in schema.fields])
    return spark.createDataFrame(data, relaxed)


@pytest.fixture
def providers(spark):
    return make(spark, "providers", [
        {"provider_id": 1, "provider_name": "Alpha Freight", "sla_threshold": D("92.00")},
        {"provider_id": 2, "provider_name": "Beta Logistics", "sla_threshold": D("90.00")},
        {"provider_id": 3, "provider_name": "Gamma Cargo", "sla_threshold": D("91.00")},
    ])


@pytest.fixture
def routes(spark):
    return make(spark, "routes", [
        {"route_id": 1, "origin_city": "Utrecht", "origin_country": "NL", "dest_city": "Lyon", "dest_country": "FR"},
        {"route_id": 2, "origin_city": "Groningen", "origin_country": "NL", "dest_city": "Bremen",
         "dest_country": "DE"},
    ])


def rows(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.collect()]
