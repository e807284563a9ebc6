"""Every query of the core package against its SQL, on the small tables."""

import glob
import math
import os

import duckdb
import pytest

from driftline.plans.everything import ORACLES, QUERIES

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for f in glob.glob(f"{DATA}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return c


def canonical(rows, names):
    order = sorted(range(len(names)), key=lambda k: names[k])
    value = lambda v: "null" if v is None else f"{v:.9g}" if isinstance(v, float) and math.isfinite(v) else str(v)
    return sorted(tuple(value(r[k]) for k in order) for r in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    df = QUERIES[name](spark, DATA)
    want = db.execute(ORACLES[name])
    names = [d[0] for d in want.description]
    assert sorted(df.columns) == sorted(names)
    assert canonical(df.collect(), df.columns) == canonical(want.fetchall(), names)
