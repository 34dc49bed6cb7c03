import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from ballotlens.session import build_session, scratch_dir
    s = build_session("local[4]", shuffle_partitions=4,
                      extra={"spark.sql.autoBroadcastJoinThreshold": str(10 * 1024 * 1024)})
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="ballotlens-test-ckpt-"))
    scratch_dir(s)
    yield s


@pytest.fixture(scope="session")
def tables(spark):
    from ballotlens.sources.tables import Tables
    return Tables.from_fixtures(spark, SF_SMALL)


def rows(df, cols=None):
    cols = cols or sorted(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()),
                  key=lambda r: tuple((x is None, str(x)) for x in r))
