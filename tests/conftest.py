import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from shelfspark.session import build_session
    ckpt = tempfile.mkdtemp(prefix="shelfspark-test-")
    s = build_session("local[4]", app_name="shelfspark-tests", shuffle_partitions=8,
                      extra={"spark.checkpoint.dir": ckpt,
                             "spark.sql.warehouse.dir": os.path.join(ckpt, "warehouse")})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def small_models(spark):
    from shelfspark.plans.models import Models
    return Models.for_tables(spark, SF_SMALL)
