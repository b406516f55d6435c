import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from offerlake.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="offerlake-tests-")
    s = build_session("local[4]", app="offerlake-tests", shuffle_partitions=8, extra={
        "spark.sql.warehouse.dir": os.path.join(scratch, "warehouse"),
        "spark.checkpoint.dir": os.path.join(scratch, "checkpoints"),
        "spark.driver.memory": "4g",
    })
    yield s
    s.stop()


@pytest.fixture()
def scratch_dir():
    return tempfile.mkdtemp(prefix="offerlake-case-")


def one_col(spark, values, fn, in_type="string"):
    """Apply a Column function to a list of literal inputs; return the outputs in order."""
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {in_type}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]
