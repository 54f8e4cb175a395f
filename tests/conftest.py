import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from cueforge.session import session

    s = session("local[4]", "tests", **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "3g"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def value(spark):
    """The value of a column expression."""
    return lambda column: spark.range(1).select(column.alias("x")).first()[0]
