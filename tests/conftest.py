import pytest
from pyspark.sql import SparkSession

from ledgerloom import session


# Expressions in the test modules need a running session when they are imported.
SPARK = session.tune(
    SparkSession.builder.master("local[4]").appName("tests")
    .config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4")
    .config("spark.driver.memory", "6g").getOrCreate()
)
SPARK.sparkContext.setLogLevel("OFF")


@pytest.fixture(scope="session")
def spark():
    return SPARK


@pytest.fixture
def column(spark):
    """Values of an expression over a one-column frame ``v`` of texts."""
    def run(values, expression, ddl="v string"):
        rows = [v if isinstance(v, tuple) else (v,) for v in values]
        df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"i int, {ddl}")
        return [r[0] for r in df.orderBy("i").select(expression.alias("x")).collect()]
    return run
