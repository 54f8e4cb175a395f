"""SparkSession factory and table reader shared by the queries and the benchmark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def session(master: str = "local[*]", app: str = "cueforge", **conf: str) -> SparkSession:
    """A session with adaptive execution, Arrow transfer and UTC time."""
    builder = SparkSession.builder.master(master).appName(app)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    for key, value in (defaults | conf).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the Parquet tables of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
