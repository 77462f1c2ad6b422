"""Session defaults shared by the tests, the bench and local runs."""

from __future__ import annotations

from pyspark.sql import SparkSession


JIT_LIMIT = 8000  # bytes of a method that HotSpot still compiles


def compilable(spark: SparkSession) -> SparkSession:
    """Lets Spark fall back to smaller methods where the code of a wide projection would only be interpreted by the JVM."""
    key = "spark.sql.codegen.hugeMethodLimit"
    if int(spark.conf.get(key)) > JIT_LIMIT:
        spark.conf.set(key, str(JIT_LIMIT))
    return spark


def local_session(cores: str = "*", app: str = "modelwarden", **conf: str) -> SparkSession:
    """A local session; on a cluster the caller brings its own session instead."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
