"""Session builder for scripts and tests; library functions accept any session."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the workers, once per application, so that they can import it.

    The archive is a few hundred kilobytes; Spark serves it from the driver.
    """
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        top = os.path.dirname(os.path.abspath(__file__))
        path = os.path.join(tempfile.mkdtemp(prefix="loomline-"), "loomline.zip")
        with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
            for folder, _, names in os.walk(top):
                for name in sorted(names):
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        archive.write(full, os.path.join("loomline", os.path.relpath(full, top)))
        spark.sparkContext.addPyFile(path)
        _SHIPPED.add(app)
    return spark


def tune(spark: SparkSession) -> SparkSession:
    """Session settings the queries rely on.

    UTC makes times independent of the machine. The method limit lets Spark split the
    code of very wide projections, which the JVM otherwise leaves uncompiled.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    return spark


def local_session(cpus: int | str | None = None, **conf: str) -> SparkSession:
    cpus = cpus or os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("loomline")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)
