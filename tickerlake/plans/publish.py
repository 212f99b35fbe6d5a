"""Write, check, publish: readers see a build only after its checks have passed.

A build goes to a version folder of its own, ``<base>/versions/<version>``,
the declared checks run on what was written there, and only a pass adds a row
to ``<base>/published``, from which readers resolve the live version.  A build
that fails a check, or dies on the way, leaves the live version as it is: its
folder is never read.  The pointer is an append of one row below
``seq=<number>``, committed by Spark's file committer like any other write; of
two publishers that take the same number one fails.
"""

from __future__ import annotations

import uuid
from typing import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerlake.operators import quality as dq
from tickerlake.plans.build import build_stored

POINTER = "version string, seq int"
REPORT = "check_name string, table string, failures bigint, passed boolean"


def _live(spark: SparkSession, base_path: str) -> tuple[int, str | None]:
    """(number, version) of the latest publication; (0, None) before the first."""
    try:
        row = spark.read.schema(POINTER).parquet(f"{base_path.rstrip('/')}/published").agg(
            F.max(F.struct("seq", "version")).alias("last")).first()
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in (e.getCondition() or ""):
            raise
        return 0, None
    return (row["last"].seq, row["last"].version) if row["last"] else (0, None)


def live_version(spark: SparkSession, base_path: str) -> str | None:
    return _live(spark, base_path)[1]


def version_path(base_path: str, version: str) -> str:
    return f"{base_path.rstrip('/')}/versions/{version}"


def read_live(spark: SparkSession, base_path: str, name: str) -> DataFrame:
    """The published dataset ``name``; a reader that has resolved it keeps its version when a new one goes live."""
    version = live_version(spark, base_path)
    if version is None:
        raise FileNotFoundError(f"nothing is published below {base_path}")
    return spark.read.parquet(f"{version_path(base_path, version)}/{name}")


def read_report(spark: SparkSession, base_path: str, version: str) -> DataFrame:
    """The check results that decided about a version, published or refused."""
    return spark.read.schema(REPORT).parquet(f"{version_path(base_path, version)}/quality_report")


def write_checked(inputs: dict[str, DataFrame], base_path: str, checks: Sequence[dq.Check] | None = None) -> str:
    """Build into a new version folder and store its check report; returns the version, which is not live."""
    spark = inputs["board"].sparkSession
    version = uuid.uuid4().hex
    tables = dict(build_stored(inputs, version_path(base_path, version)), holdings=inputs["holdings"])
    report = dq.quality_report(dq.standard_checks() if checks is None else checks, tables)
    report.coalesce(1).write.parquet(f"{version_path(base_path, version)}/quality_report")
    return version


def make_live(spark: SparkSession, base_path: str, version: str) -> None:
    """Move the pointer to a version, if its stored report has no failed check; else raise ``QualityError``."""
    dq.assert_quality(read_report(spark, base_path, version))
    seq = _live(spark, base_path)[0] + 1
    spark.createDataFrame([(version,)], "version string").coalesce(1).write.mode("error").parquet(
        f"{base_path.rstrip('/')}/published/seq={seq}")


def publish(inputs: dict[str, DataFrame], base_path: str, checks: Sequence[dq.Check] | None = None) -> str:
    """Build, check and publish; returns the new live version, or raises and leaves the old one live."""
    version = write_checked(inputs, base_path, checks)
    make_live(inputs["board"].sparkSession, base_path, version)
    return version
