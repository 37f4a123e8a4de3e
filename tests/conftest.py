from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TESTDATA = Path(os.environ.get("TESTDATA", "/root/testdata"))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[*]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("staging")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(df) -> list[tuple]:
    """All rows as plain tuples, in one fixed order."""
    return sorted((tuple(row) for row in df.collect()), key=repr)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def executed_plans(spark, after: int = -1) -> list[str]:
    """The final physical plans of all queries that ran, from the execution after that number."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    found = spark._jsparkSession.sharedState().statusStore().executionsList()
    runs = [found.apply(i) for i in range(found.size())]
    return [x.physicalPlanDescription() for x in sorted(runs, key=lambda x: x.executionId()) if x.executionId() > after]


def last_execution(spark) -> int:
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    found = spark._jsparkSession.sharedState().statusStore().executionsList()
    return max((found.apply(i).executionId() for i in range(found.size())), default=-1)
