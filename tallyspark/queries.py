"""Registry of runnable queries: name -> fn(spark, sf_dir) -> DataFrame.

Job queries return the job's daily frame over the whole input; operator
queries apply one operator to a role derived from the test tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyspark.params import test_params
from tallyspark.plans.jobs import JOBS
from tallyspark.sources.roles import TestDataRoles

QueryFn = Callable[[SparkSession, str], DataFrame]


def _job_query(name: str, daily) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        p = test_params().for_job(name)
        return daily(TestDataRoles(spark, sf_dir), p)
    run.__name__ = name
    return run


def job_queries() -> dict[str, QueryFn]:
    return {name: _job_query(name, daily) for name, daily, _ in JOBS}


def all_queries() -> dict[str, QueryFn]:
    from tallyspark.plans.operator_queries import OPERATOR_QUERIES
    out = job_queries()
    out.update(OPERATOR_QUERIES)
    return out
