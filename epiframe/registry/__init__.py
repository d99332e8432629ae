"""All queries over the given tables, with the SQL that checks them."""

import sys
from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

from epiframe.registry import episode_queries, episode_sql, table_queries, table_sql

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def spark_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**episode_queries.QUERIES, **table_queries.QUERIES}


def oracle_queries() -> dict[str, str]:
    return {**episode_sql.SQL, **table_sql.SQL}
