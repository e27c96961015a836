"""Entry points used by ``__spark_entry__``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def _catalog():
    from allelic.plans import catalog, catalog_more  # noqa: F401  (registers queries)
    return catalog


def _wrap(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        # results depend on UTC event time; pin it on whatever session we get
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return fn(spark, sf_dir)
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    cat = _catalog()
    return {k: _wrap(v) for k, v in cat.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    cat = _catalog()
    return dict(cat.ORACLE)
