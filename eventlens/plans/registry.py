"""Registry of named queries: a Spark plan and (where SQL can say it) a
DuckDB oracle string for each.

Plans are registered with :func:`query`; the Spark side is a callable
``(spark, sf_dir) -> DataFrame`` and the oracle a SQL string over the
driver's views.  Double columns are rounded to 6 digits on both sides so the
value hash does not depend on summation order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from eventlens.plans.fixture_sql import round6, with_fixtures
from eventlens.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def round6_col(c):
    """Round half up at 6 decimals with IEEE operations only
    (``floor(x * 1e6 + 0.5) / 1e6``): unlike ``round``, which each engine
    applies to a different decimal view of the double, these steps give the
    same bits in Spark and DuckDB.  ``+ 0.0`` folds -0.0 into 0.0."""
    scaled = F.floor(c * F.lit(1e6) + F.lit(0.5)).cast("double") / F.lit(1e6) + F.lit(0.0)
    return F.when(F.abs(c) < F.lit(1e12), scaled).otherwise(c)


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*[round6_col(F.col(f.name)).alias(f.name)
                       if isinstance(f.dataType, (DoubleType, FloatType)) else F.col(f.name)
                       for f in df.schema.fields])


def query(name: str, sql: str | None = None, fixtures=(), doubles=()):
    """Register ``fn`` as query ``name`` with an optional oracle ``sql``
    (fixture CTEs prepended, ``doubles`` rounded)."""
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return round_doubles(fn(spark, sf_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = round6(with_fixtures(sql, *fixtures), list(doubles))
        return fn
    return deco
