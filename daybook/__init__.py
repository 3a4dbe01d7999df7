"""daybook — a Spark-native warehouse of day-level market data.

Every operator is a function from DataFrames to a DataFrame built from
built-in Spark SQL expressions, so the same code runs on a laptop session
and on a large cluster.  Nothing is collected to the driver.

Layout
------
``functions``  column expressions (date keys, ISO text keys, CIK padding, ...)
``sources``    readers for landed files and the testdata adapters
``operators``  calendar, dimensions, facts, filing selection, as-of join
``plans``      the dependency-ordered build, sinks, and registered queries
"""

from daybook.operators import (
    asof_join,
    asset_dimension,
    cik_map,
    currency_pairs,
    daily_fx,
    daily_prices,
    equity_extended,
    shares_outstanding,
    trading_calendar,
)
from daybook.plans.build import build_all
from daybook.session import checkpoint_root, cluster_conf, get_session, scratch_path

__all__ = [
    "asof_join",
    "asset_dimension",
    "build_all",
    "checkpoint_root",
    "cik_map",
    "cluster_conf",
    "currency_pairs",
    "daily_fx",
    "daily_prices",
    "equity_extended",
    "get_session",
    "scratch_path",
    "shares_outstanding",
    "trading_calendar",
]
