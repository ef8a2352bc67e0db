"""Named outputs of an operator as two columns, ``route`` and ``reason``."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUTE = "route"
REASON = "reason"
SUCCESS = "success"
FAILURE = "failure"
EMPTY = "empty"
ORIGINAL = "original"


def with_route(df: DataFrame, failures: Iterable[tuple[Column, str | Column]], success: str | Column = SUCCESS) -> DataFrame:
    """Add ``route``/``reason``: the first condition that holds sends the row to failure."""
    route = F.lit(success) if isinstance(success, str) else success
    reason = F.lit(None).cast("string")
    for condition, text in reversed(list(failures)):
        hit = F.coalesce(condition, F.lit(False))
        route = F.when(hit, F.lit(FAILURE)).otherwise(route)
        reason = F.when(hit, F.lit(text) if isinstance(text, str) else text).otherwise(reason)
    return df.withColumns({ROUTE: route, REASON: reason})


def split_routes(df: DataFrame, routes: Iterable[str]) -> dict[str, DataFrame]:
    """One DataFrame per route; every one of them is a plain filter on the same plan."""
    return {name: df.where(F.col(ROUTE) == name).drop(ROUTE) for name in routes}
