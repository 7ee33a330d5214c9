"""Pandas UDFs that need no session to be defined."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def batch_udf(return_type: str) -> Callable:
    """Like pandas_udf, but made when it is called: importing a module must work without a session."""

    def wrap(f: Callable) -> Callable[..., Column]:
        @functools.wraps(f)
        def call(*columns: Column | str) -> Column:
            return F.pandas_udf(f, return_type)(*columns)

        return call

    return wrap
