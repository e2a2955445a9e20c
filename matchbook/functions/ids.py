"""Deterministic identifiers (a retried task must produce the same ids)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def request_id(*parts: Column | str) -> Column:
    """32 hex chars derived from the input position (``md5`` of the parts joined by '|')."""
    return F.md5(F.concat_ws("|", *[_c(p).cast("string") for p in parts]))


def execution_id(bid_id: Column | str, ask_id: Column | str) -> Column:
    """Execution id = buy request id, '-', sell request id."""
    return F.concat_ws("-", _c(bid_id), _c(ask_id))
