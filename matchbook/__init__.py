"""matchbook: limit-order flow on Spark.

Validate and route trade requests, match them per symbol in price-time
priority (batch replay or Structured Streaming with keyed state), and derive
executions, resting orders, top of book, book snapshots and a trades table.
"""

__version__ = "0.1.0"

__all__ = ["__version__"]
