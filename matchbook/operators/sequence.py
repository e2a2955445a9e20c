"""Per-symbol arrival sequence numbers without a window over a whole symbol.

``row_number() over (partition by symbol order by partition, offset)`` puts a
symbol's whole history in one task. Here each symbol's stream is cut into
fixed offset ranges ("chunks"): rows are numbered inside their chunk (bounded
window), chunk sizes are counted with a partial aggregate, and a running sum
over the (few) chunks of a symbol gives each chunk's base. A hot symbol thus
spreads over as many tasks as it has chunks.

The input is scanned twice (the rows, and a partially aggregated count over
three pruned columns); the per-chunk base table is small, and AQE broadcasts
it only when its measured size is under the broadcast threshold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_CHUNK = 1 << 20


def with_sequence(requests: DataFrame, chunk: int = DEFAULT_CHUNK, start: int = 0) -> DataFrame:
    """Add ``seq`` = start + 1-based rank of (partition, offset) within the symbol."""
    keyed = requests.withColumn("_chunk", F.floor(F.col("offset") / F.lit(chunk)).cast("long"))
    group = ["symbol", "partition", "_chunk"]
    sizes = keyed.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("symbol").orderBy("partition", "_chunk").rowsBetween(
        Window.unboundedPreceding, -1)
    bases = sizes.select(*group, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    local = keyed.withColumn("_local", F.row_number().over(Window.partitionBy(*group).orderBy("offset")))
    # NULL keys are keys like any other
    bases = bases.select(*[F.col(c).alias(f"_b{c}") for c in group], "_base")
    same = [F.col(c).eqNullSafe(F.col(f"_b{c}")) for c in group]
    return (local.join(bases, same).drop(*[f"_b{c}" for c in group])
            .withColumn("seq", (F.lit(start) + F.col("_base") + F.col("_local")).cast("long"))
            .drop("_chunk", "_base", "_local"))


def offset_gaps(log: DataFrame, chunk: int = DEFAULT_CHUNK) -> DataFrame:
    """partition, first_missing, last_missing: the ranges between a partition's least and greatest offset that no row has.

    Rows are compared with the next offset inside their chunk (a bounded window); the edges of the (few) chunks are
    compared with each other. A repeated offset is no gap.
    """
    keyed = log.select("partition", "offset", F.floor(F.col("offset") / F.lit(chunk)).cast("long").alias("_chunk"))
    inside = Window.partitionBy("partition", "_chunk").orderBy("offset")
    within = keyed.withColumn("_next", F.lead("offset").over(inside))
    edges = keyed.groupBy("partition", "_chunk").agg(F.min("offset").alias("_lo"), F.max("offset").alias("offset"))
    across = edges.withColumn("_next", F.lead("_lo").over(Window.partitionBy("partition").orderBy("_chunk")))
    both = within.select("partition", "offset", "_next").unionByName(across.select("partition", "offset", "_next"))
    return both.filter(F.col("_next") > F.col("offset") + 1).select(
        "partition", (F.col("offset") + 1).alias("first_missing"), (F.col("_next") - 1).alias("last_missing"))
