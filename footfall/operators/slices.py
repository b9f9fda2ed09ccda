"""Slices of visitors' events, so that no visitor is one task.

Ordered work per visitor (gaps, sequences) would put all events of one visitor into one task. That
is fine for people and not for a crawler that owns a third of the log. A sample of the events,
chosen by hash, shows which visitors have more than half a part's share of them, and where their
events are to be cut in order of (time, id), whatever the times are. There are about two cuts for
each part at most, so the table of cuts is small and is sent to the events. Work is done per (visitor, slice), and the
slices of a visitor are stitched together from one summary row each. Visitors that are not cut,
nearly all of them, have no slice number and nothing to stitch.

The cuts depend on the events alone, so all that read the same events find the same slices.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLICE = "visitor_slice"
#: Sampled events for each slice, and slices in a part.
SAMPLED, PER_PART = 32, 2
_RANGE = 1 << 30


def add_slices(
    events: DataFrame, visitor: str, ts: str, tie: str, parts: int | None = None
) -> DataFrame:
    """`events` with `visitor_slice`, which rises with (ts, tie) within a visitor that is cut.

    It is null for a visitor that is not. `parts` is the number of parts that the events are thought
    of in, by default Spark's number of shuffle partitions.
    """
    parts = parts or int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts = F.broadcast(_cuts(events, visitor, ts, tie, PER_PART * parts))
    found = events.join(cuts, F.col(visitor).eqNullSafe(F.col("_visitor")), "left")
    row = F.struct(F.col(ts).alias("at"), F.col(tie).alias("id"))
    number = F.when(F.col("_heads").isNotNull(), _below(row))
    return found.withColumn(SLICE, number).drop("_visitor", "_heads", "_runs", "_width")


def _cuts(events: DataFrame, visitor: str, ts: str, tie: str, slices: int) -> DataFrame:
    """Cuts of each visitor that has any, in runs, so that a row is compared with few of them."""
    total = max(events.count(), 1)
    share = min(1.0, SAMPLED * slices / total)
    step = max(1, round(share * total / slices))
    lot = F.pmod(F.xxhash64(visitor, ts, tie), F.lit(_RANGE))
    sample = events.select(visitor, ts, tie).where(lot < int(share * _RANGE))
    nth = F.row_number().over(Window.partitionBy(visitor).orderBy(ts, tie))
    cut = F.struct(F.col(ts).alias("at"), F.col(tie).alias("id"))
    listed = (
        sample.withColumn("_nth", nth)
        .where(F.col("_nth") % step == 0)
        .groupBy(F.col(visitor).alias("_visitor"))
        .agg(F.sort_array(F.collect_list(cut)).alias("_cuts"))
        .withColumn("_width", F.ceil(F.sqrt(F.size("_cuts"))).cast("int"))
    )
    starts = F.sequence(F.lit(1), F.size("_cuts"), F.col("_width"))
    runs = F.transform(starts, lambda at: F.slice("_cuts", at, F.col("_width")))
    return listed.withColumn("_runs", runs).select(
        "_visitor", F.transform("_runs", lambda run: F.get(run, F.lit(0))).alias("_heads"), "_runs", "_width"
    )


def _below(row: Column) -> Column:
    """Number of cuts that do not lie after the row: those of whole runs, then of the last run."""
    runs = F.size(F.filter("_heads", lambda cut: cut <= row))
    last = F.get("_runs", runs - 1)
    return F.when(runs == 0, F.lit(0)).otherwise(
        (runs - 1) * F.col("_width") + F.size(F.filter(last, lambda cut: cut <= row))
    )
