"""Exact rolling distinct counts over long sliding windows (W4, W5, W6, A5, K3 peak).

``HOP(time, slide, size)`` with size = k * slide puts every event in k windows:
17,280 at 1 day / 5 s. Expanding with ``window()`` multiplies the data by k
before any aggregation. The sweep below never expands:

1. distinct (keys, user, pane) with pane = floor(t / slide) -- map-side partial
   aggregation, so a hot key is deduplicated before it is shuffled;
2. per (keys, user), ``lead(pane)`` cuts the user's coverage of window starts
   [pane-k+1, pane+1) so that one user's pieces never overlap;
3. +1 at each piece start, -1 at each piece end, summed per (keys, point) --
   again partial aggregation first;
4. a running sum over the points of each key gives the distinct count for every
   run of window starts between two change points. It has two levels: points are summed up within
   stretches of ``STRETCH`` windows of time, and a stretch starts from the total of the
   stretches before it, one row each. So a key with years of points is many
   tasks, each with the points of one stretch.

Work per group is bounded by the panes in a stretch, not by the number of events or
the length of the history: step 2 sees at most one row per (key, user, pane) and step 4
one row per (key, point). Output is one row per run of equal counts
(``seg_start`` inclusive, ``seg_stop`` exclusive, both window starts in epoch
seconds); :func:`expand_segments` gives one row per window when that is small.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


STRETCH = 4      # window lengths whose points one task sums up


def floor_div(c: Column, n: int) -> Column:
    """Integer floor division, exact for |c| < 2**53 (epoch microseconds until
    the year 2255): c - pmod(c, n) is an exact multiple of n."""
    return ((c - F.pmod(c, F.lit(n))) / F.lit(n)).cast("bigint")


def rolling_distinct_segments(df: DataFrame, keys: Sequence[str], user: str, time_us: str,
                              size_s: int, slide_s: int, bounded: bool = False) -> DataFrame:
    """(keys..., seg_start, seg_stop, uv) runs of windows with the same distinct count. ``bounded``
    says that the input spans a few windows of time only: it is one stretch then."""
    if size_s % slide_s:
        raise ValueError("window size must be a multiple of the slide")
    k = size_s // slide_s
    keys = list(keys)
    pane = floor_div(F.col(time_us), slide_s * 1_000_000)
    panes = (df.where(F.col(user).isNotNull())
             .select(*keys, user, pane.alias("p")).distinct())
    nxt = F.lead("p").over(Window.partitionBy(*keys, user).orderBy("p"))
    pieces = panes.select(
        *keys, (F.col("p") - (k - 1)).alias("s"),
        F.least(F.col("p") + 1, F.coalesce(nxt - (k - 1), F.col("p") + 1)).alias("e"))
    # Both deltas of a piece come from one row: the panes are read and
    # deduplicated once, not once per union branch.
    deltas = (pieces.select(*keys, F.inline(F.array(
                  F.struct(F.col("s").alias("q"), F.lit(1).alias("d")),
                  F.struct(F.col("e").alias("q"), F.lit(-1).alias("d")))))
              .withColumn("c", F.lit(0).cast("bigint") if bounded else floor_div(F.col("q"), k * STRETCH))
              .groupBy(*keys, "c", "q").agg(F.sum("d").alias("d"))
              .where(F.col("d") != 0))
    w = Window.partitionBy(*keys, "c").orderBy("q")
    local = deltas.select(
        *keys, "c", "q",
        F.sum("d").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("uv"),
        F.lead("q").over(w).alias("q_next"))
    if bounded:
        return _positive(local, keys, slide_s)
    over = Window.partitionBy(*keys).orderBy("c")
    stretches = (deltas.groupBy(*keys, "c").agg(F.sum("d").alias("total"), F.min("q").alias("first"))
                 .select(*[F.col(x).alias(f"_{x}") for x in (*keys, "c")],
                         F.sum("total").over(over.rowsBetween(Window.unboundedPreceding, -1)).alias("before"),
                         F.lead("first").over(over).alias("first_next")))
    same = [F.col(x).eqNullSafe(F.col(f"_{x}")) for x in keys] + [F.col("c") == F.col("_c")]
    runs = local.join(stretches, same).select(
        *keys, "q", (F.col("uv") + F.coalesce("before", F.lit(0))).alias("uv"), F.coalesce("q_next", "first_next").alias("q_next"))
    return _positive(runs, keys, slide_s)


def _positive(runs: DataFrame, keys: list[str], slide_s: int) -> DataFrame:
    return runs.where(F.col("uv") > 0).select(
        *keys,
        (F.col("q") * slide_s).alias("seg_start"),
        (F.col("q_next") * slide_s).alias("seg_stop"),
        F.col("uv").cast("bigint").alias("uv"))


def expand_segments(seg: DataFrame, keys: Sequence[str], size_s: int, slide_s: int) -> DataFrame:
    """One row per window (keys, win_start, win_end, uv); only for small ranges."""
    starts = F.sequence(F.col("seg_start"), F.col("seg_stop") - slide_s, F.lit(slide_s).cast("bigint"))
    return (seg.select(*keys, F.explode(starts).alias("win_start"), "uv")
            .select(*keys, "win_start", (F.col("win_start") + size_s).alias("win_end"), "uv"))


def peak_distinct(seg: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Largest distinct count of any window per key (what a keep-max sink keeps)."""
    return seg.groupBy(*keys).agg(F.max("uv").alias("uv"))
