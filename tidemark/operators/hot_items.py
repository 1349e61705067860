"""Hot items: sliding-window view counts and top-N per window.

Plan: filter -> ``window()`` expand (12 rows per event for 60/5 min) with a
partial count on the map side -> shuffle on (window, item) -> final count ->
shuffle on window end -> top-N. The ``row_number() <= n`` filter lets Catalyst
insert a partial ``WindowGroupLimit`` before the second shuffle, so each map
task ships at most n rows per window end: a window with millions of items
never lands whole in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.time import DATETIME_FMT, local_text

# Fixed values of the reference's hot-items job and its report text.
WINDOW_SIZE = "60 minutes"
WINDOW_SLIDE = "5 minutes"
TOP_N = 3
BEHAVIOR = "pv"
REPORT_RULE = "=" * 36
REPORT_TIME = "时间: "
REPORT_RANK = "No"
REPORT_ITEM = "  商品ID="
REPORT_COUNT = "  浏览量="


def window_end_ms(w: str = "w") -> Column:
    return F.floor(F.unix_micros(F.col(f"{w}.end")) / F.lit(1000)).cast("bigint")


def item_view_counts(events: DataFrame, behavior: str = BEHAVIOR, size: str = WINDOW_SIZE,
                     slide: str = WINDOW_SLIDE, item: str = "item_id",
                     ts: str = "ts") -> DataFrame:
    """A4 + W2 + W7: (item, window_end ms, view_count) per sliding window."""
    return (events.where(F.col("event") == behavior)
            .select(ts, item)
            .groupBy(F.window(ts, size, slide).alias("w"), item)
            .agg(F.count(F.lit(1)).alias("view_count"))
            .select(item, window_end_ms().alias("window_end"), "view_count"))


def top_n(counts: DataFrame, n: int = TOP_N, group: str = "window_end",
          metric: str = "view_count", tie: str = "item_id") -> DataFrame:
    """The n largest rows per group, ``rank`` 1..n.

    Ties on the metric go to the smaller ``tie`` value (the reference keeps
    arrival order, which is not reproducible).
    """
    w = Window.partitionBy(group).orderBy(F.col(metric).desc(), F.col(tie).asc())
    return counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def hot_items(events: DataFrame, n: int = TOP_N, **kw) -> DataFrame:
    return top_n(item_view_counts(events, **kw), n)


def report(top: DataFrame, group: str = "window_end", item: str = "item_id",
           metric: str = "view_count") -> DataFrame:
    """One formatted text block per window end.

    The block's time line is the window end printed as a JVM timestamp in the
    fixed local zone (``yyyy-MM-dd HH:mm:ss.0``); rank labels start at No0.
    Each group holds at most n rows, so ``collect_list`` is bounded.
    """
    blocks = (top.groupBy(group)
              .agg(F.array_sort(F.collect_list(F.struct("rank", item, metric))).alias("rows")))
    shown = local_text(F.timestamp_millis(F.col(group)), DATETIME_FMT)
    millis = F.col(group) % 1000
    frac = F.when(millis == 0, F.lit(".0")).otherwise(
        F.concat(F.lit("."), F.regexp_replace(F.lpad(millis.cast("string"), 3, "0"), "0+$", "")))
    text = F.concat(
        F.lit(REPORT_RULE + "\n"), F.lit(REPORT_TIME), shown, frac, F.lit("\n"),
        F.array_join(F.transform("rows", lambda r: _line(r, item, metric)), ""),
        F.lit(REPORT_RULE + "\n\n"))
    return blocks.select(group, text.alias("report"))


def _line(r: Column, item: str, metric: str) -> Column:
    return F.concat(F.lit(REPORT_RANK), (r["rank"] - 1).cast("string"), F.lit(":"),
                    F.lit(REPORT_ITEM), r[item].cast("string"),
                    F.lit(REPORT_COUNT), r[metric].cast("string"), F.lit("\n"))
