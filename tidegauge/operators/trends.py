"""Each period against the device's own past."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import moment, utc_date
from ..functions.clock import utc_day
from ..schemas import MEASURES

# Label above and below the tolerance.
LABELS = {
    "iops": ("improving", "degrading"),
    "latency": ("degrading", "improving"),
    "capacity_used": ("growing", "shrinking"),
}


def trend_vs_history(insights: DataFrame, tolerance: float = 0.05, since=None) -> DataFrame:
    """Compare each average with the mean of the device's earlier periods.

    Adds `hist_*`, `delta_*`, `pct_*` and `*_trend` per measure. The first period of a device
    has NULLs and the label `new`. With `since`, only periods starting then or later are
    returned, still compared with the whole history given.

    Expects one row per device and period, without NULLs in either; a table that runs
    appended to is read with `read_insights(..., latest_only=True)`.

    A window over a whole device would put one device into one task. The history is cut
    into days instead: days are summed first, a running sum over one row per device and day
    gives what lies before each day, and a window inside (device, day) adds the rest. No
    group is longer than the periods of a day or the days of the calendar. The insights are
    read twice, so pass stored ones rather than a plan that starts at the raw metrics.
    """
    day = utc_date(F.col("period_start")).alias("_day")
    sums = [F.sum(f"avg_{m}").alias(f"sum_{m}") for m in MEASURES]
    counts = [F.count(f"avg_{m}").alias(f"n_{m}") for m in MEASURES]
    parts = [f"{kind}_{m}" for m in MEASURES for kind in ("sum", "n")] + ["rows"]

    per_day = insights.groupBy("device_id", day).agg(*sums, *counts, F.count("*").alias("rows"))
    days_before = Window.partitionBy("device_id").orderBy("_day").rowsBetween(
        Window.unboundedPreceding, -1
    )
    before_day = per_day.select(
        "device_id",
        "_day",
        *[F.coalesce(F.sum(p).over(days_before), F.lit(0)).alias(f"past_{p}") for p in parts],
    )

    in_day = Window.partitionBy("device_id", "_day").orderBy("period_start", "period_end").rowsBetween(
        Window.unboundedPreceding, -1
    )
    rows = insights.select("*", day)
    if since is not None:
        rows = rows.where(F.col("_day") >= F.lit(utc_day(since)))
    running = rows.select("*", F.count("*").over(in_day).alias("day_rows"), *[
        c.alias(name)
        for m in MEASURES
        for name, c in (
            (f"day_sum_{m}", F.sum(f"avg_{m}").over(in_day)),
            (f"day_n_{m}", F.count(f"avg_{m}").over(in_day)),
        )
    ])
    joined = running.join(before_day, ["device_id", "_day"], "left")
    if since is not None:
        joined = joined.where(F.col("period_start") >= moment(since))

    def total(part: str) -> Column:
        return F.col(f"past_{part}") + F.coalesce(F.col(f"day_{part}"), F.lit(0))

    history = {m: F.try_divide(total(f"sum_{m}"), total(f"n_{m}")) for m in MEASURES}
    hist = joined.select(
        *insights.columns,
        total("rows").alias("earlier"),
        *[h.alias(f"hist_{m}") for m, h in history.items()],
    )
    delta = hist.select("*", *[
        (F.col(f"avg_{m}") - F.col(f"hist_{m}")).alias(f"delta_{m}") for m in MEASURES
    ])
    pct = delta.select("*", *[
        F.try_divide(F.col(f"delta_{m}"), F.col(f"hist_{m}")).alias(f"pct_{m}") for m in MEASURES
    ])
    trends = [
        F.when(F.col("earlier") == 0, "new")
        .when(F.col(f"pct_{m}") > tolerance, above)
        .when(F.col(f"pct_{m}") < -tolerance, below)
        .otherwise("stable")
        .alias(f"{m}_trend")
        for m, (above, below) in LABELS.items()
    ]
    return pct.select("*", *trends).drop("earlier")
