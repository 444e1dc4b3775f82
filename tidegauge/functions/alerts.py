"""Alert texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import Thresholds


def alert_array(limits: Thresholds, style: str = "value") -> Column:
    """Alerts of one summary row: latency, then IOPS, then capacity; empty if none fires.

    `style="value"` shows the average that fired, `style="threshold"` only the limit.
    A NULL average fires nothing.
    """
    # Label, column, sign of the comparison, limit, unit.
    rules = (
        ("High average latency detected: ", "avg_latency", ">", limits.high_latency, "ms"),
        ("Low average IOPS detected: ", "avg_iops", "<", limits.low_iops, ""),
        ("High capacity usage detected: ", "avg_capacity_used", ">", limits.high_capacity, "GB"),
    )
    texts = []
    for label, name, sign, limit, unit in rules:
        fired = F.col(name) > limit if sign == ">" else F.col(name) < limit
        if style == "value":
            shown = F.col(name).cast("string")
            text = F.concat(F.lit(label), shown, F.lit(f"{unit} (threshold: {limit}{unit})"))
        elif style == "threshold":
            text = F.lit(f"{label}{sign} {limit}{unit}")
        else:
            raise ValueError(f"style must be 'value' or 'threshold', not {style!r}")
        texts.append(F.when(fired, text))
    return F.array_compact(F.array(*texts))
