"""Several sources in one stream, each with a clock of its own.

Every source has its watermark: its own greatest event time less its own delay. ``slowest`` closes a window when all
sources have passed it: nothing of a slower source is lost, and a source that stands still holds all results back
until it goes on, or until it is ``idle``: a source whose clock is further than that behind the greatest event time of
all sources is taken to be just so far behind. ``fastest`` closes it when the first one has: results come at once, and
what slower sources send for it later is dropped. The choice holds for all streams that the session starts afterwards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

POLICIES = {"slowest": "min", "fastest": "max"}


def union_sources(
    sources: list[tuple[DataFrame, str]], policy: str = "slowest", idle: str | None = None, column: str = "event_ts"
) -> DataFrame:
    """The rows of all sources, given with the delay of each; columns go by name, missing ones are null.

    With ``idle`` a source's clock also hears the others': their event times, so much earlier (and its delay later, so
    that the delay cancels out), pass its watermark and are left behind there. Each source is then read once per source.
    """
    if policy not in POLICIES:
        raise ValueError(f"policy is one of {', '.join(POLICIES)}")
    spark = sources[0][0].sparkSession
    spark.conf.set("spark.sql.streaming.multipleWatermarkPolicy", POLICIES[policy])
    out = None
    for i, (rows, delay) in enumerate(sources):
        own = rows
        if idle is not None:
            own = rows.withColumn("_beat", F.lit(False))
            heard = F.col(column) + F.expr(f"INTERVAL {delay}") - F.expr(f"INTERVAL {idle}")
            for k, (other, _) in enumerate(sources):
                if k != i:
                    beats = other.select(heard.alias(column), F.lit(True).alias("_beat"))
                    own = own.unionByName(beats, allowMissingColumns=True)
        own = own.withWatermark(column, delay)
        if idle is not None:
            # names the event time, as a filter that does not is moved below the watermark, and the beats would not be heard
            never = F.col(column) < F.lit("0001-01-01").cast("timestamp")
            own = own.filter(~F.col("_beat") | never).drop("_beat")
        out = own if out is None else out.unionByName(own, allowMissingColumns=True)
    return out
