"""The (day, region) panel and its feature table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stormgrid import defaults as D
from stormgrid.functions.numeric import at_least, calendar, in_months, log1p0
from stormgrid.functions.text import normalize_key
from stormgrid.operators.aggregate import mean_by
from stormgrid.operators.columns import difference, present, product, weighted_sum
from stormgrid.operators.joins import left_zero
from stormgrid.operators.series import history

KEYS = ["fecha", "alcaldia"]


def build_panel(
    weather: DataFrame, incidents: DataFrame, normalized: bool = False
) -> DataFrame:
    """Mean weather per day and region with that day's incident counts.

    Weather is aggregated before the join, so both sides are unique per key.
    ``normalized=True`` skips the folding of region names that the cleaning stages
    have already done; leave it off for tables from elsewhere.
    """
    measures = [c for c in weather.columns if c not in (*KEYS, "lat", "lon")]
    if not normalized:
        key = normalize_key(F.col("alcaldia"))
        weather, incidents = (t.withColumn("alcaldia", key) for t in (weather, incidents))
    means = mean_by(weather, KEYS, measures)
    return left_zero(means, incidents, KEYS, D.INCIDENT_COLUMNS + D.INCIDENT_TOTALS)


def build_features(panel: DataFrame) -> DataFrame:
    """Label, calendar, history, interaction and log columns of a panel.

    All lags and rolling sums share one window over the region, whose groups have
    one row per day.  Missing numbers end as 0.
    """
    incidents = present(panel, D.LAGGED_INCIDENTS)
    frame = history(
        panel, "alcaldia", "fecha",
        lags={c: [1] for c in ["precip", *incidents]},
        sums={"precip": D.RAIN_WINDOWS, **{c: D.INCIDENT_WINDOWS for c in incidents}},
        slice_rows=None,
    )
    frame = calendar(frame, "fecha").withColumns({
        "temporada_lluvias": in_months(F.col("fecha"), D.SEASON_MONTHS),
        D.LABEL: at_least(F.col("precip"), D.HEAVY_RAIN),
        "llovio_ayer": at_least(F.col("precip_1d"), D.RAIN),
        "lluvia_intensa_ayer": at_least(F.col("precip_1d"), D.HEAVY_RAIN),
    })
    frame = product(difference(frame, D.DIFFERENCES), D.PRODUCTS)
    frame = weighted_sum(frame, D.WEIGHTED_RAIN, "lluvia_acumulada_ponderada")
    frame = log1p0(frame, present(frame, D.LOG_COLUMNS))
    doubles = [f"{c}_{n}d" for c in incidents for n in (1, *D.INCIDENT_WINDOWS)]
    frame = frame.withColumns({c: F.col(c).cast("double") for c in doubles})
    return frame.na.fill(0)
