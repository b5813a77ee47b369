"""Each reading against the vessel's own recent past."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from seawarden import fixed_values as fixed
from seawarden.functions.stats import fraction, mean_of_parts, whole
from seawarden.operators import add


def trailing_average(
    df: DataFrame,
    key: str = "MMSI",
    time: str = "BaseDateTime",
    value: str = "SOG",
    rows: int = 24,
    bucket_days: int = 7,
) -> DataFrame:
    """Adds ``trailing_avg``: the mean of the ``rows`` readings before this one, null for the first.

    A window over the whole track of a vessel would put one busy vessel into one task. So the track
    is cut into time buckets. Inside a bucket only the first ``rows`` readings look back past its
    start, and what they need is among the first and last ``rows`` readings of each bucket. These
    edge readings alone go through a window per vessel, at most ``2 * rows`` per bucket of time,
    however many readings the vessel has: the resolution of time bounds them, also for an identity that
    many transponders share. (key, time) must be unique, as ``dedup`` leaves it.
    """
    local = f"PARTITION BY {key}, _bucket ORDER BY {time}"

    def mean_before(partition: str) -> str:
        past = f"OVER (PARTITION BY {partition} ORDER BY {time} ROWS BETWEEN {rows} PRECEDING AND 1 PRECEDING)"
        return mean_of_parts(value, "_whole", "_fraction", "_size", past)

    # Both branches below need the same columns of this step, so they share one shuffle.
    bucketed = add(
        df,
        _bucket=f"floor(unix_micros({time}) / {bucket_days * 86_400_000_000.0}D)",
        _whole=whole(value),
        _fraction=fraction(value),
        _size=f"abs({value})",
    )
    inside = add(
        bucketed,
        _position=f"row_number() OVER ({local})",
        _near_end=f"lead(1, {rows}) OVER ({local}) IS NULL",
        trailing_avg=mean_before(f"{key}, _bucket"),
    )
    kept = [*df.columns, "trailing_avg"]
    body = inside.where(f"_position > {rows}").select(*kept)
    edges = add(
        inside.where(f"_position <= {rows} OR _near_end").drop("trailing_avg"), trailing_avg=mean_before(key)
    )
    return body.unionByName(edges.where(f"_position <= {rows}").select(*kept))


def speed_drops(df: DataFrame, rows: int = 24, **kwargs) -> DataFrame:
    """Marks readings of a nearly stopped vessel that was cruising until then (``speed_drop``)."""
    drop = f"SOG < {fixed.DROP_BELOW_KNOTS} AND trailing_avg > {fixed.DROP_FROM_KNOTS}"
    return add(trailing_average(df, rows=rows, **kwargs), speed_drop=f"coalesce({drop}, false)")


def speed_drop_counts(df: DataFrame, rows: int = 24, **kwargs) -> DataFrame:
    """Readings and speed drops per vessel."""
    return (
        speed_drops(df, rows, **kwargs)
        .groupBy("MMSI")
        .agg(
            F.expr("count(1) AS record_count"),
            F.expr("count_if(speed_drop) AS speed_drop_events"),
            F.expr("max(BaseDateTime) FILTER (WHERE speed_drop) AS last_drop_time"),
        )
    )


def slowdown_episodes(
    df: DataFrame, rows: int = 24, gap_hours: int = 12, bucket_days: int = 7, key: str = "MMSI", time: str = "BaseDateTime"
) -> DataFrame:
    """One row per slowdown: speed drops of a vessel, each at most ``gap_hours`` after the one before.

    Drops are joined inside time buckets first, so a vessel with most of the readings is dealt over as many tasks as
    it has buckets. What then meets in a window per vessel are the pieces: two of one bucket lie further apart than the
    gap, so time bounds their number, however many readings there are.
    """
    drops = speed_drops(df, rows, key=key, time=time).where("speed_drop")
    limit = f"{gap_hours * 3600} * 1000000L"

    def islands(pieces: DataFrame, start: str, end: str, by: str) -> DataFrame:
        """``_island``: numbered anew where a piece starts more than the gap after the end of the one before."""
        over = f"OVER (PARTITION BY {by} ORDER BY {start})"
        apart = f"coalesce(unix_micros({start}) - unix_micros(lag({end}) {over}) > {limit}, true)"
        return add(add(pieces, _new=apart), _island=f"count_if(_new) {over}")

    def joined(pieces: DataFrame, by: str, start: str, end: str, size: str, least: str) -> DataFrame:
        return pieces.groupBy(*by.split(", "), "_island").agg(
            F.expr(f"min({start}) AS episode_start"),
            F.expr(f"max({end}) AS episode_end"),
            F.expr(f"sum({size}) AS readings"),
            F.expr(f"min({least}) AS min_sog"),
        )

    bucketed = add(drops, _bucket=f"floor(unix_micros({time}) / {bucket_days * 86_400_000_000.0}D)")
    local = joined(islands(bucketed, time, time, f"{key}, _bucket"), f"{key}, _bucket", time, time, "1L", "SOG")
    whole = islands(local.drop("_island"), "episode_start", "episode_end", key)
    merged = joined(whole, key, "episode_start", "episode_end", "readings", "min_sog")
    hours = "(unix_micros(episode_end) - unix_micros(episode_start)) / 3600000000D"
    return add(merged, hours=hours).select(key, "episode_start", "episode_end", "hours", "readings", "min_sog")
