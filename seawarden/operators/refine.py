"""Raw position reports to clean ones: parse, reject, remove duplicates, label."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from seawarden import fixed_values as fixed
from seawarden.functions.bands import bands, code_label
from seawarden.functions.text import quote
from seawarden.operators import add, replace
from seawarden.sources import schemas

POSITION_KEY = ("MMSI", "BaseDateTime")


def _between(column: str, limits: tuple[float, float]) -> str:
    return f"{column} BETWEEN {limits[0]}D AND {limits[1]}D"


LAT_OK = _between("LAT", fixed.LAT_RANGE)
LON_OK = _between("LON", fixed.LON_RANGE)
# NaN sorts above infinity, so this leaves out both.
SPEED_OK = f"SOG >= {fixed.MIN_SPEED}D AND SOG < double('Infinity')"
TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"
# Plain comparisons, which a scan can push down.
IN_SCOPE = f"{LAT_OK} AND {LON_OK} AND {SPEED_OK}"


def parsed_time(fmt: str = TIME_FORMAT, column: str = "BaseDateTime") -> str:
    """Timestamp from text in a declared format; any other text gives null instead of failing the job.

    The format is never guessed: a guess takes a time without a date for today's.
    """
    return f"try_to_timestamp({column}, {quote(fmt)})"


def reject_reason(time: str) -> str:
    """Why a report is not usable, null if it is. The first broken rule names the reason."""
    return bands(
        [
            (f"{time} IS NULL", "'bad_time'"),
            (f"NOT coalesce({LAT_OK}, false)", "'lat_out_of_range'"),
            (f"NOT coalesce({LON_OK}, false)", "'lon_out_of_range'"),
            (f"NOT coalesce({SPEED_OK}, false)", "'bad_speed'"),
        ],
        "NULL",
    )


def tag_rejects(df: DataFrame, fmt: str = TIME_FORMAT) -> DataFrame:
    """Every report with its ``reject_reason``; write this partitioned by reason to split in one pass."""
    return add(df, reject_reason=reject_reason(parsed_time(fmt)))


def parse(df: DataFrame, fmt: str = TIME_FORMAT) -> DataFrame:
    """Reports inside the monitored area and with a speed; the time parsed, null if it is no time."""
    return replace(df.where(IN_SCOPE), {"BaseDateTime": parsed_time(fmt)})


def usable(df: DataFrame, fmt: str = TIME_FORMAT) -> DataFrame:
    """Reports with everything needed to place them."""
    return parse(df, fmt).where("BaseDateTime IS NOT NULL")


def split_rejects(df: DataFrame, fmt: str = TIME_FORMAT) -> tuple[DataFrame, DataFrame]:
    """(usable reports with parsed time, rejected reports as received plus the reason)."""
    return usable(df, fmt), tag_rejects(df, fmt).where("reject_reason IS NOT NULL")


def dedup(
    df: DataFrame,
    keys: Sequence[str] = POSITION_KEY,
    order: Sequence[str] = ("SOG DESC",),
    required: str | None = None,
) -> DataFrame:
    """One row per key: the first by ``order`` (default: the fastest reading).

    All other columns break ties, so only rows equal in every column are interchangeable. The
    ``row_number() <= 1`` form lets Spark keep one row per key on the map side before it shuffles,
    so a key that holds most of the rows sends one row per task.

    ``required`` names a computed key that must not be null. It is tested together with the row
    number, since a filter on the key alone would move below its computation and run that twice.
    """
    ordered = {item.split()[0] for item in order}
    ties = [name for name in df.columns if name not in keys and name not in ordered]
    rank = f"row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY {', '.join([*order, *ties])})"
    first = "_rn <= 1" + (f" AND _rn + if({required} IS NULL, 1, 0) <= 1" if required else "")
    return add(df, _rn=rank).where(first).drop("_rn")


def add_labels(df: DataFrame) -> DataFrame:
    """Names of the vessel type and navigation status codes."""
    return add(
        df,
        VesselTypeName=code_label("VesselType", fixed.VESSEL_TYPES, fixed.VESSEL_TYPE_OTHER),
        NavStatus=code_label("Status", fixed.NAV_STATUS, fixed.NAV_STATUS_UNKNOWN),
    )


def clean(df: DataFrame, fmt: str = TIME_FORMAT) -> DataFrame:
    """Bronze to silver. Labels are added after the shuffle of ``dedup``, which so moves codes only."""
    return schemas.conform(add_labels(dedup(parse(df, fmt), required="BaseDateTime")), schemas.AIS_SILVER)
