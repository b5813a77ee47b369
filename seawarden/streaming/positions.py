"""Position reports as a stream: cleaning, duplicates, hourly speed and latest state."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from seawarden.functions.stats import exact_mean
from seawarden.operators import refine
from seawarden.session import is_there, remove_folder, subfolders
from seawarden.sources import schemas

LATE_BY = "2 hours"


def positions(spark: SparkSession, path: str, fmt: str = "parquet", **options: str) -> DataFrame:
    """Raw position reports from files that keep arriving in ``path``."""
    return spark.readStream.format(fmt).schema(schemas.AIS_BRONZE).options(**options).load(path)


def clean(stream: DataFrame) -> DataFrame:
    """Parsed, filtered and labelled reports, by the same rules as the batch layer; not deduplicated."""
    return refine.add_labels(refine.usable(stream))


def dedup(stream: DataFrame, late_by: str = LATE_BY) -> DataFrame:
    """One report per vessel and time, as long as copies arrive within ``late_by``.

    A stream passes on the first report to arrive; the batch layer keeps the fastest. State is
    dropped once the watermark passes, so it does not grow with the length of the stream.
    """
    return stream.withWatermark("BaseDateTime", late_by).dropDuplicatesWithinWatermark(list(refine.POSITION_KEY))


def hourly_speed(stream: DataFrame, late_by: str = LATE_BY) -> DataFrame:
    """Speed per port and hour. Append mode emits closed hours; update mode emits each change."""
    return (
        stream.withWatermark("BaseDateTime", late_by)
        .groupBy("PortZone", F.window("BaseDateTime", "1 hour"))
        .agg(
            F.expr("count(1) AS reports"),
            F.expr(f"round({exact_mean('SOG')}, 4) AS avg_sog"),
            F.expr("min(SOG) AS min_sog"),
            F.expr("max(SOG) AS max_sog"),
        )
        .selectExpr("PortZone", "window.start AS hour_start", "reports", "avg_sog", "min_sog", "max_sog")
    )


def latest_of(df: DataFrame) -> DataFrame:
    """The latest report per vessel; at equal times the fastest, then the greatest position."""
    newest = "max_by(struct(BaseDateTime, LAT, LON, SOG, PortZone), struct(BaseDateTime, SOG, LAT, LON, PortZone))"
    return df.groupBy("MMSI").agg(F.expr(f"{newest} AS newest")).select("MMSI", "newest.*")


def _start(stream: DataFrame, checkpoint: str, mode: str, write, trigger: dict | None) -> StreamingQuery:
    """``trigger`` as for ``DataStreamWriter.trigger``: by default all there is now, then stop."""
    return (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .foreachBatch(write)
        .start()
    )


def write_changes(
    stream: DataFrame, target: str, checkpoint: str, mode: str = "append", trigger: dict | None = None
) -> StreamingQuery:
    """Write the rows of each micro-batch into its own folder of ``target``.

    A micro-batch that runs again after a failure replaces its folder, so every row is stored once.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}")

    return _start(stream, checkpoint, mode, write, trigger)


def _versions(spark: SparkSession, target: str) -> list[int]:
    """Numbers of the complete state versions in ``target``, the newest last."""
    names = [name for name in subfolders(spark, target) if name.startswith("version=")]
    found = sorted(int(name.partition("=")[2]) for name in names)
    return [n for n in found if is_there(spark, f"{target}/version={n}/_SUCCESS")]


def keep_state(
    stream: DataFrame,
    target: str,
    checkpoint: str,
    merge: Callable[[DataFrame, DataFrame], DataFrame],
    mode: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Fold each micro-batch into one stored state: ``merge(state, batch)`` is the next version.

    A version is complete once it is written; readers take the newest complete one, whatever the age of the
    stream. The version before it stays, so that a micro-batch which runs again starts from the same state, and
    older ones are removed. Before the first micro-batch the state is empty, with its columns.
    """
    if not _versions(stream.sparkSession, target):
        nothing = stream.sparkSession.createDataFrame([], stream.schema)
        merge(nothing, nothing).write.mode("overwrite").parquet(f"{target}/version=-1")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        older = [n for n in _versions(spark, target) if n < batch_id]
        state = spark.read.parquet(f"{target}/version={older[-1]}") if older else batch.limit(0)
        merge(state, batch).write.mode("overwrite").parquet(f"{target}/version={batch_id}")
        for n in older[:-1]:
            remove_folder(spark, f"{target}/version={n}")

    return _start(stream, checkpoint, mode, write, trigger)


def stored_state(spark: SparkSession, target: str) -> DataFrame:
    """The newest complete state."""
    return spark.read.parquet(f"{target}/version={_versions(spark, target)[-1]}")


def keep_newest(
    stream: DataFrame, keys: list[str], target: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Keep the newest row per key of a stream in update mode."""

    def merge(state: DataFrame, batch: DataFrame) -> DataFrame:
        return state.join(batch.select(*keys), keys, "left_anti").unionByName(batch)

    return keep_state(stream, target, checkpoint, merge, "update", trigger)


def latest(stream: DataFrame, target: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Keep the latest report per vessel.

    The state is stored, not held by the stream, so late reports need no bound: an older report that arrives
    late loses against the stored newer one.
    """
    columns = ["MMSI", "BaseDateTime", "LAT", "LON", "SOG", "PortZone"]

    def merge(state: DataFrame, batch: DataFrame) -> DataFrame:
        return latest_of(state.unionByName(batch))

    return keep_state(stream.select(*columns), target, checkpoint, merge, "append", trigger)
