"""Weather: parse service payloads, find the observation in force, fill what is missing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from seawarden import fixed_values as fixed
from seawarden.operators import add, replace

WEATHER_COLUMNS = tuple(fixed.WEATHER_DEFAULTS)


def parse(df: DataFrame, forecast: str = "forecast_json", marine: str = "marine_json") -> DataFrame:
    """The seven weather numbers from two JSON payloads; a missing or malformed field gives null."""

    def current(payload: str, fields: dict[str, str]) -> str:
        inner = ", ".join(f"{name}: double" for name in fields)
        return f"from_json({payload}, 'current struct<{inner}>').current"

    parsed = add(df, _forecast=current(forecast, fixed.FORECAST_FIELDS), _marine=current(marine, fixed.MARINE_FIELDS))
    source = {column: f"_forecast.{name}" for name, column in fixed.FORECAST_FIELDS.items()}
    source.update({column: f"_marine.{name}" for name, column in fixed.MARINE_FIELDS.items()})
    return add(parsed, **{name: source[name] for name in WEATHER_COLUMNS}).drop("_forecast", "_marine")


def fill_defaults(df: DataFrame) -> DataFrame:
    """Defaults for missing numbers; ``weather_imputed`` tells that at least one was missing."""
    missing = " OR ".join(f"{name} IS NULL" for name in WEATHER_COLUMNS)
    filled = {name: f"coalesce({name}, {default}D)" for name, default in fixed.WEATHER_DEFAULTS.items()}
    return replace(add(df, weather_imputed=missing), filled)


#: Observations in a page, pages in a node: the longest lists that a row is looked up in, but for that of the nodes.
PAGE, NODE = 256, 1024
#: Time buckets in a row without an observation of a place that are filled in; a longer gap is looked up in pages.
GAP = 400


def pages(seen: DataFrame, bucket_hours: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """An index over observations (_by, _at, _obs), one for each place and time, as three tables.

    Observations are numbered by time within their place, and every ``PAGE`` of them are a page, whatever time they
    span. Pages, nodes of pages and the root of a place list what they hold in time order: observations, starts of
    pages, starts of nodes. A root has one entry for each PAGE * NODE observations. Numbers are counted on from one
    bucket of time to the next, so a place's observations are sorted in as many tasks as it has buckets.
    """
    bucket = f"floor(unix_micros(_at) / {bucket_hours * 3_600_000_000.0}D)"
    bucketed = add(seen, _bucket=bucket)
    earlier = "sum(_held) OVER (PARTITION BY _by ORDER BY _bucket ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    held = add(bucketed.groupBy("_by", "_bucket").agg(F.expr("count(1) AS _held")), _earlier=f"coalesce({earlier}, 0)")
    own = "row_number() OVER (PARTITION BY _by, _bucket ORDER BY _at) - 1"
    numbered = add(bucketed, _own=own).join(held.drop("_held"), ["_by", "_bucket"])
    paged = numbered.selectExpr("_by", "_at", "_obs", "_earlier + _own AS _nth", f"(_earlier + _own) div {PAGE} AS _page")
    starts = add(paged.where(f"_nth % {PAGE} = 0"), _node=f"_page div {NODE}")
    return (
        paged.groupBy("_by", "_page").agg(F.expr("sort_array(collect_list(struct(_at, _obs))) AS _seen")),
        starts.groupBy("_by", "_node").agg(F.expr("sort_array(collect_list(struct(_at))) AS _pages")),
        starts.where(f"_page % {NODE} = 0").groupBy("_by").agg(F.expr("sort_array(collect_list(struct(_at))) AS _nodes")),
    )


def entries_until(listed: str, time: str, bits: int) -> str:
    """How many entries of a list in time order are not later than a time: a binary search, 0 for no list."""
    steps = ", ".join(str(1 << k) for k in reversed(range(bits)))
    inside = f"n + s <= coalesce(size({listed}), 0) AND element_at({listed}, n + s)._at <= {time}"
    return f"aggregate(array({steps}), 0, (n, s) -> if({inside}, n + s, n))"


def as_of(
    df: DataFrame,
    observations: DataFrame,
    by: str,
    on: str,
    obs_by: str = "port_zone",
    obs_time: str = "obs_time",
    values: Sequence[str] = WEATHER_COLUMNS,
    bucket_hours: int = 24,
) -> DataFrame:
    """Adds the latest observation of the same ``by`` at or before ``on``: its time and its values.

    Observations are first reduced to one per (``by``, time), the greatest by its values. Where no place has more than
    ``PAGE`` of them in a time bucket, nor ``GAP`` buckets in a row without any, they are gathered in time order per
    (``by``, bucket), and rows pick theirs after an equi-join on that pair. A denser feed, or a lonely date far off, is
    indexed in ``pages`` of a bounded number: a row goes down the index by three equi-joins, each followed by a binary
    search. Either way rows are neither sorted nor numbered, so nothing limits how many tasks share the rows of one
    place and time: against few observations they stay where they are (broadcast), against many the joins are shuffled
    and adaptive execution splits a hot key.

    ``df`` is read once. Rows with a null place or time get nulls.
    """

    def bucket(time: str) -> str:
        return f"floor(unix_micros({time}) / {bucket_hours * 3_600_000_000.0}D)"

    seen = (
        observations.where(f"{obs_by} IS NOT NULL AND {obs_time} IS NOT NULL")
        .selectExpr(f"{obs_by} AS _by", f"{obs_time} AS _at", f"struct({', '.join([obs_time, *values])}) AS _obs")
        .groupBy("_by", "_at")
        .agg(F.expr("max(_obs) AS _obs"))
    )
    following = "lead(_bucket) OVER (PARTITION BY _by ORDER BY _bucket)"
    held = add(seen, _bucket=bucket("_at")).groupBy("_by", "_bucket").agg(F.expr("count(1) AS _held"))
    shape = add(held, _next=following).selectExpr("max(_held) AS most", "max(_next - _bucket) AS gap").first()
    if (shape["most"] or 0) <= PAGE and (shape["gap"] or 0) <= GAP:
        return _from_lists(add(df, _by=by, _at=on, _bucket=bucket(on)), add(seen, _bucket=bucket("_at")), df.columns)
    return _from_pages(add(df, _by=by, _time=on), pages(seen, bucket_hours), df.columns)


def _from_lists(rows: DataFrame, seen: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Each bucket up to the last one of a place also gets the observation still in force at its start; after it, a
    lookup by place answers.
    """
    closing = add(
        seen.groupBy("_by", "_bucket").agg(F.expr("max_by(_obs, _at) AS _obs"), F.expr("max(_at) AS _at")),
        _next="lead(_bucket) OVER (PARTITION BY _by ORDER BY _bucket)",
    )
    carried = closing.where("_next IS NOT NULL").selectExpr(
        "_by", "_at", "_obs", "explode(sequence(_bucket + 1, _next)) AS _bucket"
    )
    final = closing.where("_next IS NULL").selectExpr("_by", "_at AS _final_at", "_obs AS _final_obs")
    in_bucket = (
        seen.unionByName(carried)
        .groupBy("_by", "_bucket")
        .agg(F.expr("sort_array(collect_list(struct(_at, _obs))) AS _seen"))
    )
    place = f"nullif({entries_until('_seen', '_at', (PAGE + 1).bit_length())}, 0)"
    return (
        rows.join(in_bucket, ["_by", "_bucket"], "left")
        .join(final, "_by", "left")
        .selectExpr(*columns, "_at", "_final_at", "_final_obs", f"element_at(_seen, {place})._obs AS _past")
        .selectExpr(*columns, "coalesce(_past, CASE WHEN _final_at <= _at THEN _final_obs END) AS _found")
        .selectExpr(*columns, "_found.*")
    )


def _from_pages(rows: DataFrame, index: tuple[DataFrame, DataFrame, DataFrame], columns: Sequence[str]) -> DataFrame:
    leaves, nodes, roots = index
    at_root = rows.join(roots, "_by", "left")
    at_node = add(at_root, _node=f"cast({entries_until('_nodes', '_time', 31)} - 1 AS bigint)").drop("_nodes")
    at_node = at_node.join(nodes, ["_by", "_node"], "left")
    page = f"_node * {NODE} + {entries_until('_pages', '_time', NODE.bit_length())} - 1"
    found = add(at_node, _page=page).drop("_pages").join(leaves, ["_by", "_page"], "left")
    place = f"nullif({entries_until('_seen', '_time', PAGE.bit_length())}, 0)"
    return found.selectExpr(*columns, f"element_at(_seen, {place})._obs AS _found").selectExpr(*columns, "_found.*")
