"""PM2.5 detector with memory: exponential smoothing of level and daily season.

After each reading y in hour h the state of a series moves on:

    level'     = a (y - season[h]) + (1 - a) level
    season[h]' = g (y - level') + (1 - g) season[h]

and the next reading is expected at level + season[its hour]. That is an affine map of
the state, and maps compose. So a series of any length is cut into blocks of rows:
each block becomes one map, a prefix product over the maps (grouped, and grouped
again while there are many) gives the state before each block, and a second pass
over the blocks gives the forecasts. The first reading of a series is a map that
forgets everything, so all series run through one sequence and none lies in one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from airmart.operators.windows import ROWS_PER_BLOCK, numbered
from airmart.plans.anomaly import INTERVAL, with_score
from airmart.session import materialize

HOURS = 24
SIZE = HOURS + 2  # level, a season for each hour, and the constant 1
MAPS_PER_GROUP = 1024


@dataclass(frozen=True)
class Rates:
    level: float = 0.2
    season: float = 0.1


def moved(state: list[float], hour: int, y: float, rates: Rates) -> None:
    """The state after a reading, in place."""
    level = rates.level * (y - state[1 + hour]) + (1 - rates.level) * state[0]
    state[1 + hour] = rates.season * (y - level) + (1 - rates.season) * state[1 + hour]
    state[0] = level


def begun(y: float) -> list[float]:
    """The state after the first reading of a series."""
    return [y, *[0.0] * HOURS, 1.0]


def block_map(first: np.ndarray, hours: np.ndarray, readings: np.ndarray, rates: Rates) -> np.ndarray:
    """The map of a block's rows, in order; ``first`` marks the first row of a series."""
    begins = np.flatnonzero(first)
    if len(begins):  # whatever came before is forgotten
        state = begun(float(readings[begins[-1]]))
        for h, y in zip(hours[begins[-1] + 1 :].tolist(), readings[begins[-1] + 1 :].tolist()):
            moved(state, h, y, rates)
        constant = np.zeros((SIZE, SIZE))
        constant[:, -1] = state
        return constant
    found = np.eye(SIZE)
    one = found[-1]
    for h, y in zip(hours.tolist(), readings.tolist()):
        season = found[1 + h]
        level = rates.level * (y * one - season) + (1 - rates.level) * found[0]
        found[1 + h] = rates.season * (y * one - level) + (1 - rates.season) * season
        found[0] = level
    return found


def forecasts_of(
    state: list[float], first: np.ndarray, hours: np.ndarray, readings: np.ndarray, rates: Rates
) -> Iterator[float | None]:
    """What each reading is expected at; None for the first of a series."""
    for begins, h, y in zip(first.tolist(), hours.tolist(), readings.tolist()):
        if begins:
            state = begun(y)
            yield None
        else:
            yield state[0] + state[1 + h]
            moved(state, h, y, rates)


MAPS = "block long, map binary"
STATES = "block long, state binary"


def prefix_states(maps: DataFrame, per_group: int = MAPS_PER_GROUP) -> DataFrame:
    """(block, state): the state before each block, from a written table of maps numbered from 0."""
    def before(maps: pa.Table, state: np.ndarray) -> pa.Table:
        maps, states = maps.sort_by("block"), []
        for packed in maps.column("map").to_pylist():
            states.append(state.tobytes())
            state = np.frombuffer(packed).reshape(SIZE, SIZE) @ state
        return pa.table({"block": maps.column("block"), "state": pa.array(states, pa.binary())})

    def from_nothing(group: pa.Table) -> pa.Table:
        return before(group.select(["block", "map"]), np.eye(SIZE)[-1])

    def product(group: pa.Table) -> pa.Table:
        whole = np.eye(SIZE)
        for packed in group.sort_by("block").column("map").to_pylist():
            whole = np.frombuffer(packed).reshape(SIZE, SIZE) @ whole
        return pa.table({"block": group.column("group")[:1], "map": pa.array([whole.tobytes()], pa.binary())})

    def from_above(group: pa.Table, above: pa.Table) -> pa.Table:
        return before(group.select(["block", "map"]), np.frombuffer(above.column("state")[0].as_py()))

    last = maps.agg(F.max("block")).first()[0]
    grouped = maps.withColumn("group", F.expr(f"block div {per_group}"))
    if last is None or last < per_group:
        return grouped.groupBy("group").applyInArrow(from_nothing, STATES)
    products = materialize(grouped.groupBy("group").applyInArrow(product, MAPS), "maps")
    above = prefix_states(products, per_group).select(F.col("block").alias("group"), "state")
    return grouped.groupBy("group").cogroup(above.groupBy("group")).applyInArrow(from_above, STATES)


def smoothed(
    rows: DataFrame,
    series: tuple[str, ...] = (),
    ts: str = "TS",
    target: str = "PM2_5",
    rates: Rates = Rates(),
    rows_per_block: int = ROWS_PER_BLOCK,
    maps_per_group: int = MAPS_PER_GROUP,
) -> DataFrame:
    """(series, TS, Y, FORECAST) of all rows with a reading and a time; no forecast for the first of a series."""
    known = rows.where(F.col(ts).isNotNull() & F.col(target).isNotNull() & ~F.isnan(target))
    own = known.select(*series, F.col(ts).alias("TS"), F.col(target).cast("double").alias("Y"))
    placed = numbered(own, ["TS"], series)
    placed = materialize(placed.withColumn("_block", F.expr(f"_row div {rows_per_block}")), "smoothing")
    begins = placed.groupBy(*series).agg(F.min("_row").alias("_row")).select("_row", F.lit(True).alias("_first"))
    marked = placed.join(begins, "_row", "left").withColumns(
        {"_first": F.coalesce("_first", F.lit(False)), "_hour": F.hour("TS")}
    )

    def arrays(group: pa.Table) -> tuple[np.ndarray, ...]:
        return tuple(group.column(c).to_numpy() for c in ("_first", "_hour", "Y"))

    def to_map(group: pa.Table) -> pa.Table:
        found = block_map(*arrays(group.sort_by("_row")), rates)
        return pa.table({"block": group.column("_block")[:1], "map": pa.array([found.tobytes()], pa.binary())})

    def to_forecasts(group: pa.Table, before: pa.Table) -> pa.Table:
        group = group.sort_by("_row")
        state = np.frombuffer(before.column("state")[0].as_py()).tolist()
        found = pa.array(list(forecasts_of(state, *arrays(group), rates)), pa.float64())
        return group.select([*series, "TS", "Y"]).append_column("FORECAST", found)

    maps = materialize(marked.groupBy("_block").applyInArrow(to_map, MAPS), "maps")
    states = prefix_states(maps, maps_per_group).withColumnRenamed("block", "_block")
    schema = StructType([*own.schema.fields, StructField("FORECAST", DoubleType())])
    return marked.groupBy("_block").cogroup(states.groupBy("_block")).applyInArrow(to_forecasts, schema)


def detect_smoothed(
    rows: DataFrame, series: tuple[str, ...] = (), prediction_interval: float = INTERVAL, **how
) -> DataFrame:
    """Forecast, bounds, flag and score of each reading but the first of a series.

    The deviation is that of the forecast's errors in the series.
    """
    found = materialize(smoothed(rows, series, **how).where("FORECAST IS NOT NULL"), "forecasts")
    spread = F.stddev_pop(F.col("Y") - F.col("FORECAST")).alias("sigma")
    if series:
        found = found.join(found.groupBy(*series).agg(spread), list(series))
        return with_score(found, F.col("sigma"), prediction_interval).drop("sigma")
    return with_score(found, found.agg(spread).scalar(), prediction_interval)
