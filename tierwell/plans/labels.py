"""The newest label of every code, kept as a stored state that loads are merged into.

A label is the largest (period, load time, label) of its code, which can be merged: the state of all
loads so far and the partial state of the new ones give the state of both.  A run reads the new
loads only, and what is merged twice after a crash changes nothing.
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tierwell.config import RunConfig
from tierwell.operators import storage
from tierwell.operators.dedup import merge_labels, newest_labels
from tierwell.sources import manifest


@dataclass(frozen=True)
class LabelSource:
    """Where the labels of a dimension are: a bronze table, and its columns for the code, the label and the period."""

    table: str
    code: str
    label: str
    period: str = "Tid"


# The dimensions of the domain.
SOURCES = {
    "regions": LabelSource("scb_new_registrations", "Region", "Region_label"),
    "fuels": LabelSource("scb_new_registrations", "Drivmedel", "Drivmedel_label"),
    "categories": LabelSource("scb_cars_in_traffic", "Agarkategori", "Agarkategori_label"),
}


def state_table(config: RunConfig, name: str) -> str:
    return config.table("ops", f"labels_{name}")


def partial_state(spark: SparkSession, config: RunConfig, source: LabelSource, loads: DataFrame) -> DataFrame:
    """The state of some loads; other loads are not read."""
    rows = manifest.complete_rows(spark, config, source.table, loads)
    return newest_labels(rows, source.code, source.label, source.period)


def refresh(spark: SparkSession, config: RunConfig, sources: dict[str, LabelSource] = SOURCES) -> dict[str, DataFrame]:
    """(code, label) per dimension, after merging the loads that the stored state does not have.

    A state that was dropped is built from all loads.
    """
    used = {}
    for name, source in sources.items():
        table, consumer = state_table(config, name), f"labels_{name}"
        known = storage.exists(spark, table)
        loads = manifest.not_used(spark, config, source.table, consumer) if known else (
            manifest.recorded(spark, config, source.table).select("load_id"))
        # Kept: what is marked as used has to be what was read, whatever is recorded meanwhile.
        loads = storage.stage(loads, config, f"loads_{name}")
        if known and loads.isEmpty():
            continue
        state = partial_state(spark, config, source, loads)
        if known:
            state = merge_labels(spark.table(table), state)
        path = config.path("ops", f"labels_{name}")
        storage.point_to(spark, table, storage.write_parquet(state, path), path)
        used[consumer, source.table] = loads
    if used:
        manifest.mark_used(config, used)
    return {name: spark.table(state_table(config, name)).select("code", "label") for name in sources}
