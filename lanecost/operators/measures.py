"""Reusable measures over any grouping and filter.

Every measure is derived from a few additive *parts* (counts and sums). Parts
are first aggregated by the keys on the shipment itself; only that small result
meets the dimensions, is summed again by label, and turned into measures. The
shipments therefore never join a dimension they are merely grouped by, and a hot
carrier or route is reduced before any shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from lanecost.functions.scalars import count_where, safe_ratio
from lanecost.functions.shipments import (
    days_after_promise,
    is_late,
    is_on_time,
    route_label,
)
from lanecost.schemas import FOREIGN_KEYS, SCHEMAS, Star

MONTH = "ship_month"
"""Column by which stored shipments are partitioned, where they come from a store."""

_DELIVERY = ("promised_delivery_date", "actual_delivery_date")

# Columns whose default summary is their sum.
SUMMED_COLUMNS = (
    "weight_kg",
    "base_freight_inr",
    "fuel_surcharge_inr",
    "handling_charge_inr",
    "expedite_fee_inr",
    "recorded_freight_inr",
    "baseline_rate_inr_kg",
    "baseline_fuel_inr",
    "baseline_handling_inr",
    "modeled_baseline_inr",
    "expedited_flag",
)


@dataclass(frozen=True)
class Part:
    """An additive aggregate: the shipment columns it reads, how to compute it,
    and the type it keeps when parts are summed again."""

    reads: tuple[str, ...]
    compute: Callable[[], Column]
    kind: str = "bigint"


def _sum_of(name: str) -> Part:
    whole = isinstance(SCHEMAS["fact_shipment"][name].dataType, IntegerType)
    return Part((name,), lambda: F.sum(name), "bigint" if whole else "decimal(26,2)")


PARTS: dict[str, Part] = {
    "n": Part((), lambda: F.count(F.lit(1))),
    "recorded": _sum_of("recorded_freight_inr"),
    "baseline": _sum_of("modeled_baseline_inr"),
    "late": Part(_DELIVERY, lambda: count_where(is_late())),
    "on_time": Part(_DELIVERY, lambda: count_where(is_on_time())),
    "late_days": Part(_DELIVERY, lambda: F.sum(F.when(is_late(), days_after_promise()))),
    **{f"sum_{name}": _sum_of(name) for name in SUMMED_COLUMNS},
}

# Measure -> the parts it needs.
MEASURES: dict[str, tuple[str, ...]] = {
    "total_shipments": ("n",),
    "recorded_freight_inr": ("recorded",),
    "modeled_baseline_inr": ("baseline",),
    "cost_variance_inr": ("recorded", "baseline"),
    "cost_variance_pct": ("recorded", "baseline"),
    "delayed_shipments": ("late",),
    "on_time_shipments": ("on_time",),
    "on_time_delivery_pct": ("late", "on_time"),
    "average_delay_days": ("late", "late_days"),
    "delivery_evaluable_shipments": ("late", "on_time"),
    "missing_delivery_dates": ("n", "late", "on_time"),
    "freight_per_shipment_inr": ("n", "recorded"),
    "delay_rate_pct": ("late", "on_time"),
    "delivery_date_coverage_pct": ("n", "late", "on_time"),
    **{f"sum_{name}": (f"sum_{name}",) for name in SUMMED_COLUMNS},
}


def _measure(name: str) -> Column:
    """A measure in terms of the summed parts. No rows at all reads as blank
    (NULL), except for the two delivery counts and what adds up from them."""
    zero = F.lit(0).cast("bigint")
    late = F.coalesce(F.col("late"), zero)
    on_time = F.coalesce(F.col("on_time"), zero)
    shipments = F.nullif(F.col("n"), zero)
    recorded, baseline = F.col("recorded"), F.col("baseline")
    no_money = F.lit(0).cast("decimal(26,2)")
    variance = F.when(
        recorded.isNotNull() | baseline.isNotNull(),
        (F.coalesce(recorded, no_money) - F.coalesce(baseline, no_money)).cast("decimal(26,2)"),
    )
    formulas = {
        "total_shipments": lambda: shipments,
        "recorded_freight_inr": lambda: recorded,
        "modeled_baseline_inr": lambda: baseline,
        "cost_variance_inr": lambda: variance,
        "cost_variance_pct": lambda: safe_ratio(variance, baseline),
        "delayed_shipments": lambda: late,
        "on_time_shipments": lambda: on_time,
        "on_time_delivery_pct": lambda: safe_ratio(on_time, on_time + late),
        "average_delay_days": lambda: safe_ratio(F.col("late_days"), F.col("late")),
        "delivery_evaluable_shipments": lambda: on_time + late,
        "missing_delivery_dates": lambda: F.coalesce(F.col("n"), zero) - (on_time + late),
        "freight_per_shipment_inr": lambda: safe_ratio(recorded, shipments),
        "delay_rate_pct": lambda: safe_ratio(late, on_time + late),
        "delivery_date_coverage_pct": lambda: safe_ratio(on_time + late, shipments),
    }
    column = formulas[name]() if name in formulas else F.col(name)
    return column.alias(name)


# Dimension label -> shipment key it is reached by. ``route`` joins two columns.
_LABELS = {
    column: key
    for key, (table, dimension_key) in FOREIGN_KEYS.items()
    for column in SCHEMAS[table].fieldNames()
    if column not in (dimension_key, "data_type")
} | {"route": "route_id"}


def needed_columns(
    names: Sequence[str],
    by: Sequence[str] = (),
    filters: Mapping[str, Iterable] | None = None,
) -> list[str]:
    """Shipment columns that :func:`measures` reads for these arguments."""
    columns: set[str] = set()
    for name in names:
        for part in MEASURES[name]:
            columns.update(PARTS[part].reads)
    for label in [*by, *(filters or {})]:
        columns.add(_LABELS.get(label, label))
    return sorted(columns)


def _members(star: Star, key: str, labels: Sequence[str]) -> DataFrame:
    """Shipment key and labels of the dimension behind it."""
    table, dimension_key = FOREIGN_KEYS[key]
    values = [
        route_label(F.col("origin_city"), F.col("destination_city")).alias(label)
        if label == "route"
        else F.col(label)
        for label in labels
    ]
    return getattr(star, table).select(F.col(dimension_key).alias(key), *values)


def where_members(star: Star, filters: Mapping[str, Iterable] | None) -> DataFrame:
    """Shipments of the chosen members. Choices of different labels are combined
    with AND, an empty choice keeps everything. Labels of a dimension filter
    through its key."""
    fact = star.fact_shipment
    for label, chosen in (filters or {}).items():
        values = list(chosen or ())
        if not values:
            continue
        if label in _LABELS:
            key = _LABELS[label]
            members = _members(star, key, [label]).where(F.col(label).isin(values))
            on = [key]
            if key == "ship_date_key" and MONTH in fact.columns:
                # Stored shipments are partitioned by month: joined on as well, it prunes.
                members = members.withColumn(MONTH, F.expr("CAST(ship_date_key DIV 100 AS INT)"))
                on.append(MONTH)
            fact = fact.join(members.select(*on), on, "left_semi")
        else:
            fact = fact.where(F.col(label).isin(values))
    return fact


# What maintained parts are kept by, besides the month.
CUBE_KEYS = ("carrier_id", "route_id", "actual_mode", "delay_reason")


CUBE_ROWS = 1 << 18
"""Rows of a task that are summed up together."""


def _shares() -> dict[str, Column]:
    """What one shipment adds to each part."""
    def one(test: Column) -> Column:
        return F.when(test, 1).otherwise(0)

    counts = {"n": F.lit(1), "late": one(is_late()), "on_time": one(is_on_time())}
    days = {"late_days": F.when(is_late(), days_after_promise())}
    return {p: (counts | days).get(p, F.col(part.reads[0] if part.reads else p)) for p, part in PARTS.items()}


def _summed(keys: list[str], kinds: dict[str, pa.DataType], at_most: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Sums of all other columns by ``keys``, of so many rows of a task at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def told() -> Iterator[pa.RecordBatch]:
            rows = pa.Table.from_batches(held)
            sums = rows.group_by(keys, use_threads=False).aggregate([(p, "sum") for p in kinds])
            columns = [sums.column(k) for k in keys] + [sums.column(f"{p}_sum").cast(kind) for p, kind in kinds.items()]
            yield from pa.table(columns, names=[*keys, *kinds]).to_batches()

        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= at_most:
                yield from told()
                held, n = [], 0
        if n:
            yield from told()

    return run


def cube(fact: DataFrame, month: str = MONTH) -> DataFrame:
    """All parts by month and :data:`CUBE_KEYS`, in place of the shipments wherever these
    are grouped and filtered by nothing else. Days are kept as the first of their month,
    for calendars of whole months.

    Parts add up, so each task sums its own rows and nothing is shuffled, also where most
    shipments have keys of their own; some keys then have several rows."""
    first = F.expr(f"{month} * 100 + 1").alias("ship_date_key")
    keys = [month, *CUBE_KEYS]
    rows = fact.select(*keys, *[share.cast(PARTS[p].kind).alias(p) for p, share in _shares().items()])
    kinds = {p: pa.int64() if part.kind == "bigint" else pa.decimal128(26, 2) for p, part in PARTS.items()}
    return rows.mapInArrow(_summed(keys, kinds, CUBE_ROWS), rows.schema).select(first, "*")


def parts_by(fact: DataFrame, keys: Sequence, names: Sequence[str]) -> DataFrame:
    """The parts the named measures need, aggregated by shipment keys; summed up where
    ``fact`` is a :func:`cube`."""
    parts = dict.fromkeys(p for name in names for p in MEASURES[name])
    if set(PARTS) <= set(fact.columns):
        return fact.groupBy(*keys).agg(*[F.sum(p).cast(PARTS[p].kind).alias(p) for p in parts])
    return fact.groupBy(*keys).agg(
        *[PARTS[p].compute().cast(PARTS[p].kind).alias(p) for p in parts]
    )


def sum_parts(parts: DataFrame, grouped: GroupedData, *more: Column) -> DataFrame:
    """Add up parts over coarser groups; ``more`` are further aggregates."""
    present = [p for p in PARTS if p in parts.columns]
    return grouped.agg(*[F.sum(p).cast(PARTS[p].kind).alias(p) for p in present], *more)


def measure_columns(names: Sequence[str]) -> list[Column]:
    return [_measure(name) for name in names]


def measures(
    star: Star,
    names: Sequence[str],
    by: Sequence[str] = (),
    filters: Mapping[str, Iterable] | None = None,
    dense: bool = False,
) -> DataFrame:
    """Named measures per group.

    ``by`` takes shipment columns and dimension labels. Shipments whose key is
    unknown stay, under a NULL label. Members with equal labels are one group.
    ``dense`` adds the members of a single dimension that have no shipment, of those
    that the filters on this dimension leave.
    """
    by = list(by)
    unknown = [n for n in names if n not in MEASURES]
    if unknown:
        raise ValueError(f"unknown measures: {unknown}")
    labels = [c for c in by if c in _LABELS]
    if dense and (len(by) != 1 or not labels):
        raise ValueError("dense groups need exactly one dimension label")

    fact = where_members(star, filters)
    keys = list(dict.fromkeys(_LABELS.get(c, c) for c in by))
    grouped = parts_by(fact, keys, names)
    if labels:
        for key in dict.fromkeys(_LABELS[c] for c in labels):
            members = _members(star, key, [c for c in labels if _LABELS[c] == key])
            grouped = grouped.join(members, key, "left")
        grouped = sum_parts(grouped, grouped.groupBy(*by))
    if dense:
        chosen = {c: list(v) for c, v in (filters or {}).items() if v and _LABELS.get(c) == keys[0]}
        members = _members(star, keys[0], list(dict.fromkeys([*by, *chosen])))
        for label, values in chosen.items():
            members = members.where(F.col(label).isin(values))
        members = members.select(*by).distinct()
        grouped = members.join(grouped, by, "full")
    return grouped.select(*by, *measure_columns(names))
