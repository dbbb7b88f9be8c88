"""Registered queries: each pairs a Spark query with the SQL it must equal."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import oracle
from lanecost.functions.calendar import auto_calendar
from lanecost.functions.scalars import count_where, date_of_key, key_of_date
from lanecost.functions.shipments import is_late
from lanecost.operators import fingerprints, rules
from lanecost.operators.convert import convert
from lanecost.operators.drill import ROLES, drill_down
from lanecost.operators.fingerprints import file_fingerprints
from lanecost.operators.fingerprints import table_fingerprint as fingerprint
from lanecost.operators.measures import SUMMED_COLUMNS, measures, needed_columns
from lanecost.operators.numbering import sequential_ids
from lanecost.operators.upsert import insert_absent, upsert
from lanecost.plans import headline, model, quality, reports, views
from lanecost.plans.load import Store, load, run_states
from lanecost.schemas import FOREIGN_KEYS, PRIMARY_KEYS, TABLES
from lanecost.sources.csv_files import (
    malformed_records,
    read_csv,
    scan_csv,
    write_csv,
)
from lanecost.sources.faults import (
    as_text_with_faults,
    with_dimension_faults,
    with_faults,
    with_gaps,
)
from lanecost.sources.folders import shared_folder
from lanecost.sources.order_star import (
    SHIPMENT_COLUMNS,
    SHIPMENT_TEXT_LIMITS,
    customers,
    observed_dates,
    order_star,
    ordered_shipments,
    shipments,
    source,
)
from lanecost.streaming.batches import load_arrivals


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


QUERIES: dict[str, Query] = {}


def register(name: str, sql: str | None = None):
    def add(run: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = Query(run, sql)
        return run

    return add


_KEYS = ("ship_date_key", "customer_id", "carrier_id", "route_id")
_SLICE = {
    "calendar_year": [1996, 1998],
    "carrier_name": ["Supplier#000000001", "Supplier#000000002", "Supplier#000000003"],
    "actual_mode": ["Air", "Road"],
}
_DATES = ("promised_delivery_date", "actual_delivery_date")
_COSTS = ("recorded_freight_inr", "modeled_baseline_inr")

# --- views -------------------------------------------------------------------


@register("shipment_analysis", oracle.star("SELECT * FROM analysis", oracle.MONTHLY))
def shipment_analysis(spark, sf_dir):
    return views.shipment_analysis(order_star(spark, sf_dir))


_MONTHLY = oracle.star("SELECT * FROM monthly ORDER BY year_month", oracle.MONTHLY)


def _monthly(spark, sf_dir, trusted_keys=False, last_dispatch=False):
    keys = () if trusted_keys else _KEYS
    star = order_star(spark, sf_dir, {*views.MONTHLY_COLUMNS, *keys})
    return views.monthly_logistics(star, trusted_keys, last_dispatch)


@register("monthly_logistics", _MONTHLY)
def monthly_logistics(spark, sf_dir):
    return _monthly(spark, sf_dir).orderBy("year_month")


@register("monthly_logistics_trusted", _MONTHLY)
def monthly_logistics_trusted(spark, sf_dir):
    return _monthly(spark, sf_dir, trusted_keys=True).orderBy("year_month")


@register(
    "monthly_growth",
    oracle.star(
        """, placed AS (SELECT *, row_number() OVER (ORDER BY year_month) AS nth FROM monthly)
        SELECT now.* EXCLUDE (nth), past.recorded_freight_inr AS previous_month_freight_inr,
          (now.recorded_freight_inr-past.recorded_freight_inr)::DOUBLE
            / NULLIF(past.recorded_freight_inr::DOUBLE, 0) AS freight_growth_ratio
        FROM placed now LEFT JOIN placed past ON past.nth=now.nth-1""",
        oracle.MONTHLY,
    ),
)
def monthly_growth(spark, sf_dir):
    return views.monthly_growth(_monthly(spark, sf_dir))


_ON_GAPS = oracle.MONTHLY.replace("FROM fact_shipment f", "FROM gaps f")


@register(
    "monthly_growth_gap",
    oracle.star(
        """SELECT monthly.*, LAG(recorded_freight_inr) OVER w AS previous_month_freight_inr,
          CAST(recorded_freight_inr-LAG(recorded_freight_inr) OVER w AS DOUBLE)
          / NULLIF(CAST(LAG(recorded_freight_inr) OVER w AS DOUBLE),0) AS freight_growth_ratio
        FROM monthly WINDOW w AS (ORDER BY year_month)""",
        oracle.GAPS,
        _ON_GAPS,
    ),
)
def monthly_growth_gap(spark, sf_dir):
    """Growth over months of which every fourth is missing."""
    star = _gapped_star(spark, sf_dir, {*views.MONTHLY_COLUMNS, *_KEYS, "actual_delivery_date"})
    return views.monthly_growth(views.monthly_logistics(star))


@register(
    "monthly_growth_calendar_gap",
    oracle.star(
        """, m AS (SELECT year_month, recorded_freight_inr, strptime(year_month,'%Y-%m')::DATE AS start
          FROM monthly),
        last AS (SELECT MAX(calendar_date) AS day FROM gaps JOIN dim_date ON ship_date_key=date_key)
        SELECT m.year_month, m.recorded_freight_inr,
          p.recorded_freight_inr AS previous_calendar_month_freight_inr,
          m.year_month=strftime(last.day,'%Y-%m') AND last.day<last_day(last.day) AS partial_month,
          CAST(m.recorded_freight_inr-p.recorded_freight_inr AS DOUBLE)
            / NULLIF(CAST(p.recorded_freight_inr AS DOUBLE),0) AS calendar_growth_ratio
        FROM m LEFT JOIN m p ON p.start=(m.start - INTERVAL 1 MONTH)::DATE, last""",
        oracle.GAPS,
        _ON_GAPS,
    ),
)
def monthly_growth_calendar_gap(spark, sf_dir):
    star = _gapped_star(spark, sf_dir, {*views.MONTHLY_COLUMNS, *_KEYS, "actual_delivery_date"})
    return views.monthly_growth_calendar(views.monthly_logistics(star, last_dispatch=True))


@register(
    "monthly_growth_calendar",
    oracle.star(
        """, m AS (SELECT year_month, recorded_freight_inr,
            CAST(year_month || '-01' AS DATE) AS first_day FROM monthly),
        ends AS (SELECT d.year_month, MAX(d.calendar_date) AS last_dispatch
            FROM fact_shipment f JOIN dim_date d ON f.ship_date_key=d.date_key GROUP BY 1),
        p AS (SELECT m.year_month, m.recorded_freight_inr,
            q.recorded_freight_inr AS previous_calendar_month_freight_inr,
            m.year_month=(SELECT MAX(year_month) FROM m)
              AND ends.last_dispatch<last_day(ends.last_dispatch) AS partial_month
            FROM m LEFT JOIN m q ON q.first_day + INTERVAL 1 MONTH = m.first_day
            JOIN ends ON ends.year_month=m.year_month)
        SELECT p.*, CAST(recorded_freight_inr-previous_calendar_month_freight_inr AS DOUBLE)
          / NULLIF(CAST(previous_calendar_month_freight_inr AS DOUBLE),0) AS calendar_growth_ratio
        FROM p""",
        oracle.MONTHLY,
    ),
)
def monthly_growth_calendar(spark, sf_dir):
    return views.monthly_growth_calendar(_monthly(spark, sf_dir, last_dispatch=True))


# --- headline figures ----------------------------------------------------------


_TOTALS = """SELECT n AS total_shipments, n-ids AS duplicate_or_null_ids,
    n-dated AS missing_delivery_dates, n-marked AS non_synthetic_rows,
    CAST(freight AS DECIMAL(26,2)) AS recorded_freight_inr,
    CAST(planned AS DECIMAL(26,2)) AS modeled_baseline_inr,
    CAST(freight-planned AS DECIMAL(26,2)) AS cost_variance_inr,
    (freight-planned)::DOUBLE/NULLIF(planned,0)::DOUBLE*100::DOUBLE AS cost_variance_pct,
    freight::DOUBLE/NULLIF(n,0)::DOUBLE AS freight_per_shipment_inr
    FROM (SELECT COUNT(*) AS n, COUNT(DISTINCT shipment_id) AS ids,
      COUNT(promised_delivery_date) FILTER (actual_delivery_date IS NOT NULL) AS dated,
      COUNT(*) FILTER (upper(trim(data_type))='SYNTHETIC') AS marked,
      SUM(recorded_freight_inr) AS freight, SUM(modeled_baseline_inr) AS planned FROM {table})"""
_TOTALS_COLUMNS = ("shipment_id", "data_type", *_DATES, *_COSTS)


def _gapped_star(spark, sf_dir, columns):
    """Star with missing dates, ids, markers and months among its shipments."""
    star = order_star(spark, sf_dir, {*columns, "weight_kg", "route_id", "ship_date_key"})
    return star.with_fact(with_gaps(star.fact_shipment))


@register("headline_totals", oracle.star(_TOTALS.format(table="fact_shipment")))
def headline_totals(spark, sf_dir):
    return headline.headline_totals(order_star(spark, sf_dir, _TOTALS_COLUMNS))


@register("headline_totals_gaps", oracle.star(_TOTALS.format(table="gaps"), oracle.GAPS))
def headline_totals_gaps(spark, sf_dir):
    return headline.headline_totals(_gapped_star(spark, sf_dir, _TOTALS_COLUMNS))


@register(
    "headline_delivery",
    oracle.star(
        """SELECT punctual AS on_time_shipments, late AS delayed_shipments,
          punctual::DOUBLE/NULLIF((punctual+late)::DOUBLE, 0)*100 AS on_time_delivery_pct,
          late_days AS average_delay_days_delayed_only
        FROM (SELECT COUNT(*) FILTER (late_by<=0) AS punctual, COUNT(*) FILTER (late_by>0) AS late,
            AVG(late_by) FILTER (late_by>0) AS late_days
          FROM (SELECT actual_delivery_date-promised_delivery_date AS late_by FROM fact_shipment))"""
    ),
)
def headline_delivery(spark, sf_dir):
    return headline.headline_delivery(shipments(spark, sf_dir, _DATES))


@register(
    "delay_rate_by_mode",
    oracle.star(
        f"""SELECT actual_mode, shipments, late AS delayed_shipments,
        {oracle.share_2dp("late", "shipments")} AS delay_rate_pct
        FROM (SELECT actual_mode, COUNT(*) AS shipments, {oracle.N_LATE} AS late
              FROM fact_shipment GROUP BY 1) ORDER BY actual_mode"""
    ),
)
def delay_rate_by_mode(spark, sf_dir):
    return headline.delay_rate_by_mode(shipments(spark, sf_dir, ("actual_mode", *_DATES)))


@register(
    "ontime_by_carrier",
    oracle.star(
        f"""SELECT carrier_id, carrier_name, shipments, on_time AS on_time_shipments,
        {oracle.share_2dp("on_time", "shipments")} AS on_time_delivery_pct
        FROM (SELECT c.carrier_id, c.carrier_name, COUNT(*) AS shipments,
                {oracle.N_ON_TIME} AS on_time
              FROM fact_shipment f JOIN dim_carrier c ON c.carrier_id=f.carrier_id
              GROUP BY 1,2) ORDER BY on_time_delivery_pct DESC, carrier_id"""
    ),
)
def ontime_by_carrier(spark, sf_dir):
    return headline.ontime_by_carrier(order_star(spark, sf_dir, ("carrier_id", *_DATES)))


@register(
    "variance_by_route",
    oracle.star(
        f"""SELECT route_id, origin_city, destination_city, shipments, cost_variance_inr,
        {oracle.share_2dp("variance_paise", "baseline_paise")} AS cost_variance_pct
        FROM (SELECT r.route_id, r.origin_city, r.destination_city, COUNT(*) AS shipments,
                CAST(SUM(recorded_freight_inr-modeled_baseline_inr) AS DECIMAL(26,2))
                  AS cost_variance_inr,
                CAST(100*SUM(recorded_freight_inr-modeled_baseline_inr) AS HUGEINT)
                  AS variance_paise,
                CAST(100*SUM(modeled_baseline_inr) AS HUGEINT) AS baseline_paise
              FROM fact_shipment f JOIN dim_route r ON r.route_id=f.route_id GROUP BY 1,2,3)
        ORDER BY cost_variance_inr DESC, route_id"""
    ),
)
def variance_by_route(spark, sf_dir):
    return headline.variance_by_route(order_star(spark, sf_dir, ("route_id", *_COSTS)))


# --- quality -------------------------------------------------------------------


@register(
    "control_totals",
    oracle.star(
        """, days_shipped AS (SELECT ship_date_key AS date_key, COUNT(*) AS n, SUM(recorded_freight_inr) AS paid,
          SUM(modeled_baseline_inr) AS planned FROM fact_shipment GROUP BY ship_date_key)
        SELECT CAST(COALESCE(SUM(n), 0) AS BIGINT) AS shipment_count, COUNT(DISTINCT year_month) AS months,
          CAST(SUM(paid) AS DECIMAL(26,2)) AS recorded_freight_inr,
          CAST(SUM(planned) AS DECIMAL(26,2)) AS modeled_baseline_inr
        FROM dim_date JOIN days_shipped USING (date_key)"""
    ),
)
def control_totals(spark, sf_dir):
    return quality.control_totals(order_star(spark, sf_dir, ("ship_date_key", *_COSTS)))


_CHECKS = """SELECT check_name, issues FROM (SELECT
    COUNT(*) FILTER (least(actual_delivery_date, promised_delivery_date)<calendar_date)
      AS delivery_before_dispatch{more}
    FROM {table} LEFT JOIN dim_date ON ship_date_key=date_key)
    UNPIVOT (issues FOR check_name IN (COLUMNS(*)))"""
_MORE_CHECKS = """,
    COUNT(*) FILTER (base_freight_inr+fuel_surcharge_inr+handling_charge_inr+expedite_fee_inr
      -recorded_freight_inr<>0) AS invoice_mismatch,
    COUNT(*) FILTER (ROUND(weight_kg*baseline_rate_inr_kg,2)+baseline_fuel_inr
      +baseline_handling_inr-modeled_baseline_inr<>0) AS baseline_mismatch,
    COUNT(*) FILTER ((actual_delivery_date>promised_delivery_date)=(delay_reason='None'))
      AS reason_date_mismatch,
    COUNT(*) FILTER (data_type<>'SYNTHETIC') AS non_synthetic_rows"""


@register("quality_checks", oracle.star(_CHECKS.format(table="fact_shipment", more=_MORE_CHECKS)))
def quality_checks(spark, sf_dir):
    return quality.quality_checks(order_star(spark, sf_dir))


@register(
    "delivery_before_dispatch",
    oracle.star(
        _CHECKS.format(table="ordered", more=""),
        """ordered AS (SELECT CAST(strftime(o_orderdate,'%Y%m%d') AS INT) AS ship_date_key,
        CAST(l_shipdate AS DATE) AS promised_delivery_date,
        CAST(l_shipdate AS DATE) AS actual_delivery_date
        FROM lineitem LEFT JOIN orders ON l_orderkey=o_orderkey)""",
    ),
)
def delivery_before_dispatch(spark, sf_dir):
    star = order_star(spark, sf_dir, _DATES).with_fact(ordered_shipments(spark, sf_dir))
    return quality.dispatch_checks(star)


# --- measures and reports --------------------------------------------------------


def _report(name, build, names, by=(), tail=""):
    """Register a report dataset grouped by labels that live on ``source``."""
    joins = {
        "carrier_name": "dim_carrier USING (carrier_id)",
        "year_month": "dim_date ON ship_date_key=date_key",
        "route": "dim_route USING (route_id)",
    }
    label = {"route": "origin_city || ' → ' || destination_city"}
    group = [label.get(c, c) for c in by]
    keys = "".join(f"{expression} AS {c}, " for expression, c in zip(group, by, strict=True))
    source = "fact_shipment" + "".join(f" LEFT JOIN {joins[c]}" for c in by if c in joins)
    grouping = f" GROUP BY {', '.join(group)}" if by else ""
    sql = oracle.star(f"SELECT {keys}{oracle.measure_list(names)} FROM {source}{grouping}{tail}")

    @register(name, sql)
    def run(spark, sf_dir):
        return build(order_star(spark, sf_dir, needed_columns(names, by)))


_report("overview_cards", reports.overview_cards, reports.OVERVIEW_CARDS)
_report("monthly_trend", reports.monthly_trend, reports.MONTHLY_TREND, ["year_month"])
_report("carrier_cards", reports.carrier_cards, reports.CARRIER_CARDS)
# A member without shipments has one joined row, which is none.
_BARS = oracle.measure_list(reports.CARRIER_BAR).replace("COUNT(*)", "COUNT(shipment_id)")
_IDLE = "f.carrier_id%10<>3 AND f.actual_mode='Road'"


@register(
    "carrier_bar",
    oracle.star(
        f"""SELECT carrier_name, {_BARS} FROM dim_carrier FULL JOIN fact_shipment f USING (carrier_id)
        GROUP BY carrier_name"""
    ),
)
def carrier_bar(spark, sf_dir):
    columns = needed_columns(reports.CARRIER_BAR, ["carrier_name"])
    return reports.carrier_bar(order_star(spark, sf_dir, columns))


@register(
    "carrier_bar_filtered",
    oracle.star(
        f"""SELECT carrier_name, {_BARS} FROM (SELECT * FROM dim_carrier WHERE carrier_name IN
          ('Supplier#000000001','Supplier#000000002','Supplier#000000003')) LEFT JOIN
          (SELECT * FROM fact_shipment f WHERE {_IDLE}) f USING (carrier_id) GROUP BY carrier_name"""
    ),
)
def carrier_bar_filtered(spark, sf_dir):
    """Three chosen carriers, of which one has no shipment by the chosen mode."""
    chosen = {"carrier_name": _SLICE["carrier_name"], "actual_mode": ["Road"]}
    columns = needed_columns(reports.CARRIER_BAR, ["carrier_name"], chosen)
    star = order_star(spark, sf_dir, columns)
    busy = star.with_fact(star.fact_shipment.where("carrier_id % 10 <> 3"))
    return reports.carrier_bar(busy, chosen)


_report("carrier_scatter", reports.carrier_scatter, reports.CARRIER_SCATTER, ["carrier_name"])
_report(
    "route_top8",
    reports.route_top,
    reports.ROUTE_BAR,
    ["route"],
    " QUALIFY rank() OVER (ORDER BY cost_variance_inr DESC) <= 8",
)
_report("delay_reasons", reports.delay_reasons, reports.DELAY_REASONS, ["delay_reason"])
_report("mode_delay_chart", reports.mode_delays, reports.MODE_DELAYS, ["actual_mode"])

_SUMMARIES = [f"sum_{c}" for c in SUMMED_COLUMNS]


@register(
    "column_summaries",
    oracle.star(
        "SELECT actual_mode, "
        + ", ".join(
            f"CAST(SUM({c}) AS {'BIGINT' if c == 'expedited_flag' else 'DECIMAL(26,2)'}) AS sum_{c}"
            for c in SUMMED_COLUMNS
        )
        + " FROM fact_shipment GROUP BY actual_mode"
    ),
)
def column_summaries(spark, sf_dir):
    columns = needed_columns(_SUMMARIES, ["actual_mode"])
    return measures(order_star(spark, sf_dir, columns), _SUMMARIES, ["actual_mode"])


def _filtered_report(name, build, names, label, chosen, condition):
    """A report page under slicers of other dimensions and of its own."""
    joins = "LEFT JOIN dim_date ON ship_date_key=date_key LEFT JOIN dim_carrier USING (carrier_id)"
    head, group = (f"{label}, ", f" GROUP BY {label}") if label else ("", "")
    sql = f"SELECT {head}{oracle.measure_list(names)} FROM fact_shipment {joins} WHERE {condition}{group}"
    by = [label] if label else []

    @register(name, oracle.star(sql))
    def run(spark, sf_dir):
        return build(order_star(spark, sf_dir, needed_columns(names, by, chosen)), filters=chosen)


_YEARS, _MODE = {"calendar_year": [1996, 1998]}, {"actual_mode": ["Air", "Road"]}
_CARRIER = {"carrier_name": _SLICE["carrier_name"]}
_IN_YEARS, _IN_MODE = "calendar_year IN (1996,1998)", "actual_mode IN ('Air','Road')"
_IN_CARRIER = "carrier_name IN ('Supplier#000000001','Supplier#000000002','Supplier#000000003')"
_filtered_report("monthly_trend_filtered", reports.monthly_trend, reports.MONTHLY_TREND, "year_month", _YEARS | _CARRIER, f"{_IN_YEARS} AND {_IN_CARRIER}")
_filtered_report("carrier_cards_filtered", reports.carrier_cards, reports.CARRIER_CARDS, None, _CARRIER | _MODE, f"{_IN_CARRIER} AND {_IN_MODE}")
_filtered_report("carrier_scatter_filtered", reports.carrier_scatter, reports.CARRIER_SCATTER, "carrier_name", _CARRIER | _YEARS, f"{_IN_CARRIER} AND {_IN_YEARS}")
_filtered_report("delay_reasons_filtered", reports.delay_reasons, reports.DELAY_REASONS, "delay_reason", _YEARS | _MODE, f"{_IN_YEARS} AND {_IN_MODE}")
_filtered_report("mode_delays_filtered", reports.mode_delays, reports.MODE_DELAYS, "actual_mode", _YEARS | _MODE, f"{_IN_YEARS} AND {_IN_MODE}")


@register(
    "overview_filtered",
    oracle.star(
        f"""SELECT {oracle.measure_list(reports.OVERVIEW_CARDS)}
        FROM fact_shipment LEFT JOIN dim_date ON ship_date_key=date_key
        LEFT JOIN dim_carrier USING (carrier_id)
        WHERE calendar_year IN (1996,1998) AND actual_mode IN ('Air','Road')
        AND carrier_name IN ('Supplier#000000001','Supplier#000000002','Supplier#000000003')"""
    ),
)
def overview_filtered(spark, sf_dir):
    columns = needed_columns(reports.OVERVIEW_CARDS, filters=_SLICE)
    return reports.overview_cards(order_star(spark, sf_dir, columns), _SLICE)


@register(
    "slicer_values",
    oracle.star(
        """SELECT 'calendar_year' AS slicer, CAST(y AS VARCHAR) AS member
          FROM (SELECT unnest(generate_series(MIN(year(l_shipdate)), MAX(year(l_shipdate)))) AS y
                FROM lineitem)
        UNION ALL SELECT DISTINCT 'carrier_name', carrier_name FROM dim_carrier
        UNION ALL SELECT DISTINCT 'actual_mode', actual_mode FROM fact_shipment
        ORDER BY 1, 2"""
    ),
)
def slicer_values(spark, sf_dir):
    star = order_star(spark, sf_dir, ["actual_mode"])
    return reports.slicer_values(replace(star, dim_date=observed_dates(spark, sf_dir)))


_DENSE = tuple(oracle.MEASURE)
# A member without shipments has one joined row, which is none.
_DENSE_LIST = oracle.measure_list(_DENSE).replace("COUNT(*)", "COUNT(shipment_id)")


@register(
    "measures_dense_customer",
    oracle.star(
        f"""SELECT customer_name, {_DENSE_LIST}
        FROM dim_customer FULL JOIN (SELECT * FROM fact_shipment WHERE actual_mode='Air') f
        USING (customer_id) GROUP BY customer_name"""
    ),
)
def measures_dense_customer(spark, sf_dir):
    chosen = {"actual_mode": ["Air"]}
    columns = needed_columns(_DENSE, ["customer_name"], chosen)
    star = order_star(spark, sf_dir, columns)
    return measures(star, _DENSE, ["customer_name"], chosen, dense=True)


@register(
    "measures_null_dates",
    oracle.star(f"SELECT actual_mode, {oracle.measure_list(_DENSE)} FROM gaps GROUP BY 1", oracle.GAPS),
)
def measures_null_dates(spark, sf_dir):
    """All measures over shipments some of which lack a delivery date."""
    columns = needed_columns(_DENSE, ["actual_mode"])
    return measures(_gapped_star(spark, sf_dir, columns), _DENSE, ["actual_mode"])


_DRILL = ("total_shipments", "recorded_freight_inr", "delayed_shipments", "average_delay_days")
_DRILL_DAY = {
    "dispatch": "calendar_date",
    "promised": "promised_delivery_date",
    "actual": "actual_delivery_date",
}


def _drill(role):
    day = _DRILL_DAY[role]
    sql = oracle.star(
        f"""SELECT CAST(4-bit_count(GROUPING(y,q,m,dd)) AS INT) AS level, y AS "Year",
        q AS "QuarterNo", m AS "MonthNo", dd AS "Day", {oracle.measure_list(_DRILL)}
        FROM (SELECT *, CAST(year({day}) AS INT) AS y, CAST(quarter({day}) AS INT) AS q,
            CAST(month({day}) AS INT) AS m, CAST(day({day}) AS INT) AS dd
            FROM fact_shipment LEFT JOIN dim_date ON ship_date_key=date_key)
        GROUP BY ROLLUP (y,q,m,dd)"""
    )

    @register(f"date_rollup_{role}", sql)
    def run(spark, sf_dir):
        columns = {*needed_columns(_DRILL), ROLES[role]}
        return drill_down(order_star(spark, sf_dir, columns), role, _DRILL)


for _role in ROLES:
    _drill(_role)


# --- rules -----------------------------------------------------------------------

_ROUTE_COUNT = """ UNION ALL SELECT 'dim_route', NULL, 'C2', 'route_id',
    'dim_route has ' || CAST(n AS VARCHAR) || ' rows instead of 8'
    FROM (SELECT COUNT(*) AS n FROM dim_route) WHERE n<>8"""


def _faulty_star(spark, sf_dir, columns=None):
    """Star whose shipments carry the known faults."""
    star = order_star(spark, sf_dir, columns)
    return star.with_fact(with_faults(star.fact_shipment))


@register(
    "violations",
    oracle.star(oracle.findings("fact_shipment", "faulty") + _ROUTE_COUNT, oracle.FAULTY),
)
def violations(spark, sf_dir):
    found = rules.violations(
        _faulty_star(spark, sf_dir), expected_rows={"dim_route": 8}, text_limits=SHIPMENT_TEXT_LIMITS
    )
    return found.select(*rules.FINDING_COLUMNS)


@register(
    "violation_summary",
    oracle.star(
        "SELECT table_name, rule, column_name, COUNT(*) AS findings FROM ("
        + oracle.findings("fact_shipment", "faulty")
        + ") GROUP BY 1,2,3",
        oracle.FAULTY,
    ),
)
def violation_summary(spark, sf_dir):
    return rules.summarise(
        rules.violations(_faulty_star(spark, sf_dir), text_limits=SHIPMENT_TEXT_LIMITS)
    )


@register(
    "dimension_violations",
    oracle.star(
        """SELECT 'dim_carrier' AS table_name, CAST(carrier_id AS VARCHAR) AS row_key, 'C4' AS rule,
          'data_type' AS column_name FROM dim_carrier WHERE carrier_id%7=1
        UNION ALL SELECT 'dim_carrier', CAST(carrier_id AS VARCHAR), 'C23', 'carrier_name'
          FROM dim_carrier WHERE carrier_id%9=1
        UNION ALL SELECT 'dim_customer', NULL, 'C3', 'customer_id'
          FROM (SELECT 1 FROM dim_customer WHERE customer_id%500=1 LIMIT 1)
        UNION ALL SELECT 'dim_route', CAST(route_id AS VARCHAR), 'C25', 'rate_factor'
          FROM dim_route WHERE route_id%10=3
        UNION ALL SELECT 'dim_date', CAST(date_key AS VARCHAR), 'C26', c FROM dim_date,
          (VALUES ('month_number'),('quarter_number')) v(c) WHERE date_key%10000=229
        UNION ALL SELECT 'dim_date', CAST(calendar_date+1 AS VARCHAR), 'C24', 'calendar_date'
          FROM dim_date WHERE date_key%10000=229"""
    ),
)
def dimension_violations(spark, sf_dir):
    """The rules of the dimensions, each broken by some rows."""
    star = with_dimension_faults(order_star(spark, sf_dir))
    tables = ("dim_customer", "dim_carrier", "dim_route", "dim_date")
    return rules.violations(star, tables=tables).select("table_name", "row_key", "rule", "column_name")


@register(
    "late_snapshot",
    oracle.star(
        """SELECT 'fact_shipment' AS table_name, 'C19' AS rule,
        'actual_delivery_date' AS column_name, COUNT(*) AS findings
        FROM fact_shipment WHERE actual_delivery_date>DATE '2001-10-01'
        HAVING COUNT(*)>0"""
    ),
)
def late_snapshot(spark, sf_dir):
    found = rules.row_findings(
        order_star(spark, sf_dir),
        as_of="2001-10-01",
        tables=["fact_shipment"],
        text_limits=SHIPMENT_TEXT_LIMITS,
    )
    return rules.summarise(found)


@register(
    "orphan_keys",
    oracle.star(
        " UNION ALL ".join(
            f"""SELECT '{column}' AS column_name, CAST({column} AS BIGINT) AS key_value,
            COUNT(*) AS rows FROM faulty f
            WHERE NOT EXISTS (SELECT 1 FROM {table} d WHERE d.{key}=f.{column}) GROUP BY 2"""
            for column, (table, key) in FOREIGN_KEYS.items()
        ),
        oracle.FAULTY,
    ),
)
def orphan_keys(spark, sf_dir):
    return quality.orphan_keys(_faulty_star(spark, sf_dir, {*_KEYS, "weight_kg"}))


@register(
    "duplicate_keys",
    """SELECT l_orderkey, l_linenumber, COUNT(*) AS rows FROM lineitem
    GROUP BY 1,2 HAVING COUNT(*)>1""",
)
def duplicate_keys(spark, sf_dir):
    return quality.duplicate_keys(source(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@register(
    "dispatch_months",
    oracle.star("SELECT COUNT(DISTINCT ship_date_key//100) AS months FROM fact_shipment"),
)
def dispatch_months(spark, sf_dir):
    return rules.month_count(order_star(spark, sf_dir, ["ship_date_key"]))


@register(
    "month_finding",
    oracle.star(
        """SELECT 'fact_shipment' AS table_name, CAST(NULL AS VARCHAR) AS row_key, 'C20' AS rule,
          'ship_date_key' AS column_name, 'fact_shipment covers ' || n || ' months instead of 20' AS message
        FROM (SELECT COUNT(DISTINCT ship_date_key//100) AS n FROM fact_shipment) WHERE n<>20"""
    ),
)
def month_finding(spark, sf_dir):
    star = order_star(spark, sf_dir, ["ship_date_key"])
    return rules.month_findings(star, 20).select(*rules.FINDING_COLUMNS)


@register("faulty_quality_checks", oracle.star(_CHECKS.format(table="faulty", more=_MORE_CHECKS), oracle.FAULTY))
def faulty_quality_checks(spark, sf_dir):
    return quality.quality_checks(_faulty_star(spark, sf_dir))


_RECONCILED = (
    " UNION ALL ".join(
        f"""SELECT '{table}' AS check_name, a.n AS expected, b.n AS found_rows,
        b.k AS found_keys, a.n=b.n AND a.n=b.k AS passed
        FROM (SELECT COUNT(*) AS n FROM {table}) a,
        (SELECT COUNT(*) AS n, COUNT(DISTINCT {key}) AS k FROM {{{table}}}) b"""
        for table, key in PRIMARY_KEYS.items()
    )
    + """ UNION ALL SELECT 'business_rules', 0, n, n, n=0 FROM (SELECT COUNT(*) AS n
    FROM {fact_shipment} WHERE data_type<>'SYNTHETIC' OR recorded_freight_inr<0
    OR modeled_baseline_inr<=0)"""
)


@register(
    "reconcile",
    oracle.star(
        _RECONCILED.format(**{t: t for t in TABLES} | {"fact_shipment": "faulty"}),
        oracle.FAULTY,
    ),
)
def reconcile(spark, sf_dir):
    star = order_star(spark, sf_dir)
    return quality.reconcile(star.tables(), _faulty_star(spark, sf_dir).tables())


# --- loading ---------------------------------------------------------------------

_BATCH = """target AS (SELECT * FROM fact_shipment WHERE planned_mode<>'Sea'),
incoming AS (SELECT * REPLACE (CAST(0 AS DECIMAL(16,2)) AS expedite_fee_inr,
  CAST(recorded_freight_inr-expedite_fee_inr AS DECIMAL(16,2)) AS recorded_freight_inr)
  FROM fact_shipment WHERE expedited_flag=1)"""


def _batches(spark, sf_dir):
    """A table of the shipments not planned by sea, and a batch that waives the
    fee of every expedited shipment, some of which the table already has."""
    fact = shipments(spark, sf_dir)
    waived = fact.where("expedited_flag = 1").withColumns(
        {
            "expedite_fee_inr": F.expr("CAST(0 AS DECIMAL(16,2))"),
            "recorded_freight_inr": F.expr(
                "CAST(recorded_freight_inr - expedite_fee_inr AS DECIMAL(16,2))"
            ),
        }
    )
    return fact.where("planned_mode <> 'Sea'"), waived


@register(
    "upsert_update",
    oracle.star(
        """SELECT * FROM incoming UNION ALL SELECT * FROM target t
        WHERE NOT EXISTS (SELECT 1 FROM incoming i WHERE i.shipment_id=t.shipment_id)""",
        _BATCH,
    ),
)
def upsert_update(spark, sf_dir):
    return upsert(*_batches(spark, sf_dir), "shipment_id")


@register(
    "seed_insert",
    oracle.star(
        """SELECT * FROM target UNION ALL SELECT * FROM incoming i
        WHERE NOT EXISTS (SELECT 1 FROM target t WHERE i.shipment_id=t.shipment_id)""",
        _BATCH,
    ),
)
def seed_insert(spark, sf_dir):
    return insert_absent(*_batches(spark, sf_dir), "shipment_id")


def _new_store(spark, star, purpose):
    schemas = {t: df.schema for t, df in star.tables().items()}
    return Store(spark, shared_folder(spark, purpose), schemas)


@register(
    "load_run",
    oracle.star(_RECONCILED.format(**{t: t for t in TABLES})),
)
def load_run(spark, sf_dir):
    """A whole load, from validation to publication; its reconciliation."""
    star = order_star(spark, sf_dir)
    store = _new_store(spark, star, "load")
    return load(store, star.tables(), text_limits=SHIPMENT_TEXT_LIMITS)


def _moved_store(spark, sf_dir):
    """A first load without expedited shipments, then a batch that adds those and
    moves every weather-delayed shipment to 31 days later, across months. The order
    tables are joined once, for both."""
    star = order_star(spark, sf_dir)
    store = _new_store(spark, star, "batches")
    given = f"{store.root}/given"
    star.fact_shipment.write.parquet(given, compression="zstd")
    fact = spark.read.schema(star.fact_shipment.schema).parquet(given)
    first = star.with_fact(fact.where("expedited_flag = 0"))
    load(store, first.tables(), text_limits=SHIPMENT_TEXT_LIMITS)

    weather = "delay_reason = 'Weather'"
    later = {
        "ship_date_key": key_of_date(F.date_add(date_of_key(F.col("ship_date_key")), 31)),
        "promised_delivery_date": F.date_add("promised_delivery_date", 31),
        "actual_delivery_date": F.date_add("actual_delivery_date", 31),
    }
    batch = fact.where(f"expedited_flag = 1 OR {weather}").withColumns(
        {c: F.when(F.expr(weather), value).otherwise(F.col(c)) for c, value in later.items()}
    )
    batch_tables = {"fact_shipment": batch}
    load(store, batch_tables, whole=False, text_limits=SHIPMENT_TEXT_LIMITS)
    return store


_MOVED = """, moved AS (SELECT * REPLACE (
          CAST(strftime(CAST(strptime(CAST(ship_date_key AS VARCHAR),'%Y%m%d') AS DATE)+31,
            '%Y%m%d') AS INT) AS ship_date_key,
          promised_delivery_date+31 AS promised_delivery_date,
          actual_delivery_date+31 AS actual_delivery_date)
          FROM fact_shipment WHERE delay_reason='Weather'),
        final AS (SELECT * FROM moved
          UNION ALL SELECT * FROM fact_shipment WHERE delay_reason<>'Weather')"""


@register(
    "incremental_batch",
    oracle.star(
        _MOVED
        + """ SELECT CAST(ship_date_key//100 AS INT) AS ship_month, COUNT(*) AS shipments,
          CAST(SUM(recorded_freight_inr) AS DECIMAL(26,2)) AS recorded_freight_inr,
          COUNT(CASE WHEN actual_delivery_date>promised_delivery_date THEN 1 END) AS late
        FROM final GROUP BY 1"""
    ),
)
def incremental_batch(spark, sf_dir):
    """The shipments by month after a batch that moves some of them."""
    store = _moved_store(spark, sf_dir)
    return (
        store.table("fact_shipment")
        .groupBy(F.expr("CAST(ship_date_key DIV 100 AS INT)").alias("ship_month"))
        .agg(
            F.count(F.lit(1)).alias("shipments"),
            F.sum("recorded_freight_inr").alias("recorded_freight_inr"),
            count_where(is_late()).alias("late"),
        )
    )


_REPORTED = tuple(dict.fromkeys(n for names in (
    reports.OVERVIEW_CARDS, reports.CARRIER_CARDS, reports.MONTHLY_TREND, reports.CARRIER_BAR,
    reports.CARRIER_SCATTER, reports.ROUTE_BAR, reports.DELAY_REASONS, reports.MODE_DELAYS,
) for n in names))


@register(
    "maintained_measures",
    oracle.star(
        _MOVED
        + f""" SELECT calendar_year, carrier_name, actual_mode, delay_reason, {oracle.measure_list(_REPORTED)}
        FROM final LEFT JOIN dim_date ON ship_date_key=date_key LEFT JOIN dim_carrier USING (carrier_id)
        GROUP BY ALL"""
    ),
)
def maintained_measures(spark, sf_dir):
    """Every measure of the report pages from the parts that publications maintain, after
    a batch that moves shipments across months."""
    star = _moved_store(spark, sf_dir).report_star()
    return measures(star, _REPORTED, ["calendar_year", "carrier_name", "actual_mode", "delay_reason"])


@register(
    "load_two_sources",
    oracle.star(
        """SELECT CAST(ship_date_key//100 AS INT) AS ship_month, COUNT(*) AS shipments,
        COUNT(DISTINCT shipment_id) AS ids FROM fact_shipment GROUP BY 1"""
    ),
)
def load_two_sources(spark, sf_dir):
    """Dimensions loaded with the shipments by road, the others arriving as files in two
    folders, each read with a checkpoint of its own; shipments by month at the end."""
    star = order_star(spark, sf_dir)
    schema = star.fact_shipment.schema
    store = _new_store(spark, star, "sources")
    # The order tables are joined once: all folders are written in one pass.
    modes = F.col("planned_mode").alias("mode")
    star.fact_shipment.select("*", modes).write.partitionBy("mode").parquet(f"{store.root}/arrivals", compression="zstd")
    folders = {mode: store.folder(f"arrivals/mode={mode}") for mode in ("Road", "Sea", "Air")}
    roads = star.with_fact(spark.read.schema(schema).parquet(folders["Road"]))
    load(store, roads.tables(), text_limits=SHIPMENT_TEXT_LIMITS)
    for mode in ("Sea", "Air"):
        folder = folders[mode]
        load_arrivals(
            store, folder, f"{store.root}/progress/{mode}", SHIPMENT_TEXT_LIMITS
        ).awaitTermination()
    return (
        store.table("fact_shipment")
        .groupBy(F.expr("CAST(ship_date_key DIV 100 AS INT)").alias("ship_month"))
        .agg(F.count(F.lit(1)).alias("shipments"), F.count_distinct("shipment_id").alias("ids"))
    )


_LOG_EVENTS = """events_log AS (SELECT 'run-' || CAST(user_id AS VARCHAR) AS run_id, ts,
  CASE event_type WHEN 'purchase' THEN 'SUCCESS' WHEN 'error' THEN 'FAILED' ELSE 'RUNNING' END
    AS status, event_id AS rows_processed,
  event_type || ' ' || CAST(event_id AS VARCHAR) AS message FROM events)"""


@register(
    "run_log_state",
    f"""WITH {_LOG_EVENTS},
    ranked AS (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY ts DESC,
        status<>'RUNNING' DESC, status DESC, rows_processed DESC, message DESC) AS rn,
        MIN(ts) OVER (PARTITION BY run_id) AS started_at,
        MAX(CASE WHEN status<>'RUNNING' THEN ts END) OVER (PARTITION BY run_id) AS last_end
      FROM events_log)
    SELECT run_id, started_at, CASE WHEN status<>'RUNNING' THEN last_end END AS finished_at,
      status, rows_processed, message FROM ranked WHERE rn=1""",
)
def run_log_state(spark, sf_dir):
    """The event table read as a run log: one run per user."""
    return run_states(
        source(spark, sf_dir, "events").selectExpr(
            "concat('run-', user_id) AS run_id",
            "ts",
            "CASE event_type WHEN 'purchase' THEN 'SUCCESS' WHEN 'error' THEN 'FAILED' "
            "ELSE 'RUNNING' END AS status",
            "event_id AS rows_processed",
            "concat(event_type, ' ', event_id) AS message",
        )
    )


# --- files -----------------------------------------------------------------------


@register("csv_scan_roundtrip", oracle.star("SELECT * FROM fact_shipment"))
def csv_scan_roundtrip(spark, sf_dir):
    """Shipments written as CSV, columns in reverse, and read back by name."""
    fact = shipments(spark, sf_dir)
    path = f"{shared_folder(spark, 'csv')}/fact_shipment.csv"
    write_csv(fact.select(*reversed(fact.columns)), path, compression="gzip")
    text = read_csv(spark, path, fact.columns, "fact_shipment.csv")
    return convert(text, "fact_shipment", fact.schema).accepted()


_TEXT_FAULTS = (
    (50, "weight_kg", "''", "B2", "contains a blank value"),
    (48, "customer_id", "'c' || CAST(customer_id AS VARCHAR)", "B3", "is not an integer"),
    (
        47,
        "promised_delivery_date",
        "replace(CAST(promised_delivery_date AS VARCHAR),'-','/')",
        "B5",
        "is not an ISO date",
    ),
    (46, "fuel_surcharge_inr", "'1.005'", "B4_scale", "does not fit its decimal type"),
    (44, "route_id", "''", "B2", "contains a blank value"),
    (43, "recorded_freight_inr", "'12,50'", "B4", "is not a decimal number"),
    (42, "actual_delivery_date", "'2025-02-30'", "B5", "is not an ISO date"),
    (41, "expedited_flag", "'99999999999'", "B3", "is not an integer"),
)


@register(
    "csv_rejects",
    oracle.star(
        " UNION ALL ".join(
            f"""SELECT 'fact_shipment' AS table_name, shipment_id AS row_key,
            '{column}' AS column_name, NULLIF({raw},'') AS raw, '{rule}' AS rule,
            'fact_shipment.{column} {message}' AS message
            FROM fact_shipment WHERE weight_kg={weight}"""
            for weight, column, raw, rule, message in _TEXT_FAULTS
        )
    ),
)
def csv_rejects(spark, sf_dir):
    """Faulty text written as CSV; the values that do not convert."""
    fact = shipments(spark, sf_dir)
    path = f"{shared_folder(spark, 'csv')}/fact_shipment.csv"
    write_csv(as_text_with_faults(fact), path, compression="gzip")
    text = read_csv(spark, path, fact.columns, "fact_shipment.csv")
    found = convert(text, "fact_shipment", fact.schema).rejects()
    # A blank may be read as an empty or a missing value.
    return found.withColumn("raw", F.nullif("raw", F.lit("")))


_CARRIER_LINE = "CAST(s_suppkey AS VARCHAR) || ',' || s_name || CASE s_nationkey "
_CARRIER_LINE += "WHEN 3 THEN ',SYNTHETIC,extra' WHEN 7 THEN '' ELSE ',SYNTHETIC' END"


@register(
    "csv_malformed",
    f"""SELECT 'dim_carrier.csv' AS file_name, {_CARRIER_LINE} AS record,
    'dim_carrier.csv: wrong number of values' AS message
    FROM supplier WHERE s_nationkey IN (3,7)""",
)
def csv_malformed(spark, sf_dir):
    """Carrier lines, those of two nations one value too long or too short."""
    columns = ["carrier_id", "carrier_name", "data_type"]
    line = (
        "concat(s_suppkey, ',', s_name, CASE s_nationkey WHEN 3 THEN ',SYNTHETIC,extra' "
        "WHEN 7 THEN '' ELSE ',SYNTHETIC' END)"
    )
    path = f"{shared_folder(spark, 'csv')}/dim_carrier.csv"
    lines = source(spark, sf_dir, "supplier").select(F.expr(line).alias(",".join(columns)))
    # One column without quoting: each value is a line as it stands.
    lines.write.option("header", True).option("quote", "").option("sep", "\u0001").csv(path)
    return malformed_records(scan_csv(spark, path, columns), "dim_carrier.csv")


_FILE_ROWS = 100_000


@register(
    "file_fingerprint",
    f"""SELECT CAST(customer_id//{_FILE_ROWS} AS BIGINT) AS block,
    sha256('customer_id,customer_name,segment,data_type' || chr(10)
      || string_agg(line, chr(10) ORDER BY customer_id) || chr(10)) AS sha256
    FROM (SELECT c_custkey AS customer_id, CAST(c_custkey AS VARCHAR) || ',' || c_name || ','
      || c_mktsegment || ',SYNTHETIC' AS line FROM customer) GROUP BY 1""",
)
def file_fingerprint(spark, sf_dir):
    """Customers exported as CSV files of bounded size; the hash of each file."""
    path = shared_folder(spark, "export")
    blocks = customers(spark, sf_dir).withColumn(
        "block", F.expr(f"customer_id DIV {_FILE_ROWS}")
    )
    ordered = blocks.repartition("block").sortWithinPartitions("block", "customer_id")
    ordered.write.partitionBy("block").option("header", True).csv(path)
    block = F.regexp_extract("path", "block=([0-9]+)", 1).cast("bigint")
    return file_fingerprints(spark, path).select(block.alias("block"), "sha256")


_SUMS = ", ".join(
    f"CAST(COALESCE(SUM(('0x' || substr(h,{1 + 7 * k},7))::BIGINT::HUGEINT*b{k}%{fingerprints.MODULUS}),0)%{fingerprints.MODULUS} AS BIGINT)"
    for k in range(4)
)


@register(
    "file_digest",
    f"""WITH RECURSIVE powers AS (SELECT 0 AS n, 1::BIGINT AS b0, 1::BIGINT AS b1, 1::BIGINT AS b2, 1::BIGINT AS b3
      UNION ALL SELECT n+1, {", ".join(f"b{k}*{b}%{fingerprints.MODULUS}" for k, b in enumerate(fingerprints.BASES))}
      FROM powers WHERE n<(SELECT COUNT(*) FROM customer)),
    told AS (SELECT 0 AS n, 'customer_id,customer_name,segment,data_type' AS line UNION ALL
      SELECT row_number() OVER (ORDER BY c_custkey), c_custkey || ',' || c_name || ',' || c_mktsegment || ',SYNTHETIC' FROM customer)
    SELECT CAST(SUM(octet_length(encode(line))+1) AS BIGINT) AS bytes, COUNT(*) AS lines,
      sha256(concat_ws(':', COUNT(*), 1, {_SUMS})) AS digest
    FROM (SELECT *, sha256(line) AS h FROM told) JOIN powers USING (n)""",
)
def file_digest(spark, sf_dir):
    """All customers in one CSV file, however large; its digest by lines."""
    path = shared_folder(spark, "export")
    # Ranges in order, one task per file: the file itself is what is fingerprinted.
    customers(spark, sf_dir).coalesce(1).sortWithinPartitions("customer_id").write.option("header", True).csv(path)
    return fingerprints.file_digests(spark, path).select("bytes", "lines", "digest")


@register(
    "table_fingerprint",
    oracle.star(
        """SELECT COUNT(*) AS rows, CAST(SUM(h) AS DECIMAL(38,0)) AS digest_sum,
        bit_xor(h) AS digest_xor FROM (SELECT CAST('0x' || substr(md5("""
        + " || ".join(
            f"COALESCE(length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR),'-')"
            for c in SHIPMENT_COLUMNS
        )
        + """),1,15) AS BIGINT) AS h FROM fact_shipment)"""
    ),
)
def table_fingerprint(spark, sf_dir):
    return fingerprint(shipments(spark, sf_dir), portable=True)


@register(
    "dataset_profile",
    oracle.star(
        f"""SELECT COUNT(*) AS shipment_count, COUNT(DISTINCT ship_date_key//100) AS months,
        MIN(ship_date_key) AS ship_date_min, MAX(ship_date_key) AS ship_date_max,
        CAST(SUM(recorded_freight_inr) AS DECIMAL(26,2)) AS recorded_freight_inr,
        CAST(SUM(modeled_baseline_inr) AS DECIMAL(26,2)) AS modeled_baseline_inr,
        {oracle.N_LATE} AS late_shipments,
        CAST(SUM(expedited_flag) AS BIGINT) AS expedited_shipments FROM fact_shipment"""
    ),
)
def dataset_profile(spark, sf_dir):
    columns = ("ship_date_key", "expedited_flag", *_DATES, *_COSTS)
    return model.dataset_profile(shipments(spark, sf_dir, columns))


# --- planning model ----------------------------------------------------------------

_CARD = """card AS (SELECT * FROM (VALUES ('Road', CAST(18 AS DECIMAL(12,2)), 5),
  ('Sea', CAST(32 AS DECIMAL(12,2)), 24), ('Air', CAST(210 AS DECIMAL(12,2)), 4))
  c(mode, mode_rate, days))"""


@register(
    "baseline_model",
    oracle.star(
        """, r AS (SELECT shipment_id, weight_kg,
          CAST(ROUND(mode_rate*rate_factor,2) AS DECIMAL(12,2)) AS rate
          FROM fact_shipment JOIN dim_route USING (route_id) JOIN card ON mode=planned_mode),
        p AS (SELECT *, CAST(ROUND(weight_kg*rate,2) AS DECIMAL(16,2)) AS base FROM r),
        q AS (SELECT *, CAST(ROUND(base*CAST(0.12 AS DECIMAL(4,2)),2) AS DECIMAL(16,2)) AS fuel
          FROM p)
        SELECT shipment_id, rate AS baseline_rate_inr_kg, base AS planned_base_inr,
          fuel AS baseline_fuel_inr, CAST(1800 AS DECIMAL(16,2)) AS baseline_handling_inr,
          CAST(base+fuel+1800 AS DECIMAL(16,2)) AS modeled_baseline_inr FROM q""",
        _CARD,
    ),
)
def baseline_model(spark, sf_dir):
    columns = ("shipment_id", "planned_mode", "route_id", "weight_kg")
    return model.baseline_model(order_star(spark, sf_dir, columns), model.rate_card(spark))


@register(
    "promised_date",
    oracle.star(
        """SELECT shipment_id, calendar_date + days + CASE WHEN destination_country='AMERICA'
          THEN 3 ELSE 0 END AS promised_delivery_date
        FROM fact_shipment JOIN dim_date ON ship_date_key=date_key
        JOIN dim_route USING (route_id) JOIN card ON mode=planned_mode""",
        _CARD,
    ),
)
def promised_date(spark, sf_dir):
    columns = ("shipment_id", "ship_date_key", "planned_mode", "route_id")
    star = order_star(spark, sf_dir, columns)
    return model.promised_dates(star, model.rate_card(spark), ["AMERICA"])


@register(
    "mode_upgrades",
    oracle.star(
        """SELECT planned_mode, actual_mode, planned_mode<>actual_mode AS mode_changed,
        COUNT(*) AS shipments, CAST(SUM(expedite_fee_inr) AS DECIMAL(26,2)) AS expedite_fee_inr
        FROM fact_shipment GROUP BY 1,2"""
    ),
)
def mode_upgrades(spark, sf_dir):
    columns = ("planned_mode", "actual_mode", "expedite_fee_inr")
    return model.mode_upgrades(shipments(spark, sf_dir, columns))


@register(
    "shipment_ids",
    oracle.star(
        """SELECT shipment_id, ship_date_key, 'SIM-' || CASE WHEN n<100000
          THEN lpad(CAST(n AS VARCHAR),5,'0') ELSE CAST(n AS VARCHAR) END AS sequence_id
        FROM (SELECT shipment_id, ship_date_key, row_number() OVER
          (ORDER BY ship_date_key, md5(shipment_id), shipment_id) AS n FROM fact_shipment)"""
    ),
)
def shipment_ids(spark, sf_dir):
    fact = shipments(spark, sf_dir, ["shipment_id", "ship_date_key"])
    return sequential_ids(fact, "ship_date_key", "shipment_id")


_SHIP_YEARS = """FROM (SELECT CAST(unnest(generate_series(make_date(MIN(year(l_shipdate)),1,1),
  make_date(MAX(year(l_shipdate)),12,31), INTERVAL 1 DAY)) AS DATE) AS day FROM lineitem)"""


@register(
    "date_dimension",
    f"""SELECT CAST(strftime(day,'%Y%m%d') AS INT) AS date_key, day AS calendar_date,
    CAST(year(day) AS INT) AS calendar_year, CAST(month(day) AS INT) AS month_number,
    strftime(day,'%B') AS month_name, strftime(day,'%Y-%m') AS year_month,
    CAST(quarter(day) AS INT) AS quarter_number {_SHIP_YEARS}""",
)
def date_dimension(spark, sf_dir):
    return observed_dates(spark, sf_dir)


def _calendar(name, column, read):
    @register(
        name,
        oracle.star(
            f"""SELECT day AS "Date", CAST(year(day) AS INT) AS "Year",
            CAST(month(day) AS INT) AS "MonthNo", strftime(day,'%B') AS "Month",
            CAST(quarter(day) AS INT) AS "QuarterNo", 'Qtr ' || CAST(quarter(day) AS VARCHAR)
            AS "Quarter", CAST(day(day) AS INT) AS "Day"
            FROM (SELECT CAST(unnest(generate_series(make_date(MIN(year({column})),1,1),
              make_date(MAX(year({column})),12,31), INTERVAL 1 DAY)) AS DATE) AS day
              FROM (SELECT *, CAST(strptime(CAST(ship_date_key AS VARCHAR),'%Y%m%d') AS DATE)
                AS calendar_date FROM fact_shipment))"""
        ),
    )
    def run(spark, sf_dir):
        return auto_calendar(read(spark, sf_dir), column)


_calendar("auto_calendar", "calendar_date", observed_dates)
for _column in _DATES:
    _calendar(
        f"auto_calendar_{_column.split('_')[0]}",
        _column,
        lambda spark, sf_dir, column=_column: shipments(spark, sf_dir, [column]),
    )
