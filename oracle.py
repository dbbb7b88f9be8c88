"""The registered queries as plain SQL over the given tables.

Written apart from the Spark code, from the same definitions, so that the two
can be compared. ``star()`` prefixes a query with the star tables as CTEs.
"""

from __future__ import annotations

from lanecost.sources.faults import FAULTS, fault_sql

FACT = """
b AS (
 SELECT l.*, o.o_custkey, s.s_nationkey, c.c_nationkey, n.n_regionkey,
  CASE WHEN o.o_orderpriority='1-URGENT' THEN 'Air'
       WHEN o.o_orderpriority IN ('2-HIGH','3-MEDIUM') THEN 'Road' ELSE 'Sea' END AS planned_mode,
  CAST(l.l_shipdate AS DATE) AS ship_date,
  CAST(l.l_quantity AS DECIMAL(12,2)) AS weight_kg,
  CAST(l.l_extendedprice AS DECIMAL(16,2)) AS base_freight_inr,
  CAST(p.p_retailprice AS DECIMAL(12,2)) AS baseline_rate_inr_kg
 FROM lineitem l LEFT JOIN orders o ON l.l_orderkey=o.o_orderkey
 LEFT JOIN part p ON l.l_partkey=p.p_partkey
 LEFT JOIN supplier s ON l.l_suppkey=s.s_suppkey
 LEFT JOIN customer c ON o.o_custkey=c.c_custkey
 LEFT JOIN nation n ON c.c_nationkey=n.n_nationkey),
d AS (SELECT b.*,
  CASE WHEN l_returnflag='R' THEN 1 ELSE 0 END AS expedited_flag,
  CASE WHEN planned_mode='Sea' AND l_returnflag='R' THEN 'Air' ELSE planned_mode END AS actual_mode,
  CAST(ROUND(base_freight_inr*CAST(l_tax AS DECIMAL(4,2)),2) AS DECIMAL(16,2)) AS fuel_surcharge_inr,
  CAST(1800 AS DECIMAL(16,2)) AS handling_charge_inr,
  CAST(CASE WHEN l_returnflag='R' THEN ROUND(base_freight_inr*CAST(l_discount AS DECIMAL(4,2)),2)
            ELSE 0 END AS DECIMAL(16,2)) AS expedite_fee_inr,
  CAST(ROUND(weight_kg*baseline_rate_inr_kg,2) AS DECIMAL(16,2)) AS planned_base_inr,
  CAST(CASE planned_mode WHEN 'Road' THEN 5 WHEN 'Sea' THEN 24 ELSE 4 END
       + CASE WHEN n_regionkey=1 THEN 3 ELSE 0 END AS INT) AS planned_days,
  CAST(1+(l_orderkey+l_partkey)%30 AS INT) AS actual_days FROM b),
e AS (SELECT d.*, ship_date + planned_days AS promised_delivery_date,
  ship_date + actual_days AS actual_delivery_date,
  CAST(ROUND(planned_base_inr*CAST(0.12 AS DECIMAL(4,2)),2) AS DECIMAL(16,2)) AS baseline_fuel_inr
  FROM d),
fact_shipment AS (
SELECT concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR),
        CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR)) AS shipment_id,
 CAST(year(ship_date)*10000+month(ship_date)*100+day(ship_date) AS INT) AS ship_date_key,
 o_custkey AS customer_id, l_suppkey AS carrier_id,
 CAST(s_nationkey*(SELECT greatest(100,MAX(n_nationkey)+1) FROM nation)+c_nationkey AS INT) AS route_id, planned_mode, actual_mode, weight_kg,
 promised_delivery_date, actual_delivery_date,
 base_freight_inr, fuel_surcharge_inr, handling_charge_inr, expedite_fee_inr,
 CAST(base_freight_inr+fuel_surcharge_inr+handling_charge_inr+expedite_fee_inr
      AS DECIMAL(16,2)) AS recorded_freight_inr,
 baseline_rate_inr_kg, baseline_fuel_inr, CAST(1800 AS DECIMAL(16,2)) AS baseline_handling_inr,
 CAST(planned_base_inr+baseline_fuel_inr+1800 AS DECIMAL(16,2)) AS modeled_baseline_inr,
 expedited_flag,
 CASE WHEN actual_delivery_date<=promised_delivery_date THEN 'None'
      WHEN l_linenumber%3=0 THEN 'Weather' WHEN l_linenumber%3=1 THEN 'Capacity constraint'
      ELSE 'Documentation' END AS delay_reason,
 'SYNTHETIC' AS data_type
FROM e)
"""

DIMENSIONS = """
dim_customer AS (SELECT c_custkey AS customer_id, c_name AS customer_name,
  c_mktsegment AS segment, 'SYNTHETIC' AS data_type FROM customer),
dim_carrier AS (SELECT s_suppkey AS carrier_id, s_name AS carrier_name,
  'SYNTHETIC' AS data_type FROM supplier),
dim_route AS (SELECT CAST(a.n_nationkey*
  (SELECT greatest(100,MAX(n_nationkey)+1) FROM nation)+b.n_nationkey AS INT) AS route_id,
  a.n_name AS origin_city, b.n_name AS destination_city, r.r_name AS destination_country,
  CASE WHEN a.n_regionkey=b.n_regionkey THEN 'Domestic' ELSE 'Export' END AS route_type,
  CAST(0.8+0.2*b.n_regionkey AS DECIMAL(5,2)) AS rate_factor, 'SYNTHETIC' AS data_type
  FROM nation a CROSS JOIN nation b JOIN region r ON b.n_regionkey=r.r_regionkey),
days AS (SELECT CAST(unnest(generate_series(make_date(least(MIN(year(l_shipdate)),1970),1,1),
  make_date(greatest(MAX(year(l_shipdate)),2069),12,31), INTERVAL 1 DAY)) AS DATE) AS day FROM lineitem),
dim_date AS (SELECT CAST(strftime(day,'%Y%m%d') AS INT) AS date_key, day AS calendar_date,
  CAST(year(day) AS INT) AS calendar_year, CAST(month(day) AS INT) AS month_number,
  strftime(day,'%B') AS month_name, strftime(day,'%Y-%m') AS year_month,
  CAST(quarter(day) AS INT) AS quarter_number FROM days)
"""

MONTHLY = """
compared AS (
 SELECT *, actual_delivery_date-promised_delivery_date AS late_by,
  recorded_freight_inr-modeled_baseline_inr AS excess FROM fact_shipment f),
analysis AS (
 SELECT compared.* EXCLUDE (late_by, excess), calendar_date AS ship_date, year_month,
  origin_city, destination_city, destination_country, route_type,
  customer_name, segment, carrier_name,
  CAST(CASE WHEN late_by>0 THEN late_by WHEN late_by<=0 THEN 0 END AS INT) AS delay_days,
  CAST(COALESCE(late_by<=0, FALSE) AS INT) AS on_time_flag,
  CAST(excess AS DECIMAL(17,2)) AS cost_variance_inr,
  excess::DOUBLE/NULLIF(modeled_baseline_inr::DOUBLE, 0) AS cost_variance_ratio
 FROM dim_route JOIN compared USING (route_id) JOIN dim_date ON date_key=ship_date_key
 JOIN dim_carrier USING (carrier_id) JOIN dim_customer USING (customer_id)),
daily AS (
 SELECT ship_date, year_month, COUNT(*) AS n, SUM(on_time_flag) AS punctual, SUM(expedited_flag) AS urgent,
  SUM(expedite_fee_inr) AS fees, SUM(weight_kg) AS kg, SUM(recorded_freight_inr) AS paid,
  SUM(modeled_baseline_inr) AS planned FROM analysis GROUP BY ALL),
monthly AS (
 SELECT year_month, CAST(SUM(n) AS BIGINT) AS shipments, CAST(SUM(urgent) AS BIGINT) AS expedited_shipments,
  CAST(SUM(fees) AS DECIMAL(26,2)) AS expedite_fees_inr,
  CAST(SUM(paid) AS DECIMAL(26,2)) AS recorded_freight_inr,
  CAST(SUM(planned) AS DECIMAL(26,2)) AS modeled_baseline_inr,
  CAST(SUM(paid)-SUM(planned) AS DECIMAL(26,2)) AS cost_variance_inr,
  (SUM(paid)-SUM(planned))::DOUBLE/NULLIF(SUM(planned)::DOUBLE, 0) AS cost_variance_ratio,
  SUM(paid)::DOUBLE/NULLIF(SUM(kg)::DOUBLE, 0) AS freight_per_kg_inr,
  SUM(punctual)::DOUBLE/SUM(n)::DOUBLE AS on_time_delivery_ratio
 FROM daily GROUP BY year_month)
"""


def star(sql: str, *ctes: str) -> str:
    """``sql`` with the star tables, and any further CTEs, in front."""
    return "WITH " + ",".join([FACT, DIMENSIONS, *ctes]) + sql


def share_2dp(part: str, whole: str) -> str:
    """100 * part / whole, rounded half away from zero to two places, computed in
    whole numbers. Both arguments must be integers."""
    return (
        f"CASE WHEN ({whole})=0 THEN NULL ELSE CAST(CAST(sign({part}) AS HUGEINT)"
        f"*((20000*abs({part})+({whole}))//(2*({whole}))) AS DECIMAL(18,0))"
        "*CAST(0.01 AS DECIMAL(3,2)) END"
    )


LATE = "actual_delivery_date>promised_delivery_date"
ON_TIME = "actual_delivery_date<=promised_delivery_date"
N_LATE = f"COUNT(CASE WHEN {LATE} THEN 1 END)"
N_ON_TIME = f"COUNT(CASE WHEN {ON_TIME} THEN 1 END)"
RECORDED = "SUM(recorded_freight_inr)"
BASELINE = "SUM(modeled_baseline_inr)"


def _ratio(a: str, b: str) -> str:
    return f"CAST({a} AS DOUBLE)/NULLIF(CAST({b} AS DOUBLE),0)"


_VARIANCE = (
    f"CASE WHEN {RECORDED} IS NULL AND {BASELINE} IS NULL THEN NULL ELSE "
    f"CAST(COALESCE({RECORDED},0)-COALESCE({BASELINE},0) AS DECIMAL(26,2)) END"
)
MEASURE = {
    "total_shipments": "NULLIF(COUNT(*),0)",
    "recorded_freight_inr": f"CAST({RECORDED} AS DECIMAL(26,2))",
    "modeled_baseline_inr": f"CAST({BASELINE} AS DECIMAL(26,2))",
    "cost_variance_inr": _VARIANCE,
    "cost_variance_pct": _ratio(f"({_VARIANCE})", BASELINE),
    "delayed_shipments": N_LATE,
    "on_time_shipments": N_ON_TIME,
    "on_time_delivery_pct": _ratio(N_ON_TIME, f"({N_ON_TIME}+{N_LATE})"),
    "average_delay_days": f"AVG(CASE WHEN {LATE} THEN "
    "date_diff('day',promised_delivery_date,actual_delivery_date) END)",
    "delivery_evaluable_shipments": f"{N_ON_TIME}+{N_LATE}",
    "missing_delivery_dates": f"COUNT(*)-({N_ON_TIME}+{N_LATE})",
    "freight_per_shipment_inr": _ratio(RECORDED, "COUNT(*)"),
    "delay_rate_pct": _ratio(N_LATE, f"({N_ON_TIME}+{N_LATE})"),
    "delivery_date_coverage_pct": _ratio(f"({N_ON_TIME}+{N_LATE})", "COUNT(*)"),
}


def measure_list(names) -> str:
    return ", ".join(f"{MEASURE[n]} AS {n}" for n in names)

# The same faulty input as the queries read.
FAULTY = (
    "faulty AS (SELECT * REPLACE ("
    + ", ".join(f"{fault_sql(c)} AS {c}" for c in dict.fromkeys(c for c, _ in FAULTS.values()))
    + ") FROM fact_shipment)"
)


GAPS = """gaps AS (SELECT * REPLACE (
  CASE WHEN weight_kg IN (50,3) THEN NULL ELSE actual_delivery_date END AS actual_delivery_date,
  CASE WHEN weight_kg IN (49,3) THEN NULL ELSE promised_delivery_date END AS promised_delivery_date,
  CASE WHEN route_id%7=0 THEN CAST(0 AS DECIMAL(16,2)) ELSE modeled_baseline_inr END
    AS modeled_baseline_inr,
  CASE WHEN weight_kg=48 THEN ' synthetic ' WHEN weight_kg=47 THEN NULL WHEN weight_kg=46
    THEN 'MEASURED' ELSE data_type END AS data_type,
  CASE WHEN weight_kg=45 THEN NULL WHEN weight_kg=44 THEN 'again' ELSE shipment_id END
    AS shipment_id)
  FROM fact_shipment WHERE ship_date_key//100%4<>2)"""
"""Shipments with missing dates, ids and markers, baselines of zero, repeated ids, and whole
months left out."""


def findings(table: str, source: str, shipment_id_limit: int = 80) -> str:
    """Every row rule of the shipments, and the repeated keys, as one UNION ALL."""
    sid = "shipment_id"

    def about(text: str) -> str:
        return f"{sid} || ': {text}'"

    expected = (
        "CAST(ROUND(weight_kg*baseline_rate_inr_kg,2)+baseline_fuel_inr+baseline_handling_inr"
        " AS DECIMAL(18,2))"
    )
    charges = "base_freight_inr+fuel_surcharge_inr+handling_charge_inr+expedite_fee_inr"
    rules = []
    for rule, columns in (
        (
            "C5",
            "base_freight_inr fuel_surcharge_inr handling_charge_inr expedite_fee_inr "
            "recorded_freight_inr",
        ),
        (
            "C11",
            "baseline_rate_inr_kg baseline_fuel_inr baseline_handling_inr modeled_baseline_inr",
        ),
    ):
        for c in columns.split():
            rules.append(
                (rule, c, f"{c} IS NULL OR {c}<0", about(f"{c} is missing, not a number or below zero"))
            )
    rules.append(
        (
            "C6",
            "ship_date_key",
            "NOT EXISTS (SELECT 1 FROM dim_date d WHERE d.date_key=f.ship_date_key)",
            about("ship_date_key is not in the calendar"),
        )
    )
    for c in ("promised_delivery_date", "actual_delivery_date"):
        early = (
            f"{c} < (SELECT MAX(calendar_date) FROM dim_date d WHERE d.date_key=f.ship_date_key)"
        )
        rules.append(("C7", c, early, about(f"{c} cannot be before dispatch")))
    rules.append(
        ("C8", "weight_kg", "weight_kg<=0", about("weight_kg is not above zero"))
    )
    for c in ("planned_mode", "actual_mode"):
        bad = f"{c} IS NULL OR {c} NOT IN ('Road','Sea','Air')"
        rules.append(("C9", c, bad, f"{sid} || ': invalid {c}: ' || COALESCE({c},'None')"))
    rules += [
        (
            "C10",
            "expedited_flag",
            "expedited_flag NOT IN (0,1)",
            about("expedited_flag is neither 0 nor 1"),
        ),
        (
            "C12",
            "modeled_baseline_inr",
            "baseline_rate_inr_kg=0 OR modeled_baseline_inr=0",
            about("baseline rate or total is zero"),
        ),
        (
            "C13",
            "modeled_baseline_inr",
            f"modeled_baseline_inr<>{expected}",
            f"{sid} || ': baseline mismatch: ' || CAST({expected} AS VARCHAR)"
            " || ' by its parts, given ' || CAST(modeled_baseline_inr AS VARCHAR)",
        ),
    ]
    for c, dim in (
        ("customer_id", "dim_customer"),
        ("carrier_id", "dim_carrier"),
        ("route_id", "dim_route"),
    ):
        rules.append(
            (
                "C14",
                c,
                f"NOT EXISTS (SELECT 1 FROM {dim} d WHERE d.{c}=f.{c})",
                f"{sid} || ': no dimension row for {c} ' || COALESCE(CAST({c} AS VARCHAR),'None')",
            )
        )
    rules += [
        (
            "C15",
            "recorded_freight_inr",
            f"{charges}<>recorded_freight_inr",
            about("charges do not add up to the recorded freight"),
        ),
        (
            "C16",
            "delay_reason",
            f"{LATE} AND delay_reason='None'",
            about("late without a delay reason"),
        ),
        (
            "C17",
            "delay_reason",
            f"{ON_TIME} AND delay_reason<>'None'",
            about("delay reason although in time"),
        ),
        (
            "C18",
            "data_type",
            "data_type<>'SYNTHETIC'",
            about("not marked as synthetic"),
        ),
        (
            "C30",
            "planned_mode",
            "length(planned_mode)>10",
            "'fact_shipment.planned_mode is longer than 10'",
        ),
        (
            "C30",
            "shipment_id",
            f"length(shipment_id)>{shipment_id_limit}",
            f"'fact_shipment.shipment_id is longer than {shipment_id_limit}'",
        ),
    ]
    for c in ("shipment_id", "planned_mode", "actual_mode", "delay_reason", "data_type"):
        rules.append(("C21", c, f"regexp_full_match({c}, '\\s*')", f"'fact_shipment.{c} must not be blank'"))
    for c in ("customer_id", "base_freight_inr"):
        rules.append(("C23", c, f"{c} IS NULL", f"'fact_shipment.{c} must not be null'"))
    rows = " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, {sid} AS row_key, '{rule}' AS rule, "
        f"'{column}' AS column_name, {message} AS message FROM {source} f WHERE {bad}"
        for rule, column, bad, message in rules
    )
    return (
        f"{rows} UNION ALL SELECT '{table}', NULL, 'C3', '{sid}', "
        f"'{table}.{sid} has repeated values' FROM (SELECT COUNT(*) AS n, "
        f"COUNT(DISTINCT {sid}) AS k FROM {source}) WHERE n>k"
    )
