"""Reference SQL for the registered queries, in the dialect of the checking database.

Each query is built from the views below, given as common table expressions over the raw tables.
"""

from __future__ import annotations

# View name -> (views it reads, body). Order matters: a view follows those it reads.
VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "wh_raw": (
        (),
        """
SELECT CASE WHEN l_orderkey % 100 = 0 THEN NULL ELSE concat('ORD-', CAST(l_orderkey AS VARCHAR), '-', CAST(l_linenumber AS VARCHAR)) END AS order_id,
       CAST(DATE '2024-01-01' + CAST(l_orderkey % 182 AS INT) AS DATE) AS order_date,
       r_name AS region,
       CASE WHEN l_linenumber % 2 = 1 THEN 'Day' ELSE 'Night' END AS shift,
       CASE WHEN l_orderkey % 53 = 0 THEN CAST(-99 AS DOUBLE) ELSE CAST(80 + l_partkey % 71 AS DOUBLE) END AS throughput_uph,
       CASE WHEN l_partkey % 97 = 0 THEN CAST(60 AS DOUBLE) ELSE (l_quantity - 1) / 8 END AS dock_delay_hrs,
       CASE WHEN l_orderkey % 31 = 0 THEN CAST(150 AS DOUBLE) WHEN l_suppkey % 41 = 0 THEN NULL ELSE round(l_discount * 100) END AS defect_rate_pct,
       CASE WHEN l_partkey % 89 = 0 THEN NULL WHEN l_partkey % 83 = 0 THEN CAST(120 AS DOUBLE) ELSE 100 - round(l_tax * 100) END AS inventory_accuracy_pct,
       CASE WHEN l_suppkey % 37 = 0 THEN NULL ELSE 12 + l_quantity / 2 END AS sla_hours,
       CASE WHEN l_partkey % 101 = 0 THEN 0 WHEN l_partkey % 103 = 0 THEN NULL ELSE CAST(l_quantity AS INT) * 9 END AS units_processed,
       CAST(300 + l_partkey % 300 AS DOUBLE) / 100 AS cost_per_unit
FROM lineitem
JOIN supplier ON l_suppkey = s_suppkey
JOIN nation ON s_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey""",
    ),
    "wh_flags": (
        ("wh_raw",),
        """
SELECT w.*, order_id IS NULL AS f1, order_date IS NULL AS f2, region IS NULL AS f3,
       coalesce(throughput_uph, -1) <= 0 AS f4, coalesce(units_processed, -1) <= 0 AS f5,
       coalesce(defect_rate_pct < 0 OR defect_rate_pct > 100, FALSE) AS f6,
       coalesce(inventory_accuracy_pct < 0 OR inventory_accuracy_pct > 100, FALSE) AS f7,
       coalesce(dock_delay_hrs < 0 OR dock_delay_hrs > 48, FALSE) AS f8
FROM wh_raw w""",
    ),
    "wh_chk": (
        ("wh_flags",),
        """
SELECT q.*, (f1 OR f2 OR f3 OR f4 OR f5 OR f6 OR f7 OR f8) AS rejected,
       concat_ws(' ', CASE WHEN f1 THEN 'null:order_id' END, CASE WHEN f2 THEN 'null:order_date' END, CASE WHEN f3 THEN 'null:region' END,
         CASE WHEN f4 THEN 'non_positive:throughput_uph' END, CASE WHEN f5 THEN 'non_positive:units_processed' END,
         CASE WHEN f6 THEN 'out_of_range:defect_rate_pct' END, CASE WHEN f7 THEN 'out_of_range:inventory_accuracy_pct' END,
         CASE WHEN f8 THEN 'out_of_range:dock_delay_hrs' END) AS rejection_reason
FROM wh_flags q""",
    ),
    "wh_ok": (
        ("wh_chk",),
        """
SELECT order_id, order_date, region, shift, throughput_uph, dock_delay_hrs, defect_rate_pct, inventory_accuracy_pct,
       sla_hours, units_processed, cost_per_unit
FROM wh_chk WHERE NOT rejected""",
    ),
    "wh_rich": (
        ("wh_ok",),
        """
SELECT order_id, order_date, region, shift, throughput_uph, dock_delay_hrs, defect_rate_pct, inventory_accuracy_pct,
       sla_hours, units_processed, cost_per_unit,
       CAST(year(order_date) AS INT) AS year,
       strftime(order_date, '%Y-%m') AS month,
       concat('Q', CAST(quarter(order_date) AS VARCHAR)) AS quarter,
       coalesce(sla_hours <= 24, FALSE) AS sla_met,
       CAST(CAST(CAST(cost_per_unit AS DECIMAL(8,2)) * units_processed AS DECIMAL(12,2)) AS DOUBLE) AS total_cost,
       CASE WHEN dock_delay_hrs > 0 AND dock_delay_hrs <= 1 THEN '<1hr' WHEN dock_delay_hrs > 1 AND dock_delay_hrs <= 2 THEN '1-2hrs'
            WHEN dock_delay_hrs > 2 AND dock_delay_hrs <= 4 THEN '2-4hrs' WHEN dock_delay_hrs > 4 AND dock_delay_hrs <= 100 THEN '>4hrs' END AS dock_category,
       coalesce(defect_rate_pct > 3.5, FALSE) AS high_defect,
       coalesce(throughput_uph < 120, FALSE) AS below_benchmark,
       'warehouse_csv' AS record_source
FROM wh_ok""",
    ),
    # Two decimals, halves away from zero; every value here is zero or positive.
    "stg": (
        ("wh_rich",),
        """
SELECT order_id, order_date, region, shift, throughput_uph,
       floor(dock_delay_hrs * 100 + 0.5) / 100 AS dock_delay_hrs,
       defect_rate_pct, inventory_accuracy_pct, sla_hours, sla_met, units_processed, cost_per_unit,
       CASE WHEN units_processed % 99 = 0 THEN 'api' WHEN units_processed % 207 = 0 THEN 'upload' ELSE 'warehouse_csv' END AS record_source,
       total_cost
FROM wh_rich""",
    ),
    "fin_raw": (
        (),
        """
SELECT CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE concat('FIN-', CAST(o_orderkey AS VARCHAR)) END AS record_id,
       concat('2024-0', CAST(1 + o_orderkey % 6 AS VARCHAR)) AS month,
       r_name AS business_unit,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'Labor' WHEN '2-HIGH' THEN 'Freight' WHEN '3-MEDIUM' THEN 'Facilities' WHEN '4-NOT SPECIFIED' THEN 'SG&A' ELSE 'Technology' END AS cost_center,
       CASE WHEN o_orderkey % 59 = 0 THEN -o_totalprice ELSE o_totalprice END AS amount,
       CASE WHEN o_orderkey % 7 < 4 THEN 'actual' ELSE 'budget' END AS record_type
FROM orders
JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey""",
    ),
    "fin_chk": (
        ("fin_raw",),
        """
SELECT f.*, (record_id IS NULL OR month IS NULL OR business_unit IS NULL OR coalesce(amount, -1) <= 0) AS rejected,
       concat_ws(' ', CASE WHEN record_id IS NULL THEN 'null:record_id' END, CASE WHEN month IS NULL THEN 'null:month' END,
         CASE WHEN business_unit IS NULL THEN 'null:business_unit' END,
         CASE WHEN coalesce(amount, -1) <= 0 THEN 'non_positive:amount' END) AS rejection_reason
FROM fin_raw f""",
    ),
    "fin_ok": (
        ("fin_chk",),
        """
SELECT record_id, month, business_unit, cost_center, amount, record_type FROM fin_chk WHERE NOT rejected""",
    ),
    "audit": (
        (),
        """
SELECT event_id AS log_id,
       CAST(DATE '2024-04-01' + CAST(event_id % 91 AS INT) AS DATE) AS run_date,
       ts AS run_timestamp, event_type AS pipeline_step,
       CASE user_id % 3 WHEN 0 THEN 'warehouse_csv' WHEN 1 THEN 'finance_json' ELSE 'api' END AS source_system,
       CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS status,
       CASE WHEN user_id % 7 = 0 THEN NULL ELSE 1800 + event_id % 400 END AS records_in,
       1800 + event_id % 400 - event_id % 83 AS records_out,
       CASE WHEN user_id % 7 = 0 THEN NULL ELSE event_id % 83 END AS records_rejected,
       value AS duration_sec
FROM events""",
    ),
    "dim_region": (
        (),
        """
SELECT r_regionkey + 1 AS region_key, r_name AS region_name FROM region WHERE r_name <> 'MIDDLE EAST'""",
    ),
    "dim_shift": (
        (),
        """
SELECT 1 AS shift_key, 'Day' AS shift_name UNION ALL SELECT 2, 'Night'""",
    ),
    "dim_source": (
        (),
        """
SELECT 1 AS source_key, 'warehouse_csv' AS source_name UNION ALL SELECT 2, 'finance_json' UNION ALL SELECT 3, 'api'""",
    ),
    "dim_days": (
        (),
        """
SELECT CAST(strftime(d, '%Y%m%d') AS INT) AS date_key, CAST(d AS DATE) AS full_date
FROM (SELECT unnest(generate_series(DATE '2024-01-01', DATE '2024-06-30', INTERVAL 1 DAY)) AS d)""",
    ),
    "resolved": (
        ("stg", "dim_days", "dim_region", "dim_shift", "dim_source"),
        """
SELECT date_key, region_key, shift_key, source_key, order_id, throughput_uph, dock_delay_hrs, defect_rate_pct, inventory_accuracy_pct,
       sla_hours, sla_met, units_processed, cost_per_unit, record_source, total_cost, DATE '2024-07-01' AS pipeline_run_date
FROM stg
JOIN dim_days ON full_date = order_date
JOIN dim_region ON region_name = region
JOIN dim_shift ON shift_name = shift
JOIN dim_source ON source_name = record_source""",
    ),
    "every": (
        ("stg",),
        """
SELECT CAST(year(order_date) * 10000 + month(order_date) * 100 + day(order_date) AS INT) AS date_key,
       r_regionkey + 1 AS region_key, CASE shift WHEN 'Day' THEN 1 ELSE 2 END AS shift_key,
       CASE record_source WHEN 'warehouse_csv' THEN 1 WHEN 'api' THEN 3 ELSE 4 END AS source_key, order_id,
       throughput_uph, dock_delay_hrs, defect_rate_pct, inventory_accuracy_pct, sla_hours, sla_met, units_processed,
       cost_per_unit, record_source, total_cost, DATE '2024-07-01' AS pipeline_run_date
FROM stg JOIN region ON r_name = region""",
    ),
    # One row of each key that the target holds, by a total order, and every copy of the others.
    "src_ops": (
        ("every",),
        """
SELECT * EXCLUDE (rn, order_id)
FROM (SELECT e.*, row_number() OVER (PARTITION BY date_key, region_key, shift_key, pipeline_run_date
        ORDER BY source_key, throughput_uph NULLS LAST, dock_delay_hrs NULLS LAST, defect_rate_pct NULLS LAST,
          inventory_accuracy_pct NULLS LAST, sla_hours NULLS LAST, sla_met, units_processed, cost_per_unit,
          record_source, total_cost) AS rn
      FROM every e)
WHERE date_key % 3 <> 0 OR rn = 1""",
    ),
    "tgt_ops": (
        ("every",),
        """
SELECT date_key, region_key, shift_key, 4 AS source_key, 1.0 AS throughput_uph, 0.01 AS dock_delay_hrs, 77.5 AS defect_rate_pct,
       1.5 AS inventory_accuracy_pct, 99.5 AS sla_hours, CAST(NULL AS BOOLEAN) AS sla_met, 1 AS units_processed, 0.01 AS cost_per_unit,
       'legacy' AS record_source, 0.01 AS total_cost, run AS pipeline_run_date
FROM (SELECT DISTINCT date_key, region_key, shift_key FROM every)
JOIN (SELECT DATE '2024-07-01' AS run, 3 AS share UNION ALL SELECT DATE '2024-06-30', 5) ON date_key % share = 0""",
    ),
    # An update takes the measures of the load; keys, source and lineage stay the target's.
    "merged": (
        ("src_ops", "tgt_ops"),
        """
SELECT s.*, 'insert' AS action FROM src_ops s WHERE date_key % 3 <> 0
UNION ALL
SELECT s.* REPLACE (t.source_key AS source_key, t.record_source AS record_source), 'update' AS action
FROM src_ops s JOIN tgt_ops t USING (date_key, region_key, shift_key, pipeline_run_date)
UNION ALL
SELECT t.* REPLACE (CAST(throughput_uph AS DOUBLE) AS throughput_uph, CAST(dock_delay_hrs AS DOUBLE) AS dock_delay_hrs,
         CAST(defect_rate_pct AS DOUBLE) AS defect_rate_pct, CAST(inventory_accuracy_pct AS DOUBLE) AS inventory_accuracy_pct,
         CAST(sla_hours AS DOUBLE) AS sla_hours, CAST(cost_per_unit AS DOUBLE) AS cost_per_unit, CAST(total_cost AS DOUBLE) AS total_cost),
       'keep' AS action
FROM tgt_ops t WHERE pipeline_run_date = DATE '2024-06-30'""",
    ),
    "days": (
        (),
        """
SELECT CAST(unnest(generate_series(min(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE)), INTERVAL 1 DAY)) AS DATE) AS full_date
FROM orders""",
    ),
    "calendar": (
        ("days",),
        """
SELECT CAST(strftime(full_date, '%Y%m%d') AS INT) AS date_key, full_date, CAST(year(full_date) AS INT) AS year,
       CAST(quarter(full_date) AS INT) AS quarter, CAST(month(full_date) AS INT) AS month_num, monthname(full_date) AS month_name,
       CAST(((dayofyear(full_date) - 1 + dayofweek(date_trunc('year', full_date))) // 7) + 1 AS INT) AS week_num,
       dayname(full_date) AS day_of_week, dayofweek(full_date) NOT IN (0, 6) AS is_weekday
FROM days""",
    ),
    "trend": (
        ("audit",),
        """
SELECT run_date, CAST(sum(records_in) AS BIGINT) AS records_in,
       CAST(sum(records_rejected) AS DOUBLE) / CAST(sum(records_in) AS DOUBLE) * 100 AS rejection_rate,
       sum(duration_sec) / 60 AS pipeline_min, CAST(sum(records_out) AS BIGINT) AS records_out
FROM audit GROUP BY run_date""",
    ),
    "ops_facts": (
        ("wh_rich", "fin_ok"),
        """
SELECT record_source, CAST(order_date + 1 AS DATE) AS pipeline_run_date FROM wh_rich
UNION ALL
SELECT 'finance_json', CAST(last_day(CAST(month || '-01' AS DATE)) + 1 AS DATE) FROM fin_ok""",
    ),
    "wh_text": (
        (),
        """
SELECT CASE WHEN l_orderkey % 100 = 0 THEN NULL ELSE concat('ORD-', CAST(l_orderkey AS VARCHAR), '-', CAST(l_linenumber AS VARCHAR)) END AS order_id,
       CAST(CAST(DATE '2024-01-01' + CAST(l_orderkey % 182 AS INT) AS DATE) AS VARCHAR) AS order_date,
       CASE WHEN l_orderkey % 101 = 0 THEN NULL ELSE r_name END AS region,
       CASE WHEN l_linenumber % 2 = 1 THEN 'Day' ELSE 'Night' END AS shift,
       CASE WHEN l_orderkey % 53 = 0 THEN '1d' WHEN l_orderkey % 59 = 0 THEN NULL WHEN l_orderkey % 61 = 0 THEN 'abc'
            WHEN l_orderkey % 67 = 0 THEN ' 1.2e2 ' ELSE CAST(80 + l_partkey % 71 AS VARCHAR) END AS throughput_uph,
       CASE WHEN l_partkey % 97 = 0 THEN '60' WHEN l_partkey % 91 = 0 THEN 'late' ELSE CAST((l_quantity - 1) / 8 AS VARCHAR) END AS dock_delay_hrs,
       CASE WHEN l_orderkey % 31 = 0 THEN 'inf' WHEN l_orderkey % 37 = 0 THEN 'abc' WHEN l_orderkey % 41 = 0 THEN '1e400'
            WHEN l_orderkey % 43 = 0 THEN '-0.5' ELSE CAST(CAST(round(l_discount * 100) AS INT) AS VARCHAR) END AS defect_rate_pct,
       CASE WHEN l_partkey % 89 = 0 THEN NULL WHEN l_partkey % 83 = 0 THEN '120'
            ELSE CAST(CAST(100 - round(l_tax * 100) AS INT) AS VARCHAR) END AS inventory_accuracy_pct,
       CASE WHEN l_suppkey % 37 = 0 THEN NULL WHEN l_suppkey % 43 = 0 THEN 'soon' ELSE CAST(12 + l_quantity / 2 AS VARCHAR) END AS sla_hours,
       CASE WHEN l_partkey % 101 = 0 THEN '0' WHEN l_partkey % 103 = 0 THEN NULL
            WHEN l_partkey % 107 = 0 THEN concat(CAST(CAST(l_quantity AS INT) * 9 AS VARCHAR), '.7')
            ELSE CAST(CAST(l_quantity AS INT) * 9 AS VARCHAR) END AS units_processed,
       CAST(CAST(300 + l_partkey % 300 AS DOUBLE) / 100 AS VARCHAR) AS cost_per_unit
FROM lineitem
JOIN supplier ON l_suppkey = s_suppkey
JOIN nation ON s_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey""",
    ),
    "wh_text_chk": (
        ("wh_text",),
        """
SELECT *, f1 OR f3 OR f4 OR f5 OR f6 OR f7 OR f8 AS rejected,
       concat_ws(' ', CASE WHEN f1 THEN 'null:order_id' END, CASE WHEN f3 THEN 'null:region' END, CASE WHEN f4 THEN 'non_positive:throughput_uph' END,
         CASE WHEN f5 THEN 'non_positive:units_processed' END, CASE WHEN f6 THEN 'out_of_range:defect_rate_pct' END,
         CASE WHEN f7 THEN 'out_of_range:inventory_accuracy_pct' END, CASE WHEN f8 THEN 'out_of_range:dock_delay_hrs' END) AS rejection_reason
FROM (SELECT *, order_id IS NULL AS f1, region IS NULL AS f3,
             coalesce(throughput_num, -1) <= 0 AS f4, coalesce(units_num, -1) <= 0 AS f5,
             coalesce(defect_num < 0 OR defect_num > 100, FALSE) AS f6,
             coalesce(inventory_num < 0 OR inventory_num > 100, FALSE) AS f7,
             coalesce(dock_num < 0 OR dock_num > 48, FALSE) AS f8
      FROM (SELECT *, TRY_CAST(trim(throughput_uph) AS DOUBLE) AS throughput_num, TRY_CAST(units_processed AS DOUBLE) AS units_num,
                   CASE WHEN defect_rate_pct <> '1e400' THEN TRY_CAST(defect_rate_pct AS DOUBLE) END AS defect_num,
                   TRY_CAST(inventory_accuracy_pct AS DOUBLE) AS inventory_num, TRY_CAST(dock_delay_hrs AS DOUBLE) AS dock_num,
                   TRY_CAST(sla_hours AS DOUBLE) AS sla_num, CAST(cost_per_unit AS DOUBLE) AS cost_num
            FROM wh_text))""",
    ),
}


def _renamed(view: str, body: str = "", **names: str) -> str:
    """A view's body over other views."""
    body = body or VIEWS[view][1]
    for old, new in names.items():
        body = body.replace(f"FROM {old}", f"FROM {new}")
    return body


# The feeds with the numbers of the order lines that their rows come from.
VIEWS["wh_keyed"] = ((), VIEWS["wh_raw"][1].replace("SELECT ", "SELECT l_orderkey, l_partkey, ", 1))
VIEWS["wh_keyed_flags"] = (("wh_keyed",), _renamed("wh_flags", wh_raw="wh_keyed"))
VIEWS["txt_keyed"] = ((), VIEWS["wh_text"][1].replace("SELECT ", "SELECT l_orderkey, ", 1))
VIEWS["txt_keyed_chk"] = (("txt_keyed",), _renamed("wh_text_chk", wh_text="txt_keyed"))
VIEWS["txt_uneven"] = (
    ("txt_keyed_chk",),
    """
SELECT *, l_orderkey % 71 = 0 AS short, l_orderkey % 71 = 0 OR l_orderkey % 73 = 0 AS uneven,
       concat_ws(',', coalesce(order_id, 'None'), order_date, coalesce(region, ''), shift, coalesce(throughput_uph, 'n/a'), dock_delay_hrs,
         defect_rate_pct, coalesce(inventory_accuracy_pct, 'NA'), coalesce(sla_hours, 'n/a'), coalesce(units_processed, '<NA>')) AS line
FROM txt_keyed_chk""",
)
# API records: those of whole pages that are not empty, and the pages that were cut off.
VIEWS["api_rows"] = (
    ("wh_keyed_flags",),
    """
SELECT l_partkey % 113 = 0 AS broken, * EXCLUDE (l_partkey) FROM wh_keyed_flags WHERE l_orderkey % 211 <> 0 AND l_orderkey % 223 <> 0
UNION ALL
SELECT DISTINCT ON (l_orderkey) TRUE, * EXCLUDE (l_partkey) FROM wh_keyed_flags WHERE l_orderkey % 211 = 0""",
)
VIEWS["api_chk"] = (
    ("api_rows",),
    """
SELECT l_orderkey, CASE WHEN NOT broken THEN order_id END AS order_id, CASE WHEN NOT broken THEN CAST(order_date AS VARCHAR) END AS order_date,
       CASE WHEN NOT broken THEN region END AS region, CASE WHEN NOT broken THEN shift END AS shift,
       CASE WHEN NOT broken THEN CAST(throughput_uph AS VARCHAR) END AS throughput_uph,
       CASE WHEN NOT broken THEN CAST(dock_delay_hrs AS VARCHAR) END AS dock_delay_hrs,
       CASE WHEN NOT broken THEN CAST(defect_rate_pct AS VARCHAR) END AS defect_rate_pct,
       CASE WHEN NOT broken THEN CAST(inventory_accuracy_pct AS VARCHAR) END AS inventory_accuracy_pct,
       CASE WHEN NOT broken THEN CAST(sla_hours AS VARCHAR) END AS sla_hours,
       CASE WHEN NOT broken THEN CAST(units_processed AS VARCHAR) END AS units_processed,
       CASE WHEN NOT broken THEN CAST(cost_per_unit AS VARCHAR) END AS cost_per_unit,
       (broken OR f1 OR f2 OR f3 OR f4 OR f5 OR f6 OR f7 OR f8) AS rejected,
       CASE WHEN broken THEN 'unreadable_record null:order_id null:order_date null:region non_positive:throughput_uph non_positive:units_processed'
       ELSE concat_ws(' ', CASE WHEN f1 THEN 'null:order_id' END, CASE WHEN f2 THEN 'null:order_date' END, CASE WHEN f3 THEN 'null:region' END,
         CASE WHEN f4 THEN 'non_positive:throughput_uph' END, CASE WHEN f5 THEN 'non_positive:units_processed' END,
         CASE WHEN f6 THEN 'out_of_range:defect_rate_pct' END, CASE WHEN f7 THEN 'out_of_range:inventory_accuracy_pct' END,
         CASE WHEN f8 THEN 'out_of_range:dock_delay_hrs' END) END AS rejection_reason
FROM api_rows""",
)
# A day's order lines: odd orders by file, even ones through the API.
VIEWS["day_raw"] = (
    ("wh_keyed",),
    """
SELECT * EXCLUDE (l_orderkey, l_partkey) FROM wh_keyed
WHERE l_orderkey % 2 = 1 OR (l_orderkey % 211 <> 0 AND l_orderkey % 223 <> 0 AND l_partkey % 113 <> 0)""",
)
for _view, _source in (("flags", "raw"), ("chk", "flags"), ("ok", "chk"), ("rich", "ok")):
    VIEWS[f"day_{_view}"] = ((f"day_{_source}",), _renamed(f"wh_{_view}", **{f"wh_{_source}": f"day_{_source}"}))
VIEWS["day_stg"] = (("day_rich",), _renamed("stg", wh_rich="day_rich"))

RAW = "order_id, order_date, region, shift, throughput_uph, dock_delay_hrs, defect_rate_pct, inventory_accuracy_pct, sla_hours, units_processed, cost_per_unit"
FIN = "record_id, month, business_unit, cost_center, amount, record_type"
FACT = "date_key, region_key, shift_key, source_key, throughput_uph, dock_delay_hrs, defect_rate_pct, inventory_accuracy_pct, sla_hours, sla_met, units_processed, cost_per_unit, total_cost, pipeline_run_date, record_source"
RATE = "coalesce(CAST(sum(records_rejected) AS DOUBLE) / CAST(sum(records_in) AS DOUBLE) * 100, 0)"
SLA = "CAST(count(*) FILTER (sla_met) AS DOUBLE) / count(*) * 100"
COST = "CAST(sum(CAST(cost_per_unit AS DECIMAL(8,2)) * units_processed) AS DOUBLE)"
ON_TIME = "CAST(count(*) FILTER (hour(run_timestamp) < 6) AS DOUBLE) / count(*) * 100"
SUMMARY = """count(*) AS steps, count(*) FILTER (status = 'FAILED') AS failures, CAST(sum(records_in) AS BIGINT) AS records_in,
       CAST(sum(records_out) AS BIGINT) AS records_out, CAST(sum(records_rejected) AS BIGINT) AS records_rejected,
       round(sum(duration_sec), 4) AS duration_sec, round(CAST(sum(records_rejected) AS DOUBLE) / greatest(CAST(sum(records_in) AS DOUBLE), 1) * 100, 4) AS rejected_pct"""
REGIONAL = f"round(avg(throughput_uph), 6) AS avg_throughput_uph, round({SLA}, 6) AS sla_pct, {COST} AS total_cost"


def _rejected_by(flags: list[tuple[str, str]]) -> str:
    """Rows that fail one of the flags, with the reasons of those flags."""
    reasons = ", ".join(f"CASE WHEN {flag} THEN '{reason}' END" for flag, reason in flags)
    failed = " OR ".join(flag for flag, _ in flags)
    return f"SELECT {RAW}, concat_ws(' ', {reasons}) AS rejection_reason FROM wh_flags WHERE {failed}"


def _stats(source: str, view: str) -> str:
    return f"""SELECT '{source}' AS source, count(*) AS records_in, count(*) FILTER (NOT rejected) AS records_out,
  count(*) FILTER (rejected) AS records_rejected, round(CAST(count(*) FILTER (rejected) AS DOUBLE) / count(*) * 100, 6) AS rejection_rate FROM {view}"""


# Facts whose dimension lacks the key; the calendar there ends 30 days before the last order.
_HELD = {
    "date_key": "SELECT date_key FROM dim_days WHERE full_date <= DATE '2024-06-30' - 30",
    "region_key": "SELECT region_key FROM dim_region",
    "shift_key": "SELECT shift_key FROM dim_shift",
    "source_key": "SELECT source_key FROM dim_source",
}
ORPHANS = "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, CAST({c} AS BIGINT) AS value, count(*) AS records"
    f" FROM every WHERE {c} NOT IN ({held}) GROUP BY {c}"
    for c, held in _HELD.items()
)
_LIMITS = {"order_id": 20, "region": 60, "shift": 20, "record_source": 40}
_COLUMNS = RAW.split(", ")
_STEP = """SELECT '{step}' AS step, 'SUCCESS' AS status, {came} AS records_in, {kept} AS records_out, {lost} AS records_rejected,
  round(CAST({lost} AS DOUBLE) / {came} * 100, 6) AS rejection_rate FROM {view}"""
_KEPT = "count(*) FILTER (NOT rejected)"
_ZERO = "CAST(0 AS BIGINT)"


def _ingest(step: str, view: str) -> str:
    return _STEP.format(
        step=step, view=view, came="count(*)", kept=_KEPT, lost="count(*) FILTER (rejected)"
    )


def _pass_on(step: str, view: str) -> str:
    return _STEP.format(step=step, view=view, came=_KEPT, kept=_KEPT, lost=_ZERO)


# Query -> (views it reads, final select).
FINALS: dict[str, tuple[tuple[str, ...], str]] = {
    "qc_non_null": (
        ("wh_flags",),
        _rejected_by([("f1", "null:order_id"), ("f2", "null:order_date"), ("f3", "null:region")]),
    ),
    "qc_positive": (
        ("wh_flags",),
        _rejected_by(
            [("f4", "non_positive:throughput_uph"), ("f5", "non_positive:units_processed")]
        ),
    ),
    "qc_range": (
        ("wh_flags",),
        _rejected_by(
            [
                ("f6", "out_of_range:defect_rate_pct"),
                ("f7", "out_of_range:inventory_accuracy_pct"),
                ("f8", "out_of_range:dock_delay_hrs"),
            ]
        ),
    ),
    "qc_reasons": (
        ("wh_chk",),
        "SELECT rejection_reason, count(*) AS records FROM wh_chk WHERE rejected GROUP BY rejection_reason",
    ),
    "qc_passed": (("wh_ok",), f"SELECT {RAW} FROM wh_ok"),
    "qc_rejected": (("wh_chk",), f"SELECT {RAW}, rejection_reason FROM wh_chk WHERE rejected"),
    "qc_stats": (
        ("wh_chk", "fin_chk"),
        _stats("warehouse", "wh_chk") + "\nUNION ALL\n" + _stats("finance", "fin_chk"),
    ),
    "qc_top_reasons": (
        ("wh_chk",),
        "SELECT rejection_reason, count(*) AS records FROM wh_chk WHERE rejected GROUP BY rejection_reason ORDER BY records DESC, rejection_reason LIMIT 5",
    ),
    "qc_finance_passed": (("fin_ok",), f"SELECT {FIN} FROM fin_ok"),
    "qc_finance_rejected": (
        ("fin_chk",),
        f"SELECT {FIN}, rejection_reason FROM fin_chk WHERE rejected",
    ),
    "qc_text_feed": (("wh_text_chk",), f"SELECT {RAW}, rejected, rejection_reason FROM wh_text_chk"),
    "text_chain": (
        ("wh_text_chk",),
        """SELECT order_id, CAST(order_date AS DATE) AS order_date, region, shift, throughput_num AS throughput_uph, dock_num AS dock_delay_hrs,
       defect_num AS defect_rate_pct, inventory_num AS inventory_accuracy_pct, sla_num AS sla_hours,
       CAST(floor(units_num) AS INT) AS units_processed, cost_num AS cost_per_unit,
       CAST(year(CAST(order_date AS DATE)) AS INT) AS year, strftime(CAST(order_date AS DATE), '%Y-%m') AS month,
       concat('Q', CAST(quarter(CAST(order_date AS DATE)) AS VARCHAR)) AS quarter, coalesce(sla_num <= 24, FALSE) AS sla_met,
       CAST(CAST(CAST(cost_num AS DECIMAL(8,2)) * CAST(floor(units_num) AS INT) AS DECIMAL(12,2)) AS DOUBLE) AS total_cost,
       CASE WHEN dock_num > 0 AND dock_num <= 1 THEN '<1hr' WHEN dock_num > 1 AND dock_num <= 2 THEN '1-2hrs'
            WHEN dock_num > 2 AND dock_num <= 4 THEN '2-4hrs' WHEN dock_num > 4 AND dock_num <= 100 THEN '>4hrs' END AS dock_category,
       coalesce(defect_num > 3.5, FALSE) AS high_defect, coalesce(throughput_num < 120, FALSE) AS below_benchmark,
       'warehouse_csv' AS record_source
FROM wh_text_chk WHERE NOT rejected""",
    ),
    "text_lossy": (
        ("wh_text_chk",),
        "\nUNION ALL\n".join(
            f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NOT NULL AND ({n} IS NULL OR {more})) AS records"
            " FROM wh_text_chk WHERE NOT rejected"
            for c, n, more in (
                ("throughput_uph", "throughput_num", "FALSE"),
                ("dock_delay_hrs", "dock_num", "FALSE"),
                ("defect_rate_pct", "defect_num", "FALSE"),
                ("inventory_accuracy_pct", "inventory_num", "FALSE"),
                ("sla_hours", "sla_num", "FALSE"),
                ("units_processed", "units_num", "units_num <> floor(units_num)"),
                ("cost_per_unit", "cost_num", "FALSE"),
            )
        ),
    ),
    "audit_varchar": (
        ("wh_rich",),
        "\nUNION ALL\n".join(
            f"SELECT '{c}' AS column_name, count(*) FILTER (length({c}) > {n}) AS too_long_records FROM wh_rich"
            for c, n in _LIMITS.items()
        ),
    ),
    "enrich_warehouse": (("wh_rich",), "SELECT * FROM wh_rich"),
    "enrich_finance": (
        ("fin_ok",),
        f"""SELECT {FIN}, CAST(month || '-01' AS DATE) AS month_dt, CAST(year(CAST(month || '-01' AS DATE)) AS INT) AS year,
       concat('Q', CAST(quarter(CAST(month || '-01' AS DATE)) AS VARCHAR)) AS quarter, 'finance_json' AS record_source FROM fin_ok""",
    ),
    "dock_category_counts": (
        ("wh_rich",),
        "SELECT dock_category, count(*) AS records FROM wh_rich GROUP BY dock_category",
    ),
    "stage_ops": (("stg",), "SELECT * FROM stg"),
    "dim_date": (("calendar",), "SELECT * FROM calendar"),
    "dim_date_count": (("days",), "SELECT count(*) AS dates_populated FROM days"),
    "dim_date_incremental": (
        ("calendar",),
        """SELECT c.* REPLACE (CASE WHEN full_date IN (SELECT CAST(o_orderdate AS DATE) FROM orders WHERE o_orderstatus = 'F')
  THEN NULL ELSE is_weekday END AS is_weekday) FROM calendar c""",
    ),
    "dim_region_seed": (
        ("wh_raw", "dim_region"),
        """SELECT region_key, region_name FROM dim_region UNION ALL
SELECT CAST((SELECT max(region_key) FROM dim_region) + row_number() OVER (ORDER BY region) AS INT), region
FROM (SELECT DISTINCT region FROM wh_raw WHERE region NOT IN (SELECT region_name FROM dim_region))""",
    ),
    "load_ops_source": (("resolved",), "SELECT * FROM resolved"),
    "unmatched_dims": (
        ("stg", "dim_days", "dim_region", "dim_shift", "dim_source"),
        """SELECT 'dim_date' AS dimension, CAST(order_date AS VARCHAR) AS name, count(*) AS records FROM stg
  WHERE order_date NOT IN (SELECT full_date FROM dim_days) GROUP BY order_date
UNION ALL SELECT 'dim_region', region, count(*) FROM stg WHERE region NOT IN (SELECT region_name FROM dim_region) GROUP BY region
UNION ALL SELECT 'dim_shift', shift, count(*) FROM stg WHERE shift NOT IN (SELECT shift_name FROM dim_shift) GROUP BY shift
UNION ALL SELECT 'dim_source', record_source, count(*) FROM stg WHERE record_source NOT IN (SELECT source_name FROM dim_source) GROUP BY record_source""",
    ),
    "load_ops_all": (("every",), "SELECT * FROM every"),
    "upsert_ops": (("merged",), f"SELECT {FACT}, action FROM merged"),
    "load_fact_keys": (
        ("merged",),
        """SELECT pipeline_run_date, action, count(*) AS records, count(*) AS distinct_keys,
       count(*) FILTER (action = 'insert') AS new_keys FROM merged GROUP BY ALL""",
    ),
    "upsert_actions": (
        ("merged",),
        "SELECT action, count(*) AS records, CAST(sum(CAST(total_cost AS DECIMAL(12,2))) AS DOUBLE) AS total_cost FROM merged GROUP BY action",
    ),
    "load_ops_count": (
        ("merged",),
        "SELECT count(*) FILTER (action <> 'keep') AS records_loaded FROM merged",
    ),
    "merge_conflicts": (
        ("every", "tgt_ops"),
        """SELECT date_key, region_key, shift_key, pipeline_run_date, count(*) AS copies
FROM every JOIN (SELECT DISTINCT date_key, region_key, shift_key, pipeline_run_date FROM tgt_ops)
  USING (date_key, region_key, shift_key, pipeline_run_date)
GROUP BY ALL HAVING count(*) > 1""",
    ),
    "finance_unmatched": (
        ("fin_ok", "dim_region"),
        """SELECT month, business_unit, cost_center,
       CAST(sum(CAST(amount AS DECIMAL(18,2))) FILTER (record_type = 'budget') AS DOUBLE) AS budget_amount,
       CAST(sum(CAST(amount AS DECIMAL(18,2))) FILTER (record_type = 'actual') AS DOUBLE) AS actual_amount,
       'business_unit' AS unmatched
FROM fin_ok WHERE business_unit NOT IN (SELECT region_name FROM dim_region) GROUP BY ALL""",
    ),
    "finance_fact": (
        ("fin_ok", "dim_region"),
        """SELECT CAST(replace(month, '-', '') || '01' AS INT) AS date_key, region_key, cost_center_key, 2 AS source_key,
       CAST(budget AS DOUBLE) AS budget_amount, CAST(actual AS DOUBLE) AS actual_amount, CAST(actual - budget AS DOUBLE) AS variance_amount,
       'finance_json' AS record_source
FROM (SELECT month, business_unit, cost_center,
             sum(CAST(amount AS DECIMAL(18,2))) FILTER (record_type = 'budget') AS budget,
             sum(CAST(amount AS DECIMAL(18,2))) FILTER (record_type = 'actual') AS actual
      FROM fin_ok GROUP BY ALL) c
JOIN dim_region ON region_name = business_unit
JOIN (SELECT cost_center AS name, CAST(row_number() OVER (ORDER BY cost_center) AS INT) AS cost_center_key
      FROM (SELECT DISTINCT cost_center FROM fin_ok)) k ON k.name = c.cost_center""",
    ),
    "audit_pk": (
        ("wh_raw",),
        "SELECT order_id, count(*) AS copies FROM wh_raw GROUP BY order_id HAVING count(*) > 1",
    ),
    "audit_fk": (("every", "dim_days", "dim_region", "dim_shift", "dim_source"), ORPHANS),
    "audit_star": (
        ("every", "dim_days", "dim_region", "dim_shift", "dim_source"),
        f"""SELECT 'fact_operations' AS table_name, 'foreign_key' AS rule, column_name, CAST(sum(records) AS BIGINT) AS records
FROM ({ORPHANS}) GROUP BY column_name
UNION ALL
SELECT 'fact_operations', 'primary_key', 'fact_key', CAST(sum(n) AS BIGINT)
FROM (SELECT split_part(order_id, '-', 2) AS fact_key, count(*) AS n FROM every GROUP BY 1 HAVING count(*) > 1)
UNION ALL
SELECT 'dim_shift', 'not_null', 'shift_name', 1""",
    ),
    "audit_not_null": (
        ("wh_raw",),
        "\nUNION ALL\n".join(
            f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS null_records FROM wh_raw"
            for c in _COLUMNS
        ),
    ),
    "step_log": (
        ("wh_chk", "fin_chk"),
        "\nUNION ALL\n".join(
            [
                _ingest("Ingest: Warehouse CSV", "wh_chk"),
                _ingest("Ingest: Finance JSON", "fin_chk"),
                _pass_on("Quality: Warehouse", "wh_chk"),
                _pass_on("Quality: Finance", "fin_chk"),
                _pass_on(
                    "Load: Star Schema",
                    "(SELECT rejected FROM wh_chk UNION ALL SELECT rejected FROM fin_chk)",
                ),
            ]
        ),
    ),
    "run_summary": (("audit",), f"SELECT {SUMMARY} FROM audit"),
    "run_summary_by_step": (
        ("audit",),
        f"SELECT pipeline_step, {SUMMARY} FROM audit GROUP BY pipeline_step",
    ),
    "daily_trend": (
        ("trend",),
        "SELECT run_date, records_in, round(rejection_rate, 6) AS rejection_rate, round(pipeline_min, 6) AS pipeline_min, records_out FROM trend",
    ),
    "trend_summary": (
        ("trend",),
        """SELECT round(avg(rejection_rate), 6) AS avg_rejection_rate, round(avg(pipeline_min), 6) AS avg_pipeline_min,
       round(avg(CASE WHEN pipeline_min < 12 THEN 1.0 ELSE 0.0 END) * 100, 6) AS pct_under_target FROM trend""",
    ),
    "trend_alerts": (
        ("trend",),
        """SELECT run_date, records_in, round(rejection_rate, 6) AS rejection_rate, round(pipeline_min, 6) AS pipeline_min, records_out,
       rejection_rate > 2 AS rejection_alert, pipeline_min >= 12 AS duration_alert FROM trend""",
    ),
    "records_ingested": (
        ("audit",),
        "SELECT CAST(sum(records_out) AS BIGINT) AS records_ingested FROM audit WHERE run_date = DATE '2024-06-30'",
    ),
    "success_rate": (
        ("audit",),
        "SELECT round(CAST(count(*) FILTER (status = 'SUCCESS') AS DOUBLE) / count(*) * 100, 6) AS success_rate_pct FROM audit",
    ),
    "rejection_rate": (("audit",), f"SELECT round({RATE}, 6) AS rejection_rate_pct FROM audit"),
    "rejection_rate_by_source": (
        ("audit",),
        f"SELECT source_system, round({RATE}, 6) AS rejection_rate_pct FROM audit GROUP BY source_system",
    ),
    "avg_duration_min": (
        ("audit",),
        "SELECT round(avg(duration_sec) / 60, 6) AS avg_duration_min FROM audit",
    ),
    "avg_throughput": (
        ("stg",),
        "SELECT round(avg(throughput_uph), 6) AS avg_throughput_uph FROM stg",
    ),
    "sla_pct": (("stg",), f"SELECT round({SLA}, 6) AS sla_pct FROM stg"),
    "total_cost": (("stg",), f"SELECT {COST} AS total_cost FROM stg"),
    "completeness": (("audit",), f"SELECT round(100 - {RATE}, 6) AS completeness_pct FROM audit"),
    "on_time_pct": (("audit",), f"SELECT round({ON_TIME}, 6) AS on_time_pct FROM audit"),
    "rejection_rate_30d": (
        ("audit",),
        """SELECT d.run_date, round(CAST(sum(records_rejected) AS DOUBLE) / CAST(sum(records_in) AS DOUBLE) * 100, 6) AS rejection_rate_30d
FROM (SELECT DISTINCT run_date FROM audit) d
JOIN (SELECT run_date, sum(records_in) AS records_in, sum(records_rejected) AS records_rejected FROM audit GROUP BY run_date) a
  ON a.run_date BETWEEN d.run_date - 29 AND d.run_date
GROUP BY d.run_date""",
    ),
    "rejection_rate_30d_by_source": (
        ("audit",),
        """SELECT d.source_system, d.run_date,
       round(CAST(sum(records_rejected) AS DOUBLE) / CAST(sum(records_in) AS DOUBLE) * 100, 6) AS rejection_rate_30d
FROM (SELECT DISTINCT source_system, run_date FROM audit) d
JOIN (SELECT source_system, run_date, sum(records_in) AS records_in, sum(records_rejected) AS records_rejected FROM audit GROUP BY ALL) a
  ON a.source_system = d.source_system AND a.run_date BETWEEN d.run_date - 29 AND d.run_date
GROUP BY d.source_system, d.run_date""",
    ),
    "lineage": (
        ("ops_facts",),
        "SELECT record_source, pipeline_run_date, count(*) AS records FROM ops_facts GROUP BY ALL",
    ),
    "regional_performance": (
        ("stg",),
        f"SELECT region AS region_name, {REGIONAL} FROM stg GROUP BY region",
    ),
    "quality_scorecard": (
        ("audit",),
        f"""SELECT source_system, round({RATE}, 6) AS rejection_rate_pct, round(100 - {RATE}, 6) AS completeness_pct,
       round({ON_TIME}, 6) AS on_time_pct FROM audit GROUP BY source_system""",
    ),
    "region_filter": (
        ("stg",),
        f"""SELECT region, shift, {REGIONAL} FROM stg
WHERE region IN (SELECT r_name FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_name = 'NATION_3')
GROUP BY region, shift""",
    ),
}

FINALS |= {
    "csv_round_trip": (
        ("txt_uneven",),
        f"""SELECT {RAW.removesuffix(", cost_per_unit")}, CASE WHEN NOT short THEN cost_per_unit END AS cost_per_unit,
       CASE WHEN short THEN line WHEN uneven THEN concat(line, ',', cost_per_unit, ',extra') END AS unreadable_record,
       (uneven OR rejected) AS rejected,
       concat_ws(' ', CASE WHEN uneven THEN 'unreadable_record' END, nullif(rejection_reason, '')) AS rejection_reason
FROM txt_uneven""",
    ),
    "landing_days": (
        ("txt_keyed_chk",),
        """SELECT CAST(DATE '2024-07-01' + CAST(l_orderkey % 3 AS INT) AS DATE) AS landing_date, rejected, count(*) AS records
FROM txt_keyed_chk WHERE l_orderkey % 3 > 0 GROUP BY ALL""",
    ),
    "staged_by_source": (("stg",), "SELECT * FROM stg WHERE record_source = 'api'"),
    "run_log_file": (
        ("audit",),
        """SELECT run_date, run_timestamp, pipeline_step AS step, status, records_in, records_out, records_rejected, duration_sec,
  CAST(NULL AS VARCHAR) AS error FROM audit WHERE run_date = DATE '2024-06-30'""",
    ),
    "audit_appends": (
        ("audit",),
        """SELECT run_date, CAST(3 AS BIGINT) AS entries, CAST(3 AS BIGINT) AS distinct_ids, 3 * count(*) AS records_in,
  CAST(3 AS BIGINT) AS ids_of_the_day FROM audit GROUP BY run_date""",
    ),
    "api_feed": (("api_chk",), f"SELECT {RAW}, rejected, rejection_reason FROM api_chk"),
    "api_missing_pages": (
        ("wh_keyed",),
        """SELECT request_id, page FROM
  (SELECT DISTINCT concat('REQ-', CAST(l_orderkey // 8 AS VARCHAR)) AS request_id FROM wh_keyed WHERE l_orderkey % 211 <> 0),
  (SELECT CAST(unnest(range(1, 9)) AS INT) AS page)
EXCEPT
SELECT concat('REQ-', CAST(l_orderkey // 8 AS VARCHAR)), CAST(l_orderkey % 8 + 1 AS INT) FROM wh_keyed WHERE l_orderkey % 211 <> 0""",
    ),
    "load_stamps": (
        ("src_ops", "tgt_ops"),
        """SELECT pipeline_run_date, load_timestamp, count(*) AS records, CAST(sum(units_processed) AS BIGINT) AS units
FROM (SELECT pipeline_run_date, units_processed,
             CASE WHEN date_key % 2 = 0 THEN TIMESTAMP '2024-07-01 05:30:00' ELSE TIMESTAMP '2024-07-02 05:30:00' END AS load_timestamp
      FROM src_ops
      UNION ALL
      SELECT pipeline_run_date, units_processed, TIMESTAMP '2024-06-30 05:30:00' FROM tgt_ops WHERE pipeline_run_date = DATE '2024-06-30')
GROUP BY ALL""",
    ),
    "day_fact": (
        ("day_stg",),
        """SELECT order_date AS full_date, region AS region_name, shift AS shift_name,
       CASE WHEN CAST(split_part(order_id, '-', 2) AS BIGINT) % 2 = 1 THEN 'warehouse_csv' ELSE 'api' END AS source_name,
       throughput_uph, dock_delay_hrs, defect_rate_pct, inventory_accuracy_pct, sla_hours, sla_met, units_processed, cost_per_unit,
       total_cost, TIMESTAMP '2024-07-01 05:30:00' AS load_timestamp, DATE '2024-07-01' AS pipeline_run_date FROM day_stg""",
    ),
    "day_log": (
        ("wh_keyed_flags", "api_chk", "fin_chk", "day_ok"),
        """SELECT DATE '2024-07-01' AS run_date, TIMESTAMP '2024-07-01 05:30:00' AS run_timestamp, pipeline_step, source_system,
       'SUCCESS' AS status, records_in, records_out, records_rejected,
       round(CAST(records_rejected AS DOUBLE) / records_in * 100, 2) AS rejection_rate_pct, CAST(NULL AS VARCHAR) AS error_message
FROM (SELECT 'Quality Check: Warehouse' AS pipeline_step, 'warehouse_csv' AS source_system, count(*) AS records_in,
             count(*) FILTER (NOT bad) AS records_out, count(*) FILTER (bad) AS records_rejected
      FROM (SELECT f1 OR f2 OR f3 OR f4 OR f5 OR f6 OR f7 OR f8 AS bad FROM wh_keyed_flags WHERE l_orderkey % 2 = 1)
      UNION ALL
      SELECT 'Quality Check: Finance', 'finance_json', count(*), count(*) FILTER (NOT rejected), count(*) FILTER (rejected) FROM fin_chk
      UNION ALL
      SELECT 'Quality Check: API', 'api', count(*), count(*) FILTER (NOT rejected), count(*) FILTER (rejected)
      FROM api_chk WHERE l_orderkey % 2 = 0)
UNION ALL
SELECT DATE '2024-07-01', TIMESTAMP '2024-07-01 05:30:00', step, source, 'SUCCESS', 0, 0, 0, 0, NULL
FROM (SELECT 'Transform: Warehouse CSV' AS step, 'warehouse_csv' AS source UNION ALL SELECT 'Transform: Finance JSON', 'finance_json'
      UNION ALL SELECT 'Transform: API JSON', 'api')
UNION ALL
SELECT DATE '2024-07-01', TIMESTAMP '2024-07-01 05:30:00', 'usp_load_fact_operations', 'warehouse_csv', 'SUCCESS', NULL, count(*), NULL, NULL, NULL
FROM day_ok
UNION ALL
SELECT DATE '2024-07-01', TIMESTAMP '2024-07-01 05:30:00', 'Load: Finance', 'finance_json', 'SUCCESS', NULL,
       count(DISTINCT (month, business_unit, cost_center)), NULL, NULL, NULL
FROM fin_chk WHERE NOT rejected""",
    ),
}


def _needed(views: tuple[str, ...]) -> set[str]:
    found = set(views)
    for view in views:
        found |= _needed(VIEWS[view][0])
    return found


def oracle_sql() -> dict[str, str]:
    """Query name to SQL text."""
    out = {}
    for name, (views, final) in FINALS.items():
        needed = _needed(views)
        ctes = ",\n".join(f"{v} AS ({body})" for v, (_, body) in VIEWS.items() if v in needed)
        out[name] = f"WITH {ctes}\n{final}"
    return out
