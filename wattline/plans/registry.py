"""Registered queries: a Spark job, the SQL it must agree with, and the inventory items it covers."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from wattline.plans.inputs import plain

Job = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Registered:
    job: Job
    sql: str | None
    covers: tuple[str, ...]


REGISTRY: dict[str, Registered] = {}


def query(covers: str, sql: str | None = None):
    """Register the decorated job under its own name."""

    def add(job: Job) -> Job:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return plain(job(spark, folder))

        run.__name__ = job.__name__
        run.__doc__ = job.__doc__
        REGISTRY[job.__name__] = Registered(run, sql, tuple(covers.split()))
        return job

    return add


# Common table expressions of the SQL side, in dependency order.
CTES = {
    "readings": """
        SELECT ts AS time, 'MTR_' || event_type || '_' || lpad(CAST(user_id % 10 AS VARCHAR), 2, '0') AS meter_id,
               value AS kwh, event_type = 'error' AS is_anomaly, event_type AS source FROM events""",
    "copies": "SELECT * FROM readings UNION ALL SELECT * FROM readings WHERE source = 'error'",
    "hourly": """
        SELECT source, date_trunc('hour', time) AS time, round(sum(kwh), 8) AS kwh FROM readings GROUP BY 1, 2""",
    "series": """
        SELECT *, row_number() OVER (PARTITION BY source ORDER BY time) - 1 AS pos,
               count(*) OVER (PARTITION BY source) AS n FROM hourly""",
    "mhourly": """
        SELECT meter_id, source, date_trunc('hour', time) AS time, round(sum(kwh), 8) AS kwh
        FROM readings GROUP BY 1, 2, 3""",
    "mseries": """
        SELECT *, row_number() OVER (PARTITION BY meter_id ORDER BY time) - 1 AS pos,
               count(*) OVER (PARTITION BY meter_id) AS n FROM mhourly""",
    "predictions": """
        SELECT * FROM (SELECT time, meter_id, 'last_value' AS model,
            lag(kwh) OVER (PARTITION BY meter_id ORDER BY time) AS kwh_pred FROM mseries) WHERE kwh_pred IS NOT NULL""",
    "cad": """
        SELECT source, max(n) AS n,
               CAST(floor(coalesce(median(gap) FILTER (WHERE gap > 0), 60)) AS BIGINT) AS cadence
        FROM (SELECT source, n, floor((epoch(time) - epoch(lag(time) OVER (PARTITION BY source ORDER BY time))) / 60) AS gap
              FROM series) GROUP BY source""",
    "folds": """
        SELECT p.*, f.f AS fold, p.start + (f.f - 1) * greatest(1, (p.n - p.horizon - p.start) // 4) AS cutoff
        FROM (SELECT source, n, cadence, greatest(1, 1440 // cadence) AS horizon, greatest(1, 1440 // cadence) AS season,
                     greatest(1, 1440 // cadence) AS start FROM cad) p, (SELECT unnest([1, 2, 3, 4, 5]) AS f) f
        WHERE p.n - p.horizon > p.start
          AND p.start + (f.f - 1) * greatest(1, (p.n - p.horizon - p.start) // 4) <= p.n - p.horizon""",
    "forecasts": """
        SELECT t.source AS group_key, t.fold, t.step AS horizon_step, a.time, a.kwh AS actual, b.kwh AS forecast
        FROM (SELECT *, unnest(range(1, horizon + 1)) AS step FROM folds) t
        JOIN series a ON a.source = t.source AND a.pos = t.cutoff + t.step - 1
        LEFT JOIN series b ON b.source = t.source AND b.pos = t.cutoff + t.step - 1 - t.season""",
    "gstats": """
        SELECT source, max(n) AS n, greatest(stddev_pop(kwh), 0.01) AS std FROM series GROUP BY source""",
    "draws": """
        SELECT source, d, (n * 3 // 4) + place % (greatest(n * 3 // 4 + 1, n - 1) - n * 3 // 4) AS pos,
               kind % 2 = 0 AS is_drop, std
        FROM (SELECT g.*, k.d,
                CAST('0x' || substr(md5('42|' || source || '|' || k.d || '|place'), 1, 8) AS BIGINT) AS place,
                CAST('0x' || substr(md5('42|' || source || '|' || k.d || '|kind'), 1, 8) AS BIGINT) AS kind
              FROM gstats g, (SELECT unnest([0, 1, 2, 3, 4]) AS d) k WHERE g.n >= 8)""",
    # Five draws at most, applied one after the other.
    "points": """
        SELECT source, time, pos, n, round(k5, 8) AS kwh, hit, l5 AS label FROM (
          SELECT *, CASE WHEN d4 IS NULL THEN k4 WHEN d4 THEN greatest(0, k4 - 0.85 * k4) ELSE k4 + 10.0 * std END AS k5,
                 CASE WHEN d4 IS NULL THEN l4 ELSE CASE WHEN list_contains(l4, CASE WHEN d4 THEN 'point_drop' ELSE 'point_spike' END) THEN l4 ELSE list_append(l4, CASE WHEN d4 THEN 'point_drop' ELSE 'point_spike' END) END END AS l5 FROM (
          SELECT *, CASE WHEN d3 IS NULL THEN k3 WHEN d3 THEN greatest(0, k3 - 0.85 * k3) ELSE k3 + 10.0 * std END AS k4,
                 CASE WHEN d3 IS NULL THEN l3 ELSE CASE WHEN list_contains(l3, CASE WHEN d3 THEN 'point_drop' ELSE 'point_spike' END) THEN l3 ELSE list_append(l3, CASE WHEN d3 THEN 'point_drop' ELSE 'point_spike' END) END END AS l4 FROM (
          SELECT *, CASE WHEN d2 IS NULL THEN k2 WHEN d2 THEN greatest(0, k2 - 0.85 * k2) ELSE k2 + 10.0 * std END AS k3,
                 CASE WHEN d2 IS NULL THEN l2 ELSE CASE WHEN list_contains(l2, CASE WHEN d2 THEN 'point_drop' ELSE 'point_spike' END) THEN l2 ELSE list_append(l2, CASE WHEN d2 THEN 'point_drop' ELSE 'point_spike' END) END END AS l3 FROM (
          SELECT *, CASE WHEN d1 IS NULL THEN k1 WHEN d1 THEN greatest(0, k1 - 0.85 * k1) ELSE k1 + 10.0 * std END AS k2,
                 CASE WHEN d1 IS NULL THEN l1 ELSE CASE WHEN list_contains(l1, CASE WHEN d1 THEN 'point_drop' ELSE 'point_spike' END) THEN l1 ELSE list_append(l1, CASE WHEN d1 THEN 'point_drop' ELSE 'point_spike' END) END END AS l2 FROM (
          SELECT *, CASE WHEN d0 IS NULL THEN kwh WHEN d0 THEN greatest(0, kwh - 0.85 * kwh) ELSE kwh + 10.0 * std END AS k1,
                 CASE WHEN d0 IS NULL THEN CAST([] AS VARCHAR[]) ELSE [CASE WHEN d0 THEN 'point_drop' ELSE 'point_spike' END] END AS l1,
                 coalesce(d0, d1, d2, d3, d4) IS NOT NULL AS hit
          FROM (SELECT s.*, p.std, p.d0, p.d1, p.d2, p.d3, p.d4 FROM series s LEFT JOIN (
            SELECT source, pos, max(std) AS std, bool_or(is_drop) FILTER (WHERE d = 0) AS d0, bool_or(is_drop) FILTER (WHERE d = 1) AS d1,
                   bool_or(is_drop) FILTER (WHERE d = 2) AS d2, bool_or(is_drop) FILTER (WHERE d = 3) AS d3,
                   bool_or(is_drop) FILTER (WHERE d = 4) AS d4 FROM draws GROUP BY source, pos) p USING (source, pos)))))))""",
    "slots": """
        SELECT source, CAST(time AS DATE) AS day, hour(time) >= 14 AS late, (hour(time) - 2) % 12 AS slot, pos, kwh
        FROM points WHERE hour(time) BETWEEN 2 AND 7 OR hour(time) BETWEEN 14 AND 19""",
    "days": """
        SELECT source, day, row_number() OVER (PARTITION BY source ORDER BY day) - 1 AS rank,
               count(*) OVER (PARTITION BY source) AS days
        FROM (SELECT DISTINCT source, CAST(time AS DATE) AS day FROM points)""",
    "swapday": """
        SELECT c.source, max(c.day) AS day FROM (SELECT source, day FROM slots GROUP BY 1, 2 HAVING count(*) = 12) c
        JOIN days d ON d.source = c.source AND d.day = c.day AND d.rank >= d.days // 2 GROUP BY c.source""",
    "swaps": """
        SELECT a.source, a.pos, b.kwh AS new_kwh FROM slots a JOIN swapday USING (source, day)
        JOIN slots b ON a.source = b.source AND a.day = b.day AND a.slot = b.slot AND a.late <> b.late""",
    "swapped": """
        SELECT p.source, p.time, p.pos, p.n, coalesce(s.new_kwh, p.kwh) AS kwh, p.hit OR s.new_kwh IS NOT NULL AS hit,
               CASE WHEN s.new_kwh IS NULL THEN p.label ELSE list_append(p.label, 'contextual_day_night_swap') END AS label
        FROM points p LEFT JOIN swaps s USING (source, pos)""",
    "injected": """
        SELECT source, time, pos, n,
               CASE WHEN pos >= n - 6 AND n >= 12 THEN round(kwh + mean * 0.5 * ((pos - (n - 6) + 1) / 6), 8) ELSE kwh END AS kwh,
               hit OR (pos >= n - 6 AND n >= 12) AS is_anomaly,
               array_to_string(CASE WHEN pos >= n - 6 AND n >= 12 THEN list_append(label, 'trend_drift') ELSE label END, '+') AS anomaly_type
        FROM (SELECT *, avg(kwh) OVER (PARTITION BY source) AS mean FROM swapped)""",
    "bestfc": """
        SELECT group_key AS source, time, arg_min(forecast, horizon_step * 1000 + fold) AS forecast,
               min(horizon_step) AS horizon_step
        FROM forecasts GROUP BY 1, 2""",
    "covered": """
        SELECT i.source, i.time, i.kwh, i.is_anomaly AS truth, i.anomaly_type, i.kwh - f.forecast AS residual,
               row_number() OVER (PARTITION BY i.source ORDER BY i.time) - 1 AS pos
        FROM injected i JOIN bestfc f USING (source, time)""",
    "scored": """
        SELECT *, abs(residual - med) AS deviation, abs(residual - med) / CASE WHEN mad > 0 THEN mad ELSE 1e-9 END AS z FROM (
          SELECT *, CASE WHEN pos >= 24 THEN median(residual) OVER w END AS med, CASE WHEN pos >= 24 THEN mad(residual) OVER w END AS mad
          FROM covered WINDOW w AS (PARTITION BY source ORDER BY time ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING))""",
    "flagged": """
        SELECT *, coalesce(z > 4.0 AND deviation >= 0.12, false) AS pred FROM scored""",
    "levels": "SELECT unnest(range(46)) AS k",
    "swept": """
        SELECT CAST(round(0.5 + 0.1 * k, 1) AS DOUBLE) AS mad_multiplier,
               count(*) FILTER (WHERE truth AND hit) AS tp, count(*) FILTER (WHERE NOT truth AND hit) AS fp,
               count(*) FILTER (WHERE truth AND NOT hit) AS fn, count(*) FILTER (WHERE NOT truth AND NOT hit) AS tn
        FROM (SELECT k, truth, coalesce(z > CAST(round(0.5 + 0.1 * k, 1) AS DOUBLE) AND deviation >= 0.12, false) AS hit FROM scored, levels)
        GROUP BY k""",
    "truns": """
        SELECT source, min(pos) AS s, max(pos) AS e, string_agg(DISTINCT label, '+' ORDER BY label) AS type FROM (
          SELECT source, pos, pos - row_number() OVER (PARTITION BY source ORDER BY pos) AS island,
                 unnest(string_split(anomaly_type, '+')) AS label FROM (SELECT * FROM flagged WHERE truth) )
        GROUP BY source, island""",
    "pruns": """
        SELECT source, min(pos) AS s, max(pos) AS e FROM (
          SELECT source, pos, pos - row_number() OVER (PARTITION BY source ORDER BY pos) AS island FROM flagged WHERE pred)
        GROUP BY source, island""",
    "evts": """
        SELECT t.source, t.s, t.e, t.type, count(f.pos) AS flags, min(f.pos) FILTER (WHERE f.pos >= t.s) AS first_after,
               min(f.pos) AS first_any, count(f.pos) >= CASE WHEN t.type LIKE 'point_%' THEN 1 ELSE 5 END AS detected
        FROM truns t LEFT JOIN (SELECT source, pos FROM flagged WHERE pred) f
          ON f.source = t.source AND f.pos BETWEEN t.s - 2 AND t.e + 2 GROUP BY t.source, t.s, t.e, t.type""",
    "customers": """
        SELECT 'CUST_' || c_custkey AS meter_id, c_mktsegment AS profile, n_name AS location
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "oreadings": """
        SELECT o_orderdate AS time, 'CUST_' || o_custkey AS meter_id, o_totalprice AS kwh,
               o_orderstatus = 'F' AS is_anomaly, o_orderpriority AS source FROM orders""",
    "ofacts": """
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY meter_id, time ORDER BY kwh, source, is_anomaly) AS rn FROM oreadings)
        WHERE rn = 1""",
    "electric": """
        SELECT l_shipdate AS timestamp, CASE WHEN l_returnflag = 'A' THEN '' ELSE 'S' || l_suppkey END AS meter_id,
               CASE WHEN l_linestatus = 'O' THEN l_extendedprice END AS consumption_kwh, 230.0::DOUBLE AS voltage_v,
               l_quantity AS current_a, l_tax + 0.9::DOUBLE AS power_factor, l_returnflag AS disco FROM lineitem""",
}


def ctes(last: str) -> str:
    """WITH clause holding ``last`` and what it needs."""
    names = list(CTES)
    wanted: list[str] = []

    def visit(name: str) -> None:
        for other in names:
            if other != name and other not in wanted and _mentions(CTES[name], other):
                visit(other)
        if name not in wanted:
            wanted.append(name)

    for name in last.split():
        visit(name)
    return "WITH " + ", ".join(f"{name} AS ({CTES[name]})" for name in wanted) + " "


def _mentions(sql: str, name: str) -> bool:
    words = sql.replace("(", " ").replace(")", " ").replace(",", " , ").split()
    return any(
        words[i] == name and i and words[i - 1].upper() in ("FROM", "JOIN", ",") for i in range(len(words))
    )


def rates(columns: str, source: str) -> str:
    """Precision, recall and F1 over a relation with tp, fp and fn."""
    return (
        f"SELECT {columns}, round(precision, 9) AS precision, round(recall, 9) AS recall, "
        "round(2 * precision * recall / greatest(precision + recall, 1e-9), 9) AS f1 FROM ("
        "SELECT *, tp / greatest(tp + fp, 1) AS precision, tp / greatest(tp + fn, 1) AS recall FROM "
        f"{source})"
    )
