"""DuckDB SQL for the catalogue queries (tables are pre-registered views).

Written independently of the Spark code: label ranks with ``row_number``,
scaling with ``stddev_samp``, centres as group means, distances by pairing
each point with the (few) centres and taking the minimum. Queries whose
result depends on a fit (train_detect_*) have no SQL here.
"""

from __future__ import annotations

from ..functions.alerts import ALERT_PREFIX as _PREFIX


def _sq(a: str, b: str) -> str:
    return f"({a} - {b}) * ({a} - {b})"


def _ab(a: str, b: str) -> str:
    return f"abs({a} - {b})"


# Events prepared with features (event_type, value, user_id): raw r0..r2,
# scaled s0..s2; the 3n vector is (r0, r1, r2, r0, r1, r2, s0, s1, s2).
_EVENTS_PREP = """
ix AS (
  SELECT event_type,
         CAST(row_number() OVER (ORDER BY count(*) DESC, event_type) - 1 AS DOUBLE) AS idx
  FROM events WHERE event_type IS NOT NULL GROUP BY event_type),
b AS (
  SELECT e.event_id, e.event_type, CAST(e.value AS DOUBLE) AS r0,
         CAST(e.user_id AS DOUBLE) AS r1, ix.idx AS r2
  FROM events e JOIN ix ON e.event_type = ix.event_type),
sd AS (SELECT stddev_samp(r0) AS d0, stddev_samp(r1) AS d1, stddev_samp(r2) AS d2 FROM b),
p AS (
  SELECT b.*,
         CASE WHEN sd.d0 > 0 THEN r0 / sd.d0 ELSE 0 END AS s0,
         CASE WHEN sd.d1 > 0 THEN r1 / sd.d1 ELSE 0 END AS s1,
         CASE WHEN sd.d2 > 0 THEN r2 / sd.d2 ELSE 0 END AS s2
  FROM b CROSS JOIN sd),
c AS (
  SELECT event_type AS g, row_number() OVER (ORDER BY event_type) - 1 AS ci,
         avg(r0) AS c0, avg(r1) AS c1, avg(r2) AS c2,
         avg(s0) AS c6, avg(s1) AS c7, avg(s2) AS c8
  FROM p GROUP BY event_type)"""


def _dist(kind: str) -> str:
    t = _sq if kind == "euclid" else _ab
    raw = " + ".join(t(f"p.r{i}", f"c.c{i}") for i in range(3))
    scaled = " + ".join(t(f"p.s{i}", f"c.c{6 + i}") for i in range(3))
    return f"2 * ({raw}) + {scaled}"


def _scored(kind: str) -> str:
    return (f"WITH {_EVENTS_PREP},\n"
            f"pc AS (SELECT p.event_id, c.ci, {_dist(kind)} AS dd FROM p CROSS JOIN c),\n"
            "d AS (SELECT event_id, min(dd) AS d, arg_min(ci, dd) AS ci FROM pc GROUP BY event_id),\n"
            "st AS (SELECT avg(d) AS mu, coalesce(stddev_samp(d), 0) AS sdv FROM d)\n")


def _flagged(kind: str, n_sigma: float) -> str:
    return (_scored(kind) + "SELECT event_id, round(d, 4) AS distance FROM d, st "
            f"WHERE d > mu + {n_sigma} * sdv")


def _text(c: str, kind) -> str:
    if kind == "ts":   # Java prints a whole second as ".0"
        return (f"coalesce(CASE WHEN microsecond({c}) % 1000000 = 0 THEN CAST({c} AS VARCHAR) "
                f"|| '.0' ELSE CAST({c} AS VARCHAR) END, 'null')")
    return f"coalesce(CAST({c} AS VARCHAR), 'null')" if kind else f"coalesce({c}, 'null')"


def _alert(id_col: str, cols: list[tuple[str, object]], source: str) -> str:
    vals = ", ".join(_text(c, kind) for c, kind in cols)
    return (f"SELECT '{_PREFIX}' || CAST({id_col} + 1 AS VARCHAR) || ': [' || "
            f"concat_ws(',', {vals}) || ']' AS value FROM {source}")


_CUSTOMER_NULL_SEG = ("SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS seg, "
                      "c_acctbal, c_name FROM customer")

_NATION_X = ("SELECT n_nationkey AS id, n_regionkey AS cl, "
             "CAST(n_regionkey * 1000 + n_nationkey AS DOUBLE) AS x FROM nation")

def _silhouette_tail(by: str = "") -> str:
    """Silhouettes from ``per`` (id, cl, ocl, own, md), one mean for each ``by``."""
    keys, first = (f"{by}, id", f"{by}, ") if by else ("id", "")
    return f"""
ab AS (
  SELECT {keys},
         max(CASE WHEN ocl = cl THEN md END) AS a,
         min(CASE WHEN ocl <> cl THEN md END) AS b,
         max(CASE WHEN ocl = cl THEN own END) AS own_n
  FROM per GROUP BY {keys}),
s AS (
  SELECT {first}CASE WHEN own_n = 1 OR a IS NULL THEN 0
              WHEN a < b THEN 1 - a / b
              WHEN a > b THEN b / a - 1 ELSE 0 END AS s
  FROM ab)
SELECT {first}round(avg(s), 8) AS silhouette FROM s""" + (f" GROUP BY {by}" if by else "")


def _events_silhouette(rows: str, by: str = "") -> str:
    """Silhouettes of ``rows``: prepared events with a cluster ``cl`` (for each ``by``)."""
    sqn = "2 * (p.r0 * p.r0 + p.r1 * p.r1 + p.r2 * p.r2) + p.s0 * p.s0 + p.s1 * p.s1 + p.s2 * p.s2"
    dot = "2 * (p.r0 * cs.t0 + p.r1 * cs.t1 + p.r2 * cs.t2) + p.s0 * cs.u0 + p.s1 * cs.u1 + p.s2 * cs.u2"
    key, mine = (f"{by}, ", f"p.{by}, ") if by else ("", "")
    pairs = f"JOIN cs ON cs.{by} = p.{by}" if by else "CROSS JOIN cs"
    return (f"WITH {_EVENTS_PREP},\n"
            f"pk AS ({rows}),\n"
            f"cs AS (SELECT {key}cl, count(*) AS n, sum(r0) AS t0, sum(r1) AS t1, sum(r2) AS t2, "
            "sum(s0) AS u0, sum(s1) AS u1, sum(s2) AS u2, "
            "sum(2 * (r0 * r0 + r1 * r1 + r2 * r2) + s0 * s0 + s1 * s1 + s2 * s2) AS q "
            f"FROM pk GROUP BY {key}cl),\n"
            f"per AS (SELECT {mine}p.event_id AS id, p.cl, cs.cl AS ocl, cs.n AS own, "
            f"CASE WHEN cs.cl = p.cl THEN CASE WHEN cs.n > 1 THEN "
            f"(({sqn}) + cs.q / cs.n - 2 * ({dot}) / cs.n) * cs.n / (cs.n - 1) END "
            f"ELSE ({sqn}) + cs.q / cs.n - 2 * ({dot}) / cs.n END AS md "
            f"FROM pk p {pairs})," + _silhouette_tail(by))


def _job(sigma: int) -> str:
    """Train, refit, detect on the five customer groups: centres are the group means."""
    def indexed(rows: str, by: str) -> str:
        return (f"SELECT r.id, r.g, r.x, r.seg, l.i FROM {rows} r JOIN (SELECT seg, "
                "row_number() OVER (ORDER BY count(*) DESC, seg) - 1 AS i "
                f"FROM {by} GROUP BY seg) l ON r.seg = l.seg")
    return f"""
WITH tr AS (SELECT c_custkey AS id, c_nationkey % 5 AS g,
                   c_nationkey % 5 * 1000 + c_custkey % 40 AS x,
                   CASE WHEN c_custkey % 3 = 0 THEN 'a' ELSE 'b' END AS seg FROM customer),
sc AS (SELECT id, g, x + CASE WHEN id % 150 = 0 THEN 250 ELSE 0 END AS x,
              CASE WHEN seg = 'a' THEN 'b' ELSE 'a' END AS seg FROM tr),
tri AS ({indexed("tr", "tr")}),
sci AS ({indexed("sc", "sc")}),
sdt AS (SELECT stddev_samp(x) AS sx, stddev_samp(i) AS si FROM tri),
sds AS (SELECT stddev_samp(x) AS sx, stddev_samp(i) AS si FROM sci),
cen AS (SELECT g, avg(x) AS x, avg(i) AS i FROM tri GROUP BY g),
dist AS (SELECT s.id, s.x, s.seg, min(
           2 * (s.x - c.x) * (s.x - c.x) + 2 * (s.i - c.i) * (s.i - c.i)
           + pow(s.x / sds.sx - c.x / sdt.sx, 2) + pow(s.i / sds.si - c.i / sdt.si, 2)) AS d
         FROM sci s CROSS JOIN cen c CROSS JOIN sdt CROSS JOIN sds GROUP BY s.id, s.x, s.seg),
st AS (SELECT avg(d) AS mu, stddev_samp(d) AS sdv FROM dist)
SELECT CAST(id AS BIGINT) AS id, CAST(x AS BIGINT) AS x, seg, round(d, 3) AS distance,
       (SELECT CAST(count(*) AS INTEGER) FROM cen) AS k
FROM dist CROSS JOIN st WHERE d > mu + {sigma} * sdv"""


ORACLE_SQL: dict[str, str] = {
    "csv_scan": "SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name, c_nationkey, c_acctbal, "
                "c_mktsegment FROM customer",
    "json_scan": "SELECT c_acctbal, c_custkey, c_mktsegment, c_name, "
                 "CAST(c_nationkey AS BIGINT) AS c_nationkey FROM customer",
    "kafka_decode": "SELECT event_id, event_type, value FROM events",
    "kafka_bad_records": """
WITH k AS (
  SELECT event_id, value,
         CASE WHEN event_id % 97 = 5 THEN 'not JSON'
              WHEN event_id % 101 = 7 THEN 'does not fit the schema'
              WHEN event_id % 103 = 9 THEN 'empty payload'
              WHEN event_id % 107 = 11 THEN 'does not fit the schema' ELSE 'read' END AS status,
         CASE WHEN event_id % 97 = 5
              THEN left('{"event_id":' || event_id || ',"event_type":"', 15)
              WHEN event_id % 101 = 7
              THEN '{"event_id":' || event_id || ',"event_type":"x","value":"n/a"}'
              WHEN event_id % 103 = 9 THEN ''
              WHEN event_id % 107 = 11 THEN '[1, 2]' END AS record
  FROM events)
SELECT CASE WHEN status = 'read' THEN event_id END AS event_id,
       CASE WHEN status = 'read' THEN value END AS value, status, record FROM k""",
    "column_names": "SELECT CAST(row_number() OVER () - 1 AS INTEGER) AS position, column_name "
                    "FROM (DESCRIBE customer)",
    "preview": "SELECT * FROM events ORDER BY event_id LIMIT 20",
    "schema_fields": "SELECT CAST(row_number() OVER () - 1 AS INTEGER) AS position, column_name, "
                     "CASE column_type WHEN 'BIGINT' THEN 'long' WHEN 'INTEGER' THEN 'integer' "
                     "WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string' "
                     "WHEN 'BOOLEAN' THEN 'boolean' ELSE lower(column_type) END AS data_type "
                     "FROM (DESCRIBE customer)",
    "feature_select": "SELECT c_mktsegment, c_acctbal, c_name, c_nationkey FROM customer",
    "string_columns": "SELECT CAST(row_number() OVER () - 1 AS INTEGER) AS position, column_name "
                      "FROM (DESCRIBE SELECT c_mktsegment, c_acctbal, c_name, c_nationkey "
                      "FROM customer) WHERE column_type = 'VARCHAR'",
    "string_index": """
WITH ix AS (
  SELECT c_mktsegment,
         CAST(row_number() OVER (ORDER BY count(*) DESC, c_mktsegment) - 1 AS DOUBLE)
           AS c_mktsegment_index
  FROM customer WHERE c_mktsegment IS NOT NULL GROUP BY c_mktsegment)
SELECT c.c_custkey, c.c_mktsegment, ix.c_mktsegment_index
FROM customer c JOIN ix ON c.c_mktsegment = ix.c_mktsegment""",
    "index_distributed": """
WITH ix AS (
  SELECT c_name, CAST(row_number() OVER (ORDER BY count(*) DESC, c_name) - 1 AS DOUBLE) AS i
  FROM customer WHERE c_name IS NOT NULL GROUP BY c_name)
SELECT c.c_custkey, ix.i AS c_name_index FROM customer c JOIN ix ON c.c_name = ix.c_name""",
    "index_skip_nulls": f"""
WITH t AS ({_CUSTOMER_NULL_SEG}),
ix AS (
  SELECT seg, CAST(row_number() OVER (ORDER BY count(*) DESC, seg) - 1 AS DOUBLE) AS i
  FROM t WHERE seg IS NOT NULL GROUP BY seg)
SELECT t.c_custkey, ix.i AS c_mktsegment_index FROM t JOIN ix ON t.seg = ix.seg""",
    "index_chain": f"""
WITH t AS ({_CUSTOMER_NULL_SEG}),
i1 AS (
  SELECT seg, CAST(row_number() OVER (ORDER BY count(*) DESC, seg) - 1 AS DOUBLE) AS c_mktsegment_index
  FROM t WHERE seg IS NOT NULL GROUP BY seg),
t1 AS (SELECT t.*, i1.c_mktsegment_index FROM t JOIN i1 ON t.seg = i1.seg),
i2 AS (
  SELECT c_name, CAST(row_number() OVER (ORDER BY count(*) DESC, c_name) - 1 AS DOUBLE) AS c_name_index
  FROM t1 WHERE c_name IS NOT NULL GROUP BY c_name),
t2 AS (SELECT t1.*, i2.c_name_index FROM t1 JOIN i2 ON t1.c_name = i2.c_name),
sd AS (SELECT stddev_samp(c_acctbal) AS d0, stddev_samp(c_mktsegment_index) AS d1,
              stddev_samp(c_name_index) AS d2 FROM t2)
SELECT c_custkey, c_mktsegment_index, c_name_index,
       round(c_acctbal, 4) AS f_0, round(c_mktsegment_index, 4) AS f_1, round(c_name_index, 4) AS f_2,
       round(c_acctbal, 4) AS f_3, round(c_mktsegment_index, 4) AS f_4, round(c_name_index, 4) AS f_5,
       round(CASE WHEN d0 > 0 THEN c_acctbal / d0 ELSE 0 END, 4) AS f_6,
       round(CASE WHEN d1 > 0 THEN c_mktsegment_index / d1 ELSE 0 END, 4) AS f_7,
       round(CASE WHEN d2 > 0 THEN c_name_index / d2 ELSE 0 END, 4) AS f_8
FROM t2 CROSS JOIN sd""",
    "standard_scale": "SELECT event_id, round(value / stddev_samp(value) OVER (), 4) AS value_scaled "
                      "FROM events",
    "feature_layout": f"WITH {_EVENTS_PREP}\n"
                      "SELECT event_id, round(r0, 4) AS f_0, round(r1, 4) AS f_1, round(r2, 4) AS f_2, "
                      "round(r0, 4) AS f_3, round(r1, 4) AS f_4, round(r2, 4) AS f_5, "
                      "round(s0, 4) AS f_6, round(s1, 4) AS f_7, round(s2, 4) AS f_8 FROM p",
    "nearest_euclidean": _scored("euclid") + "SELECT event_id, round(d, 4) AS distance FROM d",
    "nearest_manhattan": _scored("manhattan") + "SELECT event_id, round(d, 4) AS distance FROM d",
    "nearest_centre": _scored("euclid") + "SELECT event_id, CAST(ci AS INTEGER) AS centre FROM d",
    "distance_stats": _scored("euclid") +
    "SELECT count(*) AS n, round(avg(d), 4) AS mean, round(coalesce(stddev_samp(d), 0), 4) AS std, "
    "round(avg(d) + 4 * coalesce(stddev_samp(d), 0), 4) AS threshold_kmeans, "
    "round(avg(d) + 3 * coalesce(stddev_samp(d), 0), 4) AS threshold_bisecting FROM d",
    "detect_kmeans_rule_euclid": _flagged("euclid", 4),
    "detect_kmeans_rule_manhattan": _flagged("manhattan", 4),
    "detect_bisecting_rule_euclid": _flagged("euclid", 3),
    "detect_bisecting_rule_manhattan": _flagged("manhattan", 3),
    "any_anomaly": _scored("euclid") + "SELECT count(*) > 0 AS any_anomaly FROM d, st "
                                        "WHERE d > mu + 4 * sdv",
    "sqrt_rule": _scored("euclid") + "SELECT event_id, round(d, 4) AS distance FROM d "
                                      "WHERE d > 2 * sqrt(d)",
    "alert_text": _alert("c_custkey", [("c_custkey", True), ("c_name", False),
                                       ("c_nationkey", True), ("c_acctbal", True),
                                       ("c_mktsegment", False)], "customer"),
    "flagged_alerts": _scored("euclid") + ", fl AS (SELECT e.* FROM events e JOIN d "
    "ON e.event_id = d.event_id CROSS JOIN st WHERE d.d > st.mu + 4 * st.sdv)\n" +
    _alert("event_id", [("event_id", True), ("ts", "ts"), ("user_id", True), ("event_type", False),
                        ("value", True), ("props", False)], "fl"),
    "text_sink_append": "WITH a AS (" + _alert("event_id", [("event_id", True),
                                                            ("event_type", False),
                                                            ("value", True)], "events") + ")\n"
                        "SELECT value FROM a UNION ALL SELECT value FROM a",
    "text_sink_replay": _alert("event_id", [("event_id", True), ("event_type", False),
                                            ("value", True)], "events"),
    "detect_one_scan": _flagged("euclid", 4),
    "saved_model": _flagged("manhattan", 3),
    "silhouette": f"""
WITH pts AS ({_NATION_X}),
sizes AS (SELECT cl, count(*) AS own FROM pts GROUP BY cl),
pair AS (SELECT a.id, a.cl, b.cl AS ocl, (a.x - b.x) * (a.x - b.x) AS d2
         FROM pts a JOIN pts b ON a.id <> b.id),
per AS (SELECT pair.id, pair.cl, pair.ocl, avg(d2) AS md, max(sizes.own) AS own
        FROM pair JOIN sizes ON pair.cl = sizes.cl GROUP BY pair.id, pair.cl, pair.ocl),""" +
    _silhouette_tail(),
    "silhouette_events": _events_silhouette("SELECT p.*, p.r2 AS cl FROM p"),
    "silhouettes_all_k": _events_silhouette(
        "SELECT p.*, CAST(ks.k AS INTEGER) AS k, CAST(p.r1 AS BIGINT) % ks.k AS cl "
        "FROM p CROSS JOIN (SELECT unnest(range(3, 11)) AS k) ks", "k"),
    "kmeans_fit": "SELECT n_nationkey, n_regionkey AS cluster FROM nation",
    "bisecting_fit": "SELECT n_nationkey, n_regionkey AS cluster FROM nation",
    "k_search_kmeans": "SELECT CAST(count(DISTINCT n_regionkey) AS INTEGER) AS k FROM nation",
    "k_search_bisecting": "SELECT CAST(count(DISTINCT n_regionkey) AS INTEGER) AS k FROM nation",
    "job_kmeans": _job(4),
    "job_bisecting": _job(3),
}
