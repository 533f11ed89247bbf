"""The same domain views as :mod:`views`, as DuckDB CTE bodies for the oracle SQL."""

RASTER = """raster AS (
  SELECT time, iy, ix, iy + 0.5 AS y, ix + 0.5 AS x,
         CASE WHEN (ix * 7 + iy * 3 + month(time)) % 29 = 0 THEN NULL ELSE q END AS qty, disc
  FROM (SELECT CAST(date_trunc('month', l_shipdate) AS TIMESTAMP) AS time,
               CAST((l_partkey // 10) % 10 AS BIGINT) AS iy, CAST(l_partkey % 10 AS BIGINT) AS ix,
               avg(l_quantity) AS q, avg(l_discount) AS disc
        FROM lineitem GROUP BY 1, 2, 3))"""

BOXES = """boxes AS (
  SELECT CAST(n_regionkey AS VARCHAR) AS basin_id, 'cat-' || CAST(n_nationkey AS VARCHAR) AS divide_id,
         CAST((n_nationkey % 5) * 2 AS DOUBLE) + CAST(0.3 AS DOUBLE) AS x0,
         CAST((n_nationkey % 5) * 2 AS DOUBLE) + CAST(0.3 AS DOUBLE) + 1 + (n_nationkey % 4) * CAST(0.1 AS DOUBLE) AS x1,
         CAST((n_nationkey // 5) * 2 AS DOUBLE) + CAST(0.2 AS DOUBLE) AS y0,
         CAST((n_nationkey // 5) * 2 AS DOUBLE) + CAST(0.2 AS DOUBLE) + CAST(1.25 AS DOUBLE) AS y1
  FROM nation)"""

GRID10 = """grid AS (SELECT CAST(a.range AS BIGINT) AS iy, CAST(b.range AS BIGINT) AS ix FROM range(10) a, range(10) b)"""

RECT_COV = """rect_cov AS (
  SELECT basin_id, divide_id, iy * 10 + ix AS cell_id, iy, ix,
         greatest(0, least(x1, ix + 1) - greatest(x0, ix)) * greatest(0, least(y1, iy + 1) - greatest(y0, iy)) AS coverage
  FROM boxes, grid
  WHERE greatest(0, least(x1, ix + 1) - greatest(x0, ix)) * greatest(0, least(y1, iy + 1) - greatest(y0, iy)) > 1e-12)"""

SERIES = """series AS (
  SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS datetime, event_type AS id, avg(value) AS value
  FROM events GROUP BY 1, 2)"""

FLOW = """flow AS (
  SELECT user_id AS feature_id, CAST(date_trunc('day', ts) AS TIMESTAMP) AS time,
         sum(CASE WHEN value > 200 THEN value ELSE 0 END) AS flow
  FROM events GROUP BY 1, 2)"""

RUNS = """runs AS (
  SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS init_hour, CAST(user_id % 3 AS INTEGER) AS step,
         event_type AS variable, value, event_id AS seq
  FROM events)"""

RUN_CELLS = """run_cells AS (
  SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS init_hour, CAST(user_id % 3 AS INTEGER) AS step,
         event_type AS variable, CAST((user_id // 3) % 10 AS BIGINT) AS iy, CAST((user_id // 30) % 10 AS BIGINT) AS ix,
         value, event_id AS seq
  FROM events)"""

NEXUS = """nexus AS (SELECT CAST(c_nationkey AS VARCHAR) AS vpu, 'nex-' || CAST(c_custkey AS VARCHAR) AS id FROM customer)"""

NEXUS_VALUES = """nexus_values AS (SELECT CAST(user_id AS VARCHAR) AS nex_id, event_id AS "index", value FROM events)"""

LEDGER = """ledger AS (
  SELECT CAST(c_custkey AS VARCHAR) AS basin_id, CASE WHEN c_custkey % 3 = 0 THEN 'finished' ELSE 'processing' END AS status
  FROM customer WHERE c_custkey % 3 <> 2)"""

BASINS = """basins AS (SELECT CAST(c_custkey AS VARCHAR) AS basin_id FROM customer)"""

WATER = """water AS (SELECT o_orderkey AS key, CAST(o_orderdate AS TIMESTAMP) AS time, o_totalprice AS value FROM orders)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
