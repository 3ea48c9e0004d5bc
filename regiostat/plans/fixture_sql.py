"""DuckDB twins of :mod:`regiostat.plans.fixtures` (same formulas)."""

from __future__ import annotations


def duck_mean(s: str, n: str) -> str:
    """DuckDB text of the exact half-away-from-zero mean (integer cents)."""
    s, n = f"({s})", f"({n})"
    q = f"((abs(CAST({s} * 100 AS HUGEINT)) * 2 + {n}) // (CAST({n} AS HUGEINT) * 2))"
    return (f"CAST(CAST(CASE WHEN {n} IS NULL OR {n} = 0 OR {s} IS NULL THEN NULL "
            f"WHEN {s} < 0 THEN -{q} ELSE {q} END AS DECIMAL(38,0)) * 0.01 AS DECIMAL(20,2))")


CTES: dict[str, tuple[list[str], str]] = {}


def cte(name: str, deps: list[str], body: str) -> None:
    CTES[name] = (deps, body)


def with_ctes(names: list[str], select: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][0]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return select
    parts = [f"{n} AS (\n{CTES[n][1]}\n)" for n in order]
    return "WITH " + ",\n".join(parts) + "\n" + select


# -- B.1 ---------------------------------------------------------------------
cte("fx_r", [], "SELECT r_regionkey AS rk, upper(substr(r_name, 1, 2)) AS cc FROM region")
cte("fx_n", ["fx_r"], "SELECT n_nationkey, cc || chr(65 + n_nationkey) AS n1 "
                      "FROM nation JOIN fx_r ON n_regionkey = rk")
cte("nuts", ["fx_r", "fx_n"], """
SELECT CAST(rk + 1 AS BIGINT) AS gid, cc AS nuts_id, CAST(0 AS INTEGER) AS stat_levl_, DATE '2013-01-01' AS year FROM fx_r
UNION ALL SELECT CAST(rk + 900001 AS BIGINT), cc, 0, DATE '2010-01-01' FROM fx_r
UNION ALL SELECT CAST(n_nationkey + 100 AS BIGINT), n1, 1, DATE '2013-01-01' FROM fx_n
UNION ALL SELECT CAST(n_nationkey * 3 + a + 1000 AS BIGINT), n1 || CAST(a AS VARCHAR), 2, DATE '2013-01-01'
  FROM fx_n, range(3) ra(a)
UNION ALL SELECT CAST(n_nationkey * 12 + a * 4 + b + 10000 AS BIGINT),
  n1 || CAST(a AS VARCHAR) || CAST(b AS VARCHAR), 3, DATE '2013-01-01'
  FROM fx_n, range(3) ra(a), range(4) rb(b)""")

# -- B.2 ---------------------------------------------------------------------
cte("lau", ["nuts"], """
SELECT c.gid, c.comm_id, c.fk_nuts_gid, n.nuts_id FROM (
  SELECT CAST(c_custkey AS BIGINT) AS gid, 'C' || CAST(c_custkey AS VARCHAR) AS comm_id,
         CAST(c_nationkey * 12 + (c_custkey % 3) * 4 + c_custkey % 4 + 10000 AS BIGINT) AS fk_nuts_gid
  FROM customer) c
LEFT JOIN (SELECT gid AS n_gid, nuts_id FROM nuts WHERE stat_levl_ = 3 AND year = DATE '2013-01-01') n
  ON c.fk_nuts_gid = n.n_gid""")

# -- B.3 ---------------------------------------------------------------------
_STATS_AGG = """count(*) AS count,
  CAST(sum(v) AS DECIMAL(20,2)) AS sum,
  CAST(CAST(stddev_pop(CAST(v AS DOUBLE)) AS DECIMAL(38,6)) AS DECIMAL(20,2)) AS stddev,
  CAST(min(v) AS DECIMAL(20,2)) AS min, CAST(max(v) AS DECIMAL(20,2)) AS max"""
cte("fx_price", [], """
SELECT o_orderkey, o_custkey, o_orderpriority, CAST(o_totalprice AS DECIMAL(20,2)) AS v FROM orders""")


def _lau_stats_body(times: int, even_only: bool) -> str:
    even = " AND o_orderkey % 2 = 0" if even_only else ""
    return f"""
SELECT a.count, a.sum, {duck_mean('a.sum', 'a.count')} AS mean, a.stddev, a.min, a.max,
       g.comm_id, g.fk_time_id, g.gid AS fk_lau_gid
FROM (SELECT gid, comm_id, CAST(t AS BIGINT) AS fk_time_id FROM lau, range(1, {times} + 1) rt(t)) g
LEFT JOIN (
  SELECT o_custkey, CAST(1 + o_orderkey % {times} AS BIGINT) AS fk_time_id, {_STATS_AGG}
  FROM fx_price WHERE o_custkey % 11 <> 0{even}
  GROUP BY o_custkey, CAST(1 + o_orderkey % {times} AS BIGINT)) a
ON g.gid = a.o_custkey AND g.fk_time_id = a.fk_time_id"""


cte("lau_stats", ["lau", "fx_price"], _lau_stats_body(1, False))
cte("lau_stats_t3", ["lau", "fx_price"], _lau_stats_body(3, False))
cte("lau_stats_new", ["lau", "fx_price"], _lau_stats_body(1, True))
cte("dataset_stats", ["fx_price"], f"""
SELECT dataset,
  CASE WHEN o_custkey % 11 <> 0 THEN count END AS count,
  CASE WHEN o_custkey % 11 <> 0 THEN sum END AS sum,
  CASE WHEN o_custkey % 11 <> 0 THEN {duck_mean('sum', 'count')} END AS mean,
  CASE WHEN o_custkey % 11 <> 0 THEN stddev END AS stddev,
  CASE WHEN o_custkey % 11 <> 0 THEN min END AS min,
  CASE WHEN o_custkey % 11 <> 0 THEN max END AS max,
  'C' || CAST(o_custkey AS VARCHAR) AS comm_id, CAST(1 AS BIGINT) AS fk_time_id, o_custkey AS fk_lau_gid
FROM (SELECT 'ds_' || regexp_replace(lower(o_orderpriority), '[^a-z0-9]+', '_', 'g') AS dataset, o_custkey, {_STATS_AGG}
      FROM fx_price GROUP BY 1, 2)""")


cte("fx_price_even", ["fx_price"], "SELECT * FROM fx_price WHERE o_orderkey % 2 = 0")
cte("dataset_new", ["fx_price_even"], CTES["dataset_stats"][1].replace("FROM fx_price ", "FROM fx_price_even "))
cte("dataset_upd", ["dataset_stats", "dataset_new"], """
SELECT dataset, """ + ", ".join(f"CASE WHEN hit THEN n.{c} ELSE o.{c} END AS {c}" for c in ("count", "sum", "mean", "stddev", "min", "max")) + """,
  o.comm_id, fk_time_id, fk_lau_gid
FROM dataset_stats AS o LEFT JOIN (SELECT *, true AS hit FROM dataset_new WHERE starts_with(comm_id, 'C1')) AS n USING (dataset, fk_time_id, fk_lau_gid)""")


def _upd_body(cols: list[str]) -> str:
    sets = ", ".join(f"CASE WHEN n.fk_lau_gid IS NOT NULL THEN n.{c} ELSE o.{c} END AS {c}"
                     if c in cols else f"o.{c}" for c in ["count", "sum", "mean", "stddev", "min", "max"])
    return f"""
SELECT {sets}, o.comm_id, o.fk_time_id, o.fk_lau_gid
FROM lau_stats o LEFT JOIN (SELECT * FROM lau_stats_new WHERE comm_id LIKE 'C1%') n
  ON o.fk_lau_gid = n.fk_lau_gid AND o.fk_time_id = n.fk_time_id"""


cte("lau_upd", ["lau_stats", "lau_stats_new"], _upd_body(["count", "sum", "mean", "stddev", "min", "max"]))
cte("lau_upd_compat", ["lau_stats", "lau_stats_new"], _upd_body(["count", "mean", "stddev", "min", "max"]))


# -- B.6 / B.7 / B.8 -------------------------------------------------------------
cte("px", [], """
SELECT CAST(1 AS BIGINT) AS fk_time_id, o_orderkey % 1024 AS col, o_orderkey // 1024 AS row,
       CAST(CASE WHEN o_orderstatus = 'P' THEN -9999.0 ELSE floor(o_totalprice) END AS DOUBLE) AS value FROM orders
UNION ALL
SELECT CAST(2 AS BIGINT), o_orderkey % 1024, o_orderkey // 1024, CAST(o_custkey % 50 AS DOUBLE) FROM orders WHERE o_orderkey % 3 <> 0""")
cte("zblock", [], """
SELECT DISTINCT (o_orderkey % 1024) // 32 AS bcol, o_orderkey // 32768 AS brow, (o_orderkey // 32768) * 32 + (o_orderkey % 1024) // 32 AS gid FROM orders""")


def _template_values() -> str:
    from regiostat.plans.fixtures import SQUARE_HOLE, SQUARE_OUTER, TRIANGLE
    rows = []
    for shape, ring, pts in ((0, 0, SQUARE_OUTER), (0, 1, SQUARE_HOLE), (1, 0, TRIANGLE)):
        rows += [f"({shape}, {ring}, {k}, {float(dx)}, {float(dy)})" for k, (dx, dy) in enumerate(pts)]
    return ", ".join(rows)


cte("zvert", ["zblock"], f"""
SELECT gid, 0 AS part, t.ring, t.seq,
  CAST(bcol * 32.0 + CASE WHEN gid % 25 = 24 THEN 100000.0 ELSE 0.0 END + 1.25 + t.dx AS DOUBLE) AS x,
  CAST(brow * 32.0 + 1.25 + t.dy AS DOUBLE) AS y
FROM zblock JOIN (VALUES {_template_values()}) t(shape, ring, seq, dx, dy) ON t.shape = gid % 2""")
cte("zedge", ["zvert"], """
SELECT * FROM (
  SELECT gid, part, ring, seq, x AS x1, y AS y1,
         lead(x) OVER (PARTITION BY gid, part, ring ORDER BY seq) AS x2,
         lead(y) OVER (PARTITION BY gid, part, ring ORDER BY seq) AS y2
  FROM zvert) WHERE x2 IS NOT NULL""")
cte("zwkt", ["zvert"], """
SELECT gid, 'POLYGON (' || string_agg(r, ',' ORDER BY ring) || ')' AS wkt FROM (
  SELECT gid, ring, '(' || string_agg(regexp_replace(CAST(x AS VARCHAR), '\\.0$', '') || ' ' ||
         regexp_replace(CAST(y AS VARCHAR), '\\.0$', ''), ',' ORDER BY seq) || ')' AS r
  FROM zvert GROUP BY gid, ring) GROUP BY gid""")
cte("zone_lau", ["nuts", "zblock"], """
SELECT z.gid, 'N' || CAST(z.gid AS VARCHAR) AS comm_id, CAST(z.gid % 25 * 12 + 10000 AS BIGINT) AS fk_nuts_gid, n.nuts_id
FROM zblock z LEFT JOIN (SELECT gid, nuts_id FROM nuts WHERE stat_levl_ = 3 AND year = DATE '2013-01-01') n
  ON n.gid = z.gid % 25 * 12 + 10000""")
cte("pos", ["zblock"], """
SELECT gid, bcol * 32 + c AS col, brow * 32 + r AS row FROM zblock, range(32) a(c), range(32) b(r)
WHERE brow * 32 + r <= (SELECT max(o_orderkey) // 1024 FROM orders)""")
cte("inside", ["pos", "zedge"], """
SELECT e.gid, p.col, p.row FROM pos p JOIN zedge e ON e.gid = p.gid
 AND (e.y1 > p.row + 0.5) <> (e.y2 > p.row + 0.5)
 AND p.col + 0.5 < e.x1 + (p.row + 0.5 - e.y1) * (e.x2 - e.x1) / (e.y2 - e.y1)
GROUP BY e.gid, p.col, p.row HAVING count(*) % 2 = 1""")
cte("tilekeys", ["px"], "SELECT DISTINCT fk_time_id, col // 32 AS tile_col, row // 32 AS tile_row FROM px")
cte("clip", ["inside", "tilekeys", "px"], """
SELECT i.gid, t.fk_time_id, i.col, i.row, COALESCE(p.value, -9999.0) AS value
FROM inside i JOIN tilekeys t ON t.tile_col = i.col // 32 AND t.tile_row = i.row // 32
LEFT JOIN px p ON p.fk_time_id = t.fk_time_id AND p.col = i.col AND p.row = i.row""")


def zonal_body(times: list[int]) -> str:
    tv = ", ".join(f"({t})" for t in times)
    return f"""
SELECT a.count, a.sum, a.mean, a.stddev, a.min, a.max, z.comm_id, t.fk_time_id, z.gid AS fk_lau_gid
FROM zone_lau z CROSS JOIN (SELECT CAST(v AS BIGINT) AS fk_time_id FROM (VALUES {tv}) tv(v)) t
LEFT JOIN (
  SELECT gid, fk_time_id, count(*) AS count, CAST(sum(value) AS DECIMAL(20,2)) AS sum,
    CAST(CAST(avg(value) AS DECIMAL(38,6)) AS DECIMAL(20,2)) AS mean,
    CAST(CAST(stddev_pop(value) AS DECIMAL(38,6)) AS DECIMAL(20,2)) AS stddev,
    CAST(min(value) AS DECIMAL(20,2)) AS min, CAST(max(value) AS DECIMAL(20,2)) AS max
  FROM clip WHERE value <> -9999.0 AND NOT isnan(value) GROUP BY gid, fk_time_id) a
ON a.gid = z.gid AND a.fk_time_id = t.fk_time_id"""


cte("zonal", ["zone_lau", "clip"], zonal_body([1, 2]))
cte("lonlat", [], """
SELECT c_custkey AS gid, (c_custkey * 37 % 3500) / 100.0 - 5 AS lon, (c_custkey * 53 % 3500) / 100.0 + 35 AS lat
FROM customer""")


# -- B.4 / B.5 --------------------------------------------------------------------------
def _fmt_case() -> str:
    from regiostat.functions.timefuncs import STRPTIME_FORMATS
    whens = " ".join(f"WHEN {i} THEN strftime(ts, '{f}')" for i, f in enumerate(STRPTIME_FORMATS))
    return f"CASE o_orderkey % 17 {whens} END"


def duck_parse(col: str) -> str:
    """DuckDB twin of the 17-format parse; a regexp guard keeps DuckDB from
    accepting blanks around the text."""
    from regiostat.functions.timefuncs import STRPTIME_FORMATS
    fl = ", ".join(f"'{f}'" for f in STRPTIME_FORMATS)
    guard = r"'[0-9]{1,4}([/.-][0-9]{1,4}){0,2}( [0-9]{1,2}:[0-9]{1,2}(:[0-9]{1,2})?)?'"
    return f"CASE WHEN regexp_full_match({col}, {guard}) THEN try_strptime({col}, [{fl}]) END"


cte("time_text", [], f"""
SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus, ts,
  CASE WHEN o_orderkey % 101 = 0 THEN (['', 'abc', '31/02/2015'])[(o_orderkey // 101) % 3 + 1]
       ELSE {_fmt_case()} END AS ts_text,
  (['Yearly', 'MONTH', 'day', 'hourly', 'decade'])[o_orderkey % 5 + 1] AS gran_text
FROM (SELECT *, o_orderdate + to_seconds(CAST((o_orderkey % 24) * 3600 + (o_orderkey % 60) * 60
                                               + o_orderkey % 59 AS BIGINT)) AS ts FROM orders)""")
cte("raw_tabular", ["time_text", "lau"], """
SELECT CASE WHEN o_orderkey % 50 = 0 THEN 'ZZ999' ELSE lower(l.nuts_id) END AS "key",
  CASE WHEN o_orderkey % 997 = 0 THEN 'n/a' WHEN o_orderkey % 13 = 0 THEN ''
       ELSE CAST(CAST(o_totalprice AS DECIMAL(20,2)) AS VARCHAR) END AS "Value EUR/m2",
  CAST(CAST((o_orderkey % 1000) / 4.0 AS DECIMAL(20,2)) AS VARCHAR) AS "Value-EUR-m2",
  CASE WHEN o_orderkey % 89 = 0 THEN '3.0' ELSE CAST(o_orderkey % 1000 AS VARCHAR) END AS "count",
  (['t', 'f', 'yes', 'no'])[o_orderkey % 4 + 1] AS flag,
  ts_text AS datetime, o_orderstatus AS comment
FROM time_text t LEFT JOIN lau l ON l.gid = t.o_custkey""")
cte("typed_tabular", ["raw_tabular"], f"""
SELECT "key" AS "key",
  TRY_CAST(nullif("Value EUR/m2", '') AS DECIMAL(20,2)) AS value_eur_m2, nullif("Value EUR/m2", '') AS r1,
  TRY_CAST(nullif("Value-EUR-m2", '') AS DECIMAL(20,2)) AS value_eur_m2_1, nullif("Value-EUR-m2", '') AS r2,
  CASE WHEN regexp_full_match(nullif("count", ''), '[+-]?[0-9]+') THEN CAST("count" AS BIGINT) END AS "count",
  nullif("count", '') AS r3,
  CASE WHEN lower(trim(flag)) IN ('t','tr','tru','true','y','ye','yes','on','1') THEN true
       WHEN lower(trim(flag)) IN ('f','fa','fal','fals','false','n','no','of','off','0') THEN false END AS flag,
  nullif(flag, '') AS r4,
  {duck_parse("nullif(datetime, '')")} AS datetime, nullif(datetime, '') AS r5
FROM raw_tabular""")
cte("accepted_tabular", ["typed_tabular"], """
SELECT "key", value_eur_m2, value_eur_m2_1, "count", flag, datetime FROM typed_tabular
WHERE NOT ((r1 IS NOT NULL AND value_eur_m2 IS NULL) OR (r2 IS NOT NULL AND value_eur_m2_1 IS NULL)
        OR (r3 IS NOT NULL AND "count" IS NULL) OR (r4 IS NOT NULL AND flag IS NULL)
        OR (r5 IS NOT NULL AND datetime IS NULL) OR length("key") > 255)""")


# -- scaled raster and zones -------------------------------------------------------------
cte("spx", [], """
SELECT CAST(1 AS BIGINT) AS fk_time_id, o_orderkey % 1024 AS col, o_orderkey // 1024 AS row,
  CASE WHEN o_orderstatus = 'P' THEN -9999.0 ELSE o_totalprice END AS value FROM orders""")


def _scaled_edges(shape) -> str:
    rows = ", ".join(f"({k}, {x1}, {y1}, {x2}, {y2})" for k, ((x1, y1), (x2, y2))
                     in enumerate(zip(shape[:-1], shape[1:])))
    return f"""
SELECT b.gid, b.bx * 32.0 + t.x1 AS x1, b.by * 32.0 + t.y1 AS y1, b.bx * 32.0 + t.x2 AS x2, b.by * 32.0 + t.y2 AS y2
FROM (SELECT DISTINCT col // 32 AS bx, row // 32 AS by, (row // 32) * 32 + col // 32 AS gid FROM spx) b,
     (VALUES {rows}) t(k, x1, y1, x2, y2)"""


def _scaled_shapes() -> None:
    from regiostat.plans.fixtures import SCALED_CHANGED, SCALED_NEW, SCALED_PREFIX, SCALED_TRIANGLE
    cte("sedge", ["spx"], _scaled_edges(SCALED_TRIANGLE))
    cte("sedge_new", ["spx"], _scaled_edges(SCALED_CHANGED))
    moved = f"gid % {SCALED_NEW} = 0 AND starts_with('B' || CAST(gid AS VARCHAR), '{SCALED_PREFIX}')"
    cte("sedge_upd", ["sedge", "sedge_new"], f"SELECT * FROM sedge WHERE NOT ({moved}) UNION ALL SELECT * FROM sedge_new WHERE {moved}")


_scaled_shapes()


def scaled_zonal_body(pixels: str, time: int) -> str:
    """Statistics of the scaled zones over one time of a pixel table."""
    return f"""
SELECT a.count, a.sum, a.mean, a.stddev, a.min, a.max, 'B' || CAST(z.gid AS VARCHAR) AS comm_id,
  CAST({time} AS BIGINT) AS fk_time_id, z.gid AS fk_lau_gid
FROM (SELECT DISTINCT gid FROM sedge) z LEFT JOIN (
  SELECT gid, count(*) AS count, CAST(sum(value) AS DECIMAL(20,2)) AS sum,
    CAST(CAST(avg(value) AS DECIMAL(38,6)) AS DECIMAL(20,2)) AS mean,
    CAST(CAST(stddev_pop(value) AS DECIMAL(38,6)) AS DECIMAL(20,2)) AS stddev,
    CAST(min(value) AS DECIMAL(20,2)) AS min, CAST(max(value) AS DECIMAL(20,2)) AS max
  FROM (SELECT e.gid, p.col, p.row, p.value FROM {pixels} p JOIN sedge e
          ON e.gid = (p.row // 32) * 32 + p.col // 32
         AND (e.y1 > p.row + 0.5) <> (e.y2 > p.row + 0.5)
         AND p.col + 0.5 < e.x1 + (p.row + 0.5 - e.y1) * (e.x2 - e.x1) / (e.y2 - e.y1)
        GROUP BY e.gid, p.col, p.row, p.value HAVING count(*) % 2 = 1)
  WHERE value <> -9999.0 GROUP BY gid) a ON a.gid = z.gid"""


cte("dspx", [], """
SELECT 'ds_' || regexp_replace(lower(o_orderpriority), '[^a-z0-9]+', '_', 'g') AS dataset, o_orderkey % 1024 AS col, o_orderkey // 1024 AS row,
  CASE WHEN o_orderstatus = 'P' THEN -9999.0 ELSE o_totalprice END AS value FROM orders""")
cte("dszonal_upd", ["dspx", "sedge_upd"], """
SELECT d.dataset, a.count, a.sum, a.mean, a.stddev, a.min, a.max, 'B' || CAST(z.gid AS VARCHAR) AS comm_id,
  CAST(1 AS BIGINT) AS fk_time_id, z.gid AS fk_lau_gid
FROM (SELECT DISTINCT gid FROM sedge_upd) z CROSS JOIN (SELECT DISTINCT dataset FROM dspx) d LEFT JOIN (
  SELECT gid, dataset, count(*) AS count, CAST(sum(value) AS DECIMAL(20,2)) AS sum,
    CAST(CAST(avg(value) AS DECIMAL(38,6)) AS DECIMAL(20,2)) AS mean,
    CAST(CAST(stddev_pop(value) AS DECIMAL(38,6)) AS DECIMAL(20,2)) AS stddev,
    CAST(min(value) AS DECIMAL(20,2)) AS min, CAST(max(value) AS DECIMAL(20,2)) AS max
  FROM (SELECT e.gid, p.dataset, p.col, p.row, p.value FROM dspx p JOIN sedge_upd e
          ON e.gid = (p.row // 32) * 32 + p.col // 32
         AND (e.y1 > p.row + 0.5) <> (e.y2 > p.row + 0.5)
         AND p.col + 0.5 < e.x1 + (p.row + 0.5 - e.y1) * (e.x2 - e.x1) / (e.y2 - e.y1)
        GROUP BY e.gid, p.dataset, p.col, p.row, p.value HAVING count(*) % 2 = 1)
  WHERE value <> -9999.0 GROUP BY gid, dataset) a ON a.gid = z.gid AND a.dataset = d.dataset""")
cte("szonal", ["spx", "sedge"], scaled_zonal_body("spx", 1))
cte("slau", ["sedge", "nuts"], """
SELECT z.gid, 'B' || CAST(z.gid AS VARCHAR) AS comm_id, CAST(10000 + z.gid % 25 * 12 + z.gid % 3 * 4 + z.gid % 4 AS BIGINT) AS fk_nuts_gid, n.nuts_id
FROM (SELECT DISTINCT gid FROM sedge) z LEFT JOIN (SELECT gid, nuts_id FROM nuts WHERE stat_levl_ = 3 AND year = DATE '2013-01-01') n
  ON n.gid = 10000 + z.gid % 25 * 12 + z.gid % 3 * 4 + z.gid % 4""")
cte("spx_second", ["spx"], """
SELECT col, row, CASE WHEN (row * 1024 + col) % 5 = 0 AND value <> -9999.0 THEN value + 1 ELSE value END AS value
FROM spx WHERE (row * 1024 + col) % 3 = 1""")
