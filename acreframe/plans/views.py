"""The roles of the operators' tables, as SQL over the driver's tables that Spark and DuckDB both read.

Row and column of a pixel are r and c in the SQL; pixels() and others name them row and col.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

VIEWS = {
    # a series of one value a day for each supplier and return flag
    "pixels": """SELECT CAST(l_suppkey % 7 AS INT) AS cell_id, CAST(floor(l_suppkey / 7) AS INT) AS r, CAST(l_suppkey % 3 AS INT) AS c, l_returnflag AS spec_index,
      CAST(l_shipdate AS DATE) AS img_date, CAST(max((l_partkey * 37 + CAST(l_quantity AS BIGINT) * 113) % 9000) AS INT) AS value
      FROM lineitem GROUP BY 1, 2, 3, 4, 5""",
    # images of six bands: one for each order, a pixel for each line
    "raw_pixels": """SELECT CAST(l_suppkey % 7 AS INT) AS cell_id, CAST(l_orderkey AS INT) AS r, CAST(l_linenumber AS INT) AS c, CAST(l_orderkey % 500 AS VARCHAR(20)) AS image_id,
      CASE WHEN l_orderkey % 4 = 0 THEN 'S2A' WHEN l_orderkey % 4 = 1 THEN 'LT05' WHEN l_orderkey % 4 = 2 THEN 'LE07' ELSE 'LC08' END AS sensor, CAST(l_shipdate AS DATE) AS img_date,
      CAST(l_partkey % 3000 AS INT) AS blue, CAST((l_partkey * 7) % 4000 AS INT) AS green, CAST((l_partkey * 13 + l_linenumber) % 5000 AS INT) AS red, CAST((l_suppkey * 211 + l_partkey * 3) % 11000 AS INT) AS nir,
      CAST((l_partkey * 17) % 6000 AS INT) AS swir1, CAST((l_partkey * 19) % 7000 AS INT) AS swir2 FROM lineitem""",
    # the fine and coarse classes of a lookup table
    "lut": """SELECT CAST(n_nationkey AS INT) AS LC_UNQ, n_name AS USE_NAME, CAST(n_regionkey + 20 AS INT) AS LC25, r_name AS LC25_name, (n_regionkey * 3 + 2) / 40.0E0 AS perLC25E,
      CASE WHEN n_regionkey < 3 THEN 30 ELSE 98 END AS LC2, CASE WHEN n_regionkey < 3 THEN 'crop' ELSE 'nocrop' END AS LC2_name,
      CASE WHEN n_regionkey < 2 THEN 'crop' WHEN n_regionkey = 2 THEN 'medcrop' ELSE 'nocrop' END AS LC3_name FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "points": """SELECT c_custkey AS OID_, CAST(c_custkey % 1000 AS DOUBLE) + 0.5E0 AS x, floor(c_acctbal) + 0.25E0 AS y, n_name AS Class, CAST(c_nationkey AS INT) AS LC_UNQ, (c_custkey * 7919 % 1000) / 1000.0E0 AS rand, (c_custkey * 104729 % 1000) / 1000.0E0 AS rand2,
      CASE WHEN c_custkey % 3 = 0 THEN 'poly' WHEN c_custkey % 3 = 1 THEN 'ground' END AS SampMethod, c_custkey % 40 AS field_id, CAST(c_custkey % 4 AS INT) AS entry_lev, CASE WHEN c_custkey % 5 > 0 THEN CAST(c_custkey % 300 AS DOUBLE) END AS FieldWidth,
      CAST(c_custkey % 200 AS DOUBLE) AS Width FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    # predictions: the order's priority against its status, as class codes
    "scores": """SELECT o_orderkey AS OID_, CAST(o_custkey % 25 AS INT) AS pred, CASE WHEN o_orderkey % 50 > 0 THEN CAST(CASE WHEN o_orderkey % 3 = 0 THEN o_custkey % 25 ELSE o_orderkey % 25 END AS INT) END AS obs,
      CAST(CASE WHEN o_orderkey % 6 = 0 THEN 1 ELSE 0 END AS INT) AS small, CASE WHEN o_orderkey % 3 = 0 THEN 'smallCrop' WHEN o_orderkey % 3 = 1 THEN 'bigCrop' ELSE 'noCrop' END AS ho_type, CAST(year(o_orderdate) AS INT) AS yr FROM orders""",
    "scenes": """SELECT CAST(o_custkey % 50 AS INT) AS cell_id, CASE o_orderkey % 5 WHEN 0 THEN 'lt05' WHEN 1 THEN 'le07' WHEN 2 THEN 'lc08' WHEN 3 THEN 'lc09' ELSE 's2a' END AS sensor, CAST(year(o_orderdate) AS INT) AS yr, CAST(o_orderdate AS DATE) AS img_date,
      CONCAT('S', CAST(o_orderkey % 4000 AS VARCHAR(20))) AS scene_id, CASE WHEN o_orderstatus = 'P' THEN true WHEN o_orderkey % 2 = 0 THEN false END AS skip, CASE WHEN o_orderkey % 37 = 0 THEN 'timeout' END AS error, CASE WHEN o_orderkey % 41 = 0 THEN 'angles' END AS brdf_error,
      o_orderstatus = 'F' AS brdf, o_orderstatus = 'F' AND o_orderkey % 3 = 0 AS coreg, CAST(o_orderkey % 7 AS DOUBLE) AS shift_x, CAST(o_orderkey % 11 AS DOUBLE) AS shift_y, o_orderstatus = 'F' AND o_orderkey % 4 > 0 AS used,
      o_custkey AS numpix, CASE WHEN o_orderstatus = 'P' THEN o_orderpriority END AS skip_reason FROM orders""",
    "files": """SELECT CAST(doc_id % 60 AS INT) AS cell_id, lang AS sub_dir, CONCAT(source, CASE WHEN doc_id % 4 = 0 THEN '_angles.nc' WHEN doc_id % 4 = 1 THEN 'X.nc' ELSE '.nc' END) AS file, n_chars AS size FROM documents""",
    "ranges": """SELECT CAST(o_custkey % 300 AS INT) AS cell_id, CAST(o_orderdate AS DATE) AS "start", CAST(o_orderdate AS DATE) + CAST(o_orderkey % 60 AS INT) AS "end" FROM orders""",
    "zones": """SELECT CAST(n_nationkey AS INT) AS zone_id, CAST((n_nationkey % 5) * 200 AS DOUBLE) AS x0, CAST(floor(n_nationkey / 5) * 2200 - 1000 AS DOUBLE) AS y0, CAST(n_regionkey * 10 + 5 AS DOUBLE) AS estimate, CAST(n_nationkey AS DOUBLE) AS avg_farm FROM nation""",
}


def cte(*names: str) -> str:
    """WITH clause of the views for DuckDB."""
    return "WITH " + ", ".join(f"{n} AS ({VIEWS[n]})" for n in names)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view as Spark reads it; only the tables it names are read."""
    sql = VIEWS[name].replace('"start"', "start").replace('"end"', "end")
    tables = {t: table(spark, sf_dir, t) for t in ("lineitem", "nation", "region", "customer", "orders", "documents") if re.search(rf"\b(FROM|JOIN) {t}\b", sql)}
    for t in tables:
        sql = re.sub(rf"\b(FROM|JOIN) {t}\b", rf"\1 {{{t}}} AS {t}", sql)
    out = spark.sql(sql, **tables)
    return out.withColumnsRenamed({"r": "row", "c": "col"}) if name in ("pixels", "raw_pixels") else out
