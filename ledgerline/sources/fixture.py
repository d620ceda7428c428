"""The dirty raw order-line view, derived deterministically from the TPC-H-like
driver tables (region nation customer part orders lineitem).

The same SQL text runs on Spark (tables passed as DataFrame parameters, no
global views) and on DuckDB (tables by name), so both engines start from an
identical raw input. Each line gets a bad date, null customer, padded
upper-case name, null/lower-case category, quantity -1, null/-5 price, -1
sales, null/0.95 discount, null region, null segment or an exact duplicate
according to fixed residues of a row hash; some names carry no-break spaces,
tabs, quotes, bars or a line break, some quantities are halves or are padded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerline.schema import RAW_COLUMNS

TABLES = ("lineitem", "orders", "customer", "part", "nation", "region")

# Fixed definition of the raw test view (agreed text; identical in both engines).
RAW_VIEW_SQL = """
with base as (
 select l.*, o.o_orderdate, o.o_custkey, c.c_name, c.c_mktsegment, p.p_name, p.p_type, n.n_name, r.r_name,
  l_orderkey*7+l_linenumber*13+l_partkey*3+l_suppkey as h
 from {lineitem} l join {orders} o on l_orderkey=o_orderkey join {customer} c on o_custkey=c_custkey
 join {part} p on l_partkey=p_partkey join {nation} n on c_nationkey=n_nationkey join {region} r on n_regionkey=r_regionkey),
raw as (select
 concat('ORD-', cast(l_orderkey as string)) as order_id,
 case when h%997=3 then 'not-a-date' else substr(cast(cast(o_orderdate as date) as string),1,10) end as order_date,
 case when h%499=5 then null else concat('C-', cast(o_custkey as string)) end as customer_id,
 case when h%101=7 then concat('  ', upper(c_name), '  ') when h%103=9 then concat(chr(160), c_name, chr(9)) else c_name end as customer_name,
 concat('P-', cast(l_partkey as string)) as product_id,
 case when h%107=3 then concat(p_name, ' 5" pipe, "x|y"') when h%109=5 then concat(p_name, chr(10), 'second, line') else p_name end as product_name,
 case when h%503=11 then null when h%50=1 then lower(p_type) else p_type end as category,
 case when h%701=13 then '-1' when h%97=4 then concat(cast(cast(l_quantity as int) as string), '.5')
  when h%89=6 then concat(chr(9), cast(cast(l_quantity as int) as string), ' ') else cast(cast(l_quantity as int) as string) end as quantity,
 case when h%401=17 then null when h%1009=19 then '-5.0' else cast(l_extendedprice as string) end as unit_price,
 case when h%601=31 then '-1.0' else cast(l_extendedprice as string) end as sales,
 case when h%211=23 then null when h%613=37 then '0.95' else cast(l_discount as string) end as discount,
 case when h%307=29 then null else lower(r_name) end as region, n_name as country, case when h%599=41 then null else c_mktsegment end as segment, h
 from base)
select * from raw union all select * from raw where h%331=0
"""


# The same rows for Spark, whose joins run once, the wide rows in two of them:
# parts go to the lines, customers to the orders, then these meet. A copied line
# is repeated in place.
_JOINS = RAW_VIEW_SQL[RAW_VIEW_SQL.index(" from {lineitem}"):RAW_VIEW_SQL.index("),\nraw as")]
_UNION = "select * from raw union all select * from raw where h%331=0"
SPARK_VIEW_SQL = RAW_VIEW_SQL.replace(_JOINS, """
 from (select * from {lineitem} join {part} on l_partkey=p_partkey) l join (
  select * from {orders} join (select * from {customer} join {nation} on c_nationkey=n_nationkey join {region} on n_regionkey=r_regionkey)
   on o_custkey=c_custkey) o on l_orderkey=o_orderkey""").replace(
    "select l.*, o.o_orderdate, o.o_custkey, c.c_name, c.c_mktsegment, p.p_name, p.p_type, n.n_name, r.r_name", "select *").replace(
    _UNION, "select raw.* from raw lateral view explode(case when h%331=0 then array(0, 1) else array(0) end) as copy")


def raw_view_sql_duckdb() -> str:
    """The raw view for DuckDB (tables referenced by name), ``h`` dropped."""
    body = RAW_VIEW_SQL.format(**{t: t for t in TABLES})
    return "select " + ", ".join(RAW_COLUMNS) + " from (" + body + ")"


def load_tables(spark: SparkSession, sf_dir: str, names=TABLES) -> dict[str, DataFrame]:
    return {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in names}


def raw_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All-string raw order lines (14 columns) derived from the driver tables."""
    tables = load_tables(spark, sf_dir)
    df = spark.sql("select * from (" + SPARK_VIEW_SQL + ")", **tables)
    return df.select(*RAW_COLUMNS)
