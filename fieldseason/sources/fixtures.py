"""Observation, crop and station tables derived from the driver's star schema.

The texts run unchanged in Spark and in DuckDB; ``{name}`` stands for a table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

ANCHOR, ANCHOR_NAME = "GHCND:ST0", "Station 0"
SUPPLEMENTAL, SUPPLEMENTAL_NAME = "GHCND:ST3", "Station 3"

OBS = """
select concat('GHCND:ST', cast(l_suppkey % 4 as varchar(4))) as stationId,
       substring(cast(cast(l_shipdate as date) as varchar(10)), 1, 10) as date,
       case l_linenumber when 1 then 'TMAX' when 2 then 'TMIN' when 3 then 'PRCP'
                         when 4 then 'SNOW' when 5 then 'SNWD'
                         when 6 then 'TMAX' else 'TMIN' end as dataType,
       case when l_partkey % 17 = 0 then null
            when l_linenumber in (1, 6) then l_quantity - 5.0
            when l_linenumber in (2, 7) then l_quantity / 2.0 - 10.0
            when l_linenumber = 3 then l_discount * 500.0
            when l_linenumber = 4 then l_tax * 250.0
            else l_tax * 1000.0 end as value,
       case when l_returnflag = 'R' and l_partkey % 11 = 0 then ',X,S'
            when l_returnflag = 'N' then null else ',,S' end as attributes
from {lineitem}
"""

CROPS = """
select cast(year(o_orderdate) as varchar(4)) as year,
       case o_custkey % 4 when 0 then 'NE' when 1 then 'KS' when 2 then 'IA' else 'MO' end as state,
       concat('COUNTY ', cast(o_custkey % 3 as varchar(4))) as countyName,
       case when o_custkey % 41 = 0 then null
            else lpad(cast(o_custkey % 3 as varchar(3)), 3, '0') end as countyFips,
       case o_orderkey % 3 when 0 then 'CORN' when 1 then 'SOYBEANS' else 'WHEAT' end as commodity,
       case (o_orderkey % 9 - o_orderkey % 3) when 0 then 'YIELD' when 3 then 'PRICE RECEIVED'
            else 'AREA HARVESTED' end as statisticCat,
       'U' as unit,
       case o_orderpriority when '5-LOW' then '(D)' when '4-NOT SPECIFIED' then ' (Z) '
            else concat(' ', cast(cast(floor(o_totalprice / 1000) as bigint) as varchar(12)), ',',
                 lpad(cast(cast(floor(o_totalprice) as bigint) % 1000 as varchar(3)), 3, '0')) end as value
from {orders}
"""

# Two of the six stations never report.
STATIONS = """
select concat('GHCND:ST', cast(s_suppkey % 6 as varchar(4))) as id,
       concat('Station ', cast(s_suppkey % 6 as varchar(4))) as name,
       cast(min(s_nationkey) + 30.5 as double) as latitude,
       cast(-90.25 - max(s_nationkey) as double) as longitude,
       '1995-01-01' as minDate, '2001-12-31' as maxDate
from {supplier}
group by s_suppkey % 6
"""

# Each station's county; two of the reporting ones share a county code in different states.
COUNTIES = """
select distinct concat('GHCND:ST', cast(s_suppkey % 6 as varchar(4))) as stationId,
       lpad(cast(s_suppkey % 6 % 3 as varchar(3)), 3, '0') as countyFips,
       case s_suppkey % 6 when 0 then 'NE' when 1 then 'KS' when 2 then 'IA' when 3 then 'MO'
                          when 4 then 'KS' else 'NE' end as stateCode
from {supplier}
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _view(spark: SparkSession, sf_dir: str, text: str, name: str) -> DataFrame:
    return spark.sql(text, **{name: table(spark, sf_dir, name)})


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, OBS, "lineitem")


def crop_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, CROPS, "orders")


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, STATIONS, "supplier")


def counties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, COUNTIES, "supplier")
