"""Stand-in inputs, derived by Spark from star-schema tables.

Region is a plot folder, nation a sheet file, order a sheet row.  Every customer is one more file, with an empty sheet
and an often untidy name, and every supplier is one more row of the plot map, so that each input grows with the tables.
The texts below are plain SQL expressions that any engine can evaluate.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from treeledger.operators.lookups import plot_map, plot_projects
from treeledger.operators.order import number_rows
from treeledger.plans.extract import Inputs, extract_located
from treeledger.schema import ELEMENT_FIELDS
from treeledger.sources.sheets import unpivot_cells
from treeledger.streaming.incremental import to_store


def uid(seed: str) -> str:
    """SQL text: a UUID-shaped digest of a SQL text expression."""
    h = f"md5({seed})"
    return "||'-'||".join(f"substr({h},{a},{n})" for a, n in [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)])


def tag(prefix: str, column: str) -> str:
    return uid(f"'{prefix}|'||cast({column} as string)")


REGION_LETTER = "substr('ABCDS', n_regionkey+1, 1)"
REGION_CODE = f"{REGION_LETTER}||lpad(cast(n_regionkey+12 as string),2,'0')||'a"
NATION_FOLDER = f"{REGION_CODE} - '||cast(50*(n_regionkey+1) as string)||' MW'"
NATION_STEM = f"'603C-LT Cable Routing'||case when n_nationkey%7=0 then ' ' else '-' end||{REGION_CODE}-BL'||lpad(cast(n_nationkey as string),2,'0')||'-R"
NATION_FILE = f"{NATION_STEM}0-30032025_DWGData.xlsx'"

# A family is 15,000 customers and 1,000 suppliers; plots and projects repeat inside a family only.
C_FAMILY = "cast(floor(c_custkey/15000) as int)"
S_FAMILY = "cast(floor(s_suppkey/1000) as int)"


def _code(key: str, family: str, dash: str = "") -> str:
    letter = f"substr('EFGHJ', cast({key}%5 as int)+1, 1)"
    number = f"cast(20+cast({key}%9 as int)+9*{family} as string)"
    return f"{letter}||'{dash}'||{number}||substr('abc', cast({key}%3 as int)+1, 1)"


C_CODE = _code("c_custkey", C_FAMILY)
C_NUMBER = f"cast(20+cast(c_custkey%9 as int)+9*{C_FAMILY} as string)"
C_LETTER = "substr('EFGHJ', cast(c_custkey%5 as int)+1, 1)"
CUSTOMER_FOLDER = f"""case cast(c_custkey%11 as int)
  when 0 then lower({C_LETTER})||{C_NUMBER}||upper(substr('abc', cast(c_custkey%3 as int)+1, 1))||'-x'
  when 1 then {C_LETTER}||{C_NUMBER}||' - x'
  when 2 then {C_LETTER}||'-'||{C_NUMBER}||'a - x'
  when 3 then chr(9)||{C_CODE}||' - 5 MW '
  when 4 then {C_CODE}
  when 5 then 'Archive'
  else {C_CODE}||' - 50 MW' end"""
CUSTOMER_FILE = f"""'603C-LT Cable Routing'||case when c_custkey%13=1 then ' ' else '-' end
  ||case when c_custkey%13=3 then 'Z99z' else {C_CODE} end
  ||case when c_custkey%13=0 then '' when c_custkey%13=2 then '-bl007'
         else '-BL'||cast(100+cast(c_custkey%40 as int)+40*{C_FAMILY} as string) end
  ||'-R'||cast(c_custkey as string)||'-30032025_DWGData.xlsx'"""
S_PLOT_SEED = f"'plot|s'||cast(cast((s_suppkey*7)%83 as int)+83*{S_FAMILY} as string)"
S_NAME = _code("s_suppkey", S_FAMILY, "-")
SUPPLIER_NAME = f"case when s_suppkey%9=4 then 'X-'||cast(s_suppkey as string)||'a' when s_suppkey%3=0 then lower({S_NAME}) else {S_NAME} end"
SUPPLIER_PROJECT = f"case when s_suppkey%31=0 then '' else {uid(f'''concat('project|s', cast(s_suppkey%7 as string), '|', cast({S_FAMILY} as string))''')} end"

TABLE_RAW = """case when o_orderkey%97=0 then '  '
  else case when o_orderkey%5=0 then 'BO' else 'B0' end||cast(n_nationkey as string)||'-R'||cast(o_custkey%60 as string)||'-S'||cast(o_orderkey%9 as string) end"""
INVERTER_RAW = "case when o_orderkey%10=0 then 'B0'||cast(n_nationkey as string)||'-I'||cast(o_custkey%48 as string)||' ' end"

# Generated workbooks hold at most this many order keys, so packing one never gathers more rows than that.
CHUNK = 4096
WORKBOOK_FILE = f"{NATION_STEM}'||lpad(cast(chunk as string),9,'0')||'-30032025_DWGData.xlsx'"
BAD_ROW = "o_orderkey%2003=1000"

ODD_FOLDER = f"case when n_nationkey%3=2 then '_odd'||cast(n_nationkey as string) else {NATION_FOLDER} end"
ODD_FILE = f"case when n_nationkey%3=0 then {NATION_STEM}9-odd.xlsx' else '_603C-Z99z-BL07-R'||cast(n_nationkey as string)||'.xlsx' end"

HEADER = ("MMS Table Names", "Inverter Names")
REGION_NAME = "substr('ABCDS', r_regionkey+1, 1)||'-'||cast(r_regionkey+12 as string)||'a'"
TABLE_NAME = "case when c_custkey%2=0 then 'r' else 'R' end||cast(c_custkey%60 as string)||'-S'||cast(c_custkey%9 as string)"

# The master, the plot map and the plots take every row of their tables; what a run should not find there has another
# name, type or id.
MAPPED_REGION = f"case when r_regionkey<4 then {REGION_NAME} else 'Q-'||cast(r_regionkey+12 as string)||'a' end"
PLOT_OF_REGION = f"case when r_regionkey<>2 then {tag('plot', 'r_regionkey')} else {tag('plot|none', 'r_regionkey')} end"
PLOT_OF_SUPPLIER = f"case when s_suppkey%4<>1 then {uid(S_PLOT_SEED)} else {tag('plot|none|s', 's_suppkey')} end"
MASTER_PLOT_ID = f"case when r_regionkey=0 then {tag('m|PLOT', 'r_regionkey')} else {tag('m|old plot', 'r_regionkey')} end"
MASTER_PLOT_NAME = f"case when r_regionkey=0 then {REGION_NAME} else 'Q-'||cast(r_regionkey+12 as string)||'a' end"
MASTER_BLOCK_TYPE = "case when n_regionkey in (0,1) and n_nationkey < 15 then 'BLOCK' else 'Old block' end"
LEAF_KIND = "cast(c_custkey%3 as int)"
MASTER_LEAF_ID = f"case {LEAF_KIND} when 0 then {tag('m|TABLE', 'c_custkey')} when 1 then {tag('m|INVERTER', 'c_custkey')} else {tag('m|old', 'c_custkey')} end"
MASTER_LEAF_NAME = f"case {LEAF_KIND} when 0 then {TABLE_NAME} when 1 then 'I'||cast(c_custkey%48 as string) else 'old '||{TABLE_NAME} end"
MASTER_LEAF_TYPE = f"case {LEAF_KIND} when 0 then 'TABLE' when 1 then 'INVERTER' else 'table' end"
# Elements with a wrong parent link, one of three kinds for each supplier.
BAD_TYPE = "case cast(s_suppkey%3 as int) when 0 then 'TABLE' when 1 then 'BLOCK' else 'PLOT' end"
BAD_PARENT = f"case cast(s_suppkey%3 as int) when 1 then '' else {tag('nowhere', 's_suppkey')} end"

# The columns that are used; a given schema saves a job that would read file footers.
SCHEMAS = {
    "region": "r_regionkey int",
    "nation": "n_nationkey int, n_regionkey int",
    "supplier": "s_suppkey bigint",
    "customer": "c_custkey bigint, c_nationkey int",
    "orders": "o_orderkey bigint, o_custkey bigint",
}


class Views:
    """The stand-in inputs for one data folder.  All are lazy."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def nation_files(self) -> DataFrame:
        return self.table("nation").selectExpr(
            "n_nationkey", "n_regionkey", f"{NATION_FOLDER} as folder_name", f"{NATION_FILE} as file_name"
        )

    @cached_property
    def files(self) -> DataFrame:
        customers = self.table("customer").selectExpr(f"{CUSTOMER_FOLDER} as folder_name", f"{CUSTOMER_FILE} as file_name")
        return self.nation_files.select("folder_name", "file_name").unionByName(customers)

    @cached_property
    def nation_orders(self) -> DataFrame:
        """Orders with the nation of their customer and the two raw cells."""
        customers = self.table("customer").selectExpr("c_custkey", "c_nationkey as n_nationkey")
        placed = self.table("orders").join(customers, F.col("o_custkey") == F.col("c_custkey"))
        return placed.selectExpr("n_nationkey", "o_orderkey", f"{TABLE_RAW} as table_raw", f"{INVERTER_RAW} as inverter_raw")

    @cached_property
    def sheet_rows(self) -> DataFrame:
        numbered = number_rows(self.nation_orders, ["n_nationkey"], "o_orderkey", "rn")
        return numbered.join(self.nation_files, "n_nationkey").selectExpr(
            "folder_name", "file_name", "1 + rn as row_idx", "table_raw", "inverter_raw"
        )

    @cached_property
    def sheet_cells(self) -> DataFrame:
        """Cells of the sheets, header row included."""
        header = self.nation_files.selectExpr(
            "folder_name", "file_name", "cast(1 as bigint) as row_idx",
            f"'{HEADER[0]}' as table_raw", f"'{HEADER[1]}' as inverter_raw",
        )
        return unpivot_cells(header.unionByName(self.sheet_rows), F.lit("DWG Data"))

    @cached_property
    def plots_projects(self) -> DataFrame:
        stale = self.spark.range(0, 1, 1, 1).selectExpr(
            "0 as ord", f"{uid(repr('pp|stale'))} as ID", f"{uid(repr('project|stale'))} as PROJECT_ID",
            f"{uid(repr('plot|stale'))} as PLOT_ID", "'b-13A' as PLOT_NAME",
        )
        regions = self.table("region").selectExpr(
            "10+r_regionkey as ord", f"{tag('pp', 'r_regionkey')} as ID", f"{tag('project', 'r_regionkey')} as PROJECT_ID",
            f"{tag('plot', 'r_regionkey')} as PLOT_ID", f"{MAPPED_REGION} as PLOT_NAME",
        )
        suppliers = self.table("supplier").selectExpr(
            "100+s_suppkey as ord", f"{tag('pp|s', 's_suppkey')} as ID", f"{SUPPLIER_PROJECT} as PROJECT_ID",
            f"{uid(S_PLOT_SEED)} as PLOT_ID", f"{SUPPLIER_NAME} as PLOT_NAME",
        )
        return stale.unionByName(regions).unionByName(suppliers)

    @cached_property
    def plots(self) -> DataFrame:
        regions = self.table("region").selectExpr(
            "r_regionkey as ord", f"{PLOT_OF_REGION} as ID", f"{uid(repr('location|0'))} as LOCATION_ID",
            f"{REGION_NAME} as NAME", "'' as DESIGN_ELEMENT_ID",
        )
        suppliers = self.table("supplier").selectExpr(
            "100+s_suppkey as ord", f"{PLOT_OF_SUPPLIER} as ID", f"{tag('location', 's_suppkey%13')} as LOCATION_ID",
            f"{SUPPLIER_NAME} as NAME", "'' as DESIGN_ELEMENT_ID",
        )
        return regions.unionByName(suppliers)

    @cached_property
    def targets(self) -> DataFrame:
        return self.table("region").selectExpr(f"{tag('project', 'r_regionkey')} as PROJECT_ID", f"{REGION_NAME} as PLOT_NAME")

    @cached_property
    def design_elements(self) -> DataFrame:
        plot = self.table("region").selectExpr(
            "cast(r_regionkey as bigint) as ord", f"{MASTER_PLOT_ID} as ID", f"{tag('project', 'r_regionkey')} as PROJECT_ID",
            f"{MASTER_PLOT_NAME} as NAME", "'PLOT' as TYPE", "'' as PARENT_ID",
        )
        nation = self.table("nation")
        blocks = nation.selectExpr(
            "100+n_nationkey as ord", f"{tag('m|BLOCK', 'n_nationkey')} as ID", f"{tag('project', 'n_regionkey')} as PROJECT_ID",
            "'BL'||lpad(cast(n_nationkey as string),2,'0') as NAME", f"{MASTER_BLOCK_TYPE} as TYPE", f"{tag('m|PLOT', 'n_regionkey')} as PARENT_ID",
        )
        customers = self.table("customer").select("c_custkey", "c_nationkey")
        tables = customers.join(nation.select("n_nationkey", "n_regionkey"), F.col("c_nationkey") == F.col("n_nationkey"))
        tables = tables.selectExpr(
            "1000+c_custkey as ord", f"{MASTER_LEAF_ID} as ID", f"upper({tag('project', 'n_regionkey')}) as PROJECT_ID",
            f"{MASTER_LEAF_NAME} as NAME", f"{MASTER_LEAF_TYPE} as TYPE", f"{tag('m|BLOCK', 'n_nationkey')} as PARENT_ID",
        )
        return plot.unionByName(blocks).unionByName(tables)

    @cached_property
    def raw_lines(self) -> DataFrame:
        """The master as text lines; at every twentieth line two records run together."""
        fields = F.concat_ws(",", *ELEMENT_FIELDS)
        lines = number_rows(self.design_elements.select("ord", fields.alias("line")), [], "ord", "rn").drop("ord")
        # Lines that meet are in the same group of twenty, so looking ahead needs no longer window.
        ahead = F.lead("line").over(W.partitionBy(F.floor(F.col("rn") / 20)).orderBy("rn"))
        glued = F.when((F.col("rn") % 20 == 0) & F.col("nxt").isNotNull(), F.concat("line", "nxt")).otherwise(F.col("line"))
        return (
            lines.withColumn("nxt", ahead)
            .where("rn = 1 or rn % 20 <> 1")
            .select(F.col("rn").alias("line_no"), glued.alias("value"))
        )

    @cached_property
    def plot_projects(self) -> DataFrame:
        return plot_projects(self.plots_projects)

    @cached_property
    def plot_map(self) -> DataFrame:
        return plot_map(self.plots_projects, self.plots)

    @cached_property
    def inputs(self) -> Inputs:
        return Inputs(self.files, self.sheet_rows, self.plot_projects, self.design_elements)

    @cached_property
    def new_located(self) -> DataFrame:
        return extract_located(self.inputs)

    @cached_property
    def new_elements(self) -> DataFrame:
        return self.new_located.select(*ELEMENT_FIELDS)

    @cached_property
    def bad_elements(self) -> DataFrame:
        """Elements with a wrong parent link."""
        return self.table("supplier").selectExpr(
            f"{tag('bad', 's_suppkey')} as ID", f"{uid(repr('project|0'))} as PROJECT_ID",
            "'bad '||cast(s_suppkey as string) as NAME", f"{BAD_TYPE} as TYPE", f"{BAD_PARENT} as PARENT_ID",
        )

    @cached_property
    def final_master(self) -> DataFrame:
        """The master with the new elements after it, in the order of the master table of an incremental run."""
        old = self.design_elements.withColumns(
            {"folder_name": F.lit(""), "file_name": F.lit(""), "row_idx": F.col("ord").cast("bigint"), "col_idx": F.lit(0)}
        )
        return to_store(old, -1).unionByName(to_store(self.new_located, 0))

    @cached_property
    def workbook_rows(self) -> DataFrame:
        """Rows of the generated workbooks: one workbook per nation and range of order keys."""
        chunked = self.nation_orders.withColumn("chunk", F.floor(F.col("o_orderkey") / CHUNK))
        return chunked.join(self.nation_files.drop("file_name"), "n_nationkey").selectExpr(
            "folder_name", f"{WORKBOOK_FILE} as file_name", "o_orderkey", "table_raw", "inverter_raw", f"{BAD_ROW} as is_bad"
        )

    @cached_property
    def odd_files(self) -> DataFrame:
        """Files that no run can use as workbooks: with ordinary names, with hidden names, in hidden folders."""
        return self.table("nation").selectExpr(
            f"{ODD_FOLDER} as folder_name", f"{ODD_FILE} as file_name", "cast('no workbook' as binary) as content"
        )

    @cached_property
    def plot_requests(self) -> DataFrame:
        return self.table("customer").selectExpr("c_custkey as request", f"lower({_code('c_custkey', C_FAMILY, '-')}) as requested_plot")

    @cached_property
    def element_requests(self) -> DataFrame:
        joined = self.table("customer").join(self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        return joined.selectExpr(
            "c_custkey as request", f"{tag('project', 'n_regionkey')} as PROJECT_ID", f"lower({TABLE_NAME}) as NAME", "'Table' as TYPE"
        )

    @cached_property
    def id_requests(self) -> DataFrame:
        return self.table("customer").selectExpr(f"upper({tag('m|TABLE', 'c_custkey')}) as request_id")
