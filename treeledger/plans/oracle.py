"""The same queries as plain SQL over the same tables, for checking results with another engine.

``VIEWS`` holds the stand-in inputs and the intermediate results as named queries.  :func:`complete` puts the ones that
a query needs in front of it.  The SQL is written for clarity (window functions over whole groups), not for size.
"""

from __future__ import annotations

import re

from treeledger.functions.names import SPACE_CLASS, WHITESPACE
from treeledger.plans import standins as S
from treeledger.plans.standins import tag, uid

SP = "'" + WHITESPACE + "'"
US = "chr(31)"


def strip(c: str) -> str:
    return f"trim({c}, {SP})"


def clean(c: str) -> str:
    return f"nullif({strip(c)}, '')"


def plot_name(code: str) -> str:
    pattern = "'^([A-Za-z])([0-9]+)([A-Za-z]?)$'"
    parts = f"upper(regexp_extract({code}, {pattern}, 1))||'-'||regexp_extract({code}, {pattern}, 2)||lower(regexp_extract({code}, {pattern}, 3))"
    return f"case when regexp_matches({code}, {pattern}) then {parts} end"


def unprefix(c: str) -> str:
    return rf"regexp_replace({c}, '^[Bb][Oo]?[0-9]+-([^\n]+)$', '\1')"


FOLDER_PLOT = plot_name(strip("split_part(folder_name, '-', 1)"))
STRICT = rf"'^([A-Z])([0-9]+)([a-z]){SPACE_CLASS}*-{SPACE_CLASS}*[^\n]+$'"
STRICT_IN = strip("folder_name")
FOLDER_PLOT_STRICT = (
    f"case when regexp_matches({STRICT_IN}, {STRICT}) then regexp_extract({STRICT_IN}, {STRICT}, 1)||'-'||"
    f"regexp_extract({STRICT_IN}, {STRICT}, 2)||regexp_extract({STRICT_IN}, {STRICT}, 3) end"
)
FILE_BLOCK = "'BL'||nullif(regexp_extract(file_name, '-BL([0-9]+)-', 1, 'i'), '')"
FILE_PLOT = plot_name("regexp_extract(file_name, '-([A-Z][0-9]+[a-z]?)-BL', 1, 'i')")


def key_id(kind: str, project: str, name: str, *more: str) -> str:
    seed = f"||{US}||".join([f"upper({kind})", f"lower({project})", f"upper({name})", *[f"cast({m} as string)" for m in more]])
    return uid(seed)


OCCURRENCE = ["folder_name", "file_name", "row_idx", "col_idx"]

VIEWS: dict[str, str] = {
    "nation_files": f"select n_nationkey as nk, n_regionkey as rk, {S.NATION_FOLDER} as folder_name, {S.NATION_FILE} as file_name from nation",
    "files": f"""select folder_name, file_name from nation_files
      union all select {S.CUSTOMER_FOLDER}, {S.CUSTOMER_FILE} from customer""",
    "nation_orders": f"""select n_nationkey, n_regionkey, o_orderkey, {S.TABLE_RAW} as table_raw, {S.INVERTER_RAW} as inverter_raw
      from orders join customer on o_custkey=c_custkey join nation on c_nationkey=n_nationkey""",
    "sheet_rows": f"""select {S.NATION_FOLDER} as folder_name, {S.NATION_FILE} as file_name,
      1 + row_number() over (partition by n_nationkey order by o_orderkey) as row_idx, table_raw, inverter_raw from nation_orders""",
    "sheet_cells": f"""select folder_name, file_name, 'DWG Data' as sheet_name, row_idx, 1 as col_idx, table_raw as value from sheet_rows where table_raw is not null
      union all select folder_name, file_name, 'DWG Data', row_idx, 2, inverter_raw from sheet_rows where inverter_raw is not null
      union all select folder_name, file_name, 'DWG Data', 1, 1, '{S.HEADER[0]}' from nation_files
      union all select folder_name, file_name, 'DWG Data', 1, 2, '{S.HEADER[1]}' from nation_files""",
    "workbook_all": f"""select folder_name, file_name, 1 + row_number() over (partition by folder_name, file_name order by o_orderkey) as row_idx,
        table_raw, inverter_raw, is_bad
      from (select {S.NATION_FOLDER} as folder_name, {S.WORKBOOK_FILE} as file_name, o_orderkey, table_raw, inverter_raw, {S.BAD_ROW} as is_bad
            from (select *, o_orderkey//{S.CHUNK} as chunk from nation_orders))""",
    "workbook_bad": "select folder_name, file_name, min(row_idx) as bad_idx from workbook_all where is_bad group by all",
    "workbook_rows": """select w.folder_name, w.file_name, row_idx, nullif(table_raw, '') as table_raw, nullif(inverter_raw, '') as inverter_raw
      from workbook_all w left join workbook_bad b using (folder_name, file_name) where bad_idx is null or row_idx < bad_idx""",
    "plots_projects": f"""select 0 as ord, {uid("'pp|stale'")} as ID, {uid("'project|stale'")} as PROJECT_ID, {uid("'plot|stale'")} as PLOT_ID, 'b-13A' as PLOT_NAME
      union all select 10+r_regionkey, {tag('pp', 'r_regionkey')}, {tag('project', 'r_regionkey')}, {tag('plot', 'r_regionkey')}, {S.MAPPED_REGION} from region
      union all select 100+s_suppkey, {tag('pp|s', 's_suppkey')}, {S.SUPPLIER_PROJECT}, {uid(S.S_PLOT_SEED)}, {S.SUPPLIER_NAME} from supplier""",
    "plots": f"""select r_regionkey as ord, {S.PLOT_OF_REGION} as ID, {uid("'location|0'")} as LOCATION_ID, {S.REGION_NAME} as NAME, '' as DESIGN_ELEMENT_ID from region
      union all select 100+s_suppkey, {S.PLOT_OF_SUPPLIER}, {tag('location', 's_suppkey%13')}, {S.SUPPLIER_NAME}, '' from supplier""",
    "targets": f"select {tag('project', 'r_regionkey')} as PROJECT_ID, {S.REGION_NAME} as PLOT_NAME from region",
    "design_elements": f"""select cast(r_regionkey as bigint) as ord, {S.MASTER_PLOT_ID} as ID, {tag('project', 'r_regionkey')} as PROJECT_ID,
        {S.MASTER_PLOT_NAME} as NAME, 'PLOT' as TYPE, '' as PARENT_ID from region
      union all select 100+n_nationkey, {tag('m|BLOCK', 'n_nationkey')}, {tag('project', 'n_regionkey')}, 'BL'||lpad(cast(n_nationkey as string),2,'0'), {S.MASTER_BLOCK_TYPE}, {tag('m|PLOT', 'n_regionkey')}
        from nation
      union all select 1000+c_custkey, {S.MASTER_LEAF_ID}, upper({tag('project', 'n_regionkey')}), {S.MASTER_LEAF_NAME}, {S.MASTER_LEAF_TYPE}, {tag('m|BLOCK', 'n_nationkey')}
        from customer join nation on c_nationkey=n_nationkey""",
    "bad_elements": f"""select {tag('bad', 's_suppkey')} as ID, {uid("'project|0'")} as PROJECT_ID, 'bad '||cast(s_suppkey as string) as NAME, {S.BAD_TYPE} as TYPE, {S.BAD_PARENT} as PARENT_ID
      from supplier""",
    "numbered_lines": "select row_number() over (order by ord) as rn, ID||','||PROJECT_ID||','||NAME||','||TYPE||','||PARENT_ID as line from design_elements",
    "raw_lines": """select rn as line_no, case when rn%20=0 and nxt is not null then line||nxt else line end as value
      from (select rn, line, lead(line) over (order by rn) as nxt from numbered_lines) where rn=1 or rn%20<>1""",
    "plot_ids": """select PLOT_ID, PROJECT_ID, PLOT_NAME, min(ord) over (partition by PLOT_ID) as first_ord,
      row_number() over (partition by PLOT_ID order by ord desc) as back from plots_projects""",
    "plot_map": """select k_plot, p.PLOT_ID, PLOT_NAME, PROJECT_ID, LOCATION_ID
      from (select upper(PLOT_NAME) as k_plot, *, row_number() over (partition by upper(PLOT_NAME) order by first_ord desc) as rn from plot_ids where back=1) p
      left join (select ID, LOCATION_ID, row_number() over (partition by ID order by ord desc) as back from plots) l on l.ID=p.PLOT_ID and l.back=1
      where rn=1""",
    "named_files": f"select folder_name, file_name, {FOLDER_PLOT} as plot_name, {FILE_PLOT} as file_plot_name, {FILE_BLOCK} as block_name from files",
    "usable": """select f.*, m.PROJECT_ID from named_files f join plot_map m on upper(f.plot_name)=m.k_plot
      where m.PROJECT_ID <> '' and block_name is not null""",
    "file_errors": """select case when f.plot_name is null then 'folder_name' when m.PROJECT_ID is null then 'no_project' when block_name is null then 'no_block'
          when coalesce(upper(f.plot_name)<>upper(file_plot_name), true) then 'plot_mismatch' end as kind, f.folder_name, f.file_name
      from named_files f left join (select * from plot_map where PROJECT_ID <> '') m on upper(f.plot_name)=m.k_plot""",
    "extraction_errors": """select distinct kind, folder_name, cast(null as string) as file_name from file_errors where kind in ('folder_name','no_project')
      union all select kind, folder_name, file_name from file_errors where kind in ('no_block','plot_mismatch')""",
    "cells": f"""select folder_name, file_name, row_idx, 1 as col_idx, 'TABLE' as TYPE, {unprefix(clean('table_raw'))} as NAME from sheet_rows where {clean('table_raw')} is not null
      union all select folder_name, file_name, row_idx, 2, 'INVERTER', {unprefix(clean('inverter_raw'))} from sheet_rows where {clean('inverter_raw')} is not null""",
    "leaves": f"""select c.*, m.PROJECT_ID from (select *, {FOLDER_PLOT} as plot_name, {FILE_BLOCK} as block_name from cells) c
      join plot_map m on upper(c.plot_name)=m.k_plot where m.PROJECT_ID <> '' and block_name is not null""",
    "survivors": """select * from (select *, row_number() over (partition by lower(PROJECT_ID), upper(NAME), upper(TYPE) order by ord desc) as back,
      min(ord) over (partition by lower(PROJECT_ID), upper(NAME), upper(TYPE)) as met from design_elements) where back=1""",
    "plot_elements": f"""select coalesce(s.ID, {key_id("'PLOT'", "u.PROJECT_ID", "u.plot_name")}) as ID, u.PROJECT_ID, u.plot_name as NAME, 'PLOT' as TYPE, '' as PARENT_ID,
        s.ID is null as is_new, folder_name, file_name
      from (select *, row_number() over (partition by lower(PROJECT_ID), upper(plot_name) order by folder_name, file_name) as rn from usable) u
      left join survivors s on lower(s.PROJECT_ID)=lower(u.PROJECT_ID) and upper(s.NAME)=upper(u.plot_name) and upper(s.TYPE)='PLOT' where rn=1""",
    "block_elements": f"""select coalesce(s.ID, {key_id("'BLOCK'", "u.PROJECT_ID", "u.block_name")}) as ID, u.PROJECT_ID, u.block_name as NAME, 'BLOCK' as TYPE, p.ID as PARENT_ID,
        s.ID is null as is_new, u.folder_name, u.file_name
      from (select *, row_number() over (partition by lower(PROJECT_ID), upper(block_name) order by folder_name, file_name) as rn from usable) u
      join plot_elements p on lower(p.PROJECT_ID)=lower(u.PROJECT_ID) and upper(p.NAME)=upper(u.plot_name)
      left join survivors s on lower(s.PROJECT_ID)=lower(u.PROJECT_ID) and upper(s.NAME)=upper(u.block_name) and upper(s.TYPE)='BLOCK' where rn=1""",
    "first_leaves": """select * from (select *, row_number() over (partition by lower(PROJECT_ID), upper(NAME), TYPE order by folder_name, file_name, row_idx, col_idx) as rn from leaves) where rn=1""",
    "new_leaves": f"""select {key_id('l.TYPE', 'l.PROJECT_ID', 'l.NAME')} as ID, l.PROJECT_ID, l.NAME, l.TYPE, b.ID as PARENT_ID, l.folder_name, l.file_name, l.row_idx, l.col_idx
      from first_leaves l join block_elements b on lower(b.PROJECT_ID)=lower(l.PROJECT_ID) and upper(b.NAME)=upper(l.block_name)
      where not exists (select 1 from survivors s where lower(s.PROJECT_ID)=lower(l.PROJECT_ID) and upper(s.NAME)=upper(l.NAME) and upper(s.TYPE)=l.TYPE)""",
    "all_leaves": f"""select {key_id('l.TYPE', 'l.PROJECT_ID', 'l.NAME', *['l.' + c for c in OCCURRENCE])} as ID, l.PROJECT_ID, l.NAME, l.TYPE, b.ID as PARENT_ID
      from leaves l join block_elements b on lower(b.PROJECT_ID)=lower(l.PROJECT_ID) and upper(b.NAME)=upper(l.block_name)""",
    "new_located": """select ID, PROJECT_ID, NAME, TYPE, PARENT_ID, folder_name, file_name, cast(0 as bigint) as row_idx, 0 as col_idx from plot_elements where is_new
      union all select ID, PROJECT_ID, NAME, TYPE, PARENT_ID, folder_name, file_name, 0, 1 from block_elements where is_new
      union all select ID, PROJECT_ID, NAME, TYPE, PARENT_ID, folder_name, file_name, row_idx, col_idx from new_leaves""",
    "new_elements": "select ID, PROJECT_ID, NAME, TYPE, PARENT_ID from new_located",
    "final_master": """select ID, PROJECT_ID, NAME, TYPE, PARENT_ID, -1 as batch_id, '' as folder_name, '' as file_name, ord as row_idx, 0 as col_idx from design_elements
      union all select ID, PROJECT_ID, NAME, TYPE, PARENT_ID, 0, folder_name, file_name, row_idx, col_idx from new_located""",
    "checked_elements": """select ID, PROJECT_ID, NAME, TYPE, PARENT_ID from new_elements
      union all select ID, PROJECT_ID, NAME, TYPE, PARENT_ID from bad_elements""",
    "new_issues": """select case when TYPE='PLOT' then 'plot_has_parent' when PARENT_ID='' then 'empty_parent' else 'parent_not_found' end as kind, TYPE, NAME, ID, PROJECT_ID, PARENT_ID
      from new_elements e where (TYPE='PLOT' and PARENT_ID<>'') or (TYPE in ('BLOCK','TABLE','INVERTER')
        and (PARENT_ID='' or not exists (select 1 from new_elements p where p.ID=e.PARENT_ID)))""",
    "headers": f"""select folder_name, file_name, sheet_name, row_idx, count(*) as n_cells from sheet_cells
      where row_idx <= 5 and {clean('value')} is not null group by all""",
    "samples": f"""select * from (select c.folder_name, c.file_name, c.sheet_name, c.col_idx, {clean('value')} as sample,
        row_number() over (partition by c.folder_name, c.file_name, c.sheet_name, c.col_idx order by row_idx) as rank
      from sheet_cells c join (select folder_name, file_name, sheet_name, count(*)+1 as start from headers group by all) h using (folder_name, file_name, sheet_name)
      where {clean('value')} is not null and row_idx >= start and row_idx < start+20 and col_idx <= 29) where rank <= 10""",
    "tagged": """select folder_name, file_name, sheet_name, col_idx, rank, sample,
      case when contains(sample,'R') and (contains(sample,'T') or contains(sample,'S')) then 'TABLE' when starts_with(sample,'I') or contains(sample,'-I') then 'INVERTER' end as tag from samples""",
    "line_fields": "select line_no, string_split(value, ',') as f from raw_lines",
    "missing": """select PARENT_ID, count(*) as n_blocks, min(ord) as first_ord, arg_min(PROJECT_ID, ord) as PROJECT_ID from design_elements
      where TYPE='BLOCK' and PARENT_ID<>'' and PARENT_ID not in (select ID from design_elements) group by PARENT_ID""",
    "restored": """select ord, ID, PROJECT_ID, NAME, TYPE, PARENT_ID from design_elements
      union all select (select max(ord)+1 from design_elements), PARENT_ID, PROJECT_ID, 'B-13a', 'PLOT', ''
        from (select * from missing order by n_blocks desc, first_ord limit 1)
        where PROJECT_ID<>'' and not exists (select 1 from design_elements where TYPE='PLOT' and NAME='B-13a')""",
}

# The workbooks hold only the nation files, so the incremental run is the extraction over them.
WORKBOOK_VIEWS = {
    "files": "select distinct folder_name, file_name from workbook_all",
    "sheet_rows": "select folder_name, file_name, row_idx, table_raw, inverter_raw from workbook_rows",
}

ELEMENT = "ID, PROJECT_ID, NAME, TYPE, PARENT_ID"
COUNTS = ", ".join(f"count(*) filter (TYPE='{t}') as n_{t.lower()}" for t in ("PLOT", "BLOCK", "TABLE", "INVERTER"))
SHEET = "folder_name, file_name, sheet_name"


def _stats(created: str) -> str:
    known = "exists (select 1 from survivors s where lower(s.PROJECT_ID)=lower(u.PROJECT_ID) and upper(s.NAME)=upper(u.{}) and upper(s.TYPE)='{}')"
    counters = {
        "plots_processed": "(select count(*) from usable)",
        "plots_created": "(select count(*) from plot_elements where is_new)",
        "plots_skipped": f"(select count(*) from usable u where {known.format('plot_name', 'PLOT')})",
        "blocks_processed": "(select count(*) from usable)",
        "blocks_created": "(select count(*) from block_elements where is_new)",
        "blocks_skipped": f"(select count(*) from usable u where {known.format('block_name', 'BLOCK')})",
    }
    for level, kind in (("tables", "TABLE"), ("inverters", "INVERTER")):
        counters[f"{level}_extracted"] = f"(select count(*) from leaves where TYPE='{kind}')"
        counters[f"{level}_created"] = f"(select count(*) from {created} where TYPE='{kind}')"
        counters[f"{level}_skipped"] = f"{counters[f'{level}_extracted']}-{counters[f'{level}_created']}"
    inner = ", ".join(f"{sql} as {name}" for name, sql in counters.items())
    totals = ", ".join(
        f"cast({'+'.join(c for c in counters if c.endswith(w))} as bigint) as total_{w}" for w in ("extracted", "created", "skipped")
    )
    return f"select *, {totals} from (select {inner})"


def _row(i: int) -> str:
    return f"string_agg(value, '|' order by col_idx) filter (row_idx={i})"


BODIES: dict[str, str] = {
    "scan_sheet_files": "select distinct folder_name, file_name from workbook_all",
    "scan_sheet_rows": """select folder_name, file_name, row_idx, table_raw, inverter_raw, false as is_error from workbook_rows
      union all select folder_name, file_name, null, null, null, true from workbook_bad""",
    "scan_sheet_cells": f"""select folder_name, file_name, 'DWG Data' as sheet_name, true as is_active, row_idx, cast(1 as bigint) as col_idx, table_raw as value from workbook_all
      union all select folder_name, file_name, 'DWG Data', true, row_idx, 2, inverter_raw from workbook_all where inverter_raw is not null
      union all select folder_name, file_name, 'DWG Data', true, row_idx, 3, 'extra' from workbook_all where is_bad
      union all select folder_name, file_name, 'DWG Data', true, 1, 1, '{S.HEADER[0]}' from (select distinct folder_name, file_name from workbook_all)
      union all select folder_name, file_name, 'DWG Data', true, 1, 2, '{S.HEADER[1]}' from (select distinct folder_name, file_name from workbook_all)""",
    "load_plots_projects": "select ID, PROJECT_ID, PLOT_ID, PLOT_NAME from plots_projects",
    "load_plots": """select ID, LOCATION_ID, NAME, DESIGN_ELEMENT_ID
      from (select *, row_number() over (partition by ID order by ord desc) as back from plots) where back=1""",
    "load_design_elements": f"select {ELEMENT} from survivors",
    "load_raw_elements": "select " + ", ".join(f"'  '||{c}||' '||chr(9) as {c}" for c in ELEMENT.split(", ")) + " from design_elements",
    "append_elements": f"select {ELEMENT} from design_elements union all select {ELEMENT} from new_elements",
    "snapshot_roundtrip": f"select ord, {ELEMENT} from design_elements",
    "staged_rewrite": f"select ord, {ELEMENT} from restored",
    "summary_long": """select 'total' as section, 'rows' as item, count(*) as n from design_elements
      union all select 'type', TYPE, count(*) from design_elements group by TYPE
      union all select 'target', PLOT_NAME||':'||measure, n from (
        select PLOT_NAME, 'n_total' as measure, count(e.ID) as n from targets t left join design_elements e using (PROJECT_ID) group by all
        union all select PLOT_NAME, 'n_'||lower(k), count(e.ID) from targets t
          join (values ('PLOT'),('BLOCK'),('TABLE'),('INVERTER')) kinds(k) on true
          left join design_elements e on e.PROJECT_ID=t.PROJECT_ID and e.TYPE=k group by all)""",
    "plot_from_folder": f"select folder_name, file_name, {FOLDER_PLOT} as plot_name from files",
    "plot_from_folder_strict": f"select folder_name, file_name, {FOLDER_PLOT_STRICT} as plot_name from files",
    "block_from_file": f"select file_name, {FILE_BLOCK} as block_name from files",
    "plot_from_file": f"select file_name, {FILE_PLOT} as plot_name from files",
    "parse_paths": rf"""select 'c:\data\'||folder_name||'\'||file_name as path, folder_name, file_name,
      {FOLDER_PLOT_STRICT} as plot_name, {FILE_PLOT} as file_plot_name, {FILE_BLOCK} as block_name from files""",
    "clean_names": f"select file_name, row_idx, {unprefix('table_raw')} as name from sheet_rows",
    "classify_names": f"""select *, case when regexp_matches(name, '^I[0-9]+$', 'i') then 'INVERTER' else 'TABLE' end as type_or_default,
        case when regexp_matches(name, '^I[0-9]+$', 'i') then 'INVERTER' when regexp_matches(name, '^R[0-9]+-[ST][0-9]+$', 'i') then 'TABLE' end as type_or_null
      from (select file_name, row_idx, coalesce({unprefix(clean('inverter_raw'))}, {unprefix(clean('table_raw'))}, '?') as name from sheet_rows)""",
    "clean_cells": f"select file_name, row_idx, {clean('table_raw')} as table_cell, {clean('inverter_raw')} as inverter_cell from sheet_rows",
    "table_inverter_pairs": f"select file_name, row_idx, {unprefix(clean('table_raw'))} as table_name, {unprefix(clean('inverter_raw'))} as inverter_name from sheet_rows",
    "validate_names": """select name, regexp_matches(name, '^[A-Z]-[0-9]+[a-z]$') as is_plot, regexp_matches(name, '^BL[0-9]+$', 'i') as is_block,
        regexp_matches(name, '^R[0-9]+-[ST][0-9]+$', 'i') as is_table, regexp_matches(name, '^I[0-9]+$', 'i') as is_inverter
      from (select plot_name as name from named_files union all select block_name from named_files union all select NAME from cells) where name is not null""",
    "element_keys": "select ID, lower(PROJECT_ID) as k_project, upper(NAME) as k_name, upper(TYPE) as k_type from design_elements",
    "element_ids": f"""select folder_name, file_name, row_idx, col_idx, {key_id('TYPE', 'PROJECT_ID', 'NAME')} as default_id,
      {key_id('TYPE', 'PROJECT_ID', 'NAME', *OCCURRENCE)} as occurrence_id, {key_id("'BLOCK'", 'PROJECT_ID', 'block_name')} as block_id from leaves""",
    "project_to_schema": "select ID, PROJECT_ID, NAME, TYPE, '' as PARENT_ID from design_elements",
    "project_labels": """select PROJECT_ID, coalesce(PLOT_NAME, substr(PROJECT_ID,1,8)||'...') as label, coalesce(PLOT_NAME, 'Unknown') as label_or_unknown, n
      from (select PROJECT_ID, count(*) as n from design_elements group by PROJECT_ID) left join targets using (PROJECT_ID)""",
    "plot_consistency": "select folder_name, file_name, plot_name, file_plot_name, coalesce(upper(plot_name)=upper(file_plot_name), false) as is_consistent from named_files",
    "elements_of_type": f"select ord, {ELEMENT} from design_elements where TYPE in ('PLOT','TABLE')",
    "target_elements": f"select ord, {ELEMENT} from design_elements where PROJECT_ID in (select PROJECT_ID from targets)",
    "find_by_name": f"select ord, {ELEMENT} from design_elements where NAME='R21-S3' and TYPE='TABLE'",
    "lookup_plots": f"""select request, requested_plot, PLOT_ID, PLOT_NAME, PROJECT_ID, LOCATION_ID
      from (select c_custkey as request, lower({S._code('c_custkey', S.C_FAMILY, '-')}) as requested_plot from customer) r left join plot_map m on upper(requested_plot)=m.k_plot""",
    "lookup_elements": f"""select r.*, s.ID is not null as found, s.ID as found_id, s.PARENT_ID as found_parent_id
      from (select c_custkey as request, {tag('project', 'n_regionkey')} as PROJECT_ID, lower({S.TABLE_NAME}) as NAME, 'Table' as TYPE
            from customer join nation on c_nationkey=n_nationkey) r
      left join survivors s on lower(s.PROJECT_ID)=lower(r.PROJECT_ID) and upper(s.NAME)=upper(r.NAME) and upper(s.TYPE)=upper(r.TYPE)""",
    "lookup_by_id": f"""select request_id, {ELEMENT} from (select upper({tag('m|TABLE', 'c_custkey')}) as request_id from customer) r
      left join (select *, row_number() over (partition by lower(ID) order by met desc) as rn from survivors) s on lower(s.ID)=lower(r.request_id) and s.rn=1""",
    "detect_glued_rows": "select line_no, value, cast(length(value)-length(replace(value, ',', '')) as bigint) as n_commas from raw_lines where length(value)-length(replace(value, ',', '')) > 5",
    "resolve_projects": "select folder_name, file_name, plot_name, PROJECT_ID from (select f.folder_name, f.file_name, f.plot_name, m.PROJECT_ID from named_files f join plot_map m on upper(f.plot_name)=m.k_plot where m.PROJECT_ID<>'')",
    "unresolved_folders": "select kind, folder_name from extraction_errors where kind in ('folder_name','no_project')",
    "plot_info": "select PLOT_ID, PLOT_NAME, PROJECT_ID, LOCATION_ID from plot_map",
    "new_only": """select folder_name, file_name, row_idx, col_idx, PROJECT_ID, TYPE, NAME from leaves l
      where not exists (select 1 from survivors s where lower(s.PROJECT_ID)=lower(l.PROJECT_ID) and upper(s.NAME)=upper(l.NAME) and upper(s.TYPE)=l.TYPE)""",
    "already_present": """select folder_name, file_name, row_idx, col_idx, PROJECT_ID, TYPE, NAME from leaves l
      where exists (select 1 from survivors s where lower(s.PROJECT_ID)=lower(l.PROJECT_ID) and upper(s.NAME)=upper(l.NAME) and upper(s.TYPE)=l.TYPE)""",
    "resolve_ids": f"""select folder_name, file_name, row_idx, col_idx, coalesce(s.ID, {key_id('l.TYPE', 'l.PROJECT_ID', 'l.NAME')}) as ID, s.ID is null as is_new
      from leaves l left join survivors s on lower(s.PROJECT_ID)=lower(l.PROJECT_ID) and upper(s.NAME)=upper(l.NAME) and upper(s.TYPE)=l.TYPE""",
    "assign_parents": """select l.folder_name, l.file_name, l.row_idx, l.col_idx, l.block_name, b.ID as PARENT_ID from leaves l
      join block_elements b on lower(b.PROJECT_ID)=lower(l.PROJECT_ID) and upper(b.NAME)=upper(l.block_name)""",
    "children_with_parent": """select c.PROJECT_ID, c.ID, c.NAME, c.TYPE, c.PARENT_ID, p.NAME as parent_name from new_elements c
      join new_elements p on p.ID=c.PARENT_ID where c.TYPE in ('TABLE','INVERTER')""",
    "sample_chain": """select p.ID as plot_id, p.NAME as plot_name, b.ID as block_id, b.NAME as block_name, t.ID as table_id, t.NAME as table_name, i.ID as inverter_id, i.NAME as inverter_name
      from (select 1) one left join lateral (select * from final_master where TYPE='PLOT' order by batch_id, folder_name, file_name, row_idx, col_idx limit 1) p on true
      left join lateral (select * from final_master where TYPE='BLOCK' and PARENT_ID=p.ID order by batch_id, folder_name, file_name, row_idx, col_idx limit 1) b on true
      left join lateral (select * from final_master where TYPE='TABLE' and PARENT_ID=b.ID order by batch_id, folder_name, file_name, row_idx, col_idx limit 1) t on true
      left join lateral (select * from final_master where TYPE='INVERTER' and PARENT_ID=b.ID order by batch_id, folder_name, file_name, row_idx, col_idx limit 1) i on true""",
    "element_paths": """select e.ID, e.PROJECT_ID, e.TYPE, concat_ws('/', g.NAME, p.NAME, e.NAME) as path,
        cast(1 + (p.ID is not null)::int + (g.ID is not null)::int as bigint) as depth
      from final_master e left join final_master p on p.ID=e.PARENT_ID and p.TYPE in ('PLOT','BLOCK')
      left join final_master g on g.ID=p.PARENT_ID and g.TYPE='PLOT' and p.TYPE='BLOCK'""",
    "compare_new_master": """select PROJECT_ID, TYPE, coalesce(n.n, 0) as n_new, coalesce(m.n, 0) as n_master, n.n is not null as in_new, m.n is not null as in_master
      from (select PROJECT_ID, TYPE, count(*) as n from new_elements group by all) n
      full join (select PROJECT_ID, TYPE, count(*) as n from design_elements group by all) m using (PROJECT_ID, TYPE)
      where PROJECT_ID in (select PROJECT_ID from targets)""",
    "dedupe_last": f"select ord, {ELEMENT} from survivors",
    "plot_map_last_wins": "select k_plot, PLOT_ID, PLOT_NAME, PROJECT_ID from plot_map",
    "dedupe_first": "select folder_name, file_name, row_idx, col_idx, PROJECT_ID, TYPE, NAME, block_name from first_leaves",
    "get_or_create_plots": f"select {ELEMENT}, is_new from plot_elements",
    "get_or_create_blocks": f"select {ELEMENT}, is_new from block_elements",
    "create_leaves": f"select {ELEMENT} from new_leaves",
    "create_leaves_allow_dups": f"select {ELEMENT} from all_leaves",
    "unpivot_leaves": "select folder_name, file_name, row_idx, col_idx, TYPE, NAME from cells",
    "extract_elements": f"select {ELEMENT} from new_elements",
    "extract_elements_allow_dups": f"select {ELEMENT} from new_elements where TYPE in ('PLOT','BLOCK') union all select {ELEMENT} from all_leaves",
    "new_elements_written": f"select {ELEMENT} from new_elements",
    "duplicate_keys": """select lower(PROJECT_ID) as k_project, upper(NAME) as k_name, TYPE as k_type, count(*) as n_rows, count(distinct block_name) as n_blocks
      from leaves group by 1, 2, 3 having count(*) > 1""",
    "run_stats": _stats("new_leaves"),
    "run_stats_allow_dups": _stats("all_leaves"),
    "run_status": """select *, case when n_errors>0 then 'errors' when n_warnings>0 then 'warnings' else 'ok' end as status
      from (select count(*) filter (kind='plot_mismatch') as n_warnings, count(*) filter (kind<>'plot_mismatch') as n_errors from extraction_errors)""",
    "workbook_errors": """select kind, folder_name, file_name from extraction_errors
      union all select 'sheet_error', folder_name, file_name from workbook_bad join usable using (folder_name, file_name)""",
    "rows_per_file": """select f.folder_name, f.file_name, count(r.row_idx) as n_rows, count(r.row_idx)=0 as is_empty
      from files f left join sheet_rows r using (folder_name, file_name) group by all""",
    "count_by_type": "select TYPE, count(*) as n from (select TYPE from design_elements union all select TYPE from new_elements) group by TYPE",
    "count_by_project": "select PROJECT_ID, count(*) as n from new_elements group by PROJECT_ID",
    "project_type_matrix": f"select PROJECT_ID, {COUNTS}, count(*) filter (TYPE in ('PLOT','BLOCK','TABLE','INVERTER')) as n_total from new_elements group by PROJECT_ID",
    "target_summary": f"""select t.PROJECT_ID, PLOT_NAME, count(e.ID) as n_total, {COUNTS} from targets t
      left join (select {ELEMENT} from design_elements union all select {ELEMENT} from new_elements) e on e.PROJECT_ID=t.PROJECT_ID group by t.PROJECT_ID, PLOT_NAME""",
    "block_breakdown": """select c.PROJECT_ID, p.NAME as block_name, count(*) filter (c.TYPE='TABLE') as n_table, count(*) filter (c.TYPE='INVERTER') as n_inverter, count(*) as n_total
      from new_elements c join new_elements p on p.ID=c.PARENT_ID where c.TYPE in ('TABLE','INVERTER') group by c.PROJECT_ID, p.NAME""",
    "lookup_stats": """select (select count(*) from plot_map) as n_plots, count(*) as n_keys, count(distinct PROJECT_ID) as n_projects,
      count(distinct lower(PROJECT_ID)) as n_projects_nocase, count(distinct lower(ID)) as n_ids from survivors""",
    "project_element_sets": "select distinct PROJECT_ID, ID from survivors",
    "reconcile_append": """select n_before, n_added, n_before+n_added as n_expected, n_after, n_after-n_before-n_added as difference, n_after=n_before+n_added as passed
      from (select (select count(*) from design_elements) as n_before, (select count(*) from new_elements) as n_added,
            (select count(*) from (select ID from design_elements union all select ID from new_elements)) as n_after)""",
    "plot_presence": """select PROJECT_ID, PLOT_NAME, n_found, n_found > 0 as is_present, case when sum(n_found) over () = count(*) over () then 'REUSE' else 'CREATE' end as advice,
        cast(count(*) over () - sum(n_found) over () as bigint) as n_to_create
      from (select t.PROJECT_ID, t.PLOT_NAME, count(e.ID) as n_found from targets t left join design_elements e on e.PROJECT_ID=t.PROJECT_ID and e.TYPE='PLOT' group by all)""",
    "new_plots": "select ID, PROJECT_ID, NAME, count(*) over () as n_new from plot_elements where is_new",
    "issue_summary": "select kind, count(*) as n from (select kind from extraction_errors union all select kind from new_issues) group by kind",
    "extraction_errors": "select kind, folder_name, file_name from extraction_errors",
    "hierarchy_issues": "select * from new_issues",
    "hierarchy_issues_full": f"""select case when TYPE='PLOT' then 'plot_has_parent' when PARENT_ID='' then 'empty_parent' else 'parent_not_found' end as kind, TYPE, NAME, ID, PROJECT_ID, PARENT_ID
      from checked_elements e where (TYPE='PLOT' and PARENT_ID<>'') or (TYPE in ('BLOCK','TABLE','INVERTER') and (PARENT_ID='' or PARENT_ID not in (select ID from checked_elements union all select ID from design_elements)))""",
    "master_issues": """select case when PARENT_ID='' then 'empty_parent' else 'parent_not_found' end as kind, TYPE, NAME, ID, PROJECT_ID, PARENT_ID from design_elements
      where TYPE in ('BLOCK','TABLE','INVERTER') and PARENT_ID not in (select ID from design_elements)""",
    "first_issues": "select *, greatest((select count(*) from new_issues)-10, 0) as n_more from new_issues order by kind, TYPE, NAME, ID limit 10",
    "sheet_profile": f"""select *, count(distinct header) over (partition by folder_name) = 1 as same_header
      from (select {SHEET}, max(row_idx) as max_row, cast(max(col_idx) as bigint) as max_col, {_row(1)} as header,
              {", ".join(f"coalesce({_row(i)}, '') as row_{i}" for i in (2, 3, 4, 5))} from sheet_cells group by {SHEET})""",
    "header_candidates": "select * from headers",
    "column_patterns": f"""select {SHEET}, cast(col_idx as bigint) as col_idx, bool_or(contains(sample,'R') and contains(sample,'T')) as has_table,
        bool_or(starts_with(sample,'I') or contains(sample,'-I')) as has_inverter, bool_or(contains(sample,'B') and contains(sample,'-')) as has_block,
        count(*) as n_samples, count(*) filter (tag='TABLE') as n_table_tags, count(*) filter (tag='INVERTER') as n_inverter_tags from tagged group by all""",
    "column_headers": f"""select {SHEET}, cast(col_idx as bigint) as col_idx,
        coalesce(string_agg({strip('value')}, ' | ' order by row_idx) filter (row_idx <= 3 and value <> ''), 'Col'||cast(col_idx as string)) as header
      from sheet_cells where col_idx <= 29 group by {SHEET}, col_idx""",
    "column_samples": f"select {SHEET}, col_idx, rank, sample, tag from tagged",
    "sheet_head": f"""select {SHEET}, row_idx, cast(col_idx as bigint) as col_idx, case when length(value)>30 then substr(value,1,27)||'...' else value end as value
      from sheet_cells where row_idx<=10 and col_idx<=19""",
    "file_audit": "select folder_name, file_name, plot_name, file_plot_name, block_name, coalesce(upper(plot_name)=upper(file_plot_name), false) as is_consistent, plot_name||'/'||block_name as hierarchy from named_files",
    "files_top2": """select folder_name, rank, file_name, greatest(total-2, 0) as n_more
      from (select *, row_number() over (partition by folder_name order by file_name) as rank, count(*) over (partition by folder_name) as total from files) where rank<=2""",
    "repair_glued_rows": """select line_no, cast(0 as bigint) as part, f[1] as ID, f[2] as PROJECT_ID, f[3] as NAME, f[4] as TYPE, case when len(f)=9 then left(f[5], length(f[5])-36) else f[5] end as PARENT_ID from line_fields
      union all select line_no, 1, right(f[5], 36), f[6], f[7], f[8], f[9] from line_fields where len(f)=9""",
    "truncate_glued_rows": "select line_no, f[1] as ID, f[2] as PROJECT_ID, f[3] as NAME, f[4] as TYPE, f[5] as PARENT_ID from line_fields",
    "repair_glued_file": f"select {ELEMENT} from design_elements",
    "missing_parents": "select * from missing",
    "restore_missing_plot": "select * from restored",
    "verify_repair": """select count(*) as n_rows, count(*) filter (is_it) as n_found, min(PROJECT_ID) filter (is_it) as PROJECT_ID, min(NAME) filter (is_it) as NAME,
        min(TYPE) filter (is_it) as TYPE, min(PARENT_ID) filter (is_it) as PARENT_ID
      from (select *, ID = (select min(ID) from restored where NAME='B-13a' and TYPE='PLOT') as is_it from restored)""",
    "extract_workbooks": f"select {ELEMENT} from new_elements",
    "workbook_run_stats": _stats("new_leaves"),
    "workbook_run_status": """select *, case when n_errors>0 then 'errors' when n_warnings>0 then 'warnings' else 'ok' end as status
      from (select count(*) filter (kind='plot_mismatch') as n_warnings, count(*) filter (kind<>'plot_mismatch') as n_errors
        from (select kind from extraction_errors union all select 'sheet_error' from workbook_bad join usable using (folder_name, file_name)))""",
    "append_report_reconciliation": """select n_before, n_added, n_before+n_added as n_expected, n_before+n_added as n_after, cast(0 as bigint) as difference, true as passed
      from (select (select count(*) from design_elements) as n_before, (select count(*) from new_elements) as n_added)""",
    "append_report_by_type": "select TYPE, count(*) as n from new_elements group by TYPE",
    "append_report_issues": "select * from new_issues",
    "repair_and_publish": f"select ord, {ELEMENT} from restored",
    "incremental_extract": f"select {ELEMENT} from new_elements",
    "incremental_errors": f"""select kind, folder_name, file_name from extraction_errors
      union select 'sheet_error', folder_name, file_name from workbook_bad join usable using (folder_name, file_name)
      union select 'sheet_error', {S.ODD_FOLDER}, {S.ODD_FILE} from nation where n_nationkey%3<2 and n_regionkey<4
      union select 'plot_mismatch', {S.ODD_FOLDER}, {S.ODD_FILE} from nation where (n_nationkey%3=1 or n_nationkey%3=0 and n_nationkey%7=0) and n_regionkey<4
      union select 'folder_name', {S.ODD_FOLDER}, null from nation where n_nationkey%3=2""",
    "append_then_dedupe": "select ID||'-second' as ID, PROJECT_ID, NAME, TYPE, PARENT_ID, cast(1 as bigint) as batch_id from survivors",
}


def complete(body: str, views: dict[str, str] = VIEWS) -> str:
    """The query with the views that it needs, in order of definition."""
    needed: set[str] = set()

    def visit(sql: str) -> None:
        for name in set(re.findall(r"\w+", sql)) & set(views) - needed:
            needed.add(name)
            visit(views[name])

    visit(body)
    order = [n for n in views if n in needed]
    return "with " + ",\n".join(f"{n} as ({views[n]})" for n in order) + "\n" + body if order else body


def _for_workbooks() -> dict[str, str]:
    late = {n: sql for n, sql in VIEWS.items() if n not in ("files", "sheet_rows", "sheet_cells", "headers", "samples", "tagged")}
    names = list(late)
    at = names.index("workbook_rows") + 1
    return {n: late[n] for n in names[:at]} | WORKBOOK_VIEWS | {n: late[n] for n in names[at:]}


BODIES["append_report_matrix"] = BODIES["project_type_matrix"]
BODIES["append_report_blocks"] = BODIES["block_breakdown"]
BODIES["append_report_by_project"] = """select e.PROJECT_ID, coalesce(t.PLOT_NAME, substr(e.PROJECT_ID, 1, 8) || '...') as label,
  coalesce(t.PLOT_NAME, 'Unknown') as label_or_unknown, count(*) as n
  from new_elements e left join targets t on t.PROJECT_ID = e.PROJECT_ID group by e.PROJECT_ID, t.PLOT_NAME"""
BODIES["empty_folders"] = f"""select folder_name, case when {FOLDER_PLOT} is null then 'folder_name'
    when not exists (select 1 from plot_map m where m.k_plot = upper({FOLDER_PLOT}) and m.PROJECT_ID <> '') then 'no_project'
    else 'no_files' end as kind
  from (select {S.REGION_CODE.replace('n_regionkey', 'r_regionkey')} - 0 MW' as folder_name from region union all select '_empty'||cast(r_regionkey as string) from region)"""
BODIES["ledger_extract"] = BODIES["incremental_extract"]
BODIES["ledger_errors"] = BODIES["incremental_errors"]
OVER_WORKBOOKS = {
    "extract_workbooks", "workbook_run_stats", "workbook_run_status", "incremental_extract", "incremental_errors",
    "workbook_errors", "ledger_extract", "ledger_errors",
}
ORACLES = {name: complete(body, _for_workbooks() if name in OVER_WORKBOOKS else VIEWS) for name, body in BODIES.items()}
