"""Fixed schemas of the data model.  Every persisted field is a string."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


ELEMENT_FIELDS = ["ID", "PROJECT_ID", "NAME", "TYPE", "PARENT_ID"]
PLOT_PROJECT_FIELDS = ["ID", "PROJECT_ID", "PLOT_ID", "PLOT_NAME"]
PLOT_FIELDS = ["ID", "LOCATION_ID", "NAME", "DESIGN_ELEMENT_ID"]

ELEMENT = _strings(*ELEMENT_FIELDS)
PLOT_PROJECT = _strings(*PLOT_PROJECT_FIELDS)
PLOT = _strings(*PLOT_FIELDS)
PROJECT = T.StructType(
    _strings("ID", "SPV_ID", "NAME", "TYPE", "CATEGORY").fields
    + [T.StructField("RFI_COUNT", T.IntegerType()), T.StructField("NC_COUNT", T.IntegerType())]
)

# Level names, root first; the last two are leaves of the tree.
TYPES = ["PLOT", "BLOCK", "TABLE", "INVERTER"]

# The order in which elements are met: folder, then file, then row, then column.
VISIT_ORDER = ["folder_name", "file_name", "row_idx", "col_idx"]
KEY = ["k_project", "k_name", "k_type"]
