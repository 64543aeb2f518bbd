"""Plot map, and lookups of many requests at once.

The joins carry no broadcast hint.  Spark broadcasts a side when its measured size is under the session's threshold
and shuffles both sides otherwise, so the plan also holds when a dimension grows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from treeledger.functions.keys import with_keys
from treeledger.operators.order import keep_last
from treeledger.schema import ELEMENT_FIELDS, KEY


def plot_projects(plots_projects: DataFrame) -> DataFrame:
    """One row per plot name (ignoring case): k_plot, PLOT_ID, PLOT_NAME, PROJECT_ID.

    A PLOT_ID keeps the values of its last row but the position of its first one; among plots of equal name the one at
    the highest position wins.  The row order is in ``ord``.
    """
    by_id = plots_projects.groupBy("PLOT_ID").agg(
        F.max_by(F.struct("PROJECT_ID", "PLOT_NAME"), "ord").alias("last"), F.min("ord").alias("first_ord")
    )
    by_name = by_id.groupBy(F.upper("last.PLOT_NAME").alias("k_plot")).agg(
        F.max_by(F.struct("PLOT_ID", "last.PLOT_NAME", "last.PROJECT_ID"), "first_ord").alias("p")
    )
    return by_name.select("k_plot", "p.PLOT_ID", "p.PLOT_NAME", "p.PROJECT_ID")


def plot_map(plots_projects: DataFrame, plots: DataFrame) -> DataFrame:
    """:func:`plot_projects` with LOCATION_ID, which is null for a plot that is not in ``plots``.

    ``plots`` may repeat an ID only if it carries the row order in ``ord``, and then its last row counts.
    """
    if "ord" in plots.columns:
        plots = keep_last(plots, ["ID"], ["ord"])
    places = plots.select(F.col("ID").alias("PLOT_ID"), "LOCATION_ID")
    return plot_projects(plots_projects).join(places, "PLOT_ID", "left").select(
        "k_plot", "PLOT_ID", "PLOT_NAME", "PROJECT_ID", "LOCATION_ID"
    )


def lookup_plots(requests: DataFrame, plots_by_name: DataFrame) -> DataFrame:
    """Plot data for each ``requested_plot``; nulls when there is no such plot."""
    return requests.withColumn("k_plot", F.upper("requested_plot")).join(plots_by_name, "k_plot", "left").drop("k_plot")


def surviving(master: DataFrame, order: list[str]) -> DataFrame:
    """The master as it is seen by key: the last row of each key."""
    return keep_last(with_keys(master), KEY, order)


def surviving_among(master: DataFrame, keys: DataFrame, order: list[str]) -> DataFrame:
    """:func:`surviving` for the given keys only.

    The semi-join comes first, so a few keys against a large master cost one pass over it and no shuffle of it.
    """
    return keep_last(with_keys(master).join(keys.select(*KEY).distinct(), KEY, "left_semi"), KEY, order)


def lookup_elements(requests: DataFrame, master: DataFrame, order: list[str]) -> DataFrame:
    """For each requested (PROJECT_ID, NAME, TYPE): whether it exists, its id and its parent id."""
    asked = with_keys(requests)
    found = surviving_among(master, asked, order).select(
        *KEY, F.col("ID").alias("found_id"), F.col("PARENT_ID").alias("found_parent_id")
    )
    return asked.join(found, KEY, "left").select(
        *requests.columns, F.col("found_id").isNotNull().alias("found"), "found_id", "found_parent_id"
    )


def lookup_by_id(requests: DataFrame, master: DataFrame, order: list[str]) -> DataFrame:
    """Element for each requested ``request_id``, ignoring case, among the rows that survive by key.

    An id that several keys share gives the key that was met first at the highest position.  Only the keys that ever
    carried a requested id are aggregated, so the master itself is not shuffled for a few requests.
    """
    asked = requests.withColumn("k_id", F.lower("request_id"))
    ids = asked.select("k_id").distinct()
    rows = with_keys(master).withColumn("k_id", F.lower("ID"))
    keys = rows.join(ids, "k_id", "left_semi").select(*KEY).distinct()
    rank = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    alive = (
        rows.join(keys, KEY, "left_semi")
        .groupBy(*KEY)
        .agg(F.max_by(F.struct("k_id", *ELEMENT_FIELDS), rank).alias("e"), F.min(rank).alias("met"))
        .select("e.*", "met")
    )
    found = keep_last(alive, ["k_id"], ["met"])
    return asked.join(found.select("k_id", *ELEMENT_FIELDS), "k_id", "left").select("request_id", *ELEMENT_FIELDS)
