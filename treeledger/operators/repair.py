"""Repair of damaged masters: glued lines and missing root rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from treeledger.operators.verify import without_row
from treeledger.schema import ELEMENT_FIELDS

ID_LENGTH = 36


def line_fields(line: Column) -> Column:
    """The fields of a comma-separated line.  Only a line with a quote pays for the quote-aware split."""
    quoted = F.split(line, r',(?=(?:[^"]*"[^"]*")*[^"]*\z)')
    unquoted = F.transform(
        quoted,
        lambda f: F.when(
            f.startswith('"') & f.endswith('"') & (F.length(f) > 1),
            F.replace(F.substring(f, F.lit(2), F.length(f) - 2), F.lit('""'), F.lit('"')),
        ).otherwise(f),
    )
    return F.when(line.contains('"'), unquoted).otherwise(F.split(line, ","))


def glued_lines(lines: DataFrame) -> DataFrame:
    """Physical lines (line_no, value) with more than five commas: records that were written without a line end."""
    commas = F.size(F.split("value", ",")) - 1
    return lines.withColumn("n_commas", commas.cast("bigint")).where("n_commas > 5")


def split_glued_lines(lines: DataFrame) -> DataFrame:
    """One row per record, with its place (line_no, part).

    Where two records meet, the parent id of the first and the id of the second share a field.  The id is the last 36
    characters of it; what stands before is the parent id, which may be empty.  Any number of records may be glued.
    """
    f = F.col("f")
    parts = F.sequence(F.lit(0), F.greatest(F.floor((F.size(f) - 2) / 4), F.lit(0)).cast("int"))

    def field(i: Column) -> Column:
        return F.coalesce(F.get(f, i), F.lit(""))

    def record(i: Column) -> Column:
        head, tail = field(i * 4), field(i * 4 + 4)
        is_last = i * 4 + 5 >= F.size(f)
        identifier = F.when(i == 0, head).otherwise(F.right(head, F.lit(ID_LENGTH)))
        parent = F.when(is_last, tail).otherwise(F.left(tail, F.length(tail) - ID_LENGTH))
        return F.struct(
            i.alias("part"),
            identifier.alias("ID"),
            field(i * 4 + 1).alias("PROJECT_ID"),
            field(i * 4 + 2).alias("NAME"),
            field(i * 4 + 3).alias("TYPE"),
            parent.alias("PARENT_ID"),
        )

    fielded = lines.select("line_no", line_fields(F.col("value")).alias("f"))
    return fielded.select("line_no", F.inline(F.transform(parts, record))).withColumn("part", F.col("part").cast("bigint"))


def truncate_glued_lines(lines: DataFrame) -> DataFrame:
    """Every line cut to five fields: the fifth keeps what was glued to it and the second record is lost."""
    f = line_fields(F.col("value"))
    return lines.select("line_no", *[F.coalesce(F.get(f, F.lit(i)), F.lit("")).alias(c) for i, c in enumerate(ELEMENT_FIELDS)])


def missing_parents(elements: DataFrame, order: str = "ord") -> DataFrame:
    """Parent ids that BLOCK rows name but no row has, with their block count and the project of the first such block."""
    blocks = elements.where("TYPE = 'BLOCK' and PARENT_ID <> ''")
    per_parent = blocks.groupBy("PARENT_ID").agg(
        F.count(F.lit(1)).alias("n_blocks"), F.min(order).alias("first_ord"), F.min_by("PROJECT_ID", order).alias("PROJECT_ID")
    )
    return without_row(per_parent, elements)


def restore_missing_plot(elements: DataFrame, name: str, order: str = "ord") -> DataFrame:
    """The elements plus the root row that was lost, or the elements unchanged.

    Nothing is added when a PLOT of exactly this name exists anywhere, when no parent is missing, or when the blocks of
    the chosen parent have no project.  The parent with the most blocks is taken, the first seen on a tie.
    """
    # A global aggregate leaves one row, whatever the number of missing parents.
    best = missing_parents(elements, order).agg(
        F.max_by(F.struct("PARENT_ID", "PROJECT_ID"), F.struct("n_blocks", (-F.col("first_ord")).alias("o"))).alias("b")
    )
    taken = elements.agg(
        F.count(F.when((F.col("TYPE") == "PLOT") & (F.col("NAME") == name), 1)).alias("n"), F.max(order).alias("last")
    )
    row = best.select(
        F.col("b.PARENT_ID").alias("ID"),
        F.col("b.PROJECT_ID").alias("PROJECT_ID"),
        F.lit(name).alias("NAME"),
        F.lit("PLOT").alias("TYPE"),
        F.lit("").alias("PARENT_ID"),
        taken.select("n").scalar().alias("n"),
        (taken.select("last").scalar() + 1).alias(order),
    )
    added = row.where("ID is not null and PROJECT_ID <> '' and n = 0")
    fields = [order, *ELEMENT_FIELDS]
    return elements.select(*fields).unionByName(added.select(*fields))


def verify_repair(elements: DataFrame, identifier: str) -> DataFrame:
    """Row count after a repair, and the repaired row (nulls when its id is still absent)."""
    fields = [f for f in ELEMENT_FIELDS if f != "ID"]
    hit = F.col("ID") == identifier
    return elements.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(F.when(hit, 1)).alias("n_found"),
        *[F.min(F.when(hit, F.col(f))).alias(f) for f in fields],
    )
