"""From cells (one value of one column of one row) to whole rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.column import Column

ROW = ["entry_id", "rowkey"]


def rows_of(cells: DataFrame, columns: list[str], families: list[str] | None = None, strict: bool = False, more: list[Column] = ()) -> DataFrame:
    """entry_id, rowkey, the columns, _cells_total, _event_ts, _delete: one row for each key of an entry.

    The last cell of a column wins, by cell_index; delete markers count and carry a time, but no value. With
    families a row passes if any of its cells is of one, with all its cells, or with strict only those. `more` are
    further aggregates of a row's cells.
    """
    if strict and families:
        cells = cells.where(F.col("family").isin(families))
    value = lambda q: F.max_by(F.col("value"), F.when((F.col("qualifier") == q) & ~F.col("is_delete") & F.col("value").isNotNull(), F.col("cell_index"))).alias(q)
    passes = F.bool_or(F.col("family").isin(families)) if families else F.bool_or(F.lit(True))
    rows = cells.groupBy(*ROW).agg(*map(value, columns), F.count("*").alias("_cells_total"), F.max("cell_ts").alias("_event_ts"), F.bool_or("is_delete").alias("_delete"), *more, passes.alias("_passes"))
    return rows.where("_passes").drop("_passes")


def row_maps(cells: DataFrame) -> DataFrame:
    """entry_id, rowkey, values, _cells_total, _event_ts, _delete: one row for each key of an entry, whatever its columns.

    `values` maps each qualifier to the value of its last cell, as in rows_of(), in the order in which the row's columns
    first got a value; cells without one leave no key. Cells are dealt by row once; both aggregations use that.
    """
    has = ~F.col("is_delete") & F.col("value").isNotNull()
    columns = cells.repartition(*ROW).groupBy(*ROW, "qualifier").agg(
        F.min(F.when(has, F.col("cell_index"))).alias("first"),
        F.max_by("value", F.when(has, F.col("cell_index"))).alias("value"),
        F.count("*").alias("n"),
        F.max("cell_ts").alias("ts"),
        F.bool_or("is_delete").alias("gone"),
    )
    listed = F.sort_array(F.collect_list(F.when(F.col("first").isNotNull(), F.struct("first", "qualifier", "value"))))
    pairs = F.transform(listed, lambda c: F.struct(c["qualifier"], c["value"]))
    return columns.groupBy(*ROW).agg(
        F.map_from_entries(pairs).alias("values"),
        F.sum("n").alias("_cells_total"),
        F.max("ts").alias("_event_ts"),
        F.bool_or("gone").alias("_delete"),
    )


def metrics(cells: DataFrame, families: list[str]) -> DataFrame:
    """entries, rows, cells, filtered_rows of a batch; rows counts those sent and those filtered."""
    passes: Column = F.bool_or(F.col("family").isin(families))
    rows = cells.groupBy(*ROW).agg(F.count("*").alias("cells"), passes.alias("passes"))
    return rows.agg(F.countDistinct("entry_id").alias("entries"), F.count("*").alias("rows"), F.sum("cells").alias("cells"), F.sum(F.when(F.col("passes"), 0).otherwise(1)).alias("filtered_rows"))
