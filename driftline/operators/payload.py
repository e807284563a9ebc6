"""The layout of a row that is sent: metadata, key, values, then what is known of its cells and its log entry."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from driftline.functions.binary import hex_lower, without_salt


def payload(
    rows: DataFrame,
    namespace: str,
    qualifier: str,
    keys: list[str],
    columns: list[str],
    families: str | None = None,
    rowkey: str | None = None,
    salt: int = 0,
) -> DataFrame:
    """rows (of rows_of()) as they are sent, in this order of columns:

    _table, _namespace, _qualifier, _cf, _cells_total if `families` (a comma list) is given; keys; columns; _cells_cf
    with the metadata; _event_ts; _delete, 1 or null; _rowkey in "hex" or "base64", without its salt; _wal_seq and
    _wal_write_time where rows have them, null below 0. What a row has no value for is null, which JSON lines leave out.
    """
    named = qualifier if namespace.lower() == "default" else f"{namespace}:{qualifier}"
    meta = {"_table": named, "_namespace": namespace, "_qualifier": qualifier, "_cf": families} if families is not None else {}
    out = [F.lit(v).alias(c) for c, v in meta.items()]
    out += [F.col("_cells_total")] if meta else []
    out += [F.col(c) for c in (*keys, *(c for c in columns if c not in keys))]
    out += [F.col("_cells_cf")] if meta and "_cells_cf" in rows.columns else []
    out += [F.col("_event_ts"), F.when(F.col("_delete"), 1).alias("_delete")]
    if rowkey:
        key = without_salt(F.col("rowkey"), salt)
        out.append((F.base64(key) if rowkey == "base64" else hex_lower(key)).alias("_rowkey"))
    out += [F.when(F.col(c) >= 0, F.col(c)).alias(c) for c in ("_wal_seq", "_wal_write_time") if meta and c in rows.columns]
    return rows.select(out)
