"""The checks run on one layer, as a dictionary of lazy frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from tillroll.operators import audit, dedup


def audit_layer(
    df: DataFrame,
    partition: dict[str, Column | str],
    day: Column,
    keys: list[str],
    sums: dict[str, Column | str],
    store: dict[str, Column | str] | None = None,
    source_file: Column | str | None = None,
) -> dict[str, DataFrame]:
    """Nothing runs until a frame of the result is used."""
    out = {
        "rows_per_partition": audit.count_by(df, **partition),
        "rows_per_day": audit.count_by(df, day=day),
        "range": audit.range_profile(df, day),
        "totals_per_day": audit.control_totals(df, {"day": day}, sums),
        "duplicate_keys": dedup.duplicate_keys(df, keys),
        "missing_days": audit.missing_days(df, day),
        "columns": audit.column_profile(df),
    }
    if store is not None:
        out["totals_per_store"] = audit.control_totals(df, store, sums)
    if source_file is not None:
        out["rows_per_file"] = audit.count_by(df, source_file=source_file, **partition)
    return out
