"""The checks of one layer from one scan, kept by partition and rolled up.

One aggregate with two grouping sets reads the layer once: the finest cells (partition,
day, store, file), from which every count, range and total follows, and the rows per key,
from which the duplicates follow. Both are summed in every task before the shuffle, so
one pass replaces a scan for each check. All results are read from the stored cells.

For a layer in partitions the cells are stored by partition next to the number, size and
newest change of its files. A rerun compares these with the listing and scans only
partitions that are new or were written to; the rest is rolled up from what is stored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.parse import as_column
from tillroll.operators import audit
from tillroll.operators.sketch import column_sketches, estimated_profile, merge_sketches
from tillroll.session import cut_lineage
from tillroll.sources.partitions import partition_columns, partition_files, path_exists
from tillroll.sources.readers import read_files
from tillroll.sources.writers import overwrite_partitions

PART = "audit_part"
_STATE = ("n_files", "n_bytes", "changed")
_CELLS, _KEYS = 0, 1


@dataclass(frozen=True)
class AuditSpec:
    """What ``audit_layer`` takes, in one value."""

    partition: Mapping[str, Column | str]
    day: Column
    keys: tuple[str, ...]
    sums: Mapping[str, Column | str]
    store: Mapping[str, Column | str] = field(default_factory=dict)
    source_file: Column | str | None = None

    @cached_property
    def cell(self) -> dict[str, Column]:
        """The columns of the finest cells, named apart from the keys."""
        out = {f"p_{k}": as_column(c) for k, c in self.partition.items()}
        out["day"] = self.day
        out |= {f"s_{k}": as_column(c) for k, c in self.store.items()}
        if self.source_file is not None:
            out["source_file"] = as_column(self.source_file)
        return out

    @property
    def marks(self) -> list[str]:
        return [f"k_{k}" for k in self.keys]

    def digest(self) -> str:
        """Names the store of a spec: another spec gets another one."""
        parts = [*self.cell.items(), *self.keys, *self.sums.items()]
        return hashlib.sha256(repr(parts).encode()).hexdigest()[:16]


def audit_cells(df: DataFrame, spec: AuditSpec, by: Mapping[str, Column] | None = None) -> DataFrame:
    """(by, cell columns, key columns, part_of, n_rows, sums and how many they add up).

    ``part_of`` is 0 for a cell and 1 for a key, whose other columns are null. Lazy, and
    one scan of ``df``; cells of splits of a layer add up to those of the layer.
    """
    by = by or {}
    named = [c.alias(k) for k, c in {**by, **spec.cell}.items()]
    keys = [F.col(f"`{k}`").alias(m) for k, m in zip(spec.keys, spec.marks)]
    values = [as_column(c).alias(f"v_{k}") for k, c in spec.sums.items()]
    rows = df.select(*named, *keys, *values)
    sets = [[*by, *spec.cell], [*by, *spec.marks]]
    totals = [F.try_sum(f"v_{k}").alias(f"t_{k}") for k in spec.sums]
    counts = [F.count(f"v_{k}").alias(f"c_{k}") for k in spec.sums]
    # The first cell column (a key set has none of them) tells the sets apart.
    mark = F.grouping(next(iter(spec.cell))).cast("int").alias("part_of")
    columns = [*by, *spec.cell, *spec.marks]
    summed = rows.groupingSets(sets, *columns).agg(mark, F.count(F.lit(1)).alias("n_rows"), *totals, *counts)
    return summed.select(*columns, "part_of", "n_rows", *[f"{x}_{k}" for k in spec.sums for x in "tc"])


def audit_once(df: DataFrame, spec: AuditSpec) -> dict[str, DataFrame]:
    """The frames of ``audit_layer`` except the column profile, after one scan of ``df``."""
    return _frames(cut_lineage(_kept(audit_cells(df, spec), spec, split=False)), spec)


def _kept(cells: DataFrame, spec: AuditSpec, split: bool) -> DataFrame:
    """Without the keys that have one row, unless more may follow from another split."""
    return cells if split else cells.where((F.col("part_of") == _CELLS) | (F.col("n_rows") > 1))


def _frames(stored: DataFrame, spec: AuditSpec) -> dict[str, DataFrame]:
    cells = stored.where(F.col("part_of") == _CELLS)
    partition = {k: f"p_{k}" for k in spec.partition}

    n_rows = F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows")

    def rows_by(**names: str) -> DataFrame:
        keys = [F.col(c).alias(k) for k, c in names.items()]
        return cells.groupBy(*keys).agg(n_rows)

    def totals_by(**names: str) -> DataFrame:
        keys = [F.col(c).alias(k) for k, c in names.items()]
        return cells.groupBy(*keys).agg(n_rows, *[_total(stored, k) for k in spec.sums])

    days = cells.agg(F.min("day").alias("min_value"), F.max("day").alias("max_value"), n_rows)
    keys = stored.where(F.col("part_of") == _KEYS).groupBy(*[F.col(m).alias(k) for k, m in zip(spec.keys, spec.marks)])
    out = {
        "rows_per_partition": rows_by(**partition),
        "rows_per_day": rows_by(day="day"),
        "range": days,
        "totals_per_day": totals_by(day="day"),
        "duplicate_keys": keys.agg(n_rows).where("n_rows > 1"),
        "missing_days": audit.missing_days(cells, F.col("day")),
    }
    if spec.store:
        out["totals_per_store"] = totals_by(**{k: f"s_{k}" for k in spec.store})
    if spec.source_file is not None:
        out["rows_per_file"] = rows_by(source_file="source_file", **partition)
    return out


def _total(stored: DataFrame, name: str) -> Column:
    """The sum of sums in their type; one that left its type leaves the total null."""
    lost = F.max(F.col(f"t_{name}").isNull() & (F.col(f"c_{name}") > 0))
    whole = F.try_sum(f"t_{name}").try_cast(stored.schema[f"t_{name}"].dataType)
    return F.when(~lost, whole).alias(name)


# A layer in partitions ---------------------------------------------------------
def _part_name(columns: list[str]) -> Column:
    """A partition's folders as text; like the columns, known from the listing alone."""
    one = [F.concat(F.lit(f"{c}="), F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("(none)"))) for c in columns]
    return F.concat_ws("/", F.lit("in"), *one)


def _listed(spark: SparkSession, path: str) -> DataFrame:
    columns = partition_columns(spark, path)
    return partition_files(spark, path).select(_part_name(columns).alias(PART), *_STATE)


@dataclass(frozen=True)
class Audit:
    """The frames, and which partitions had to be scanned for them."""

    frames: dict[str, DataFrame]
    scanned: list[str]


def audit_partitions(spark: SparkSession, path: str, spec: AuditSpec, store: str, fmt: str = "parquet") -> Audit:
    """Audit the layer at ``path``, scanning only what changed since the last audit in ``store``.

    Frames are those of ``audit_once`` and, as ``columns``, the profile of all columns
    with estimated distinct counts, merged from a sketch for each partition (a second
    aggregate over the same partitions). The state of the files is taken before they are
    read, so a write in between is seen by the next run; a run that breaks off has stored
    nothing or whole partitions. Partitions that are gone drop out.

    Keys stay in the store with their counts, unless the partition columns are part of
    the key and duplicates cannot span partitions: then only duplicates stay.
    """
    root = f"{store.rstrip('/')}/{spec.digest()}"
    cell_path, profile_path = f"{root}/cells", f"{root}/columns"
    columns = partition_columns(spark, path)
    listed = cut_lineage(_listed(spark, path))
    held = read_files(spark, profile_path) if path_exists(spark, profile_path) else None
    # As many names as partitions changed; the first run takes the whole tree unfiltered.
    stale = listed if held is None else listed.join(held.select(PART, *_STATE).distinct(), [PART, *_STATE], "left_anti")
    names = sorted(r[0] for r in stale.select(PART).collect())
    if names or held is None:
        layer = read_files(spark, path, fmt)
        part = _part_name(columns)
        changed = layer if held is None else layer.where(part.isin(names))
        split = not {c.lower() for c in columns} <= {k.lower() for k in spec.keys}
        cells = _kept(audit_cells(changed, spec, {PART: part}), spec, split)
        profile = column_sketches(changed, {PART: part})
        state = F.broadcast(stale)
        overwrite_partitions(cells.join(state, PART), cell_path, (PART,))
        # Last, as it says which partitions are done.
        overwrite_partitions(profile.join(state, PART), profile_path, (PART,))
    current = F.broadcast(listed.select(PART, *_STATE))
    cells = read_files(spark, cell_path).join(current, [PART, *_STATE], "left_semi")
    profile = read_files(spark, profile_path).join(current, [PART, *_STATE], "left_semi")
    return Audit({**_frames(cells, spec), "columns": estimated_profile(merge_sketches(profile))}, names)
