"""Message transforms (P12-P14): DataFrame -> DataFrame functions.

The transform slot takes any ``DataFrame -> DataFrame`` callable, so user
code stays inside Catalyst.  Field renames work on the JSON body through
VARIANT: top-level only, in order, overwriting the target key; a missing key
or a non-object body leaves the row unchanged.
"""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


Transform = Callable[[DataFrame], DataFrame]


def identity(df: DataFrame) -> DataFrame:
    """The no-op transform (default of the slot)."""
    return df


def apply_transform(df: DataFrame, transform: Transform | None) -> DataFrame:
    """Optional transform slot."""
    return df if transform is None else df.transform(transform)


def _sorted_json(m: Column) -> Column:
    """JSON text of a ``map<string, variant>`` with keys in sorted order."""
    keys = F.array_sort(F.map_keys(m))
    return F.to_json(F.map_from_arrays(keys, F.transform(keys, lambda k: F.element_at(m, k))))


def _rename_step(m: Column, old: str, new: str) -> Column:
    moved = F.map_concat(F.map_filter(m, lambda k, _v: ~k.isin(old, new)),
                         F.create_map(F.lit(new), F.element_at(m, F.lit(old))))
    return F.when(F.map_contains_key(m, F.lit(old)), moved).otherwise(m)


def rename_fields(renames: Sequence[tuple[str, str]], source: str = "source") -> Transform:
    """Transform renaming top-level body fields (sorted keys on output).

    One projection per rename: each step reads the previous map as a column,
    so the plan stays linear in the number of renames.
    """
    steps = [(a, b) for a, b in renames if a != b]

    def _t(df: DataFrame) -> DataFrame:
        v = F.try_parse_json(F.col(source))
        out = df.withColumn("_obj", F.schema_of_variant(v).startswith("OBJECT")).withColumn(
            "_m", v.try_cast("map<string,variant>"))
        for old, new in steps:
            out = out.withColumn("_m", _rename_step(F.col("_m"), old, new))
        return out.withColumn(source, F.when(F.col("_obj"), _sorted_json(F.col("_m"))).otherwise(F.col(source))) \
                  .drop("_m", "_obj")
    return _t


def rename_columns(mapping: dict[str, str]) -> Transform:
    """P12 for typed tables: plain column renames."""
    return lambda df: df.withColumnsRenamed(mapping)
