"""Route files (or any named rows) to splits and corpus versions by name."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """``column = then`` when the lower-cased name contains ``contains``, else ``otherwise``."""
    column: str
    contains: str
    then: str
    otherwise: str


# fixed values: the story corpus naming rules
DEFAULT_RULES = (
    Rule("split", "valid", "validation", "train"),
    Rule("version", "tinystoriesv2", "version2", "original"),
)
# slice -> versions it keeps
SLICES = {"combined": ("original", "version2"), "original": ("original",),
          "version2": ("version2",)}


def route_files(df: DataFrame, name_col: str = "file_name", rules=DEFAULT_RULES,
                suffix: str | None = "txt", data_slice: str | None = "combined",
                slice_col: str = "version") -> DataFrame:
    """Keep names ending in ``suffix``; add one column per rule; keep the slice."""
    name = F.lower(F.col(name_col))
    out = df
    if suffix:
        out = out.filter(F.col(name_col).endswith(suffix))
    for r in rules:
        out = out.withColumn(r.column, F.when(name.contains(r.contains), F.lit(r.then))
                             .otherwise(F.lit(r.otherwise)))
    if data_slice is not None:
        if data_slice not in SLICES:
            raise ValueError(f"unknown slice {data_slice!r}; expected one of {sorted(SLICES)}")
        out = out.filter(F.col(slice_col).isin(*SLICES[data_slice]))
    return out
