"""Whole-table cleaners compiled from a spec.

``clean(df, spec)`` is one Filter (required keys not NULL) and one Project
(every derived column). No shuffle, no Python: a narrow, codegen'd stage
that runs per input split, so it scales with the number of splits.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mediamart.specs import DatasetSpec


def required_filter(spec: DatasetSpec) -> Column | None:
    """Conjunction of NOT NULL over the spec's required raw keys (F1, F2)."""
    if not spec.required:
        return None
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in spec.required])


def clean(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    missing = [c for c in spec.raw if c not in df.columns]
    if missing:
        raise ValueError(f"{spec.name}: input lacks raw columns {missing}")
    cond = required_filter(spec)
    if cond is not None:
        df = df.filter(cond)
    return df.select(*[d.build().alias(d.name) for d in spec.columns])


def derive(df: DataFrame, spec: DatasetSpec, names: list[str], keep: list[str] = ()) -> DataFrame:
    """Only some derived columns (plus raw ``keep`` columns): the single
    projection operators P1-P9b exposed one at a time."""
    by_name = {d.name: d for d in spec.columns}
    return df.select(*[F.col(k) for k in keep],
                     *[by_name[n].build().alias(n) for n in names])
