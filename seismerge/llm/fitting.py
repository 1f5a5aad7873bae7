"""Bounded labelled samples and one-task fits for the trained operators."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seismerge.llm.common import released

_STEPS = 1 << 20


def class_counts(labelled: DataFrame, label: str) -> dict:
    """Rows per label; the number of labels is small by nature."""
    return {r[0]: r[1] for r in labelled.groupBy(label).count().orderBy(label).collect()}


def stratified(labelled: DataFrame, label: str, counts: dict, per_class: int) -> DataFrame:
    """About ``per_class`` rows of each label at most, taken evenly by a hash of
    the id, with ``rate``, the share of the label's rows that were taken."""
    rate = F.lit(0.0)
    for value, n in counts.items():
        rate = F.when(F.col(label) == F.lit(value), F.lit(min(1.0, per_class / n))).otherwise(rate)
    return labelled.withColumn("rate", rate).where(
        F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(_STEPS)) < F.col("rate") * _STEPS)


def fitted(sample: DataFrame, fit: Callable[[pd.DataFrame], dict], schema: str) -> dict | None:
    """The model that one task fits on the whole (bounded) sample; None without rows."""
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        model = pd.DataFrame([fit(rows.sort_values("doc_id", kind="stable"))])
        released()
        return model
    got = sample.withColumn("whole", F.lit(0)).groupBy("whole").applyInPandas(run, schema).collect()
    return got[0].asDict() if got else None
