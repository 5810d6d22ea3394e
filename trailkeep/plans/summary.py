"""One summary over several tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame

from trailkeep.operators.order import union_records
from trailkeep.operators.profile import summarize
from trailkeep.session import shared_folder

#: Tables whose jobs run at the same time.
AT_ONCE = 4


def master_summary(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """One row per table: its rows, exact duplicates and outliers of the named measures.

    Quartiles take a few short jobs one after another, so several tables are worked on at a time.
    """
    for df, _ in tables.values():
        shared_folder(df.sparkSession)  # settled before the threads ask for it
    with ThreadPoolExecutor(AT_ONCE) as pool:
        rows = pool.map(lambda item: summarize(*item[1], item[0]), tables.items())
        return union_records(*rows)
