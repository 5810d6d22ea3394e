"""The cleaning run as a whole: preserve, profile, clean, gate, export, verify, audit."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import replace
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailkeep.operators.order import union_records
from trailkeep.plans.clean import Cleaned, publish
from trailkeep.session import written
from trailkeep.sources.snapshot import audit_report, drift, snapshot_once, write_audit


class Step(NamedTuple):
    """One table of a run: where it comes from, the plan that cleans it, and where its export goes."""

    source: DataFrame
    clean: Callable[[DataFrame], Cleaned]
    target: str


def _fence_rows(name: str, fences: DataFrame) -> DataFrame:
    """Fences in the audit's form; those of a group carry the group's values."""
    groups = [c for c in fences.columns if c not in ("column", "n", "q1", "q3", "lower", "upper")]
    cells = [
        F.struct(F.concat_ws(" ", F.lit(side), "column", *groups).alias("metric"), F.col(side).cast("string").alias("value"))
        for side in ("lower", "upper")
    ]
    return fences.select(F.lit(name).alias("file"), F.lit("fence").alias("stage"), F.inline(F.array(*cells)))


def _drift_rows(name: str, changes: DataFrame) -> DataFrame:
    """Changes of a source in the audit's form: what was preserved and what is there now."""
    cells = [F.struct(F.concat_ws(" ", F.lit(side), "metric").alias("metric"), F.col(side).alias("value")) for side in ("preserved", "now")]
    return changes.select(F.lit(name).alias("file"), F.lit("drift").alias("stage"), F.inline(F.array(*cells)))


def full_run(tables: Mapping[str, Step], folder: str) -> DataFrame:
    """Clean and export all tables, and return the audit (file, stage, metric, value) kept in ``folder``/audit.

    The inputs are preserved in ``folder`` on the first run and replayed by later ones, so a run repeats its
    result even if a target is its own source; the audit's stage "drift" names what has changed in a source since its
    copy was preserved. All tables are cleaned before any is exported: a failing gate,
    or a value beyond its fence, stops the run with every target as it was.
    """
    done, changes = {}, {}
    for name, step in tables.items():
        changes[name] = drift(step.source, f"{folder}/input/{name}")
        before = snapshot_once(step.source, f"{folder}/input/{name}")
        cleaned = step.clean(before)
        done[name] = before, replace(cleaned, clean=written(cleaned.clean))
    publish({tables[name].target: cleaned for name, (_, cleaned) in done.items()})
    parts = []
    for name, (before, cleaned) in done.items():
        parts.append(audit_report(before, cleaned.clean, cleaned.details, name))
        parts.append(_drift_rows(name, changes[name]))
        if cleaned.fences is not None:
            parts.append(_fence_rows(name, cleaned.fences))
    report = union_records(*parts)
    write_audit(report, f"{folder}/audit")
    return report.sparkSession.read.schema(report.schema).json(f"{folder}/audit")
