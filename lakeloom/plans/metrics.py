"""Reading ``Observation`` metrics robustly.

When Catalyst collapses a plan to an empty relation (for example a join of
two empty inputs), no task runs the metrics collector and the observation
has no usable row. Nothing flowed through the write then, so the correct
values are the same aggregates over an empty input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation

from lakeloom.plans.workspace import empty_frame


def observed_values(obs: Observation, df: DataFrame, exprs) -> dict:
    try:
        got = obs.get
    except Exception:  # the collector never ran
        got = None
    if got:
        return dict(got)
    return empty_frame(df.sparkSession, df.schema).agg(*exprs).first().asDict()
