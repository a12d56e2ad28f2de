"""A validation between a loader and a writer."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from .suite import Suite
from .validate import Validation, validate


def run_validation(
    spark: SparkSession,
    load: Callable[..., DataFrame],
    config: Suite | Iterable[Mapping[str, Any]],
    write: Callable[..., None] | None = None,
    *,
    write_rows: Callable[..., None] | None = None,
    name: str = "default",
    keys: list[str] | None = None,
    result_format: str | Mapping | None = None,
    params: Mapping[str, Any] | None = None,
    loader_kwargs: Mapping[str, Any] | None = None,
    writer_kwargs: Mapping[str, Any] | None = None,
    rows_kwargs: Mapping[str, Any] | None = None,
    run_id: str | None = None,
    run_time: dt.datetime | None = None,
) -> Validation:
    """Load with ``load(spark, ...)``, validate, hand the results to ``write(results, ...)``.

    ``config`` is a suite or a list of ``{"expectation_type", "kwargs"}`` items
    whose parameters are filled from ``params``.  At the level COMPLETE all
    offending rows go to ``write_rows(violations, ...)``: a result holds only
    its first ones.  If a rule fails on the data, it is searched on the input
    split that fails; it then fails alone, with its message, and the others
    keep their results.
    """
    suite = config if isinstance(config, Suite) else Suite.from_config(name, config, params)
    df = load(spark, **(loader_kwargs or {}))
    if not isinstance(df, DataFrame):
        raise TypeError(f"the loader returned {type(df).__name__}, not a Spark DataFrame")
    outcome = validate(df, suite, keys=keys, result_format=result_format, run_id=run_id, run_time=run_time)

    def store(outcome: Validation) -> None:
        # The results come last: a run whose results are stored is there as a whole.
        if write_rows is not None and outcome.complete:
            write_rows(outcome.violations, **(rows_kwargs or {}))
        if write is not None:
            write(outcome.results, **(writer_kwargs or {}))

    while True:
        try:
            store(outcome)
            return outcome
        except Exception:
            failing = outcome.failing()
            if not failing:
                raise  # the writer's own fault
            outcome = outcome.without(failing)
