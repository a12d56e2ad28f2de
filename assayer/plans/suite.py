"""Suites: named lists of rules, from code, from a config list or from storage."""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass, replace
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from ..operators.registry import Rule

SUITE_SCHEMA = "suite string, position int, rule_id string, expectation_type string, kwargs string, meta string"


@dataclass(frozen=True)
class Suite:
    """Rules in order, each with a ``rule_id``; of equal rules the last one counts."""

    name: str
    rules: tuple[Rule, ...]

    def __init__(self, name: str, rules: Iterable[Rule]):
        kept: dict[tuple, Rule] = {}
        for rule in rules:
            kept[rule.identity] = rule
        taken = {rule.rule_id for rule in kept.values()}
        numbered, n = [], 0
        for rule in kept.values():
            if rule.rule_id is None:
                n += 1
                while f"rule_{n:03d}" in taken:
                    n += 1
                rule = replace(rule, rule_id=f"rule_{n:03d}")
            numbered.append(rule)
        object.__setattr__(self, "name", name)
        object.__setattr__(self, "rules", tuple(numbered))

    def __iter__(self) -> Iterator[Rule]:
        return iter(self.rules)

    def __len__(self) -> int:
        return len(self.rules)

    @staticmethod
    def from_config(name: str, config: Iterable[Mapping[str, Any]], params: Mapping[str, Any] | None = None) -> "Suite":
        """A suite from ``[{"expectation_type": ..., "kwargs": {...}}, ...]``.

        ``meta`` may stand next to ``kwargs`` or inside them.  A value written as
        ``{"$PARAMETER": "name"}`` is taken from ``params``.
        """
        rules = []
        for item in config:
            kwargs = _filled(dict(item.get("kwargs", {})), params or {})
            meta = item.get("meta") or kwargs.pop("meta", None)
            kwargs.pop("meta", None)
            rules.append(
                Rule.of(
                    item["expectation_type"],
                    meta=_filled(meta, params or {}),
                    rule_id=item.get("rule_id"),
                    **kwargs,
                )
            )
        return Suite(name, rules)

    def to_config(self) -> list[dict]:
        return [
            {
                "expectation_type": r.expectation_type,
                "kwargs": dict(r.kwargs),
                "meta": dict(r.meta),
                "rule_id": r.rule_id,
            }
            for r in self.rules
        ]

    def save(self, spark: SparkSession, path: str) -> None:
        """Write the rules as a JSON dataset, whether or not they ever passed."""
        rows = [
            (self.name, i, r.rule_id, r.expectation_type, _json(r.kwargs), _json(r.meta))
            for i, r in enumerate(self.rules)
        ]
        spark.createDataFrame(rows, SUITE_SCHEMA).coalesce(1).write.mode("overwrite").json(path)

    @staticmethod
    def load(spark: SparkSession, path: str, name: str | None = None) -> "Suite":
        """Read a saved suite; it is a handful of rows, not data."""
        saved: DataFrame = spark.read.schema(SUITE_SCHEMA).json(path)
        if name is not None:
            saved = saved.filter(saved.suite == name)
        rows = saved.orderBy("position").collect()
        if not rows:
            raise ValueError(f"no suite {name or ''} in {path}")
        return Suite(
            name or rows[0].suite,
            [Rule(r.expectation_type, json.loads(r.kwargs), json.loads(r.meta), r.rule_id) for r in rows],
        )


def _json(value: Mapping) -> str:
    return json.dumps(value, ensure_ascii=False, default=str)


def _filled(value, params: Mapping[str, Any]):
    if isinstance(value, Mapping):
        if set(value) == {"$PARAMETER"}:
            if value["$PARAMETER"] not in params:
                raise KeyError(f"parameter {value['$PARAMETER']!r} is not given")
            return params[value["$PARAMETER"]]
        return {k: _filled(v, params) for k, v in value.items()}
    if isinstance(value, (list, tuple)):
        return [_filled(v, params) for v in value]
    return value
