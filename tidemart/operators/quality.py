"""Declarative data-quality gates.

A gate is a list of rules. Reject sets may overlap, a warning rule files rows without
rejecting them, and a table that lacks a rule's column fails (or passes) that rule whole.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    reason: str
    column: str
    broken: Callable[[Column], Column]
    rejects: bool = True
    fails_when_absent: bool = True

    def on(self, df: DataFrame) -> Column:
        """True where the row breaks the rule."""
        if self.column not in df.columns:
            return F.lit(self.fails_when_absent)
        return F.coalesce(self.broken(F.col(self.column)), F.lit(False))


@dataclass(frozen=True)
class Gate:
    valid: DataFrame
    rejected: DataFrame
    report: DataFrame


def _empty_text(value: Column) -> Column:
    return value.isNull() | (F.length(F.trim(value)) == 0)


PRODUCT_RULES = [
    Rule("invalid_price", "price", lambda c: c.isNull() | (c <= 0)),
    Rule("missing_product_id", "product_id", lambda c: c.isNull()),
    Rule("missing_name", "name", _empty_text),
    Rule("invalid_rating", "rating", lambda c: (c < 0) | (c > 5), fails_when_absent=False),
]

REVIEW_RULES = [
    Rule("missing_review_id", "review_id", lambda c: c.isNull()),
    Rule("missing_product_id", "product_id", lambda c: c.isNull()),
    Rule("invalid_rating", "rating", lambda c: c.isNull() | (c < 1) | (c > 5)),
    Rule("missing_text", "review_text", _empty_text, rejects=False),
]


def _rejected_by(df: DataFrame, rules: list[Rule]) -> Column:
    verdict = F.lit(False)
    for rule in rules:
        if rule.rejects:
            verdict = verdict | rule.on(df)
    return verdict


def valid_rows(df: DataFrame, rules: list[Rule]) -> DataFrame:
    return df.filter(~_rejected_by(df, rules))


def rejected_rows(df: DataFrame, entity: str, rules: list[Rule]) -> DataFrame:
    """One row per broken rule, tagged with entity and reason; rows may repeat."""
    reasons = F.array_compact(F.array(*[
        F.when(rule.on(df), F.lit(rule.reason)) for rule in rules
    ]))
    return df.select(
        F.lit(entity).alias("entity"), F.explode(reasons).alias("reason"), *df.columns
    )


def report_columns(df: DataFrame, rules: list[Rule]) -> list[Column]:
    """Aggregates of the quality report, usable in `agg` and in `observe`."""
    return [
        F.count(F.lit(1)).alias("input_rows"),
        F.count_if(~_rejected_by(df, rules)).alias("valid_rows"),
        F.count_if(_rejected_by(df, rules)).alias("rejected_rows"),
        *[F.count_if(rule.on(df)).alias(rule.reason) for rule in rules],
    ]


def quality_report(df: DataFrame, entity: str, rules: list[Rule]) -> DataFrame:
    """One row: input, valid and rejected counts, and a count per reason, in one pass."""
    return df.agg(*report_columns(df, rules)).select(F.lit(entity).alias("entity"), "*")


def apply_rules(df: DataFrame, entity: str, rules: list[Rule]) -> Gate:
    return Gate(
        valid=valid_rows(df, rules),
        rejected=rejected_rows(df, entity, rules),
        report=quality_report(df, entity, rules),
    )


def product_gate(df: DataFrame) -> Gate:
    return apply_rules(df, "products", PRODUCT_RULES)


def review_gate(df: DataFrame) -> Gate:
    return apply_rules(df, "reviews", REVIEW_RULES)
