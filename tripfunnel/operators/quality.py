"""Table rules: uniqueness, nulls, accepted values, ranges, expressions, freshness."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripfunnel.functions.scalar import clock, seconds_between

RESULT_COLUMNS = ("test_name", "model", "status", "failures", "message")


@dataclass(frozen=True)
class Rule:
    """One rule on one model. ``columns`` holds several names only for ``unique``."""

    kind: str
    columns: tuple[str, ...] = ()
    values: tuple = ()
    low: float | None = None
    high: float | None = None
    expression: str = ""
    where: str = ""
    severity: str = "warn"

    @property
    def name(self) -> str:
        subject = "_".join(self.columns) or self.expression
        return f"{self.kind}: {subject}"


def not_null(*columns: str) -> list[Rule]:
    return [Rule("not_null", (c,)) for c in columns]


def unique(*columns: str) -> Rule:
    return Rule("unique" if len(columns) == 1 else "unique_combination", columns)


def accepted_values(column: str, *values) -> Rule:
    return Rule("accepted_values", (column,), values=values)


def accepted_range(column: str, low=None, high=None) -> Rule:
    return Rule("accepted_range", (column,), low=low, high=high)


def expression_is_true(expression: str, where: str = "") -> Rule:
    return Rule("expression_is_true", expression=expression, where=where)


def violation(rule: Rule) -> Column:
    """True for a row that breaks a row-level rule; nulls pass all but ``not_null``."""
    if rule.kind == "not_null":
        broken = F.col(rule.columns[0]).isNull()
    elif rule.kind == "accepted_values":
        broken = ~F.col(rule.columns[0]).isin(*rule.values)
    elif rule.kind == "accepted_range":
        value = F.col(rule.columns[0])
        broken = F.lit(False)
        if rule.low is not None:
            broken = broken | (value < rule.low)
        if rule.high is not None:
            broken = broken | (value > rule.high)
    elif rule.kind == "expression_is_true":
        broken = ~F.expr(rule.expression)
    else:
        raise ValueError(f"{rule.kind} is not a row-level rule")
    if rule.where:
        broken = broken & F.expr(rule.where)
    return F.coalesce(broken, F.lit(False))


def _is_unique_rule(rule: Rule) -> bool:
    return rule.kind.startswith("unique")


def _duplicates(df: DataFrame, rule: Rule) -> DataFrame:
    """Values that occur more than once, with their counts; nulls are not values."""
    present = df
    if len(rule.columns) == 1:
        present = df.filter(F.col(rule.columns[0]).isNotNull())
    return (
        present.groupBy(*rule.columns).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")
    )


def failing_rows(df: DataFrame, rule: Rule) -> DataFrame:
    """The rows (or repeated values) behind a failure, to be stored for inspection."""
    return _duplicates(df, rule) if _is_unique_rule(rule) else df.filter(violation(rule))


def _status(severity: str) -> Column:
    return F.when(F.col("failures") == 0, "pass").otherwise("fail" if severity == "error" else "warn")


def _result(counted: DataFrame, name: Column, model: str, severity: str) -> DataFrame:
    return counted.select(
        name.alias("test_name"),
        F.lit(model).alias("model"),
        _status(severity).alias("status"),
        "failures",
        F.when(F.col("failures") > 0, F.concat(F.col("failures").cast("string"), F.lit(" failures")))
        .alias("message"),
    )


def run_quality(df: DataFrame, model: str, rules: Sequence[Rule]) -> DataFrame:
    """One result row per rule. All row-level rules of a model share one scan and one
    aggregation; each uniqueness rule is a grouping of its own.
    """
    parts = []
    for severity in ("warn", "error"):
        by_row = [r for r in rules if r.severity == severity and not _is_unique_rule(r)]
        if by_row:
            counts = df.agg(*[F.count_if(violation(r)).alias(f"r{i}") for i, r in enumerate(by_row)])
            pairs = F.array(
                *[
                    F.struct(F.lit(r.name).alias("name"), F.col(f"r{i}").alias("failures"))
                    for i, r in enumerate(by_row)
                ]
            )
            rows = counts.select(F.inline(pairs))
            parts.append(_result(rows, F.col("name"), model, severity))
    for rule in rules:
        if _is_unique_rule(rule):
            counted = _duplicates(df, rule).agg(F.count(F.lit(1)).alias("failures"))
            parts.append(_result(counted, F.lit(rule.name), model, rule.severity))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def freshness(
    df: DataFrame, model: str, ts: str, warn_hours: float, error_hours: float, as_of=None
) -> DataFrame:
    """Age of the newest row against two limits; an empty table is an error."""
    age = seconds_between(clock(as_of), F.col("newest")) / 3600
    return df.agg(F.max(ts).alias("newest")).select(
        F.lit(f"freshness: {ts}").alias("test_name"),
        F.lit(model).alias("model"),
        F.when(age <= warn_hours, "pass").when(age <= error_hours, "warn").otherwise("fail")
        .alias("status"),
        F.round(age, 6).alias("age_hours"),
    )


def relationships(
    child: DataFrame, child_key: str, parent: DataFrame, parent_key: str, model: str,
    severity: str = "warn",
) -> DataFrame:
    """Child rows whose key is missing in the parent. Both sides are reduced to one
    row per key first, so a hot foreign key costs nothing extra.
    """
    used = (
        child.filter(F.col(child_key).isNotNull())
        .groupBy(F.col(child_key).alias("_key"))
        .agg(F.count(F.lit(1)).alias("_rows"))
    )
    offered = parent.select(F.col(parent_key).alias("_key")).distinct()
    orphans = used.join(offered, "_key", "left_anti").agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("failures")
    )
    return _result(orphans, F.lit(f"relationships: {child_key}"), model, severity)


def quality_summary(results: DataFrame) -> DataFrame:
    """Pass rate in percent and counts per status; 0 when nothing was tested."""
    return results.agg(
        F.count(F.lit(1)).alias("tests"),
        F.count_if(F.col("status") == "pass").alias("passed"),
        F.count_if(F.col("status") == "warn").alias("warned"),
        F.count_if(F.col("status") == "fail").alias("failed"),
    ).withColumn(
        "pass_rate",
        F.when(F.col("tests") > 0, F.col("passed") * 100.0 / F.col("tests")).otherwise(F.lit(0.0)),
    )
