"""Row checks: annotate, split, quarantine rows and failure summary."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.operators.columns import LineageNames, RunInfo
from stratum.quoting import ref, refs

ERRORS = "dq_errors"
WARNINGS = "dq_warnings"
_NO_CHECKS = "cast(array() as array<struct<name: string, message: string>>)"


@dataclass(frozen=True)
class Rule:
    """``expression`` describes the good state; a NULL result passes, as in a SQL CHECK constraint."""

    name: str
    expression: str
    message: str
    criticality: str = "error"

    def failed(self) -> Column:
        return F.coalesce(~F.expr(self.expression), F.lit(False))

    def result(self) -> Column:
        entry = F.struct(F.lit(self.name).alias("name"), F.lit(self.message).alias("message"))
        return F.when(self.failed(), entry)


def parse_rules(entries: Iterable[Mapping] | None) -> list[Rule]:
    """Rules from ``{check: {function: sql_expression, arguments: {...}}, criticality}`` mappings.

    ``criticality`` is accepted beside or inside ``check``. Anything malformed raises ``ValueError``.
    """
    rules = []
    for number, entry in enumerate(entries or [], 1):
        check = entry.get("check") if isinstance(entry, Mapping) else None
        if not isinstance(check, Mapping):
            raise ValueError(f"rule {number}: no check")
        if check.get("function") != "sql_expression":
            raise ValueError(f"rule {number}: unknown function {check.get('function')!r}")
        arguments = check.get("arguments")
        if not isinstance(arguments, Mapping) or not arguments.get("expression"):
            raise ValueError(f"rule {number}: no expression")
        expression = arguments["expression"]
        criticality = entry.get("criticality", check.get("criticality", "error"))
        if criticality not in ("warn", "error"):
            raise ValueError(f"rule {number}: criticality must be warn or error, not {criticality!r}")
        message = arguments.get("msg") or f"not satisfied: {expression}"
        rules.append(Rule(arguments.get("name") or f"rule_{number}", expression, message, criticality))
    return rules


def validate_rules(df: DataFrame, rules: Sequence[Rule]) -> None:
    """Check that every expression is a condition on ``df``; only analyses, runs no job."""
    for rule in rules:
        try:
            df.filter(F.expr(rule.expression))
        except AnalysisException as problem:
            raise ValueError(f"rule {rule.name}: {problem}") from problem


def annotated(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add the lists of failed error and warning rules, NULL where none failed."""
    validate_rules(df, rules)

    def results(criticality: str) -> Column:
        chosen = [r for r in rules if r.criticality == criticality]
        if not chosen:
            return F.expr(f"if(false, {_NO_CHECKS}, null)")
        failed = reduce(or_, (r.failed() for r in chosen))
        # Clean rows, the usual case, build no array at all.
        return F.when(failed, F.array_compact(F.array(*[r.result() for r in chosen])))

    return df.withColumns({ERRORS: results("error"), WARNINGS: results("warn")})


def any_failure(rules: Sequence[Rule]) -> Column:
    return reduce(or_, (r.failed() for r in rules), F.lit(False))


def passed(checked: DataFrame) -> DataFrame:
    """Rows without errors (warnings are allowed), without the check columns."""
    return checked.where(ref(ERRORS).isNull()).drop(ERRORS, WARNINGS)


def quarantined(checked: DataFrame) -> DataFrame:
    """Rows with an error or a warning. Rows with warnings only are also among the passed rows."""
    return checked.where(ref(ERRORS).isNotNull() | ref(WARNINGS).isNotNull())


def failure_counts(failing: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """Rows per failed rule, from a single pass over both lists."""
    def tagged(column: str, criticality: str) -> Column:
        entries = F.coalesce(ref(column), F.expr(_NO_CHECKS))
        return F.transform(entries, lambda e: F.struct(
            F.lit(criticality).alias("quality_check_type"),
            e["name"].alias("name"), e["message"].alias("message")))

    each = F.explode(F.concat(tagged(ERRORS, "error"), tagged(WARNINGS, "warn"))).alias("failed")
    return (
        failing.select(*refs(group), each)
        .groupBy(*refs(group), "failed.quality_check_type", "failed.name", "failed.message")
        .agg(F.count(F.lit(1)).alias("count"))
    )


def failure_summary(failing: DataFrame, table: str, run: RunInfo, rules: Sequence[Rule],
                    names: LineageNames = LineageNames()) -> DataFrame:
    """Rows for the summary table: counts per correlation id and rule, with run and rule details."""
    if names.correlation not in failing.columns:
        failing = failing.withColumn(names.correlation, F.lit(run.correlation_id).cast("string"))
    checks = json.dumps([vars(r) for r in rules])
    return failure_counts(failing, [names.correlation]).select(
        ref(names.correlation).alias("correlation_id"),
        "quality_check_type", "name", "message", "count",
        F.lit(table).alias("source_table_path"),
        F.lit(run.job_id).cast("string").alias(names.job),
        F.lit(run.run_id).cast("string").alias(names.run),
        F.parse_json(F.lit(checks)).alias("checks"),
        run.timestamp().alias("processed_time"),
    )


def exception_rows(failing: DataFrame, table: str, run: RunInfo,
                   names: LineageNames = LineageNames()) -> DataFrame:
    """Rows for the exception table: the whole failing row as one VARIANT."""
    record = [c for c in failing.columns if c != names.correlation]
    return failing.select(
        F.lit(table).alias("source_table_path"),
        F.lit(run.correlation_id).cast("string").alias("correlation_id"),
        F.lit(run.job_id).cast("string").alias(names.job),
        F.lit(run.run_id).cast("string").alias(names.run),
        run.timestamp().alias("processed_time"),
        F.to_variant_object(F.struct(*[_variant_ready(failing, c) for c in record])).alias("exception_record"),
    )


def _variant_ready(df: DataFrame, name: str) -> Column:
    # VARIANT holds plain strings only; a collated or char/varchar column is cast down to one.
    return ref(name).cast("string").alias(name) if df.schema[name].dataType.typeName() == "string" else ref(name)
