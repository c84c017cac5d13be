"""Running a layer: extract, transform, write, mask, audit.

Reads of the source per run:

* bronze: one. Rows are counted inside the write job and compared with the rows found in the target;
  only if they differ is the source counted per file.
* silver: one if no row fails, or if the failing rows can be read back (overwrite in record mode, merge,
  staged input); otherwise a second, filtered one.
* gold: one per target.
"""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stratum.functions.privacy import publish_masked_view
from stratum.operators import quality
from stratum.operators.aggregate import rows_per_file
from stratum.operators.columns import RunInfo
from stratum.operators.reconcile import loaded_per_file, reconciled
from stratum.operators.upsert import repeated_keys, snapshot_applied, with_deletion_columns
from stratum.plans.frames import bronze_frame, extracted, gold_frame, gold_select, silver_frame
from stratum.quoting import quoted, ref
from stratum.scratch import released, staged
from stratum.sinks import tables
from stratum.sinks.clustering import clustered
from stratum.sources.files import CORRUPT, corrupt_records, good_records
from stratum.sources.listing import FileRef, files_frame
from stratum.spec import PipelineSpec, TargetSpec

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class RunResult:
    status: str
    rows: int | None = None
    failing_rows: int = 0


def run(spark: SparkSession, spec: PipelineSpec, info: RunInfo, as_of: dt.date | None = None) -> RunResult:
    """Run the spec's layer and record the outcome. Errors are recorded and raised again.

    Date folders are looked up as of ``as_of``, by default the day the run started.
    """
    runner: Callable = {"bronze": _run_bronze, "silver": _run_silver, "gold": _run_gold}[spec.layer]
    started = dt.datetime.now(dt.timezone.utc) if info.started is None else info.started
    try:
        with released(spark):
            result = runner(spark, spec, info, started, as_of or started.date())
    except Exception as problem:
        log.exception("%s failed", spec.name)
        record_status(spark, spec, info, started, RunResult("failed"), str(problem))
        raise
    record_status(spark, spec, info, started, result, None)
    return result


def _run_bronze(spark, spec, info, started, as_of) -> RunResult:
    df, files = extracted(spark, spec, as_of)
    if df is None:
        return RunResult("skipped")
    target = spec.target
    try:
        screened = Observation() if target.corrupt_record and CORRUPT in df.columns else None
        good = df
        if screened:
            good = good_records(df.observe(screened, F.count(ref(CORRUPT)).alias("corrupt")))
        counted = Observation()
        written = bronze_frame(good, spec, info).observe(counted, F.count(F.lit(1)).alias("rows"))
        if _read_again(target):
            written = staged(written, "bronze-input")
        _write(spark, written, target, started)
        if screened and screened.get["corrupt"]:
            tables.append(corrupt_records(df), target.corrupt_record, location=_beside(target, target.corrupt_record))
        publish_masks(spark, spec)
        rows = counted.get["rows"]
        if spec.audit.load_history:
            history = _file_history(spark, spec, info, started, written, files, rows)
            tables.append(history, spec.audit.load_history, location=_beside(spec.audit, spec.audit.load_history))
    except Exception:
        if spec.audit.load_history and files:
            failed = files_frame(spark, files).select(ref("path").alias("source_name"), *_history_columns(
                spec, started, F.lit(None).cast("bigint"), F.lit(None).cast("bigint"), F.lit("Failed")))
            tables.append(failed, spec.audit.load_history, location=_beside(spec.audit, spec.audit.load_history))
        raise
    return RunResult("success", rows)


def _file_history(spark, spec, info, started, frame: DataFrame, files: list[FileRef], rows: int) -> DataFrame:
    names = spec.lineage
    key = names.path or names.file
    loaded = loaded_per_file(spark.table(spec.target.table), info.run_id, names.run, key).persist()
    try:
        found = loaded.agg(F.coalesce(F.sum("records_succeeded"), F.lit(0))).first()[0]
        if found == rows and spec.target.mode != "merge":
            # Every row written was found again, so the totals per file are those of the target. After a
            # merge, rows left alone and rows of a reused run id could cancel out, and the frame is staged.
            totals = loaded.withColumnRenamed("records_succeeded", "records_total")
        else:
            totals = rows_per_file(frame, key, "records_total")
        known = files_frame(spark, files) if files else None
        if known is not None and names.path:
            known = known.withColumn("file_name", ref("path"))
        result = reconciled(totals, loaded, known)
        # One row per file: written out before the small cached counts are released.
        return staged(result.select("source_name", *_history_columns(
            spec, started, ref("records_total"), ref("records_succeeded"), ref("load_status"))), "file-history")
    finally:
        loaded.unpersist()


def _history_columns(spec, started, total, succeeded, status):
    return (
        F.lit(spec.target.table).alias("target_name"),
        F.lit(spec.target.mode).alias("operation_type"),
        total.alias("records_total"),
        succeeded.alias("records_succeeded"),
        status.alias("load_status"),
        F.lit(started).cast("timestamp").alias("start_dtm"),
    )


def _run_silver(spark, spec, info, started, as_of) -> RunResult:
    df, _ = extracted(spark, spec, as_of)
    if df is None:
        return RunResult("skipped")
    target, rules = spec.target, list(spec.rules)
    frame = silver_frame(df, spec)
    quality.validate_rules(frame, rules)
    counted = Observation()
    frame = frame.observe(counted, F.count(F.lit(1)).alias("rows"),
                          F.count_if(quality.any_failure(rules)).alias("failing"))
    if spec.stage_input or _read_again(target):
        frame = staged(frame, "silver-input")
    checked = quality.annotated(frame, rules) if rules else frame
    written = quality.passed(checked) if rules and spec.on_fail == "drop" else frame
    _write(spark, written, target, started)
    failing = counted.get["failing"]
    if failing:
        if target.mode == "overwrite" and written is frame and not spec.stage_input:
            checked = quality.annotated(spark.table(target.table), rules)
        record_failures(spec, info, quality.quarantined(checked))
    publish_masks(spark, spec)
    return RunResult("success", counted.get["rows"], failing)


@dataclass(frozen=True)
class Batch:
    """A micro-batch: its name, in the column of that name wherever it is recorded, and whether it was begun before."""

    name: str
    column: str
    replayed: bool = False


def checked_batch(frame: DataFrame, spec: PipelineSpec, info: RunInfo, batch: Batch | None = None) -> DataFrame:
    """Apply the rules to one written-out batch: record what fails, return the rows to load."""
    rules = list(spec.rules)
    if not rules:
        return frame
    frame = staged(frame, "silver-batch")
    checked = quality.annotated(frame, rules)
    failing = quality.quarantined(checked)
    if not failing.isEmpty():
        record_failures(spec, info, failing, batch)
    return quality.passed(checked) if spec.on_fail == "drop" else frame


def record_failures(spec: PipelineSpec, info: RunInfo, failing: DataFrame, batch: Batch | None = None) -> None:
    """Exception rows and summary, both from the failing rows written out once."""
    audit, table, names = spec.audit, spec.target.table, spec.lineage
    if not (audit.exceptions or audit.summary):
        return
    failing = staged(failing, "failing-rows")
    if audit.exceptions:
        rows = quality.exception_rows(failing, table, info, names)
        _record(rows, audit, audit.exceptions, batch)
    if audit.summary:
        rows = quality.failure_summary(failing, table, info, list(spec.rules), names)
        _record(rows, audit, audit.summary, batch)


def _record(rows: DataFrame, audit, table: str, batch: Batch | None) -> None:
    """Append to an audit table; what a replayed batch has recorded already is left as it is."""
    spark = rows.sparkSession
    if batch:
        rows = rows.withColumn(batch.column, F.lit(batch.name))
        if batch.replayed and spark.catalog.tableExists(table):
            known = spark.table(table)
            if batch.column in known.columns and not known.where(ref(batch.column) == batch.name).isEmpty():
                return
    tables.append(rows, table, location=_beside(audit, table))


def record_batch_history(spec: PipelineSpec, started: dt.datetime, read: DataFrame, loaded: DataFrame, batch: Batch) -> None:
    """A row for each file of a batch: the rows read from it, and those found in the target."""
    key = spec.lineage.path or spec.lineage.file
    counts = reconciled(rows_per_file(read, key, "records_total"), rows_per_file(loaded, key, "records_succeeded"))
    history = counts.select("source_name", *_history_columns(
        spec, started, ref("records_total"), ref("records_succeeded"), ref("load_status")))
    _record(staged(history, "file-history"), spec.audit, spec.audit.load_history, batch)


def _run_gold(spark, spec, info, started, as_of) -> RunResult:
    df, _ = extracted(spark, spec, as_of)
    if df is None:
        return RunResult("skipped")
    total = 0
    for target in spec.targets:
        if target.materialization == "view":
            tables.replace_view(spark, target.table, gold_select(spark, spec, target.aggregations))
            continue
        counted = Observation()
        frame = gold_frame(df, spec, target.aggregations).observe(counted, F.count(F.lit(1)).alias("rows"))
        if _read_again(target):
            frame = staged(frame, "gold-input")
        _write(spark, frame, target, started)
        total += counted.get["rows"]
    publish_masks(spark, spec)
    return RunResult("success", total)


def _write(spark: SparkSession, df: DataFrame, target: TargetSpec, started: dt.datetime) -> None:
    """Write by mode. A frame that is read several times here (``_read_again``) comes staged."""
    if target.cluster_by:
        df = clustered(df, target.cluster_by)
    if target.mode == "merge":
        prepare_merge(df, target)
        if target.soft_deletes:
            _apply_snapshot(spark, df, target, started)
        else:
            tables.merge(df, target.table, target.on, target.update, target.insert, target.update_condition,
                         stage=False, evolve=target.schema_evolution)
    elif target.mode == "overwrite":
        tables.overwrite(df, target.table, target.partition_by, target.location, target.empty_result)
    elif target.mode == "append":
        if target.empty_result == "fail" and df.isEmpty():
            raise tables.EmptyResult(f"nothing to write to {target.table}")
        tables.append(df, target.table, target.partition_by, target.location, target.schema_evolution)
    else:
        raise ValueError(f"unknown write mode: {target.mode}")


def _read_again(target: TargetSpec) -> bool:
    """Whether writing takes more than one action. Observations count the first one, so it must be the staging."""
    return target.mode == "merge" or bool(target.cluster_by) or (target.mode == "append" and target.empty_result == "fail")


def prepare_merge(df: DataFrame, target: TargetSpec) -> None:
    """Create the table a first merge needs, empty, so that it is merged like any other."""
    spark = df.sparkSession
    if spark.catalog.tableExists(target.table):
        return
    shape = df.limit(0)
    if target.insert:
        names = [*df.columns, *(c for c in target.insert if c not in df.columns)]
        shape = shape.alias("src").select([
            F.expr(target.insert[c]).alias(c) if c in target.insert else F.col(f"src.{quoted(c)}") for c in names])
    if target.soft_deletes:
        shape = with_deletion_columns(shape)
    empty = spark.createDataFrame([], shape.schema)
    buckets = tables.Buckets(target.buckets, target.keys) if target.buckets else None
    tables.create(empty, target.table, target.partition_by, target.location, buckets)


def _apply_snapshot(spark, snapshot: DataFrame, target: TargetSpec, started: dt.datetime) -> None:
    if not repeated_keys(snapshot, list(target.keys)).isEmpty():
        raise tables.AmbiguousMerge(f"repeated keys in the snapshot for {target.table}")
    current = spark.table(target.table)
    result = snapshot_applied(current, snapshot, list(target.keys), F.lit(started).cast("timestamp"))
    tables.overwrite(result, target.table, target.partition_by)


def publish_masks(spark: SparkSession, spec: PipelineSpec) -> None:
    """Readers get the masked view; every registered policy is part of it from the start."""
    if not spec.masks:
        return
    for target in spec.targets:
        view = spec.masked_view if spec.masked_view and len(spec.targets) == 1 else tables.sibling(target.table, "_masked")
        publish_masked_view(spark, target.table, view, spec.masks, spec.policies)


def record_status(spark, spec, info, started, result: RunResult, error: str | None) -> None:
    if not spec.audit.run_status:
        return
    target = ", ".join(t.table for t in spec.targets)
    row = (info.run_id, spec.name, spec.layer, target, result.status, result.rows, started, error)
    schema = ("run_id string, pipeline string, layer string, target string, status string, "
              "rows bigint, start_dtm timestamp, error string")
    tables.append(spark.createDataFrame([row], schema), spec.audit.run_status,
                  location=_beside(spec.audit, spec.audit.run_status))


def _beside(owner, table: str) -> str | None:
    """Location of an audit table below the configured folder, if there is one."""
    base = getattr(owner, "location", None)
    return f"{base.rstrip('/')}/{table.split('.')[-1]}" if base else None
