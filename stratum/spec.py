"""Declarative specs: frozen dataclasses read from YAML or mappings, checked before any data is read."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from stratum.functions.privacy import POLICIES
from stratum.operators.columns import LineageNames
from stratum.operators.quality import Rule, parse_rules
from stratum.sources.csv_splits import header_mode
from stratum.sources.fixed_width import Field

# Accepted source types (left) and what they mean here.
SOURCE_TYPES = {
    "file": "file",
    "table": "table",
    "delta_table": "table",
    "jdbc": "jdbc",
    "cloudfiles": "incremental",
    "incremental": "incremental",
}
SOURCE_SETTINGS = ("type name table source_path format options extension discover multi_split schema layout compat_names "
                   "url partition_column bounds")
TRANSFORM_SETTINGS = ("with_columns on_column_error standardize casts on_cast_error filters aggregations fill_nulls "
                      "replace_in_names all_to_string select drop deduplicate hash_mode hash_all_columns")
STANDARDIZE_SETTINGS = "rename_map case trim_strings strip_whitespace lowercase uppercase"
TARGET_SETTINGS = ("table target name mode write_mode primary_keys merge_condition update insert update_condition "
                   "enable_soft_deletes schema_evolution corrupt_record partition_by buckets cluster_by location materialization "
                   "empty_result aggregations")
LAYERS = ("bronze", "silver", "gold")
WRITE_MODES = ("append", "overwrite", "merge")
MATERIALIZATIONS = ("table", "view")
EMPTY_RESULTS = ("write", "skip", "fail")


def flag(value: Any, default: bool = False) -> bool:
    """Booleans as they come from YAML or parameters: true, "yes", "1", 1 ..."""
    if value is None:
        return default
    return value.strip().lower() in ("true", "yes", "y", "1", "on") if isinstance(value, str) else bool(value)


def required(mapping: Mapping[str, Any], key: str, where: str) -> Any:
    if mapping.get(key) in (None, ""):
        raise ValueError(f"{where}: missing {key}")
    return mapping[key]


def _one_of(value: str, allowed: Sequence[str], what: str) -> str:
    if value not in allowed:
        raise ValueError(f"{what} must be one of {', '.join(allowed)}, not {value!r}")
    return value


def _only(entry: Mapping[str, Any], known: str, where: str) -> None:
    """A setting that is not known is a mistake: it would have no effect."""
    unknown = sorted(set(entry) - set(known.split()))
    if unknown:
        raise ValueError(f"{where}: unknown setting {', '.join(map(str, unknown))}")


@dataclass(frozen=True)
class SourceSpec:
    kind: str
    table: str | None = None
    path: str | None = None
    format: str | None = None
    options: Mapping[str, Any] = field(default_factory=dict)
    extension: str = ""
    last_n_days: int | None = None
    split_enabled: bool = True
    header_mode: str = "auto"
    schema: str | None = None
    layout: tuple[Field, ...] = ()
    compat_names: bool = False
    url: str | None = None
    partition_column: str | None = None
    bounds: tuple[Any, ...] = ()

    @classmethod
    def of(cls, source: Mapping[str, Any]) -> SourceSpec:
        kind = SOURCE_TYPES.get(source.get("type"))
        if kind is None:
            raise ValueError(f"source: unknown type {source.get('type')!r}")
        props = source.get("properties", source)
        _only(source if props is source else {k: v for k, v in source.items() if k != "properties"},
              SOURCE_SETTINGS if props is source else "type name", "source")
        _only(props, SOURCE_SETTINGS, "source")
        if kind in ("file", "incremental"):
            required(props, "source_path", "source")
            required(props, "format", "source")
        else:
            required(props, "table", "source")
        if kind == "jdbc":
            required(props, "url", "source")
        if props.get("bounds") and not props.get("partition_column"):
            raise ValueError("source: bounds need a partition_column")
        discover = props.get("discover") or {}
        dated = discover.get("type") == "date_hierarchy"
        split = props.get("multi_split", discover.get("multi_split", True))
        detailed = split if isinstance(split, Mapping) else {"enabled": split}
        return cls(
            kind=kind,
            table=props.get("table"),
            path=props.get("source_path"),
            format=props.get("format"),
            options=dict(props.get("options") or {}),
            extension=props.get("extension") or "",
            last_n_days=int(discover.get("last_n_days", 1)) if dated else None,
            split_enabled=flag(detailed.get("enabled"), default=True),
            header_mode=header_mode(detailed.get("header")),
            schema=props.get("schema"),
            layout=tuple(Field(**f) for f in props.get("layout") or ()),
            compat_names=flag(props.get("compat_names")),
            url=props.get("url"),
            partition_column=props.get("partition_column"),
            bounds=tuple(props.get("bounds") or ()),
        )


@dataclass(frozen=True)
class AggregateSpec:
    group_by: tuple[str, ...] = ()
    metrics: tuple[Mapping[str, str], ...] = ()
    whole_table: bool = False

    @classmethod
    def of(cls, entry: Mapping[str, Any] | None) -> AggregateSpec:
        entry = entry or {}
        return cls(tuple(entry.get("group_by") or ()), tuple(entry.get("metrics") or ()),
                   flag(entry.get("whole_table")))


@dataclass(frozen=True)
class TransformSpec:
    with_columns: tuple[tuple[str, str], ...] = ()
    on_column_error: str = "fail"
    standardize: Mapping[str, Any] = field(default_factory=dict)
    casts: tuple[tuple[str, str], ...] = ()
    on_cast_error: str = "fail"
    filters: tuple[str, ...] = ()
    aggregations: AggregateSpec = AggregateSpec()
    fill_nulls: Mapping[str, Any] = field(default_factory=dict)
    replace_in_names: Mapping[str, str] = field(default_factory=dict)
    all_to_string: bool = False
    select: tuple[str, ...] = ()
    drop: tuple[str, ...] = ()
    deduplicate: Mapping[str, Any] | None = None
    hash_mode: str = "compat"
    hash_all_columns: bool = False

    @classmethod
    def of(cls, entry: Mapping[str, Any] | None) -> TransformSpec:
        entry = entry or {}
        std = entry.get("standardize") or {}
        _only(entry, TRANSFORM_SETTINGS, "transform")
        _only(std, STANDARDIZE_SETTINGS, "standardize")
        _one_of(entry.get("on_column_error", "fail"), ("fail", "skip"), "on_column_error")
        _one_of(entry.get("on_cast_error", "fail"), ("fail", "null"), "on_cast_error")
        _one_of(entry.get("hash_mode", "compat"), ("compat", "strict"), "hash_mode")
        return cls(
            with_columns=tuple((c["name"], c["expr"]) for c in entry.get("with_columns") or ()
                               if c.get("name") and c.get("expr")),
            on_column_error=entry.get("on_column_error", "fail"),
            standardize={
                "rename": dict(std.get("rename_map") or {}),
                "case": std.get("case") or "none",
                "trim_all": flag(std.get("trim_strings")),
                "strip": tuple(std.get("strip_whitespace") or ()),
                "lower": tuple(std.get("lowercase") or ()),
                "upper": tuple(std.get("uppercase") or ()),
            },
            casts=tuple((c["column"], c["to_type"]) for c in entry.get("casts") or ()
                        if c.get("column") and c.get("to_type")),
            on_cast_error=entry.get("on_cast_error", "fail"),
            filters=tuple(entry.get("filters") or ()),
            aggregations=AggregateSpec.of(entry.get("aggregations")),
            fill_nulls=dict(entry.get("fill_nulls") or {}),
            replace_in_names=dict(entry.get("replace_in_names") or {}),
            all_to_string=flag(entry.get("all_to_string")),
            select=tuple(entry.get("select") or ()),
            drop=tuple(entry.get("drop") or ()),
            deduplicate=entry.get("deduplicate"),
            hash_mode=entry.get("hash_mode", "compat"),
            hash_all_columns=flag(entry.get("hash_all_columns")),
        )


@dataclass(frozen=True)
class TargetSpec:
    table: str
    name: str = ""
    mode: str = "append"
    keys: tuple[str, ...] = ()
    merge_condition: str | None = None
    update: Mapping[str, str] | None = None
    insert: Mapping[str, str] | None = None
    update_condition: str | None = None
    soft_deletes: bool = False
    schema_evolution: bool = True
    corrupt_record: str | None = None
    partition_by: tuple[str, ...] = ()
    #: files a table is dealt into by its merge keys when it is created, so that merges need not shuffle it
    buckets: int = 0
    #: columns whose interleaved bits order the rows of an append or overwrite
    cluster_by: tuple[str, ...] = ()
    location: str | None = None
    materialization: str = "table"
    empty_result: str = "write"
    aggregations: AggregateSpec | None = None

    @classmethod
    def of(cls, entry: Mapping[str, Any]) -> TargetSpec:
        _only(entry, TARGET_SETTINGS, "destination")
        table = entry.get("table") or entry.get("target")
        if not table:
            raise ValueError("destination: missing table")
        mode = _one_of(entry.get("mode") or entry.get("write_mode") or "append", WRITE_MODES, "write mode")
        keys = tuple(entry.get("primary_keys") or ())
        condition = entry.get("merge_condition")
        if mode == "merge" and not (keys or condition):
            raise ValueError("destination: merge needs primary_keys or merge_condition")
        soft_deletes = flag(entry.get("enable_soft_deletes"))
        if soft_deletes and not (mode == "merge" and keys):
            raise ValueError("destination: soft deletes need mode merge and primary_keys")
        if entry.get("buckets") and not (mode == "merge" and keys):
            raise ValueError("destination: buckets need mode merge and primary_keys")
        if entry.get("cluster_by") and mode == "merge":
            raise ValueError("destination: cluster_by is for append and overwrite")
        own = entry.get("aggregations")
        return cls(
            table=table,
            name=entry.get("name") or table,
            mode=mode,
            keys=keys,
            merge_condition=condition,
            update=entry.get("update"),
            insert=entry.get("insert"),
            update_condition=entry.get("update_condition"),
            soft_deletes=soft_deletes,
            schema_evolution=flag(entry.get("schema_evolution"), default=True),
            corrupt_record=entry.get("corrupt_record"),
            partition_by=tuple(entry.get("partition_by") or ()),
            buckets=int(entry.get("buckets") or 0),
            cluster_by=tuple(entry.get("cluster_by") or ()),
            location=entry.get("location"),
            materialization=_one_of(entry.get("materialization") or "table", MATERIALIZATIONS, "materialization"),
            empty_result=_one_of(entry.get("empty_result") or "write", EMPTY_RESULTS, "empty_result"),
            aggregations=AggregateSpec.of(own) if own else None,
        )

    @property
    def on(self) -> str | list[str]:
        return self.merge_condition or list(self.keys)


@dataclass(frozen=True)
class AuditTables:
    """Names of the audit tables; None leaves that record out."""

    load_history: str | None = None
    run_status: str | None = None
    exceptions: str | None = None
    summary: str | None = None
    location: str | None = None

    @classmethod
    def of(cls, entry: Mapping[str, Any] | None) -> AuditTables:
        return cls(**(entry or {}))


@dataclass(frozen=True)
class PipelineSpec:
    name: str
    layer: str
    source: SourceSpec
    transform: TransformSpec
    targets: tuple[TargetSpec, ...]
    rules: tuple[Rule, ...] = ()
    on_fail: str = "record"
    stage_input: bool = False
    masks: tuple[Mapping[str, str], ...] = ()
    masked_view: str | None = None
    policies: Mapping[str, str] = field(default_factory=lambda: dict(POLICIES))
    lineage: LineageNames = LineageNames()
    audit: AuditTables = AuditTables()

    @classmethod
    def of(cls, config: Mapping[str, Any]) -> PipelineSpec:
        if not isinstance(config, Mapping):
            raise ValueError("a spec must be a mapping")
        meta = required(config, "pipeline_metadata", "spec")
        source = SourceSpec.of(required(config, "source", "spec"))
        layer = _one_of(meta.get("layer"), LAYERS, "layer")
        destination = config.get("target") or config.get("destination") or {}
        entries = destination if isinstance(destination, list) else [destination]
        targets = tuple(TargetSpec.of(e) for e in entries)
        if len(targets) > 1 and layer != "gold":
            raise ValueError("only gold writes several targets")
        if any(t.corrupt_record for t in targets) and not (source.kind == "file" and source.schema):
            raise ValueError("destination: corrupt_record needs a file source with a schema")
        security = config.get("security") or {}
        masks = tuple(security.get("masking") or ())
        policies = {**POLICIES, **(security.get("policies") or {})}
        for mask in masks:
            required(mask, "column", "masking")
            _one_of(required(mask, "policy", "masking"), tuple(policies), "masking policy")
        return cls(
            name=meta.get("name") or "unnamed",
            layer=layer,
            source=source,
            transform=TransformSpec.of(config.get("transform")),
            targets=targets,
            rules=tuple(parse_rules(config.get("data_quality"))),
            on_fail=_one_of(config.get("on_fail", "record"), ("record", "drop"), "on_fail"),
            stage_input=flag(config.get("stage_input")),
            masks=masks,
            masked_view=security.get("masked_view"),
            policies=policies,
            lineage=LineageNames(**(config.get("lineage") or {})),
            audit=AuditTables.of(config.get("audit")),
        )

    @property
    def target(self) -> TargetSpec:
        return self.targets[0]


def load_spec(path: str) -> PipelineSpec:
    import yaml

    with open(path, encoding="utf-8") as stream:
        return PipelineSpec.of(yaml.safe_load(stream))
