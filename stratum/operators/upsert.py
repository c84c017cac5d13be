"""Keyed upsert, soft delete and snapshot difference as joins.

Shape of the upsert plan:

* changed part: target LEFT JOIN source. A source within the broadcast threshold leaves the target
  unshuffled; a larger one gives a sort-merge join whose target side adaptive execution can split, so
  a hot or NULL target key does not pin one task. Source keys are unique where it matters.
* inserted part: source LEFT ANTI JOIN the target's key columns, reduced first (see ``_target_keys``).
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, DoubleType, FloatType, NumericType

from stratum.operators.sizing import fits_broadcast
from stratum.quoting import quoted, ref, refs

TARGET = "tgt"
SOURCE = "src"
_HIT = "__hit"
_ROW = "__row"
_COUNT = "__rows"
_RANK = "__rank"
_KEY = "__key"
_END = "__end"
#: Digits of the longest decimal type.
_MOST_DIGITS = 38
_NAME = r"(?:`((?:[^`]|``)+)`|(\w+))"
_EQUALITY = re.compile(rf"(tgt|src)\.{_NAME}\s*==?\s*(tgt|src)\.{_NAME}", re.IGNORECASE)

_COMPARISON = re.compile(rf"(tgt|src)\.{_NAME}\s*(<=|>=|<|>)\s*(tgt|src)\.{_NAME}", re.IGNORECASE)
_SIDE = re.compile(r"\b(tgt|src)\.", re.IGNORECASE)
_TURNED = {"<": ">", ">": "<", "<=": ">=", ">=": "<="}

_CONNECTIVE = re.compile(
    r"""'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"|`(?:[^`]|``)*`|[()]|(?<!\.)\b(?:and|or|case|end)\b""", re.IGNORECASE)


@dataclass(frozen=True)
class Match:
    """A join condition over ``tgt`` and ``src`` with its equality pairs (target, source)."""

    condition: str
    pairs: tuple[tuple[str, str], ...]
    only_pairs: bool = True

    @property
    def target_keys(self) -> list[str]:
        return list(dict.fromkeys(t for t, _ in self.pairs))

    @property
    def source_keys(self) -> list[str]:
        return list(dict.fromkeys(s for _, s in self.pairs))

    @classmethod
    def on(cls, keys: str | Sequence[str]) -> Match:
        """From key columns, or from a SQL condition such as ``tgt.id = src.id AND src.v > tgt.v``.

        A condition needs at least one AND-ed equality between the two sides: without it every target
        row would have to meet every source row.
        """
        if isinstance(keys, str):
            pairs, parts = cls._equalities(keys)
            return cls(keys, pairs, parts == len(pairs))
        if not keys:
            raise ValueError("an upsert needs at least one key column")
        condition = " AND ".join(f"{TARGET}.{quoted(k)} = {SOURCE}.{quoted(k)}" for k in keys)
        return cls(condition, tuple((k, k) for k in keys))

    @staticmethod
    def _equalities(condition: str) -> tuple[tuple[tuple[str, str], ...], int]:
        """The equality pairs and the number of AND-ed parts."""
        pairs = []
        parts = _and_parts(condition)
        for part in parts:
            pair = _pair(part)
            if pair:
                pairs.append(pair)
        if not pairs:
            raise ValueError(f"no equality between tgt and src in merge condition: {condition}")
        return tuple(pairs), len(parts)


def _bare(part: str) -> str:
    """A part without the parentheses around it, where those are all it has."""
    part = part.strip()
    return part[1:-1].strip() if part[:1] == "(" and part[-1:] == ")" and part.count("(") == 1 else part


def _name(quoted_name: str | None, plain: str | None) -> str:
    return (quoted_name or plain).replace("``", "`")


def _pair(part: str) -> tuple[str, str] | None:
    """(target, source) columns of an equality between the sides."""
    found = _EQUALITY.fullmatch(_bare(part))
    if not found or found[1].lower() == found[4].lower():
        return None
    a, b = _name(found[2], found[3]), _name(found[5], found[6])
    return (a, b) if found[1].lower() == TARGET else (b, a)


@dataclass(frozen=True)
class _Bound:
    """What a match asks beyond equal keys: one comparison between the sides, and conditions on either side alone.

    Of the rows of a key one then matches if any does: the source's largest value against the target's smallest, or the
    other way round. So a hot key needs no pairs of rows.
    """

    source: str
    comparison: str  # source value, this, target value
    target: str
    source_only: tuple[str, ...] = ()
    target_only: tuple[str, ...] = ()

    @property
    def largest(self) -> bool:
        return self.comparison[0] == ">"

    def holds(self, source: Column, target: Column) -> Column:
        return {"<": source < target, "<=": source <= target, ">": source > target, ">=": source >= target}[self.comparison]

    def source_rows(self, source: DataFrame) -> DataFrame:
        """Rows that can match anything at all."""
        return _where(source, SOURCE, self.source_only).where(ref(self.source).isNotNull())

    def easiest(self, source: DataFrame, keys: Sequence[str]) -> DataFrame:
        """One row for each key, the one that matches if any of the key does. Ranks are limited before the shuffle."""
        value = ref(self.source)
        rank = F.row_number().over(Window.partitionBy(refs(keys)).orderBy(value.desc() if self.largest else value.asc()))
        return self.source_rows(source).withColumn(_RANK, rank).where(ref(_RANK) == 1).drop(_RANK)

    def target_limits(self, target: DataFrame, keys: Sequence[str]) -> DataFrame:
        """The value of each key that is matched if any of the key is, under the column's own name."""
        end = F.min if self.largest else F.max
        return _where(target, TARGET, self.target_only).groupBy(refs(keys)).agg(end(ref(self.target)).alias(_END))


def _where(df: DataFrame, alias: str, conditions: Sequence[str]) -> DataFrame:
    for condition in conditions:
        df = df.alias(alias).where(F.expr(condition))
    return df


def bound_of(target: DataFrame, source: DataFrame, match: Match, update_condition: str | None = None) -> _Bound | None:
    """The match as one comparison, if it is one."""
    comparisons, alone = [], {TARGET: [], SOURCE: []}
    for condition in filter(None, (match.condition, update_condition)):
        parts = _and_parts(condition)
        if not parts:
            return None
        for part in parts:
            if condition is match.condition and _pair(part):
                continue
            sides = {side.lower() for side in _SIDE.findall(part)}
            if len(sides) == 1:
                alone[sides.pop()].append(part)
            else:
                comparisons.append(_COMPARISON.fullmatch(_bare(part)))
    if len(comparisons) != 1 or comparisons[0] is None:
        return None
    found = comparisons[0]
    left, right = _name(found[2], found[3]), _name(found[6], found[7])
    turned = found[1].lower() == TARGET
    bound = _Bound(right if turned else left, _TURNED[found[4]] if turned else found[4], left if turned else right,
                   tuple(alone[SOURCE]), tuple(alone[TARGET]))
    try:  # each condition has to make sense on its side alone
        left_type = bound.source_rows(source).select(ref(bound.source)).schema[0].dataType
        right_type = _where(target, TARGET, bound.target_only).select(ref(bound.target)).schema[0].dataType
    except AnalysisException:
        return None
    return bound if _same_order(left_type, right_type) else None


def _same_order(left: DataType, right: DataType) -> bool:
    """Whether the cast before a comparison of the two types keeps the order of either one's values.

    Numbers may become equal by it, but never change places. Texts do, and decimals too long for a common type are lost.
    """
    if left == right:
        return True
    if not (isinstance(left, NumericType) and isinstance(right, NumericType)):
        return False
    kinds = {type(left), type(right)}
    if kinds & {FloatType, DoubleType} or DecimalType not in kinds:
        return True
    (whole, scale), (other_whole, other_scale) = _decimal_places(left), _decimal_places(right)
    return max(whole, other_whole) + max(scale, other_scale) <= _MOST_DIGITS


def _decimal_places(kind: DataType) -> tuple[int, int]:
    """Digits before and after the point."""
    return (kind.precision - kind.scale, kind.scale) if isinstance(kind, DecimalType) else (20, 0)


def _and_parts(condition: str) -> list[str]:
    """The parts a condition ANDs outside parentheses, CASE and quotes; none if it ORs there."""
    depth = start = 0
    parts = []
    for token in _CONNECTIVE.finditer(condition):
        word = token[0].lower()
        if word in ("(", "case"):
            depth += 1
        elif word in (")", "end"):
            depth -= 1
        elif depth == 0 and word == "or":
            return []
        elif depth == 0 and word == "and":
            parts.append(condition[start:token.start()])
            start = token.end()
    return [*parts, condition[start:]]


def upserted(
    target: DataFrame,
    source: DataFrame,
    on: str | Sequence[str],
    update: Mapping[str, str] | None = None,
    insert: Mapping[str, str] | None = None,
    update_condition: str | None = None,
    one_match: bool = False,
) -> DataFrame:
    """The target after the merge, with the target's columns and types.

    ``update`` and ``insert`` map target columns to SQL over ``tgt`` and ``src``. ``None`` takes every
    column the source has; an empty mapping takes no action. A matched row for which
    ``update_condition`` is not true keeps its values. A NULL key matches nothing. Source rows must
    not match the same target row twice: see ``ambiguous_matches``. Where that is known and source keys repeat,
    ``one_match`` keeps rows that can update nothing out of the join, if the match is one comparison (``bound_of``).
    """
    match = Match.on(on)
    source = named_as(source, target)
    bound = bound_of(target, source, match, update_condition) if one_match else None
    shared = {c: f"{SOURCE}.{quoted(c)}" for c in target.columns if c in source.columns}
    update = shared if update is None else _known(target, update)
    insert = shared if insert is None else _known(target, insert)
    rows = target
    if update:
        updates = bound.easiest(source, match.source_keys) if bound else source
        rows = _updated(target, updates, match, update, update_condition)
    if insert:
        rows = rows.unionByName(_inserted(target, source, match, insert))
    return rows


def _updated(target: DataFrame, source: DataFrame, match: Match, update: Mapping[str, str],
             update_condition: str | None) -> DataFrame:
    hits = source.withColumn(_HIT, F.lit(True)).alias(SOURCE)
    joined = target.alias(TARGET).join(hits, _update_match(match, update_condition), "left")
    hit = F.col(f"{SOURCE}.{_HIT}").isNotNull()
    return joined.select([
        _typed(F.when(hit, F.expr(update[f.name])).otherwise(_old(f.name)), f) if f.name in update
        else _old(f.name).alias(f.name)
        for f in target.schema.fields
    ])


def _inserted(target: DataFrame, source: DataFrame, match: Match, insert: Mapping[str, str]) -> DataFrame:
    # Rows with a NULL key match nothing and stay out of the join, where they would meet in one task.
    complete = _has_all(match.source_keys)
    keyed = source.where(complete)
    bound = None if match.only_pairs else bound_of(target, source, match)
    if bound:
        limits = bound.target_limits(target, match.target_keys).alias(TARGET)
        met = _same_keys(match) & bound.holds(F.col(f"{SOURCE}.{quoted(bound.source)}"), F.col(f"{TARGET}.{_END}"))
        for condition in bound.source_only:
            met = met & F.expr(condition)
        fresh = keyed.alias(SOURCE).join(limits, met, "left_anti")
    else:
        present = _target_keys(target, keyed, match).alias(TARGET)
        fresh = keyed.alias(SOURCE).join(present, F.expr(match.condition), "left_anti")
    return as_inserts(target, fresh.unionByName(source.where(~complete)), insert)


def as_inserts(target: DataFrame, rows: DataFrame, insert: Mapping[str, str] | None = None) -> DataFrame:
    """Source rows in the shape they are inserted into the target."""
    rows = named_as(rows, target)
    if insert is None:
        insert = {c: f"{SOURCE}.{quoted(c)}" for c in target.columns if c in rows.columns}
    else:
        insert = _known(target, insert)
    return rows.alias(SOURCE).select([
        _typed(F.expr(insert[f.name]) if f.name in insert else F.lit(None), f) for f in target.schema.fields
    ])


def _same_keys(match: Match) -> Column:
    return reduce(and_, (F.col(f"{TARGET}.{quoted(t)}") == F.col(f"{SOURCE}.{quoted(s)}") for t, s in match.pairs))


def _has_all(keys: Sequence[str]) -> Column:
    return reduce(and_, (ref(k).isNotNull() for k in keys))


def _target_keys(target: DataFrame, source: DataFrame, match: Match) -> DataFrame:
    """The target's values of the columns in the condition, at least those the source can match."""
    used = [c for c in target.columns
            if re.search(rf"\btgt\.(`{re.escape(c)}`|{re.escape(c)}\b)", match.condition, re.IGNORECASE)]
    keys = target.select(refs(used))
    if fits_broadcast(source):
        # A small source filters the target's keys where they are; only the hits are shuffled.
        keys = keys.alias(TARGET).join(source.alias(SOURCE), F.expr(match.condition), "left_semi")
    # Distinct combines on the map side, so a hot key travels once per task.
    return keys.distinct()


def _update_match(match: Match, update_condition: str | None) -> Column:
    condition = F.expr(match.condition)
    return condition if update_condition is None else condition & F.expr(update_condition)


def _old(name: str) -> Column:
    return F.col(f"{TARGET}.{quoted(name)}")


def _typed(value: Column, field) -> Column:
    return value.cast(field.dataType).alias(field.name)


def _known(target: DataFrame, mapping: Mapping[str, str]) -> Mapping[str, str]:
    """The mapping with the target's spelling of its columns."""
    names = {c.lower(): c for c in target.columns}
    unknown = sorted(c for c in mapping if c.lower() not in names)
    if unknown:
        raise ValueError(f"not columns of the target: {', '.join(unknown)}")
    return {names[c.lower()]: expression for c, expression in mapping.items()}


def named_as(source: DataFrame, target: DataFrame) -> DataFrame:
    """``source`` with the target's spelling of the columns both have; names differ by more than case."""
    names = {c.lower(): c for c in target.columns}
    changed = {c: names[c.lower()] for c in source.columns if names.get(c.lower(), c) != c}
    return source.withColumnsRenamed(changed) if changed else source


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys without NULLs that occur more than once; counts combine on the map side."""
    counts = df.where(_has_all(keys)).groupBy(refs(keys)).agg(F.count(F.lit(1)).alias(_COUNT))
    return counts.where(ref(_COUNT) > 1)


def ambiguous_matches(target: DataFrame, source: DataFrame, on: str | Sequence[str],
                      update_condition: str | None = None, repeated: DataFrame | None = None) -> DataFrame:
    """Source keys with several rows that would update the same target row. Must be empty before an upsert.

    Repeated source keys that match no target row are legal: all of them are inserted.
    """
    match = Match.on(on)
    if repeated is None:
        repeated = repeated_keys(source, match.source_keys)
    if match.only_pairs and update_condition is None:
        # The keys decide alone: no pair of rows needs to be formed.
        keys = [F.col(f"{SOURCE}.{quoted(s)}") for s in match.source_keys]
        hits = repeated.alias(SOURCE).join(
            _target_keys(target, repeated, match).alias(TARGET), F.expr(match.condition), "left_semi")
        return hits.select(*keys, F.col(_COUNT).alias("source_rows"))
    suspects = source.join(repeated, match.source_keys, "left_semi")
    keys = [F.col(f"{SOURCE}.{quoted(s)}") for s in match.source_keys]
    bound = bound_of(target, source, match, update_condition)
    if bound:
        # The target row that is matched most easily has the most matches: rows meet one value per key.
        limits = bound.target_limits(target, match.target_keys).alias(TARGET)
        met = bound.holds(F.col(f"{SOURCE}.{quoted(bound.source)}"), F.col(f"{TARGET}.{_END}"))
        hits = bound.source_rows(suspects).alias(SOURCE).join(limits, _same_keys(match) & met, "inner")
        return hits.groupBy(*keys).agg(F.count(F.lit(1)).alias("source_rows")).where("source_rows > 1")
    # Rows alike in all that the conditions look at meet as one, with their number.
    conditions = " ".join(filter(None, (match.condition, update_condition)))
    rows = suspects.select(refs(_used(source.columns, match.source_keys, conditions)))
    rows = rows.groupBy(refs(rows.columns)).agg(F.count(F.lit(1)).alias(_COUNT)).alias(SOURCE)
    kinds = target.select(refs(_used(target.columns, match.target_keys, conditions))).distinct()
    numbered = kinds.withColumn(_ROW, F.monotonically_increasing_id()).alias(TARGET)
    hits = numbered.join(rows, _update_match(match, update_condition), "inner")
    # Counting starts in the join's own tasks, so matches are not shuffled one by one.
    return (
        hits.groupBy(F.col(f"{TARGET}.{_ROW}"), *keys)
        .agg(F.sum(F.col(f"{SOURCE}.{_COUNT}")).alias("source_rows"))
        .where("source_rows > 1")
        .groupBy(refs(match.source_keys))
        .agg(F.max("source_rows").alias("source_rows"))
    )


def _used(columns: Sequence[str], keys: Sequence[str], conditions: str) -> list[str]:
    """The keys, and the columns whose names appear in the conditions, on either side."""
    wanted = {k.lower() for k in keys}
    return [c for c in columns
            if c.lower() in wanted or re.search(rf"(?<!\w){re.escape(c)}(?!\w)", conditions.replace("``", "`"), re.IGNORECASE)]


def snapshot_applied(target: DataFrame, snapshot: DataFrame, keys: Sequence[str],
                     at: dt.datetime | Column, flag: str = "is_deleted",
                     stamp: str = "deleted_at") -> DataFrame:
    """Upsert a full snapshot; target rows it no longer holds are flagged, not removed.

    A row already flagged keeps its first time stamp; a row that returns is unflagged. Keys of the snapshot
    must be unique: see ``repeated_keys``, which layer runs check first.
    """
    moment = at if isinstance(at, Column) else F.lit(at)
    target = with_deletion_columns(target, flag, stamp)
    snapshot = named_as(snapshot, target)
    live = snapshot.withColumns({flag: F.lit(False), stamp: F.lit(None).cast("timestamp")})
    match = Match.on(keys)
    values = {c: f"{SOURCE}.{quoted(c)}" for c in target.columns if c in live.columns}
    present = snapshot.withColumn(_HIT, F.lit(True)).alias(SOURCE)
    joined = target.alias(TARGET).join(present, F.expr(match.condition), "left")
    hit = F.col(f"{SOURCE}.{_HIT}").isNotNull()

    def value(field):
        if field.name == flag:
            return ~hit
        if field.name == stamp:
            return F.when(~hit, F.coalesce(_old(stamp), moment.cast(field.dataType)))
        if field.name in snapshot.columns:
            return F.when(hit, F.expr(values[field.name])).otherwise(_old(field.name))
        return _old(field.name)

    kept = joined.select([_typed(value(f), f) for f in target.schema.fields])
    return kept.unionByName(_inserted(target, live, match, values))


def with_deletion_columns(target: DataFrame, flag: str = "is_deleted", stamp: str = "deleted_at") -> DataFrame:
    """``target`` with the columns of a soft delete, where it lacks them."""
    for name, value in ((flag, F.lit(False)), (stamp, F.lit(None).cast("timestamp"))):
        if name not in target.columns:
            target = target.withColumn(name, value)
    return target


def snapshot_diff(before: DataFrame, after: DataFrame, keys: Sequence[str],
                  hash_column: str | None = None, keep_before: bool = False) -> DataFrame:
    """Rows inserted, updated or deleted between two snapshots with unique keys (NULL is a key). A
    repeated key fails the job.

    Deleted rows carry the old values, the others the new ones, plus a ``change`` column. Columns are
    those of ``after``; one that ``before`` lacks counts as NULL there. With
    ``hash_column`` two rows are equal if their stored fingerprints are; otherwise all columns are
    compared, NULLs included. ``keep_before`` adds the whole old row as the struct ``before``, which
    ``changes_composed`` needs.
    """
    if keep_before and hash_column:
        raise ValueError("rows compared by hash have no old row at hand")
    for field in after.schema.fields:
        if field.name not in before.columns:
            before = before.withColumn(field.name, F.lit(None).cast(field.dataType))
    before = before.select(refs(after.columns))
    if hash_column:
        return _diff_by_hash(before, after, keys, hash_column)
    columns = after.columns
    joined = _full_join(before, after, keys, columns)
    compared = [c for c in columns if c not in keys]
    change = _change([F.col("old")[c].eqNullSafe(F.col("new")[c]) for c in compared])
    return (
        joined.select(change.alias("change"), F.coalesce("new", "old").alias("row"), F.col("old").alias("before"))
        .where("change IS NOT NULL")
        .select("change", *[F.col("row")[c].alias(c) for c in columns], *(["before"] if keep_before else []))
    )


def changes_composed(changes: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """The net change of each key over several consecutive differences, numbered in the column ``version``.

    ``changes`` is the union of differences with their old rows (``snapshot_diff`` with ``keep_before``), one row per
    key and version. What was inserted and deleted again cancels, chains fold into one change from the first old row to
    the last new one, and a row that is as it was drops out: the result is the difference of the first and the last
    snapshot. One aggregate that combines on the map side: a key's versions are never brought together as a list.
    """
    columns = [c for c in changes.columns if c not in ("change", "before", version)]
    row = F.when(ref("change") != "delete", F.struct(refs(columns)))
    # The values are wrapped, because a missing row must not be skipped in favour of another version's.
    folded = changes.groupBy(F.struct(refs(keys)).alias(_KEY)).agg(
        F.min_by(F.struct(ref("before").alias("row")), ref(version))["row"].alias("old"),
        F.max_by(F.struct(row.alias("row")), ref(version))["row"].alias("new"))
    compared = [c for c in columns if c not in keys]
    same = [F.col("old")[c].eqNullSafe(F.col("new")[c]) for c in compared]
    change = F.when(F.col("old").isNull() & F.col("new").isNull(), F.lit(None)).otherwise(_change(same))
    return (
        folded.select(change.alias("change"), F.coalesce("new", "old").alias("row"), F.col("old").alias("before"))
        .where("change IS NOT NULL")
        .select("change", *[F.col("row")[c].alias(c) for c in columns], "before")
    )


def _diff_by_hash(before: DataFrame, after: DataFrame, keys: Sequence[str], hash_column: str) -> DataFrame:
    """Only keys and hashes meet in the full join; the changed rows are then fetched by key."""
    narrow = [*keys, hash_column]
    joined = _full_join(before.select(refs(narrow)), after.select(refs(narrow)), keys, narrow)
    change = _change([F.col("old")[hash_column].eqNullSafe(F.col("new")[hash_column])])
    changed = joined.select(
        change.alias("change"),
        *[F.coalesce("new", "old")[k].alias(f"__c{i}") for i, k in enumerate(keys)],
    ).where("change IS NOT NULL")
    same_key = [ref(k).eqNullSafe(F.col(f"__c{i}")) for i, k in enumerate(keys)]

    def rows(side: DataFrame, condition: str) -> DataFrame:
        return side.join(changed.where(condition), same_key).select("change", *refs(side.columns))

    return rows(after, "change <> 'delete'").unionByName(rows(before, "change = 'delete'"))


def _full_join(before: DataFrame, after: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Columns ``old`` and ``new``. The key is joined as one struct, in which NULLs equal each other."""
    old = _unique(before, keys).select(F.struct(refs(columns)).alias("old"), ref(_KEY).alias("__b"))
    new = _unique(after, keys).select(F.struct(refs(columns)).alias("new"), ref(_KEY).alias("__a"))
    return old.join(new, F.col("__b") == F.col("__a"), "full_outer")


def _unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows with their key, failing at a second row of one key instead of letting the join pair all
    of them.

    Ranks are limited to two per key before the shuffle, and the shuffle is the one the join needs.
    """
    rank = F.row_number().over(Window.partitionBy(ref(_KEY)).orderBy(ref(_KEY)))
    keyed = df.withColumn(_KEY, F.struct(refs(keys)))
    limited = keyed.withColumn(_RANK, rank).where(ref(_RANK) <= 2)
    problem = F.raise_error(F.lit(f"repeated key ({', '.join(keys)}) in a snapshot"))
    return limited.where(F.when(ref(_RANK) == 2, problem).otherwise(F.lit(True))).drop(_RANK)


def _change(same_values: Sequence[Column]) -> Column:
    unchanged = reduce(and_, same_values, F.lit(True))
    return (
        F.when(F.col("old").isNull(), "insert")
        .when(F.col("new").isNull(), "delete")
        .when(~unchanged, "update")
    )


def diff_applied(before: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Replay a snapshot difference; the inverse of ``snapshot_diff``."""
    touched = changes.select(*[ref(k).alias(f"__c{i}") for i, k in enumerate(keys)])
    same_key = [ref(k).eqNullSafe(F.col(f"__c{i}")) for i, k in enumerate(keys)]
    kept = before.join(touched, same_key, "left_anti")
    return kept.unionByName(changes.where("change <> 'delete'").drop("change"))
