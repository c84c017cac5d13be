"""Gold targets that follow a load-partitioned table without reading it again.

Beside the target a table of states is kept, with one more row for each load whose rows are in them. A run reads the
loads that have no such row, merges their states into the kept ones, and publishes states and loads with one change of the
catalog: a run that fails before it changes nothing, and one that is repeated finds nothing to do. The target is then written
from the states; a run that failed between the two writes it the next time.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.operators.states import Metric, merged_states, states, values
from stratum.quoting import ref
from stratum.scratch import staged
from stratum.sinks import tables

_LOAD = "__load"
# Fixed value: how the catalog spells a NULL partition.
_NULL = "__HIVE_DEFAULT_PARTITION__"


def refreshed(spark: SparkSession, source: str, load_column: str, target: str, group_by: Sequence[str],
              metrics: Sequence[Metric], location: str | None = None) -> list[str]:
    """Bring ``target`` up to date with ``source``, a table partitioned by ``load_column``; the loads merged now.

    Loads are taken as whole: rows added to one that is merged already are not seen. A NULL load is one as well.
    """
    info = tables.table_info(spark, source)
    if load_column not in info.partitions:
        raise ValueError(f"{source} is not partitioned by {load_column}")
    kept_in = tables.sibling(target, "__states")
    rows = spark.table(source)
    kept = staged(spark.table(kept_in), "gold-states") if spark.catalog.tableExists(kept_in) else None
    present = _loads(spark, source, load_column)
    if kept is not None:
        present = present.join(kept.where(ref(_LOAD).isNotNull()).select(_LOAD), _LOAD, "left_anti")
    loads = sorted(r[0] for r in present.collect())  # one value per load that is new
    if loads:
        new = states(_of_loads(rows, load_column, loads), group_by, metrics)
        if kept is not None:
            old = kept.where(ref(_LOAD).isNull()).drop(_LOAD)
            new = merged_states(old.unionByName(new.select([ref(f.name).cast(f.dataType).alias(f.name) for f in old.schema.fields])),
                                group_by, metrics)
        ledger = spark.createDataFrame([(load,) for load in loads], f"{_LOAD} string")
        if kept is not None:
            ledger = ledger.unionByName(kept.where(ref(_LOAD).isNotNull()).select(_LOAD))
        both = new.withColumn(_LOAD, F.lit(None).cast("string")).unionByName(ledger, allowMissingColumns=True)
        tables.overwrite(both, kept_in, location=f"{location}__states" if location else None)
    if loads or not spark.catalog.tableExists(target):
        current = spark.table(kept_in).where(ref(_LOAD).isNull()).drop(_LOAD)
        tables.overwrite(values(current, group_by, metrics), target, location=location)
    return loads


def _loads(spark: SparkSession, table: str, load_column: str) -> DataFrame:
    """The table's loads by its catalog entry; no file is opened."""
    value = F.regexp_extract("partition", rf"(?:^|/){re.escape(load_column)}=([^/]*)", 1)
    plain = F.url_decode(F.replace(value, F.lit("+"), F.lit("%2B")))
    known = spark.sql(f"SHOW PARTITIONS {table}").select(F.when(value != _NULL, plain).otherwise("").alias(_LOAD))
    return known.distinct()


def _of_loads(rows: DataFrame, load_column: str, loads: Sequence[str]) -> DataFrame:
    """The rows of the loads; others' partitions are not read."""
    named = [load for load in loads if load != ""]
    wanted = ref(load_column).cast("string").isin(named)
    return rows.where(wanted | ref(load_column).isNull() if "" in loads else wanted)
