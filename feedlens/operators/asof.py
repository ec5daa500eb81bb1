"""As-of join: each row with the version of its key that was valid at its time.

Events and versions become one line of rows per key in order of time, versions first at equal
times, and every event takes the last version before it.  The line is dealt by ranges of (key,
time), so neither a key with a third of all events nor one with very many versions lies in one
task, and no event meets more than one version: nothing is multiplied and then filtered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.operators.ranking import carried_forward


def join_as_of(events: DataFrame, versions: DataFrame, event_key: str, event_time: str,
               version_key: str, valid_from: str, values: list[str]) -> DataFrame:
    """``events`` with the ``values`` columns of the version valid at ``event_time`` (``valid_from``
    at or before it); null where the key has none yet.  Versions without key or time never match,
    events without never do either; of versions of one key and time the greatest values win."""
    own = F.struct(*[F.col(f"`{c}`") for c in events.columns])
    version = F.struct(*[F.col(f"`{c}`") for c in values])
    kind = events.schema[event_key].dataType
    line = events.select(
        F.col(event_key).alias("_ao_key"), F.col(event_time).alias("_ao_at"), F.lit(1).alias("_ao_kind"), own.alias("_ao_event"))
    known = versions.filter(F.col(version_key).isNotNull() & F.col(valid_from).isNotNull()).select(
        F.col(version_key).cast(kind).alias("_ao_key"), F.col(valid_from).alias("_ao_at"), F.lit(0).alias("_ao_kind"), version.alias("_ao_version"))
    wanted = line.select(F.col("_ao_key").alias("_ao_own")).filter(F.col("_ao_own").isNotNull()).distinct()
    known = known.join(wanted, F.col("_ao_key") == F.col("_ao_own"), "left_semi")      # keys without an event are not dealt
    both = line.unionByName(known, allowMissingColumns=True)
    found = carried_forward(both, [F.asc("_ao_at"), F.asc("_ao_kind"), F.asc("_ao_version")], ("_ao_key",), "_ao_version", "_ao_valid")
    matched = F.when(F.col("_ao_key").isNotNull() & F.col("_ao_at").isNotNull(), F.col("_ao_valid"))
    return found.filter(F.col("_ao_kind") == 1).select(
        *[F.col(f"_ao_event.`{c}`").alias(c) for c in events.columns], *[matched[c].alias(c) for c in values])
