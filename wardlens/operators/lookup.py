"""Left or inner join of a large frame to a per-key lookup."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 * 1024 * 1024
SALTS = 32
#: A key with more than one in so many rows is hot; there are fewer hot keys than this.
HOT_SHARE = 200
#: Keys that the summary of frequent ones tracks; counts are off by at most 3.5 / SUMMARY of all rows.
SUMMARY = 16_384
#: Rows may take so many times the bytes of their compressed files.
EXPANSION = 16


def measured_bytes(df: DataFrame) -> int:
    """Upper estimate of a lookup's size.

    Where the statistics of its files say that it is small whatever their compression, no job runs;
    else it is the size of the rows as JSON text.
    """
    estimate = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if estimate * EXPANSION <= BROADCAST_BYTES:
        return estimate * EXPANSION
    size = df.agg(F.sum(F.octet_length(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}))))
    return size.first()[0] or 0


def hot_hashes(facts: DataFrame, key: Column) -> list[int]:
    """Hashes of the keys of more than 1 / ``HOT_SHARE`` of the rows, in one pass with a bounded summary.

    The summary may add a key just below that share, but misses none: it counts each key short by less than
    half of what makes a key hot.
    """
    found = facts.select(key.alias("h")).agg(
        F.count("*").alias("rows"), F.expr(f"approx_top_k(h, {2 * HOT_SHARE}, {SUMMARY})").alias("top")).first()
    return sorted(item["item"] for item in found.top or [] if item["count"] * 2 * HOT_SHARE > found.rows)


def attach(facts: DataFrame, lookup: DataFrame, on: Mapping[str, Column], spread_by: str,
           null_safe: tuple[str, ...] = (), how: str = "left",
           max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Join ``facts`` to ``lookup``, which holds at most one row per key and keeps its other columns.

    ``on`` maps each key column of the lookup to an expression over ``facts``; null keys match
    only for columns in ``null_safe``. The lookup is measured first, so it should be a written
    table or derive from one. Up to ``max_bytes`` it is broadcast and the facts are not shuffled.

    Beyond that, facts and lookup are shuffled by key. Hot keys are found first; only their facts are
    spread by a salt from ``spread_by``, and only their lookup rows are copied ``SALTS`` times. Facts whose null
    key matches nothing are spread too. A stream's keys can't be counted ahead: there, all keys are salted and
    all rows copied. All ways give the same rows.
    """
    renamed = {name: f"_lookup_{name}" for name in on}
    side = lookup.withColumnsRenamed(renamed)
    extra = list(renamed.values())
    condition = F.lit(True)
    for name, expression in on.items():
        target = F.col(renamed[name])
        match = expression.eqNullSafe(target) if name in null_safe else expression == target
        condition = condition & match
    if measured_bytes(lookup) <= max_bytes:
        return facts.join(F.broadcast(side), condition, how).drop(*extra)
    spread = F.pmod(F.xxhash64(F.col(spread_by)), F.lit(SALTS)).cast("int")
    all_salts = F.sequence(F.lit(0), F.lit(SALTS - 1))
    if facts.isStreaming:
        salt, copies = spread, all_salts
    else:
        # Both sides hash the lookup's types, so that equal keys have equal hashes.
        typed = {name: expression.cast(lookup.schema[name].dataType) for name, expression in on.items()}
        hot = hot_hashes(facts, F.xxhash64(*typed.values()))
        unmatched = reduce(or_, [on[name].isNull() for name in on if name not in null_safe], F.lit(False))
        salt = F.when(unmatched, spread).otherwise(0)
        copies = F.array(F.lit(0))
        if hot:
            salt = F.when(F.xxhash64(*typed.values()).isin(hot), spread).otherwise(salt)
            copies = F.when(F.xxhash64(*map(F.col, renamed.values())).isin(hot), all_salts).otherwise(copies)
    side = side.withColumn("_lookup_salt", F.explode(copies))
    joined = facts.withColumn("_salt", salt).join(side, condition & (F.col("_salt") == F.col("_lookup_salt")), how)
    return joined.drop(*extra, "_salt", "_lookup_salt")
