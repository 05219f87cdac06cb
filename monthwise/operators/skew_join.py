"""Equi-joins with a dimension when a few keys hold much of the facts.

Adaptive execution splits a hot key only where it sees the shuffle of the very join, and not
below an aggregation or after an explicit repartitioning.  Here the heavy keys are found
first, by a frequent-items sketch (one pass, a bounded sketch per task), and their rows
are dealt over several salts; the dimension rows of these keys, and of no others, are
repeated once per salt.  All other keys join as usual.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TRACKED = 10_000               # items that a sketch holds
MOST_HEAVY = 256               # heavy keys fetched to the driver


@dataclass(frozen=True)
class HeavyKeys:
    """Heavy keys with their estimated rows, the rows in all, and those whose key is NULL."""
    keys: tuple
    total: int
    nulls: int

    def salts(self, rows: int, parts: int) -> int:
        """Salts of a key: as many as the fair shares of ``parts`` tasks that its rows fill."""
        return max(1, -(-rows * parts // max(1, self.total)))


def heavy_keys(df: DataFrame, key: str, share: float = 1 / 256) -> HeavyKeys:
    """Keys that hold more than ``share`` of the rows (at most ``1 / share`` of them, fetched to
    the driver).  The sketch is off by at most total / TRACKED * 2 rows, far below such a share."""
    row = df.agg(F.count("*").alias("n"), F.count_if(F.col(key).isNull()).alias("nulls"),
                 F.expr(f"approx_top_k(`{key}`, {MOST_HEAVY}, {TRACKED})").alias("top")).first()
    found = [(x["item"], x["count"]) for x in row["top"] or []
             if x["item"] is not None and x["count"] > share * row["n"]]
    return HeavyKeys(tuple(sorted(found, key=lambda x: -x[1])), row["n"], row["nulls"])


def _salts(heavy: HeavyKeys, key: str, parts: int, kind: str) -> Column:
    """Number of salts of a row's key: 1 for keys that are not heavy."""
    out = F.when(F.lit(False), F.lit(1))
    for k, n in heavy.keys:
        out = out.when(F.col(key) == F.lit(k).cast(kind), F.lit(heavy.salts(n, parts)))
    return out.otherwise(F.lit(1))


def salted_join(facts: DataFrame, dim: DataFrame, key: str, how: str = "left", parts: int | None = None,
                heavy: HeavyKeys | None = None) -> DataFrame:
    """``facts.join(dim, key, how)`` for ``how`` in left, inner; no task gets much more than
    its share of a heavy key.  ``parts``: tasks to spread over (default: the session's
    shuffle partitions).  A dimension that Spark broadcasts is joined without a shuffle.  ``dim`` may hold a key several times; NULL keys match nothing, and a
    left join spreads them like a heavy key."""
    if how not in ("left", "inner"):
        raise ValueError("how must be 'left' or 'inner'")
    parts = parts or int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    heavy = heavy_keys(facts, key) if heavy is None else heavy
    kind = facts.schema[key].dataType.simpleString()
    n = F.when(F.col(key).isNull(), F.lit(heavy.salts(heavy.nulls, parts))).otherwise(_salts(heavy, key, parts, kind))
    # the row's number in its task: rows that are equal in all columns are spread too
    salted = facts.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), n).cast("int"))
    copies = dim.withColumn("_salt", F.explode(F.sequence(F.lit(0), _salts(heavy, key, parts, kind) - 1)))
    return salted.join(copies, [key, "_salt"], how).select(*facts.columns, *[c for c in dim.columns if c != key])
