"""What changed between full snapshots: content-defined chunks, then a join of the rows of unmatched chunks."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A chunk ends, on average, after this many keys. Short chunks find equal ones although a tenth of the keys change.
CHUNK_KEYS = 16
#: Bytes of the table's files wanted in one bucket (over all snapshots); a bucket is what one task sorts.
BUCKET_BYTES = 4_000_000


def snapshot_changes(
    rows: DataFrame,
    snapshot: Column,
    previous: DataFrame,
    keys: list[Column],
    value: Column,
    delivered: Column,
    chunk_keys: int = CHUNK_KEYS,
    buckets: int = 0,
) -> DataFrame:
    """(``snapshot``, ``k0``.., ``change_kind``): keys added, removed or changed against the snapshot before.

    ``previous`` lists the delivered snapshots as (``snapshot``, ``next_snapshot``, ``has_previous``). A snapshot holding a key more than
    once counts its latest delivery (null = earliest; on a tie the greatest value, null least). Two null values are
    equal, a null differs from any value. The first snapshot gives nothing. Rows with a null snapshot or a null in
    any key are ignored. An empty table gives no rows; other columns are not carried.

    Plan. Keys are hashed to ``buckets`` (0: by the size of the files, without a count) and each bucket of each snapshot is sorted by key. A key
    whose hash is a multiple of ``chunk_keys`` opens a chunk, so the same keys give the same chunks in every snapshot and a change moves only
    the borders beside it. A chunk is known by its first key, its count and two 64-bit digests of its rows. Chunks that agree in
    consecutive snapshots are discarded; only the rows of the others are taken, once per side, and brought together by key. Digests are laid beside
    the rows by windows over a chunk (its keys times the snapshots). As all is partitioned by bucket, windows and the final comparison need no
    exchange beyond one by bucket; repeated rows of a hot key are reduced before the first exchange.
    """
    k = [f"k{i}" for i in range(len(keys))]
    src = rows.select(
        snapshot.alias("snapshot"), *[c.alias(a) for c, a in zip(keys, k)], value.alias("v"), delivered.alias("d")
    ).where(" and ".join(f"{c} is not null" for c in ["snapshot", *k]))
    buckets = buckets or max(16, math.ceil(file_bytes(rows) / BUCKET_BYTES))
    one = src.groupBy("snapshot", *k).agg(F.max(F.struct("d", "v"))["v"].alias("v"))
    h = F.xxhash64(*k)
    one = one.withColumn("bucket", F.pmod(F.xxhash64(F.lit("bucket"), *k), F.lit(buckets)).cast("int")).withColumn("h", h)
    w = Window.partitionBy("bucket", "snapshot").orderBy(*k)
    opens = F.when(F.pmod("h", F.lit(chunk_keys)) == 0, F.col("h"))
    # Rows before the first opening key of a bucket belong to chunk 0.
    chunked = one.repartition("bucket").withColumn("chunk", F.coalesce(F.last(opens, ignorenulls=True).over(w), F.lit(0).cast("long")))
    chunked = chunked.join(F.broadcast(_neighbours(previous)), "snapshot")  # a list of snapshots, not of rows
    same = Window.partitionBy("bucket", "chunk", "snapshot")
    own = F.struct(
        F.count(F.lit(1)).over(same).alias("n"), F.bit_xor(F.xxhash64("h", F.col("v"), F.col("v").isNull())).over(same).alias("h1"), F.bit_xor(F.xxhash64(F.lit(7), *k, F.col("v"), F.col("v").isNull())).over(same).alias("h2")
    )
    x = chunked.withColumn("own", own)
    x = x.withColumn("all", F.collect_set(F.struct("snapshot", "own")).over(Window.partitionBy("bucket", "chunk")))  # one digest per snapshot
    of = lambda name: F.get(F.filter("all", lambda e: e["snapshot"] == name), 0)["own"]
    # Both sides present with one digest: nothing in the chunk changed.
    differs = lambda name: F.col(name).isNotNull() & ~F.coalesce(of(F.col(name)) == F.col("own"), F.lit(False))
    sides = F.array_compact(
        F.array(
            F.when(differs("previous_snapshot"), F.struct(F.col("snapshot").alias("pair"), F.lit(1).alias("side"))),
            F.when(differs("next_snapshot"), F.struct(F.col("next_snapshot").alias("pair"), F.lit(0).alias("side"))),
        )
    )
    left = x.select("bucket", *k, "v", F.explode(sides).alias("x")).select("bucket", *k, "v", "x.pair", "x.side")
    both = left.groupBy("bucket", "pair", *k).agg(
        F.max("side").alias("now"),
        F.min("side").alias("before"),
        F.max(F.when(F.col("side") == 1, F.col("v"))).alias("v1"),
        F.max(F.when(F.col("side") == 0, F.col("v"))).alias("v0"),
    )
    kind = (
        F.when(F.col("before") == 1, "added")
        .when(F.col("now") == 0, "removed")
        .when(~F.col("v1").eqNullSafe(F.col("v0")), "changed")
    )
    out = both.withColumn("change_kind", kind).where("change_kind is not null")
    return out.select(F.col("pair").alias("snapshot"), *k, "change_kind")


def file_bytes(df: DataFrame) -> int:
    """Bytes of the files a frame reads, as the planner knows them from the file listing; 0 where it reads none. No job runs."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [leaves.apply(i).stats().sizeInBytes() for i in range(leaves.size())]
    return max([x for x in map(int, sizes) if x < 1 << 60], default=0)


def _neighbours(previous: DataFrame) -> DataFrame:
    """(``snapshot``, ``previous_snapshot``, ``next_snapshot``) of a list of snapshots."""
    if "previous_snapshot" in previous.columns:
        return previous.select("snapshot", "previous_snapshot", "next_snapshot")
    before = previous.where("next_snapshot is not null").select(F.col("next_snapshot").alias("snapshot"), F.col("snapshot").alias("previous_snapshot"))
    return previous.select("snapshot", "next_snapshot").join(F.broadcast(before), "snapshot", "left")


def consecutive(rows: DataFrame, snapshot: Column, ranks: DataFrame) -> DataFrame:
    """(``snapshot``, ``previous_snapshot``, ``next_snapshot``, ``has_previous``) of the snapshots that were delivered, in the order of their rank.

    ``ranks`` is (``release_id``, ``release_rank``). The distinct snapshots are few (one per publication), so one
    sorted array holds them.
    """
    seen = rows.select(snapshot.alias("release_id")).where("release_id is not null").distinct()
    a = seen.join(ranks.select("release_id", "release_rank").distinct(), "release_id").agg(
        F.array_sort(F.collect_list(F.struct("release_rank", "release_id"))).alias("a")
    )
    return a.select(F.posexplode("a").alias("i", "s"), "a").select(
        F.col("s.release_id").alias("snapshot"),
        F.when(F.col("i") > 0, F.get("a", F.col("i") - 1)["release_id"]).alias("previous_snapshot"),
        F.get("a", F.col("i") + 1)["release_id"].alias("next_snapshot"),
        (F.col("i") > 0).alias("has_previous"),
    )
