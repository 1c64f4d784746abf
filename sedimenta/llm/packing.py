"""Filling containers of fixed capacity: shortest-pack-first over the histogram of lengths."""

from __future__ import annotations

from bisect import insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Ranks within one length are counted in this many hash parts, so a length shared by a third of all items is not one task's.
RANK_PARTS = 64
#: More than the items of one length.
RANKS = 1 << 42


def pack_histogram(histogram: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """(number of containers, {length: items in each}) for items no longer than ``capacity``.

    Lengths are placed longest first. The items of a length go to the pack with the most room left that still takes them (the shortest
    pack), else to new packs. As many copies as fit go into a pack at once. Equal packs are held as one pattern with a count; only rooms that
    have packs are kept, in order, so a length looks at no more rooms than it fills.
    """
    room: dict[int, list[list]] = {}  # room left -> [count, pattern]
    rooms: list[int] = []  # the keys of ``room`` in ascending order

    def add(left: int, pack: list) -> None:
        if left not in room:
            room[left] = []
            insort(rooms, left)
        room[left].append(pack)

    for length in sorted((x for x in histogram if histogram[x] > 0), reverse=True):
        left = histogram[length]
        opened: list[tuple[int, list]] = []  # packs touched by this length: not filled again by it
        while left and rooms and rooms[-1] >= length:
            r = rooms[-1]
            packs = room[r]
            while packs and left:
                count, pattern = packs.pop()
                each = min(r // length, -(-left // count))
                full = min(count, left // each)
                if not full:
                    each, full = left, 1
                if full < count:
                    opened.append((r, [count - full, pattern]))
                left -= full * each
                opened.append((r - each * length, [full, {**pattern, length: each}]))
            if not packs:
                del room[r]
                rooms.pop()
        for r, pack in opened:
            add(r, pack)
        if left:
            each = capacity // length
            full, rest = divmod(left, each)
            if full:
                add(capacity - each * length, [full, {length: each}])
            if rest:
                add(capacity - rest * length, [1, {length: rest}])
    return [(count, pattern) for r in rooms for count, pattern in room[r]]


def pack(items: DataFrame, item_id: str, size: Column, capacity: int) -> DataFrame:
    """(``item_id``, ``piece``, ``length``, ``container``, ``split``): every item placed in a container of ``capacity``.

    An item larger than the capacity is cut into pieces of the full capacity (each a container of its own) and a rest that is packed like
    other items; no other item is cut. Only the histogram of lengths, bounded by the capacity, comes to the driver;
    the patterns found there are sent out as one sorted table of rank ranges and joined back to the items by length and rank.

    Defined results: a null id is an item like any other; a null or negative size counts 0 and items of size 0 take container -1; repeated rows
    are separate items; an empty table gives no rows; other columns are dropped. Cost: one exchange of (id, length) by length and hash part.
    """
    spark = items.sparkSession
    n = F.greatest(F.coalesce(size.cast("long"), F.lit(0)), F.lit(0))
    base = items.select(F.col(item_id).cast("long").alias("item_id"), n.alias("n"))
    pieces = F.when(F.col("n") > 0, F.sequence(F.lit(0), F.floor((F.col("n") - 1) / capacity).cast("int"))).otherwise(F.array(F.lit(0)))
    p = base.select("item_id", "n", F.explode(pieces).alias("piece"))
    p = p.select("item_id", "piece", F.least(F.lit(capacity), F.col("n") - F.col("piece").cast("long") * capacity).cast("int").alias("length"), (F.col("n") > capacity).alias("split"))
    p = p.withColumn("part", F.pmod(F.xxhash64("item_id", "piece"), F.lit(RANK_PARTS)).cast("int"))
    parts = (
        p.groupBy("length", "part")
        .agg(F.count(F.lit(1)).alias("c"))
        .groupBy(F.col("length").alias("l"))
        .agg(F.array_sort(F.collect_list(F.struct("part", "c"))).alias("parts"), F.sum("c").alias("n"))
    )  # at most one row per length, with RANK_PARTS counts
    histogram = {r.l: r.n for r in parts.where("l > 0").select("l", "n").collect()}
    slots, container, used = [], 0, defaultdict(int)
    for count, pattern in pack_histogram(histogram, capacity):
        for length, each in pattern.items():
            slots.append((length, used[length], used[length] + count * each, each, container))
            used[length] += count * each
        container += count
    # The rank within a length: the place within its hash part, after the items of the parts before.
    local = F.row_number().over(Window.partitionBy("length", "part").orderBy("item_id", "piece")) - 1
    before = F.aggregate(F.filter("parts", lambda x: x["part"] < F.col("part")), F.lit(0).cast("long"), lambda acc, x: acc + x["c"])
    ranked = p.withColumn("r", local).join(F.broadcast(parts.select("l", "parts")), F.col("length") == F.col("l"))
    ranked = ranked.withColumn("rank", F.col("r") + before).drop("parts", "l")
    slots.sort()
    shared = spark.sparkContext.broadcast([np.array([x[i] for x in slots], dtype=np.int64) for i in range(5)])

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        length, lo, _, each, first = shared.value
        key = length * RANKS + lo
        for pdf in batches:
            n, r = pdf["length"].to_numpy(dtype=np.int64), pdf["rank"].to_numpy(dtype=np.int64)
            container = np.full(len(pdf), -1, dtype=np.int64)
            some = n > 0
            at = np.searchsorted(key, n[some] * RANKS + r[some], "right") - 1
            container[some] = first[at] + (r[some] - lo[at]) // each[at]
            yield pdf.assign(container=container)[["item_id", "no_id", "piece", "length", "container", "split"]]

    ranked = ranked.select(F.coalesce("item_id", F.lit(0).cast("long")).alias("item_id"), F.col("item_id").isNull().alias("no_id"), "piece", "length", "rank", "split")
    out = ranked.mapInPandas(place, "item_id long, no_id boolean, piece int, length int, container long, split boolean")
    return out.select(F.when(~F.col("no_id"), F.col("item_id")).alias(item_id), "piece", "length", "container", "split")


def byte_tokens(text: Column) -> Column:
    """Tokens of the public byte tokenizer: one per UTF-8 byte and one end token; a null text has no bytes."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1
