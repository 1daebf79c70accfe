"""Items of varying size into containers of fixed capacity, by bounded-space online best fit.

A fixed number of containers is open at a time. A bitset has bit f set if an open container has f units free, so the best fit
is the lowest set bit at or above the item's size. When none fits and all places are taken, the fullest container closes.
Shards of the items are packed each by itself; at most `open_bins` containers a shard stay less than full for want of items.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rovermill.operators.chunks import map_groups
from rovermill.runtime import cut


@dataclass(frozen=True)
class PackingRules:
    capacity: int = 2_048
    open_bins: int = 64
    shard_bins: int = 8_192


def best_fit(sizes: list[int], capacity: int, open_bins: int) -> tuple[list[int], list[int]]:
    """Container and place (units taken before it) of each item, in order; every size is at most capacity."""
    bits, count, made = 0, 0, 0
    by_free: dict[int, list[int]] = {}
    bins, places = [], []
    for s in sizes:
        fit = bits >> s
        if fit:
            free = s + (fit & -fit).bit_length() - 1
            stack = by_free[free]
            b = stack.pop()
            if not stack:
                bits &= ~(1 << free)
        else:
            if count == open_bins:
                low = (bits & -bits).bit_length() - 1
                by_free[low].pop()
                if not by_free[low]:
                    bits &= ~(1 << low)
                count -= 1
            b, free = made, capacity
            made += 1
            count += 1
        bins.append(b)
        places.append(capacity - free)
        free -= s
        if free:
            by_free.setdefault(free, []).append(b)
            bits |= 1 << free
        else:
            count -= 1
    return bins, places


def pack(items: DataFrame, rules: PackingRules | None = None) -> DataFrame:
    """Containers for items (doc_id, n_tokens): doc_id, part, part_start, part_tokens, bin_id, bin_offset.

    An item larger than the capacity fills whole containers with its first parts, the rest is packed like any other item.
    Smaller items are never split. Items of size 0 take no room but get a container; null sizes count as 0. bin_id is
    '<shard>-<number>', where oversized parts have containers '<doc_id>/<row>/<part>' of their own. Repeated doc_ids are items of their own.
    """
    r = rules or PackingRules()
    sized = cut(items.select("doc_id", F.coalesce(F.greatest("n_tokens", F.lit(0)), F.lit(0)).cast("long").alias("n"), F.monotonically_increasing_id().alias("row")), "sizes")
    total = sized.agg(F.sum("n").alias("t")).first()["t"] or 0
    shards = max(1, math.ceil(total / (r.capacity * r.shard_bins)))
    full = F.when(F.col("n") > r.capacity, F.floor(F.col("n") / r.capacity)).otherwise(0).cast("long")
    base = sized.withColumn("full", full)
    whole = base.where("full > 0").select("doc_id", "row", F.explode(F.sequence(F.lit(0).cast("long"), F.col("full") - 1)).alias("part"))
    whole = whole.select("doc_id", "part", (F.col("part") * r.capacity).alias("part_start"), F.lit(r.capacity).cast("long").alias("part_tokens"), F.concat_ws("/", "doc_id", "row", "part").alias("bin_id"), F.lit(0).cast("long").alias("bin_offset"))
    rest = base.withColumn("size", F.col("n") - F.col("full") * r.capacity).where("size > 0 or full = 0")
    rest = rest.select("doc_id", F.col("full").alias("part"), (F.col("full") * r.capacity).alias("part_start"), "size", F.pmod(F.xxhash64("doc_id", "row"), F.lit(shards)).alias("shard"), F.xxhash64("doc_id", "row", F.lit(1)).alias("turn"), "row")

    def fill(key: dict, a: dict) -> dict:
        bins, places = best_fit(a["size"].tolist(), r.capacity, r.open_bins)
        return {"doc_id": a["doc_id"], "part": a["part"], "part_start": a["part_start"], "part_tokens": a["size"], "bin_id": np.array([f"{key['shard']}-{b}" for b in bins], object), "bin_offset": np.array(places, np.int64)}

    packed = map_groups(rest, ["shard"], ["turn", "row"], fill, "doc_id long, part long, part_start long, part_tokens long, bin_id string, bin_offset long")
    return whole.unionByName(packed)
