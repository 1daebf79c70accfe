"""Signal operators on ordered readings: Gaussian smoothing with mirrored ends, lagged correlation, shift by lag."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rovermill.operators.chunks import map_groups, with_halo


def gaussian_kernel(sigma: float, truncate: float = 4.0) -> list[float]:
    """Weights of offsets -radius..radius, radius = int(truncate x sigma + 0.5), with sum 1."""
    radius = int(truncate * sigma + 0.5)
    w = [math.exp(-0.5 * (k / sigma) ** 2) for k in range(-radius, radius + 1)]
    return [x / sum(w) for x in w]


def smooth(df: DataFrame, cols: list[str], sigma: float, entity: str = "ride_id", span: int = 4_096) -> DataFrame:
    """Gaussian-weighted means of cols over the rows around each. df has seq, the 0-based position in its entity (dense).

    Beyond an end the series is mirrored with the end row repeated. Windows run per block of positions with a halo of the
    kernel's radius. Nulls make the means that touch them null.
    """
    kernel = gaussian_kernel(sigma)
    radius = len(kernel) // 2
    size = df.groupBy(entity).agg(F.count(F.lit(1)).alias("_n"))
    rows = with_halo(df.drop("chunk").join(size, entity), F.col("seq"), span, radius, radius)
    w = Window.partitionBy(entity, "chunk").orderBy("seq")
    around = lambda c: F.array(*[F.lag(c, -k).over(w) for k in range(-radius, radius + 1)])

    def mean(c: str) -> Column:
        total: Column = F.lit(0.0)
        for k, weight in zip(range(-radius, radius + 1), kernel, strict=True):
            at = F.pmod(F.col("seq") + k, 2 * F.col("_n"))
            at = F.when(at >= F.col("_n"), 2 * F.col("_n") - 1 - at).otherwise(at)
            total = total + F.lit(weight) * F.element_at(f"_a_{c}", (at - F.col("seq") + radius + 1).cast("int"))
        return total

    rows = rows.withColumns({f"_a_{c}": around(c) for c in cols}).where("own")
    return rows.withColumns({f"{c}_smooth": mean(c) for c in cols}).drop("_n", "own", "chunk", *[f"_a_{c}" for c in cols])


def lagged_correlation(df: DataFrame, a: str, b: str, lags: tuple[int, int] = (-100, 100), entity: str = "ride_id", span: int = 8_192) -> DataFrame:
    """entity, lag, n, r: Pearson correlation of a at position seq + lag with b at seq, lags from first to last exclusive.

    df has entity and seq (dense from 0) and finite a and b. Each block of positions gives the sums of every lag in one pass of
    arrays; r is null where either side is constant or fewer than two pairs exist.
    """
    first, last = lags
    reach = max(abs(first), abs(last))
    rows = with_halo(df.select(entity, "seq", F.col(a).cast("double").alias("a"), F.col(b).cast("double").alias("b")), F.col("seq"), span, reach, reach)

    def sums(key: dict, g: dict) -> dict | None:
        seq, va, vb, own = g["seq"], g["a"], g["b"], g["own"].astype(bool)
        mine = np.flatnonzero(own)
        if len(mine) == 0:
            return None
        out: dict[str, list] = {c: [] for c in ("lag", "n", "sa", "sb", "saa", "sbb", "sab")}
        base = seq[0]
        for lag in range(first, last):
            at = seq[mine] + lag - base
            ok = (at >= 0) & (at < len(seq))
            x, y = va[at[ok]], vb[mine[ok]]
            for c, v in zip(out, (lag, len(x), x.sum(), y.sum(), (x * x).sum(), (y * y).sum(), (x * y).sum()), strict=True):
                out[c].append(v)
        return {entity: np.full(last - first, key[entity])} | {c: np.array(v) for c, v in out.items()}

    parts = map_groups(rows, [entity, "chunk"], ["seq"], sums, f"{entity} long, lag long, n long, sa double, sb double, saa double, sbb double, sab double")
    t = parts.groupBy(entity, "lag").agg(*[F.sum(c).alias(c) for c in ("n", "sa", "sb", "saa", "sbb", "sab")]).where("n >= 2")
    n = F.col("n")
    va, vb = F.col("saa") / n - F.pow(F.col("sa") / n, 2), F.col("sbb") / n - F.pow(F.col("sb") / n, 2)
    tiny = F.lit(1e-9)
    r = F.when((va > tiny) & (vb > tiny), (F.col("sab") / n - F.col("sa") / n * F.col("sb") / n) / F.sqrt(F.when((va > tiny) & (vb > tiny), va * vb).otherwise(1.0)))
    return t.select(entity, "lag", "n", r.alias("r"))


def best_lag(corr: DataFrame, entity: str = "ride_id", least: float = 0.7) -> DataFrame:
    """entity, lag, r, aligned of the greatest correlation, the first of equal ones. An entity with any undefined correlation is not aligned."""
    best = F.min_by(F.struct("lag", "r"), F.struct(-F.col("r"), F.col("lag")))
    t = corr.groupBy(entity).agg(best.alias("best"), F.max(F.col("r").isNull()).alias("undefined"))
    lag, r = F.when(~F.col("undefined"), F.col("best.lag")), F.when(~F.col("undefined"), F.col("best.r"))
    return t.select(entity, lag.alias("lag"), r.alias("r"), F.coalesce(~F.col("undefined") & (F.col("best.r") > least), F.lit(False)).alias("aligned"))


def shifted(df: DataFrame, lags: DataFrame, move: list[str], keep: list[str], entity: str = "ride_id", reach: int = 100, span: int = 8_192) -> DataFrame:
    """entity, seq, keep and move: rows with the columns of move taken `lag` positions later than those of keep.

    df: entity, seq (dense from 0), keep and move, none of them null. Rows that lose their partner fall away. Null lags count as 0, as
    do those of entities without one; none is longer than reach. Blocks of positions carry a halo of it, so rows are shuffled once.
    """
    cols = df.select(entity, "seq", *keep, *move)
    rows = with_halo(cols.withColumn("_lag", F.lit(0).cast("long")), F.col("seq"), span, reach, reach)
    # a block learns its lag from a row of its own, so that the rows of a ride needn't meet for a join
    last = cols.groupBy(entity).agg(F.max("seq").alias("_n")).join(lags.select(entity, F.col("lag").alias("_lag")), entity, "left")
    blocks = F.sequence(F.floor(F.lit(-reach) / F.lit(span)), F.floor((F.col("_n") + reach) / F.lit(span)))
    types = {f.name: f.dataType for f in cols.schema}
    told = last.select(entity, F.lit(-(2**62)).cast("long").alias("seq"), *[F.lit(0).cast(types[c]).alias(c) for c in (*keep, *move)], F.coalesce("_lag", F.lit(0)).cast("long").alias("_lag"), F.explode(blocks).alias("chunk"), F.lit(False).alias("own"))

    def fn(key: dict, a: dict) -> dict | None:
        lag, a = int(a["_lag"][0]), {c: v[1:] for c, v in a.items()}
        if abs(lag) > reach:
            raise ValueError(f"a lag of {lag} rows is beyond the reach of {reach}")
        at = np.flatnonzero(a["own"].astype(bool))
        at = at[(at + lag >= 0) & (at + lag < len(a["seq"]))]
        return {entity: np.full(len(at), key[entity]), "seq": a["seq"][at]} | {c: a[c][at] for c in keep} | {c: a[c][at + lag] for c in move}

    return map_groups(rows.unionByName(told), [entity, "chunk"], ["seq"], fn, cols.schema)
