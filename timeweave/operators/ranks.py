"""How far two orders of the same rows differ, without listing pairs of rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Groups of more rows than this are cut into blocks; rows of a block as a rule, blocks of a group at most.
SMALL, BLOCK, MOST = 4096, 65_536, 1024


def inversions(group: np.ndarray, a: np.ndarray, b: np.ndarray, weight: np.ndarray, groups: int) -> np.ndarray:
    """Weight of each group's pairs with a less and b greater; n log n for all groups together, by the bits of b's ranks.

    Two rows part at the highest bit in which their ranks differ: an inversion
    is a one before a zero among the rows that agree in all higher bits.
    """
    order = np.lexsort((b, a, group))  # rows of equal a with rising b: no inversions among them
    rank, w, g = np.unique(b, return_inverse=True)[1][order], weight[order].astype(np.int64), group[order]
    total = np.zeros(groups, np.int64)
    bits = int(rank.max(initial=0)).bit_length()
    for bit in range(bits - 1, -1, -1):
        key = (g.astype(np.int64) << bits) + (rank >> (bit + 1))
        by = np.argsort(key, kind="stable")
        prefix, one, own = key[by], (rank[by] >> bit) & 1, w[by]
        before = np.cumsum(own * one)
        starts = np.flatnonzero(np.append(True, prefix[1:] != prefix[:-1]))
        base = np.repeat(np.append(0, before)[starts], np.diff(np.append(starts, len(by))))
        np.add.at(total, g[by], (before - base) * own * (1 - one))
    return total


def discordant_fraction(df: DataFrame, keys: list[str], rank_a: str, rank_b: str) -> DataFrame:
    """Share of pairs that the two rankings order differently, within each group, and the number of pairs.

    A pair is two rows of different ``rank_a``; equal ``rank_b`` is no
    difference, and pairs with a null ``rank_b`` count in ``pairs`` only. Groups
    without pairs give no row. Equal rows are counted before anything else.
    Groups of up to SMALL different rows are one array each. A larger one is cut
    into blocks of neighbours by either ranking; what two blocks of the first and
    two of the second hold is counted as a product, so only pairs within a block
    of one of them are looked at, by their ranks and not one by one.
    """
    a, b = F.col(rank_a).alias("a"), F.col(rank_b).alias("b")
    cells = df.select(*keys, a, b).where("a is not null").groupBy(*keys, "a", "b").agg(F.count("*").alias("w"))
    per = cells.groupBy(*keys, "a").agg(F.sum("w").alias("n"), F.sum(F.when(F.col("b").isNotNull(), F.col("w")).otherwise(0)).alias("m"), F.count("b").alias("different"))
    square = lambda c: F.col(c).cast("decimal(38,0)") * F.col(c).cast("decimal(38,0)")
    pairs = lambda c: ((F.sum(c).cast("decimal(19,0)") * F.sum(c).cast("decimal(19,0)") - F.sum(square(c))) / 2).cast("long")
    sizes = per.groupBy(*keys).agg(pairs("n").alias("pairs"), pairs("m").alias("known"), F.sum("different").alias("different")).where("pairs > 0")
    known = cells.where("b is not null")

    def counted(rows: pa.Array) -> pa.Array:
        x, y, w = (c.to_numpy(zero_copy_only=False) for c in rows.flatten().flatten())
        group = np.repeat(np.arange(len(rows)), rows.value_lengths().to_numpy(zero_copy_only=False))
        return pa.array(inversions(group, x, y, w, len(rows)), pa.int64())

    small = known.join(sizes.where(F.col("different") <= SMALL).select(*keys), keys).groupBy(*keys).agg(F.collect_list(F.struct("a", "b", "w")).alias("rows"))
    found = small.select(*keys, F.arrow_udf(counted, "long")("rows").alias("turned")).unionByName(_large(known, sizes.where(F.col("different") > SMALL), keys))
    out = sizes.join(found, keys, "left")
    return out.select(*keys, F.when(F.col("known") > 0, F.coalesce("turned", F.lit(0)) / F.col("known")).alias("discordant"), "pairs")


def _large(cells: DataFrame, sizes: DataFrame, keys: list[str]) -> DataFrame:
    held = cells.join(sizes.select(*keys, "different"), keys)
    shares = [i / MOST for i in range(1, MOST)]
    marks = held.groupBy(*keys).agg(F.max("different").alias("d"), *(F.percentile_approx(c, shares, 10_000).alias(f"{c}s") for c in "ab"))
    # every so manieth mark: about BLOCK rows between two
    step = F.greatest(F.lit(1), F.floor(F.lit(MOST) * BLOCK / F.col("d"))).cast("int")
    thin = lambda c: F.array_distinct(F.filter(c, lambda x, i: i % step == 0))
    marks = marks.select(*keys, thin("as").alias("as"), thin("bs").alias("bs"))
    below = lambda c: F.size(F.filter(f"{c}s", lambda x: x <= F.col(c)))
    placed = held.drop("different").join(marks, keys).select(*keys, "a", "b", "w", below("a").alias("ia"), below("b").alias("ib"))
    kinds = dict(placed.dtypes)
    ddl = ", ".join([*(f"`{k}` {kinds[k]}" for k in keys), "turned long"])

    def row(t: pa.Table, value: int) -> pa.Table:
        return pa.table([t[k].slice(0, 1) for k in keys] + [pa.array([value], pa.int64())], [*keys, "turned"])

    def arrays(t: pa.Table) -> list[np.ndarray]:
        return [t[c].to_numpy() for c in ("a", "b", "w", "ia", "ib")]

    def within(t: pa.Table) -> pa.Table:
        x, y, w, _, _ = arrays(t)
        return row(t, int(inversions(np.zeros(len(x), int), x, y, w, 1)[0]))

    def across(t: pa.Table) -> pa.Table:
        x, y, w, i, _ = arrays(t)
        # without the pairs that the first ranking's blocks count
        return row(t, int(inversions(np.zeros(len(x), int), x, y, w, 1)[0] - inversions(i, x, y, w, MOST + 1).sum()))

    def products(t: pa.Table) -> pa.Table:
        i, j, w = (t[c].to_numpy() for c in ("ia", "ib", "w"))
        grid = np.zeros((MOST + 1, MOST + 1), np.int64)
        grid[i, j] = w
        # weight above in the first ranking and greater in the second
        before = np.zeros_like(grid)
        before[1:, :-1] = np.cumsum(np.cumsum(grid[:, ::-1], axis=1)[:, ::-1], axis=0)[:-1, 1:]
        return row(t, int((grid * before).sum()))

    parts = placed.groupBy(*keys, "ia").applyInArrow(within, ddl)
    parts = parts.unionByName(placed.groupBy(*keys, "ib").applyInArrow(across, ddl))
    cross = placed.groupBy(*keys, "ia", "ib").agg(F.sum("w").alias("w"))
    return parts.unionByName(cross.groupBy(*keys).applyInArrow(products, ddl)).groupBy(*keys).agg(F.sum("turned").alias("turned"))
