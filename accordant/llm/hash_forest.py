"""Approximate nearest neighbours: a hash-prefix forest.

Every vector gets, in each of several trees, a long string of hash bits: signs of random
projections about the tree's own medians. A tree is the sorted array of its strings. A query
descends in each tree by bisection to the rows that share its longest prefix, then ascends all
trees together: the least prefix length at which any tree still has unseen rows gives up its rows
next, until the share of rows asked for has been seen. Distances to those rows are exact.

The index is built in blocks of rows, every row in one; a task builds the forest of a block once, from its
sorted stream of rows, and the queries that follow stream past it a batch at a time, so it holds one block and
one batch. A query's nearest of all blocks are merged. The hash functions come from a seed and a
block's own rows, so no row is left out of the index and nothing is sent to all executors. Equal
vectors are one entry that carries the least ids, as many as a result can show: a vector that a
third of the rows share costs no more than any other.

Defined results: vectors that are null, empty, zero, or hold null or non-finite components take no
part; vectors are compared with those of their own length; repeated rows (equal id and vector)
count once; a row is never its own neighbour, nor is another row of its id; ties in distance go to
the smaller id; fewer candidates than k are all returned; an empty table gives no rows. Other
columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

TREES, BITS = 16, 48
#: Rows of a block.
BLOCK_ROWS = 4096
#: Share of a block's rows whose distances are computed for a query, at least.
SHARE = 0.5
#: Rows seen in a block at least, however small the share.
LEAST = 512


class Forest:
    """Sorted hash strings of one block of vectors, in every tree."""

    def __init__(self, vectors: np.ndarray, trees: int = TREES, bits: int = BITS, seed: int = 11):
        self.n, self.bits, self.trees = len(vectors), bits, trees
        rng = np.random.default_rng(seed)
        self.planes = rng.standard_normal((trees, vectors.shape[1], bits))
        self.powers = 1 << np.arange(bits - 1, -1, -1, dtype=np.int64)
        self.cuts = np.empty((trees, bits))
        self.strings, self.order = np.empty((trees, self.n), dtype=np.int64), np.empty((trees, self.n), dtype=np.int64)
        for t in range(trees):
            seen = vectors @ self.planes[t]
            self.cuts[t] = np.median(seen, axis=0)  # halves the rows at each bit
            codes = (seen > self.cuts[t]) @ self.powers
            self.order[t] = np.argsort(codes, kind="stable")
            self.strings[t] = codes[self.order[t]]

    def codes(self, queries: np.ndarray) -> np.ndarray:
        return np.stack([((queries @ self.planes[t]) > self.cuts[t]) @ self.powers for t in range(self.trees)], axis=1)

    def candidates(self, codes: np.ndarray, wanted: int) -> Iterator[np.ndarray]:
        """For each query a mask of rows seen: the trees ascend together from the longest prefixes until `wanted` rows are in.

        Prefixes eight bits longer than it takes to tell a block's rows apart come in one step.
        """
        longest = min(self.bits, self.n.bit_length() + 8)
        low = np.empty((longest + 1, self.trees, len(codes)), dtype=np.int64)
        high = np.empty_like(low)
        for length in range(longest + 1):  # descent: bisection for every prefix length, all queries at once
            shift = self.bits - length
            for t in range(self.trees):
                first = (codes[:, t] >> shift) << shift
                low[length, t] = np.searchsorted(self.strings[t], first, side="left")
                high[length, t] = np.searchsorted(self.strings[t], first + (1 << shift), side="left")
        sizes = (high - low).sum(axis=1)
        for q in range(len(codes)):
            seen = np.zeros(self.n, dtype=bool)
            a, b = low[longest, :, q], high[longest, :, q]
            for t in range(self.trees):
                seen[self.order[t, a[t] : b[t]]] = True
            for length in range(longest - 1, -1, -1):
                if sizes[length + 1, q] >= wanted and seen.sum() >= wanted:
                    break
                c, d = low[length, :, q], high[length, :, q]
                for t in np.flatnonzero((c < a) | (d > b)):  # what a shorter prefix adds stands on either side
                    seen[self.order[t, c[t] : a[t]]] = True
                    seen[self.order[t, b[t] : d[t]]] = True
                a, b = c, d
            yield seen


def valid(vector):
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & F.coalesce(finite, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def nearest(vectors: DataFrame, queries: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = 10, share: float = SHARE, trees: int = TREES, bits: int = BITS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """query_id, rank, `key`, score: the k nearest found of each query row (same columns as `vectors`)."""

    def own(df: DataFrame) -> DataFrame:
        rows = df.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("v")).where("id is not null")
        return rows.where(valid(F.col("v")))

    # One entry for equal vectors, with the least ids: k + 1, since a query's own is passed over.
    # The limit by rank works before the shuffle too, so a common vector arrives as a few rows a task.
    class_ = Window.partitionBy("v").orderBy("id")
    least = own(vectors).withColumn("n", F.dense_rank().over(class_)).where(F.col("n") <= k + 1)
    entries = least.groupBy("v").agg(F.array_sort(F.collect_set("id")).alias("ids"))
    entries = materialise(entries.select(F.expr("ids[0]").alias("first"), "ids", "v"))
    asked = materialise(own(queries).distinct())

    blocks = max(1, math.ceil(entries.count() / block_rows))
    rows = entries.select(F.pmod(F.xxhash64("first"), F.lit(blocks)).cast("int").alias("block"), F.lit(False).alias("asks"), "ids", "v")
    asks = asked.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(True).alias("asks"), F.array("id").alias("ids"), "v")

    def answers(forests: dict, wants: pd.DataFrame) -> pd.DataFrame:
        out = []
        for size, group in wants.groupby(wants["v"].map(len)):
            if size not in forests:
                continue
            forest, x, ids = forests[size]
            q = np.stack(group["v"].to_numpy())
            wanted = max(min(forest.n, LEAST), math.ceil(share * forest.n))
            for n, (own_ids, seen) in enumerate(zip(group["ids"].to_list(), forest.candidates(forest.codes(q), wanted))):
                rows_ = np.flatnonzero(seen)
                distance = np.sqrt(((x[rows_] - q[n]) ** 2).sum(axis=1))
                if len(rows_) > k + 1:  # an entry has an id to give, but for the query's own alone
                    edge = np.partition(distance, k)[k]
                    near = distance <= edge
                    rows_, distance = rows_[near], distance[near]
                me = int(own_ids[0])
                found = sorted((d, int(i)) for d, r in zip(distance.tolist(), rows_.tolist()) for i in ids[r] if int(i) != me)[:k]
                out += [(me, i, d) for d, i in found]
        return pd.DataFrame(out, columns=["query_id", "id", "score"])

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, base, forests = None, [], {}
        for batch in batches:
            block, asks_ = batch["block"].to_numpy(), batch["asks"].to_numpy(dtype=bool)
            edges = np.flatnonzero(np.concatenate(([True], (block[1:] != block[:-1]) | (asks_[1:] != asks_[:-1])))).tolist() if len(batch) else []
            for a, b in zip(edges, [*edges[1:], len(batch)]):
                if block[a] != now:
                    now, base, forests = block[a], [], {}
                if not asks_[a]:
                    base.append(batch.iloc[a:b])
                    continue
                if base:
                    whole, base = pd.concat(base), []
                    for size, group in whole.groupby(whole["v"].map(len)):
                        x = np.stack(group["v"].to_numpy())
                        forests[size] = Forest(x, trees, bits), x, group["ids"].to_list()
                yield answers(forests, batch.iloc[a:b])

    # A block's rows, then its queries.
    streamed = rows.unionByName(asks).repartition("block").sortWithinPartitions("block", "asks", F.col("ids")[0])
    found = streamed.mapInPandas(search, "query_id long, id long, score double")
    best = found.groupBy("query_id", "id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "id")).alias("rank")
    return best.select("query_id", rank, F.col("id").alias(key), "score").where(F.col("rank") <= k)
