"""N-gram Jaccard join: documents whose word-shingle sets overlap, by T-occurrence search.

A document's set is its distinct 5-word shingles, as 64-bit names. Two documents link when their
Jaccard similarity reaches the threshold, which is an overlap of at least T shingles. The search
follows DivideSkip: a document's inverted lists are divided into the long ones, as many as T
allows to leave out, and the short ones; short lists are merged, and the documents found often
enough are probed for in the long lists by bisection. The lists are ascending runs of one array, which a stable
sort merges run by run; a heap would do the same a number at a time.

Distribution. (1) One pass names every document's set by a digest; documents of equal sets are one
class, whose first (least id) alone goes on. The same pass counts shingles, whose most frequent (a bounded
list) rank last in the global order. (2) By the prefix filter, linked sets share k of
their first n - T + k shingles in that order; sets that share fewer with all others together are
done. Classes that share one meet in a cell, named by the least of their digests; any linked pair shares a
cell. (3) The firsts' texts are sent to all their cells. A cell beyond a size is cut into
blocks, all pairs of which meet in bounded tasks. (4) In a cell the T-occurrence search finds every
link over the whole sets; the least cell that both ends share tells it, so it is told once. `pairs`
returns the links themselves; `join` counts them where they are found, since their number
grows with the square of a group, and sends on those that hold a cell's components together, which
become components by contraction.

Every link between classes is found; nothing is passed over, capped or sampled.

Defined results: a null or empty text, or one without words, has an empty set and links with
nothing; a shorter text than a shingle is one shingle; repeated rows are one document; rows that
share an id but not a text are classes of their own, each with its links, and join their components (texts of
one id are told apart by 64 bits); a null id gets a null component and links with nothing; an empty table
gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from accordant.operators.graph import components

from .common import LOWER_TABLE, chunks, id_columns, ids_of, materialise
from .word_hashes import WordNames, mix, window_names

WIDTH, PERCENT = 5, 75
#: Prefixes are longer by this share of a set, and linked sets then share as many shingles there, not only one.
EXTRA_PERCENT = 10
#: Shingles ranked by frequency: the most frequent, at most so many. Others rank before them, by name.
RANKED = 1 << 18
#: Shingles counted together in a worker, and the count there from which they are told.
COUNTED, TOLD = 3_000_000, 3
#: Shingles that one task holds of a cell; beyond it the cell is cut into blocks.
CELL_SHINGLES = 4_000_000
#: Bits of a name that prefixes leave out where they are shuffled.
POSTED = np.uint64(16)
#: Digests a worker remembers to pass over copies.
REMEMBERED = 300_000


class Shingler:
    def __init__(self, width: int = WIDTH):
        self.width, self.names = width, WordNames()

    def sets(self, texts: list[str | None]) -> list[np.ndarray]:
        """The sorted distinct shingle names of each text."""
        words = [t.encode("utf-8", "surrogatepass").translate(LOWER_TABLE).split() if t else [] for t in texts]
        sizes = np.array([len(w) for w in words])
        flat = self.names.of([w for own in words for w in own])
        windows = window_names(flat, self.width, 1)
        out, at = [], 0
        for n in sizes.tolist():
            if n >= self.width:
                out.append(np.unique(windows[at : at + n - self.width + 1]))
            elif n:
                out.append(window_names(flat[at : at + n], n, 100 + n))
            else:
                out.append(np.empty(0, dtype=np.uint64))
            at += n
        return out


def needed(n: int, percent: int = PERCENT) -> int:
    """The least overlap that any link of a set of n asks for."""
    return -(-percent * n // 100)


def extra(n: int) -> int:
    return max(1, EXTRA_PERCENT * n // 100)


def shared_at_least(n: int, percent: int = PERCENT) -> int:
    """Shingles that a set of n shares in its prefix with any set it links to.

    Of O common shingles in the global order the k-th stands in a set of n before the O - k others, so
    within the first n - needed(n) + k; k is the lesser extra of the two, and the other set has needed(n) at least.
    """
    return min(extra(n), extra(needed(n, percent)))


def reaches(overlap, n, m, percent: int = PERCENT):
    return 100 * overlap >= percent * (n + m - overlap)


def _digest(own: np.ndarray) -> tuple[int, int]:
    d = blake2b(own.tobytes(), digest_size=16).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


SET_SCHEMA = "doc long, h long, n long, d1 long, d2 long, shingles array<long>, counts array<long>"


def _name_sets(docs: DataFrame, width: int) -> DataFrame:
    """A row per document (doc, h, n, d1, d2; h names its text), and rows with n < 0 that carry counts of shingles seen often in a worker."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler, seen, pending, held = Shingler(width), set(), [], 0

        def told() -> pd.DataFrame:
            # Sorted in place, and the sets go first: np.unique would hold several copies of the names.
            names = np.concatenate(pending)
            pending.clear()
            names.sort()
            starts = np.flatnonzero(np.concatenate(([True], names[1:] != names[:-1])))
            counts = np.diff(starts, append=len(names))
            often = counts >= TOLD
            return pd.DataFrame({"doc": pd.array([None], dtype="Int64"), "h": [0], "n": [-1], "d1": [0], "d2": [0], "shingles": [names[starts[often]].view(np.int64)], "counts": [counts[often]]})

        for batch in batches:
            keys, texts = ids_of(batch), batch["t"].tolist()
            for a, b in chunks(texts):
                sets = shingler.sets(texts[a:b])
                digests = [_digest(s) for s in sets]
                for d, s in zip(digests, sets):
                    if len(s) and d not in seen:
                        seen.add(d)
                        pending.append(s)
                        held += len(s)
                if len(seen) > REMEMBERED:
                    seen.clear()
                yield pd.DataFrame({"doc": keys[a:b], "h": batch["h"].to_numpy()[a:b], "n": [len(s) for s in sets], "d1": [d[0] for d in digests], "d2": [d[1] for d in digests], "shingles": None, "counts": None})
                if held >= COUNTED:
                    yield told()
                    held = 0
        if pending:
            yield told()

    return docs.select("doc", "doc_null", "t", "h").mapInPandas(run, SET_SCHEMA)


def _order(named: DataFrame, ranked: int) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles, sorted by name, and their ranks: 1 and up, the most frequent last."""
    counted = named.where("n < 0").select(F.explode(F.arrays_zip("shingles", "counts")).alias("x")).groupBy(F.col("x.shingles").alias("name")).agg(F.sum("x.counts").alias("n"))
    top = counted.orderBy(F.desc("n"), "name").limit(ranked).toPandas()
    names, n = top["name"].to_numpy(dtype=np.int64).view(np.uint64), top["n"].to_numpy(dtype=np.int64)
    rank = np.empty(len(names), dtype=np.int64)
    rank[np.lexsort((names, n))] = np.arange(1, len(names) + 1)
    at = np.argsort(names)
    return names[at], rank[at]


def prefix_of(own: np.ndarray, names: np.ndarray, ranks: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """The first n - T + extra shingles of a set in the global order."""
    size = len(own) - needed(len(own), percent) + extra(len(own))
    if len(names):
        at = np.minimum(np.searchsorted(names, own), len(names) - 1)
        rank = np.where(names[at] == own, ranks[at], 0)
    else:
        rank = np.zeros(len(own), dtype=np.int64)
    return own[np.lexsort((mix(own), rank))[:size]]


def _postings(docs: DataFrame, order, width: int, percent: int) -> DataFrame:
    """d1, token: the prefix of each set, once for copies in a worker.

    A token is the upper 48 bits of a shingle's name: the zeros above them join those of the next row's head, so a shuffled row
    packs to two bytes less. Shingles that share them only put more sets into a cell, whose search compares whole names.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler, seen = Shingler(width), set()
        names, ranks = order.value
        for batch in batches:
            texts = batch["t"].tolist()
            for a, b in chunks(texts):
                digests, tokens = [], []
                for own in shingler.sets(texts[a:b]):
                    if len(own) and (d := _digest(own)) not in seen:
                        seen.add(d)
                        tokens.append((prefix_of(own, names, ranks, percent) >> POSTED).view(np.int64))
                        digests.append(np.full(len(tokens[-1]), d[0], dtype=np.int64))
                if len(seen) > REMEMBERED:
                    seen.clear()
                if tokens:
                    yield pd.DataFrame({"d1": np.concatenate(digests), "token": np.concatenate(tokens)})

    return docs.where("not doc_null").select("t").mapInPandas(run, "d1 long, token long")


def links_of(sets: list[np.ndarray], percent: int = PERCENT) -> Iterator[tuple[int, np.ndarray]]:
    """The index of each set with later links, and the indices of all later sets that it links to, by T-occurrence search."""
    g = len(sets)
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    flat = np.concatenate(sets) if g else np.empty(0, np.uint64)
    owner = np.repeat(np.arange(g), sizes)
    _, token = np.unique(flat, return_inverse=True)
    order = np.lexsort((owner, token))  # inverted lists: the owners of each token, in order
    lists, ends = owner[order], np.cumsum(np.bincount(token))
    starts = np.concatenate(([0], ends[:-1])).astype(np.int64)  # moved on past each owner, so that lists hold later sets alone
    offsets = np.concatenate(([0], np.cumsum(sizes)))
    for i in range(g):
        mine = token[offsets[i] : offsets[i + 1]]
        starts[mine] += 1
        lengths = ends[mine] - starts[mine]
        mine, lengths = mine[lengths > 0], lengths[lengths > 0]
        t = needed(int(sizes[i]), percent)
        if t == 0 or len(mine) < t:
            continue
        mine = mine[np.argsort(lengths, kind="stable")]
        # DivideSkip: as many long lists as its rule of thumb says, always fewer than T.
        longest = max(2, int(lengths.max()))
        apart = min(t - 1, int(t / (0.0085 * np.log2(longest) + 1)))
        short, long = mine[: len(mine) - apart], mine[len(mine) - apart :]
        merged = np.concatenate([lists[starts[x] : ends[x]] for x in short])
        merged.sort(kind="stable")  # merges the lists, which are ascending runs
        at = np.flatnonzero(np.concatenate(([True], merged[1:] != merged[:-1])))
        found, counts = merged[at], np.diff(np.concatenate((at, [len(merged)])))
        keep = counts >= t - len(long)
        found, counts = found[keep], counts[keep]
        if 4 * len(found) * len(long) > lengths.sum():  # so many are left that the long lists are merged, too
            counts = np.bincount(np.concatenate([lists[starts[x] : ends[x]] for x in mine]), minlength=g)[found]
        else:
            for x in long:  # bisection for the few that are left
                if not len(found):
                    break
                own = lists[starts[x] : ends[x]]
                at = np.minimum(np.searchsorted(own, found), len(own) - 1)
                counts = counts + (own[at] == found)
        found = found[reaches(counts, sizes[i], sizes[found], percent)]
        if len(found):
            yield i, found


class Joined:
    """Components of what is linked: the root of each is its least index."""

    def __init__(self, g: int):
        self.parent = np.arange(g)

    def find(self, i: int) -> int:
        parent = self.parent
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return int(i)

    def link(self, i: int, others: np.ndarray) -> None:
        for j in others[self.parent[others] != self.find(i)].tolist():
            a, b = sorted((self.find(i), self.find(j)))
            self.parent[b] = a
        self.parent[others] = self.find(i)

    def roots(self) -> np.ndarray:
        return np.array([self.find(i) for i in range(len(self.parent))], dtype=np.int64)


def link_sets(sets: list[np.ndarray], percent: int = PERCENT) -> np.ndarray:
    """Component of each set: the least index in it."""
    joined = Joined(len(sets))
    for i, others in links_of(sets, percent):
        joined.link(i, others)
    return joined.roots()


FOUND_SCHEMA = "a long, h long, b long, n long"


def _search_cells(members: DataFrame, texts: DataFrame, width: int, percent: int, every: bool = False) -> DataFrame:
    """FOUND_SCHEMA: links (a, null, b, null) that hold the components of each cell together, and (a, h, null, n) with links
    that a class has in a cell; or, for `every`, each link once, a not above b. members: cell, doc, h, n; texts: doc, h, t."""
    weight = members.groupBy("cell").agg(F.sum("n").alias("total"), F.count("*").alias("m")).where("m > 1")
    blocks = F.greatest(F.lit(1), F.ceil(F.col("total") / F.lit(CELL_SHINGLES)).cast("int"))
    of = members.groupBy("doc", "h").agg(F.sort_array(F.collect_set("cell")).alias("cells"))
    # A cell's blocks meet in pairs: a member of block x goes to every pair (x, y).
    cut = members.join(weight.select("cell", blocks.alias("blocks")), "cell").withColumn("x", F.pmod(F.xxhash64("doc", "h"), F.col("blocks")).cast("int"))
    cut = cut.withColumn("y", F.explode(F.expr("sequence(0, blocks - 1)"))).select("cell", "doc", "h", "x", F.least("x", "y").alias("low"), F.greatest("x", "y").alias("high"))
    rows = cut.join(texts.join(of, ["doc", "h"]), ["doc", "h"]).repartition("cell", "low", "high").sortWithinPartitions("cell", "low", "high", "doc", "h")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler, now, ids, sets, of, xs = Shingler(width), None, [], [], [], []

        def close() -> Iterator[pd.DataFrame]:
            if len(sets) < 2:
                return
            doc, h = np.array(ids, dtype=np.int64).T
            block = np.array(xs)
            kinds = {cells: k for k, cells in enumerate(dict.fromkeys(of))}
            kind, told_here = np.array([kinds[cells] for cells in of]), {}
            joined, n = Joined(len(sets)), np.zeros(len(sets), dtype=np.int64)
            for i, others in links_of(sets, percent):
                joined.link(i, others)
                if of[i] not in told_here:  # by the other end's cells: is this the least that both share
                    own = set(of[i])
                    told_here[of[i]] = np.array([min(own.intersection(cells)) == now[0] for cells in kinds])
                once = told_here[of[i]][kind[others]]
                if now[1] != now[2]:  # links within a block are told where it meets itself
                    once &= block[others] != block[i]
                others = others[once]
                n[i] += len(others)
                n[others] += 1
                if every and len(others):
                    yield frame(np.minimum(doc[i], doc[others]), None, np.maximum(doc[i], doc[others]), None)
            if not every:
                roots = joined.roots()
                tied, linked = np.flatnonzero(roots != np.arange(len(roots))), np.flatnonzero(n)
                yield frame(doc[tied], None, doc[roots[tied]], None)
                yield frame(doc[linked], h[linked], None, n[linked])

        def frame(a, h, b, n) -> pd.DataFrame:
            return pd.DataFrame({"a": a, "h": h, "b": b, "n": n}).astype("Int64")

        for batch in batches:
            keys = list(zip(batch["cell"].tolist(), batch["low"].tolist(), batch["high"].tolist()))
            docs_, texts_, cells_, xs_ = list(zip(batch["doc"].tolist(), batch["h"].tolist())), batch["t"].tolist(), batch["cells"].tolist(), batch["x"].tolist()
            for a, b in chunks(texts_):
                for key, doc, cells, x, own in zip(keys[a:b], docs_[a:b], cells_[a:b], xs_[a:b], shingler.sets(texts_[a:b])):
                    if key != now:
                        yield from close()
                        now, ids, sets, of, xs = key, [], [], [], []
                    ids.append(doc)
                    sets.append(own)
                    of.append(tuple(cells))
                    xs.append(x)
        yield from close()

    return rows.select("cell", "low", "high", "doc", "h", "x", "cells", "t").mapInPandas(run, FOUND_SCHEMA)


def _meet(docs: DataFrame, key: str, text: str, width: int, percent: int, ranked: int) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Documents (doc, n, d1, d2), classes (d1, d2, first, h, n), members of cells (cell, doc, h, n) and their texts (doc, h, t)."""
    rows = docs.select(*id_columns(key), F.col(f"`{text}`").alias("t")).withColumn("h", F.xxhash64("t"))
    named = materialise(_name_sets(rows, width))
    found = named.where("n >= 0").select("doc", "h", "n", "d1", "d2")
    order = rows.sparkSession.sparkContext.broadcast(_order(named, ranked))  # `ranked` names and ranks at most

    least = F.min(F.struct("doc", "h"))
    classes = found.where("n > 0 and doc is not null").groupBy("d1", "d2").agg(least.alias("least"), F.max("n").alias("n"))
    classes = materialise(classes.select("d1", "d2", F.col("least.doc").alias("first"), F.col("least.h").alias("h"), "n"))

    of_token = Window.partitionBy("token")
    shared = _postings(rows, order, width, percent).select("d1", F.min("d1").over(of_token).alias("cell"), F.max("d1").over(of_token).alias("last"))
    shared = shared.where("cell <> last").groupBy("d1", "cell").agg(F.count("*").alias("tokens"))
    # A set that shares fewer shingles than a link takes has none.
    enough = F.greatest(F.lit(1), F.least(*[F.expr(f"{EXTRA_PERCENT} * {n} div 100") for n in ("n", f"((({percent} * n) + 99) div 100)")]))
    of_class = shared.withColumn("all_tokens", F.sum("tokens").over(Window.partitionBy("d1"))).join(classes, "d1").where(F.col("all_tokens") >= enough)
    members = materialise(of_class.select("cell", F.col("first").alias("doc"), "h", "n"))
    lone = members.groupBy("cell").agg(F.count("*").alias("m")).where("m = 1").select("cell")
    members = members.join(lone, "cell", "left_anti")

    wanted = members.select("doc", "h").distinct()
    texts = materialise(rows.where("not doc_null").select("doc", "h", "t").join(wanted, ["doc", "h"], "left_semi").groupBy("doc", "h").agg(F.max("t").alias("t")))
    return found, classes, members, texts


def pairs(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH, percent: int = PERCENT, ranked: int = RANKED) -> DataFrame:
    """Every link between classes once: a and b, the least ids of two different sets that link, a below b (or the same, where one id holds both)."""
    _, _, members, texts = _meet(docs, key, text, width, percent, ranked)
    return _search_cells(members, texts, width, percent, every=True).select("a", "b")


def join(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH, percent: int = PERCENT, ranked: int = RANKED) -> DataFrame:
    """`key`, n_shingles, component_id, class_id (the least id of an equal set) and n_links (classes that the row's class links to) of every row."""
    found, classes, members, texts = _meet(docs, key, text, width, percent, ranked)
    searched = materialise(_search_cells(members, texts, width, percent))
    links = searched.where("b is not null").select("a", "b")
    counts = searched.where("n is not null").groupBy(F.col("a").alias("first"), "h").agg(F.sum("n").alias("links"))

    # Ids that hold several classes tie those together.
    set_ = F.struct("d1", "d2")
    some = found.where("n > 0 and doc is not null")
    several = some.groupBy("doc").agg(F.min(set_).alias("low"), F.max(set_).alias("high")).where("low <> high").select("doc")
    held = some.join(several, "doc").select("doc", "d1", "d2").distinct().join(classes, ["d1", "d2"]).select("doc", "first")
    tied = held.join(held.groupBy("doc").agg(F.min("first").alias("b")), "doc").select(F.col("first").alias("a"), "b")
    label = components(links.unionByName(tied)).withColumnRenamed("node", "first")
    classes = classes.join(counts, ["first", "h"], "left").join(label, "first", "left")
    of = classes.select("d1", "d2", F.col("first").alias("class_id"), F.coalesce("label", "first").alias("component_id"), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"))
    out = found.select("doc", "n", "d1", "d2").join(of, ["d1", "d2"], "left")
    own = F.col("doc").isNotNull() & (F.col("n") > 0)
    return out.select(
        F.col("doc").alias(key), F.col("n").alias("n_shingles"), F.when(own, F.col("component_id")).otherwise(F.col("doc")).alias("component_id"),
        F.when(own, F.col("class_id")).otherwise(F.col("doc")).alias("class_id"), F.when(own, F.col("n_links")).otherwise(0).alias("n_links"),
    )
