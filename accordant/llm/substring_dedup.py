"""Substring dedup by recompression: words of long passages that an earlier document holds go.

Words have two independent 64-bit names. Rounds of recompression replace runs of one symbol, and pairs
whose first symbol falls on the left and whose second falls on the right side of a coin that
depends on the symbol and the round alone, by new symbols named from their parts. Names are thus
global without an exchange a round, and a passage gets the same interior symbols wherever it stands.

Two kinds of names leave the workers. Blocks are two neighbouring symbols of a window's length or
more, with what stands between: a shared block covers every window inside it at once. Anchors see to it that nothing is missed: after the
first round a symbol has two words at most, and whether two words are parted depends on these two
alone, so every window contains chains of whole symbols of CHAIN or CHAIN + 1 words whose ends its own words
determine; the least name of these chains is the window's anchor, the same for equal windows.

A shared name only reveals. What is removed is verified by 128 bits over the words themselves, half of them from each
of the words' names: a block by its name and by a polynomial over its words, a window (whose anchor
occurs in several documents, and that no block covers) by two sums over its words.

Distribution. Names are aggregated in the worker before the shuffle: of the documents of a chunk
that share a name only the least goes on, so a passage that a third of the documents hold is a few
rows. Documents with the same words as an earlier one are settled by a digest of 128 bits. Texts are
shuffled by document to meet their shared names, and again (the same exchange, where the plan
allows) to meet the windows to remove.

Defined results: a null or empty text has no words; a document of fewer words than a window loses none;
rows that share an id are never each other's earlier document; a row with a null id loses nothing
and takes from none; repeated rows are treated alike; an empty table gives no rows. Other columns pass
through where asked for and are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import chunks, materialise
from .word_hashes import TwoNames, factors, mix, window_names

WINDOW = 13
#: Words of a chain, at least; a chain ends with the symbol that reaches it. WINDOW >= CHAIN + 4 keeps one in every window.
CHAIN = 5
ROUNDS = 14
#: Characters whose names are aggregated together in a worker.
TOGETHER = 4_000_000
_TOP = np.iinfo(np.uint64).max
_PAIR, _RUN, _COIN, _BLOCK, _BASE = factors(3, 21), factors(3, 22), factors(ROUNDS + 1, 23), factors(3, 24), factors(2, 25)
_INVERSE = np.uint64(pow(int(_BASE[0]), -1, 1 << 64))
#: A cover in one long: whether it is known, a part of the text's digest, the first window.
_KNOWN, _DIGEST_BITS, _START_BITS = 1 << 62, 30, 32


def split_words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split() if text else []  # bytes split at ASCII blanks alone


def _digest(words: list[bytes]) -> tuple[int, int]:
    d = blake2b(b" ".join(words), digest_size=16).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


class Recompressed:
    """The symbols of many documents at once. `names` are the words', `owner` the document's number of each."""

    def __init__(self, names: np.ndarray, owner: np.ndarray, window: int = WINDOW):
        self.names, self.owner, self.window = names, owner, window
        symbols, starts, lengths = self._pairs(names, np.arange(len(names)), np.ones(len(names), dtype=np.int64), 0)
        self.cut = np.zeros(len(names) + CHAIN + 2, dtype=bool)
        self.cut[starts] = True
        self.cut[len(names) :] = True
        for n in range(1, ROUNDS):
            if not (lengths < window).any():
                break
            symbols, starts, lengths = self._pairs(*self._runs(symbols, starts, lengths), n)
        self._blocks(symbols, starts, lengths)

    def _blocks(self, symbols, starts, lengths):
        """Two neighbouring symbols of a window's length each, with what stands between them: every window that
        isn't at the edge of a shared passage lies in such a block."""
        whole = np.flatnonzero(lengths >= self.window)
        a, b = whole[:-1], whole[1:]
        same = self.owner[starts[a]] == self.owner[starts[b]]
        a, b = a[same], b[same]
        place = np.arange(len(symbols))
        last = np.maximum.accumulate(np.where(lengths >= self.window, place, 0))
        between = np.where(lengths < self.window, mix(symbols * _RUN[0] + (place - last).astype(np.uint64) * _RUN[1]), np.uint64(0))
        total = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(between, dtype=np.uint64)))
        self.blocks = mix(symbols[a] * _BLOCK[0] + (total[b] - total[a + 1]) * _BLOCK[1] + symbols[b] * _BLOCK[2])
        self.block_starts, self.block_lengths = starts[a], starts[b] + lengths[b] - starts[a]

    def _pairs(self, symbols, starts, lengths, n):
        """One round of pairs. Symbols of a window's length take no part any more."""
        if len(symbols) < 2:
            return symbols, starts, lengths
        right = (mix(symbols * _COIN[n]) >> np.uint64(63)).astype(bool)
        small, own = lengths < self.window, self.owner[starts]
        merge = ~right[:-1] & right[1:] & small[:-1] & small[1:] & (own[:-1] == own[1:])
        at = np.flatnonzero(merge)
        symbols, lengths = symbols.copy(), lengths.copy()
        symbols[at] = mix(symbols[at] * _PAIR[0] + symbols[at + 1] * _PAIR[1] + _PAIR[2])
        lengths[at] += lengths[at + 1]
        keep = np.ones(len(symbols), dtype=bool)
        keep[at + 1] = False
        return symbols[keep], starts[keep], lengths[keep]

    def _runs(self, symbols, starts, lengths):
        """One round of runs: equal neighbours become one symbol, named by symbol and number."""
        if len(symbols) < 2:
            return symbols, starts, lengths
        own = self.owner[starts]
        first = np.concatenate(([True], (symbols[1:] != symbols[:-1]) | (own[1:] != own[:-1]) | (lengths[1:] >= self.window)))
        at = np.flatnonzero(first)
        count = np.diff(np.concatenate((at, [len(symbols)])))
        named = np.where(count > 1, mix(symbols[at] * _RUN[0] + count.astype(np.uint64) * _RUN[1] + _RUN[2]), symbols[at])
        return named, starts[at], np.add.reduceat(lengths, at)

    def windows(self) -> np.ndarray:
        """Whether a window starts at each word."""
        n, out = len(self.names), np.zeros(len(self.names), dtype=bool)
        if n >= self.window:
            out[: n - self.window + 1] = self.owner[: n - self.window + 1] == self.owner[self.window - 1 :]
        return out

    def anchors(self) -> np.ndarray:
        """The anchor of the window that starts at each word; meaningless where none does."""
        n = len(self.names)
        short, long = (np.concatenate((window_names(self.names, w, 3), np.full(min(n, w - 1), _TOP, dtype=np.uint64))) for w in (CHAIN, CHAIN + 1))
        here, at_short, at_long = self.cut[:n], self.cut[CHAIN : n + CHAIN], self.cut[CHAIN + 1 : n + CHAIN + 1]
        chain_short = np.where(here & at_short, short, _TOP)
        chain_long = np.where(here & ~at_short & at_long, long, _TOP)
        both = np.minimum(chain_short, chain_long)
        out = np.full(n + self.window, _TOP, dtype=np.uint64)
        last = self.window - 1 - CHAIN  # where the last short chain may start
        for o in range(1, last):
            out[: n - o] = np.minimum(out[: n - o], both[o:])
        if n > last:
            out[: n - last] = np.minimum(out[: n - last], chain_short[last:])
        return out[:n]


def _flat(names: TwoNames, words: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Both names of all words, their owners, and where each owner's begin."""
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    return *names.of([w for own in words for w in own]), np.repeat(np.arange(len(words)), sizes), np.concatenate(([0], np.cumsum(sizes)))


def spans_names(names: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A name for each span of words: a polynomial over the words' names, whatever stands before it."""
    powers = np.cumprod(np.full(len(names), _BASE[0], dtype=np.uint64), dtype=np.uint64)
    back = np.cumprod(np.full(len(names), _INVERSE, dtype=np.uint64), dtype=np.uint64)
    total = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(names * powers, dtype=np.uint64)))
    return mix((total[starts + lengths] - total[starts]) * back[starts] + lengths.astype(np.uint64) * _BASE[1])


def _block_names(names: np.ndarray) -> np.ndarray:
    return mix(names ^ np.uint64(0xB10C))  # apart from anchors


def _named(rows: DataFrame, window: int) -> DataFrame:
    """name, doc, kind, salt: what each document might share.

    kind 0: anchor; 1: block; 2: anchor shared within the chunk; 3: block shared within the chunk.
    A name's least document in the chunk has salt 0 and is compared with other
    chunks'; the others are settled, and their salt spreads them.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names, least = TwoNames(), {}
        for batch in batches:
            keys, texts = batch["doc"].tolist(), batch["t"].tolist()
            for a, b in chunks(texts, TOGETHER):
                ids, words = [], []
                for key, text in zip(keys[a:b], texts[a:b]):
                    own = split_words(text)
                    if len(own) < window:
                        continue
                    d = _digest(own)
                    if d in least and least[d] < key:
                        continue  # a later copy; an equal id is a repeated row, which changes nothing
                    if len(least) > 300_000:
                        least.clear()
                    least[d] = key
                    ids.append(key)
                    words.append(own)
                if not ids:
                    continue
                flat, _, owner, _ = _flat(names, words)
                made = Recompressed(flat, owner, window)
                doc_of = np.array(ids, dtype=np.int64)
                starts, anchors = made.windows(), made.anchors()
                fresh = starts.copy()
                fresh[1:] &= ~starts[:-1] | (anchors[1:] != anchors[:-1])
                found = np.concatenate((anchors[fresh], _block_names(made.blocks)))
                doc = np.concatenate((doc_of[owner[fresh]], doc_of[owner[made.block_starts]]))
                block = np.concatenate((np.zeros(int(fresh.sum()), dtype=bool), np.ones(len(made.blocks), dtype=bool)))
                order = np.lexsort((doc, found))
                found, doc, block = found[order], doc[order], block[order]
                new_name = np.concatenate(([True], found[1:] != found[:-1]))
                keep = new_name | np.concatenate(([True], doc[1:] != doc[:-1]))
                found, doc, block, new_name = found[keep], doc[keep], block[keep], new_name[keep]
                several = np.repeat(*(lambda at: (np.diff(at) > 1, np.diff(at)))(np.concatenate((np.flatnonzero(new_name), [len(found)]))))
                kind = (block + 2 * several).astype(np.int32)
                salt = np.where(new_name, 0, doc)
                by_doc = np.argsort(doc, kind="stable")  # equal ids beside each other compress in the shuffle
                yield pd.DataFrame({"name": found.view(np.int64)[by_doc], "doc": doc[by_doc], "kind": kind[by_doc], "salt": salt[by_doc]})

    return rows.where("doc is not null").mapInPandas(run, "name long, doc long, kind int, salt long")


#: h1 and h2 name `count` windows from `place` on by 128 bits; of windows that are known to be an earlier document's they only spread the rows.
COVER_SCHEMA = "h1 long, h2 long, doc long, place long, count int"


def short_digest(words: list[bytes]) -> int:
    """What tells texts of one id apart in a cover."""
    return _digest(words)[0] & ((1 << _DIGEST_BITS) - 1)


def _windows(rows: DataFrame, window: int) -> DataFrame:
    """Rows (doc, t, anchors, blocks, firsts) to windows and blocks that may be another document's, and runs of windows known to be.

    `blocks` are a lesser document's too, so that windows inside them needn't be told; of `firsts` the
    document is the least, and both they and their windows are.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = TwoNames()
        for batch in batches:
            keys, texts, *lists = (batch[c].tolist() for c in ("doc", "t", "anchors", "blocks", "firsts"))
            chosen = [i for i, x in enumerate(lists[0]) if x is not None]  # others share nothing
            keys, texts = [keys[i] for i in chosen], [texts[i] for i in chosen]
            all_anchors, all_blocks, all_firsts = ([own[i].astype(np.int64).view(np.uint64) for i in chosen] for own in lists)
            for a, b in chunks(texts, TOGETHER):
                words = [split_words(t) for t in texts[a:b]]
                flat, other, owner, offsets = _flat(names, words)
                if not len(flat):
                    continue
                made = Recompressed(flat, owner, window)
                starts, anchors = made.windows(), made.anchors()
                block_owner, block_names = owner[made.block_starts], _block_names(made.blocks)
                covered, open_, hits = np.zeros(len(flat) + 1, dtype=np.int64), np.zeros(len(flat), dtype=bool), []
                for i in range(b - a):
                    lo, hi = offsets[i], offsets[i + 1]
                    x, y = np.searchsorted(block_owner, [i, i + 1])
                    if len(all_blocks[a + i]):
                        hit = x + np.flatnonzero(np.isin(block_names[x:y], all_blocks[a + i]))
                        hits.append(hit)
                        covered[made.block_starts[hit]] += 1
                        covered[made.block_starts[hit] + made.block_lengths[hit] - window + 1] -= 1
                    if len(all_firsts[a + i]):
                        hits.append(x + np.flatnonzero(np.isin(block_names[x:y], all_firsts[a + i])))
                    if len(all_anchors[a + i]):
                        open_[lo:hi] = np.isin(anchors[lo:hi], all_anchors[a + i])
                hit = np.concatenate(hits) if hits else np.empty(0, dtype=np.int64)
                doc_of = np.array(keys[a:b], dtype=np.int64)
                d_of = np.array([short_digest(w) for w in words], dtype=np.int64) << _START_BITS
                at = np.flatnonzero(open_ & starts & ~(np.cumsum(covered[:-1]) > 0))
                pad = np.zeros(window, dtype=np.uint64)
                h1 = np.concatenate((np.concatenate((window_names(flat, window, 4), pad))[at], block_names[hit]))
                h2 = np.concatenate((np.concatenate((window_names(other, window, 5), pad))[at], spans_names(other, made.block_starts[hit], made.block_lengths[hit])))
                count = np.concatenate((np.ones(len(at), dtype=np.int64), made.block_lengths[hit] - window + 1))
                at = np.concatenate((at, made.block_starts[hit]))
                # Within the chunk: what a lesser document holds too is known.
                order = np.lexsort((doc_of[owner[at]], h2, h1))
                at, h1, h2, count = at[order], h1[order], h2[order], count[order]
                new = np.concatenate(([True], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1]))) if len(at) else np.empty(0, dtype=bool)
                doc = doc_of[owner[at]]
                later = doc > doc[np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))] if len(at) else new
                known = np.zeros(len(flat) + 1, dtype=np.int64)
                np.add.at(known, at[later], 1)
                np.add.at(known, at[later] + count[later], -1)
                known = np.cumsum(known[:-1]) > 0
                by_place = np.argsort(at[~later], kind="stable")  # places in order compress in the shuffle
                at, h1, h2, count = (x[~later][by_place] for x in (at, h1, h2, count))
                # Known windows as runs within a document.
                edge = np.flatnonzero(known & np.concatenate(([True], ~known[:-1] | (owner[1:] != owner[:-1]))))
                after = np.flatnonzero(known & np.concatenate((~known[1:] | (owner[1:] != owner[:-1]), [True])))
                spread = mix(edge.astype(np.uint64) * _PAIR[0] + doc_of[owner[edge]].view(np.uint64) * _PAIR[1])
                rows_ = np.concatenate((at, edge))
                own = owner[rows_]
                place = d_of[own] + rows_ - offsets[own]
                place[len(at) :] += _KNOWN
                both = {"h1": np.concatenate((h1, spread)).view(np.int64), "h2": np.concatenate((h2, np.zeros(len(edge), dtype=np.uint64))).view(np.int64)}
                yield pd.DataFrame(both | {"doc": doc_of[own], "place": place, "count": np.concatenate((count, after - edge + 1)).astype(np.int32)})

    return rows.mapInPandas(run, COVER_SCHEMA)


def kept_words(words: list[bytes], runs: list[tuple[int, int]], window: int = WINDOW) -> list[bytes]:
    """The words that no window of the runs (first window, number of windows) covers."""
    if not runs:
        return words
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    for start, count in runs:
        edge[start] += 1
        edge[start + count + window - 1] -= 1
    return [w for w, gone in zip(words, np.cumsum(edge[:-1]) > 0) if not gone]


def covered_windows(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """doc, covers: runs of windows that an earlier document holds, as place (first window, and a part of the text's digest) and count."""
    if window < CHAIN + 4:
        raise ValueError(f"a window has {CHAIN + 4} words at least")
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("doc"), F.col(f"`{text}`").alias("t"))

    def digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for t in batch["t"]:
                words = split_words(t)
                out.append((len(words), *_digest(words)))
            yield pd.DataFrame(out, columns=["n", "d1", "d2"]).assign(doc=batch["doc"].to_numpy())[["doc", "n", "d1", "d2"]]

    seen = materialise(rows.where("doc is not null").mapInPandas(digests, "doc long, n long, d1 long, d2 long").where(F.col("n") >= window))
    first = seen.groupBy("d1", "d2").agg(F.min("doc").alias("first"))
    copies = seen.join(first, ["d1", "d2"]).where("doc > first").select("doc", "n", "d1").distinct()
    copies = materialise(copies)

    of_name = Window.partitionBy("name", "salt")
    named = _named(rows, window).select("name", "doc", "kind", "salt", F.min("doc").over(of_name).alias("low"), F.max("doc").over(of_name).alias("high"))
    block, first = F.col("kind").isin(1, 3), (F.col("salt") == 0) & (F.col("doc") == F.col("low"))
    shared = named.where((F.col("kind") >= 2) | (F.col("low") < F.col("high"))).groupBy("doc").agg(
        F.collect_set(F.when(~block, F.col("name"))).alias("anchors"),
        F.collect_set(F.when(block & ~first, F.col("name"))).alias("blocks"),
        F.collect_set(F.when(block & first, F.col("name"))).alias("firsts"),
    )
    # An outer join, as the last one is, so that both read one exchange of texts. A row without an id shares nothing.
    found = _windows(rows.join(shared, "doc", "left").select(F.coalesce("doc", F.lit(0).cast("long")).alias("doc"), "t", "anchors", "blocks", "firsts"), window)
    low = F.min("doc").over(Window.partitionBy("h1", "h2"))
    known = F.col("place") >= _KNOWN
    covers = found.select("doc", "place", "count", known.alias("known"), low.alias("low")).where("known or doc > low")
    covers = covers.select("doc", F.col("place").bitwiseAND(F.lit(_KNOWN - 1)).alias("place"), F.col("count").cast("long").alias("count"))
    d = F.col("d1").bitwiseAND(F.lit((1 << _DIGEST_BITS) - 1)) * F.lit(1 << _START_BITS)
    whole = copies.select("doc", d.alias("place"), (F.col("n") - window + 1).alias("count"))
    return covers.unionByName(whole).groupBy("doc").agg(F.collect_list(F.struct("place", "count")).alias("covers"))


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, keep_untouched: bool = False) -> DataFrame:
    """`docs` with the words left in `text`, one blank between, and n_words and n_removed in place of columns of these names.

    With `keep_untouched`, a text that loses no word stays as it is, blanks and nulls included.
    """
    columns = [c for c in docs.columns if c not in ("n_words", "n_removed")]
    covers = covered_windows(docs, key, text, window).withColumnRenamed("doc", "__doc")
    # Without other columns this is the projection that covered_windows shuffles, so one exchange serves both.
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("doc"), F.col(f"`{text}`").alias("t"), *[F.col(f"`{c}`").alias(f"__{c}") for c in columns if c not in (key, text)])
    joined = rows.join(covers, F.col("doc") == F.col("__doc"), "left").drop("__doc")
    field = {key: "doc", text: "t"}
    kinds = {f.name: f for f in docs.schema.fields}
    schema = T.StructType([T.StructField(c, T.LongType() if c == key else kinds[c].dataType) for c in columns] + [T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("t")
            texts, n_words, n_removed = [], [], []
            for t, own in zip(batch.column(at).to_pylist(), batch.column(batch.schema.get_field_index("covers")).to_pylist()):
                words = split_words(t)
                left = words
                if own:
                    d = short_digest(words)
                    left = kept_words(words, [(x["place"] & ((1 << _START_BITS) - 1), x["count"]) for x in own if x["place"] >> _START_BITS == d], window)
                texts.append(t if keep_untouched and len(left) == len(words) else b" ".join(left).decode("utf-8", "surrogatepass"))
                n_words.append(len(words))
                n_removed.append(len(words) - len(left))
            arrays = [pa.array(texts, batch.schema.field(at).type) if c == text else batch.column(batch.schema.get_field_index(field.get(c, f"__{c}"))) for c in columns]
            arrays += [pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*columns, "n_words", "n_removed"])

    return joined.mapInArrow(run, schema)
