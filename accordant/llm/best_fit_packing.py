"""Best-fit packing of tokenised documents by large-item matching.

Documents become token sequences ending in a separator; only those longer than a sequence are cut,
the first piece taking the rest. Pieces above one third of the capacity pair at most twice in a
bin: greedily, the largest with the largest that fits beside it. Smaller pieces then best-fit the
gaps that remain, largest first, and open new bins where none fits.

The plan needs only how many pieces there are of each length, at most `capacity` counts, so it is
made on the driver in time and space that don't grow with the corpus: bins of one shape are one
class with a number of bins. A full piece is a sequence of its own and stays where it is. Of the others
executors give each its rank among those of its length, by salt so that no common length gathers in
one task, and look up the class that holds that rank.

Pieces carry their ids all the way: between tasks in two bytes each where a piece's ids fit, in what
`pack` returns as little-endian unsigned 32-bit bytes. `sequences` puts those of each sequence together.

Defined results: a null or empty text is the separator alone, one piece; repeated rows are packed
each; a null id stays null beside any other; pieces of one length take their places in order of salt, key,
piece and row; an empty table gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import chunks, id_columns, ids_of, materialise

CAPACITY = 2048
SEPARATOR = 0
#: Pieces of one length that a task ranks, about: a common length is dealt by salt to as many tasks as it takes.
RANKED = 20_000
#: Rows of a table that may be broadcast; they are counted before, and a larger one is shuffled.
BROADCAST_ROWS = 1_000_000
#: Parts that byte-level BPE encodes alone, since its own split never crosses them: a run of letters that a blank or
#: plain punctuation ends, else all up to the next blank, and blanks by the tokenizer's own rule.
_PART = re.compile(r" ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+(?=[\s.,;:!?]|\Z)| ?\S+|\s+(?!\S)|\s+")
#: Python's \s takes these, the tokenizer's doesn't: such texts go to the library whole.
_ODD = ("\x1c", "\x1d", "\x1e", "\x1f")
#: Parts that a worker remembers; the older half, which holds the common ones, outlives the newer.
CACHED_PARTS = 400_000

PIECES = "key long, piece int, start long, length int, ids_crc32 long, ids binary"


def narrow(data: bytes) -> bytes:
    """Ids of four bytes in two each, where all of them fit."""
    ids = np.frombuffer(data, dtype="<u4")
    return ids.astype("<u2").tobytes() if ids.max(initial=0) < 1 << 16 else data


def widen(data: bytes, length: int) -> bytes:
    """What `narrow` was given, of so many ids."""
    return np.frombuffer(data, dtype="<u2").astype("<u4").tobytes() if len(data) == 2 * length else data


class PartEncoder:
    """The library's ids as little-endian unsigned 32-bit bytes; parts met before come from a bounded cache.

    Texts that hold an added token's string are left to the library as a whole, as are odd blanks.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.whole = (*_ODD, *(t.content for t in self.library.get_added_tokens_decoder().values()))
        self.parts: dict[str, bytes] = {}

    def _library(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype="<u4").tobytes() for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.parts) > CACHED_PARTS:
            self.parts = dict(islice(self.parts.items(), CACHED_PARTS // 2))
        known, split, found, open_ = self.parts.get, [], [], []
        for n, t in enumerate(texts):
            if any(x in t for x in self.whole):
                split.append(None)
                found.append(self._library([t]))
                continue
            split.append(own := _PART.findall(t))
            found.append(got := list(map(known, own)))
            if None in got:
                open_.append((n, [i for i, ids in enumerate(got) if ids is None]))
        fresh = sorted({split[n][i] for n, places in open_ for i in places})
        for a in range(0, len(fresh), 20_000):
            self.parts.update(zip(fresh[a : a + 20_000], self._library(fresh[a : a + 20_000])))
        for n, places in open_:
            own, got = split[n], found[n]
            for i in places:
                got[i] = known(own[i])
        return [b"".join(got) for got in found]


@lru_cache(maxsize=2)
def load(path: str) -> PartEncoder:
    """One encoder for all tasks of a worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return PartEncoder(path)


def pieces(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, separator: int = SEPARATOR) -> DataFrame:
    """The pieces (PIECES) of each row's ids and the separator; their ids as `narrow` leaves them, their checksums of four bytes an id."""
    end = np.array([separator], dtype="<u4").tobytes()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = load(path)
        for batch in batches:
            texts, keys, at, rows = batch["t"].tolist(), ids_of(batch), [], []
            for a, b in chunks(texts):
                for i, data in zip(range(a, b), encoder.encode(texts[a:b])):
                    data += end
                    n = len(data) // 4
                    start, piece = 0, 0
                    while start < n:
                        length = (n - start) % capacity or capacity
                        own = data[4 * start : 4 * (start + length)]
                        rows.append((piece, start, length, zlib.crc32(own), narrow(own)))
                        at.append(i)
                        start, piece = start + length, piece + 1
            out = pd.DataFrame(rows, columns=["piece", "start", "length", "ids_crc32", "ids"])
            out.insert(0, "key", keys[at])
            yield out

    return docs.select(*id_columns(key), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("t")).mapInPandas(run, PIECES)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Where the pieces of each length go: (length, first rank, pieces a bin, bins, first bin, first offset).

    The pieces of that length with ranks from `first rank` on fill `bins` bins in turn, `pieces a bin`
    beside each other from `first offset` in each.
    """
    left = {n: c for n, c in counts.items() if c > 0}
    taken = dict.fromkeys(left, 0)
    places: list[tuple[int, int, int, int, int, int]] = []
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap: (first bin, bins), all of them filled from 0 up to capacity - gap
    made = 0

    def put(n: int, each: int, bins: int, first: int, offset: int) -> None:
        places.append((n, taken[n], each, bins, first, offset))
        taken[n] += each * bins
        left[n] -= each * bins

    large = sorted((n for n in left if 3 * n > capacity), reverse=True)
    for n in large:
        # The largest piece left takes the largest that fits beside it.
        for other in (m for m in large if m <= n and m + n <= capacity):
            bins = min(left[n], left[other]) if other != n else left[n] // 2
            if bins <= 0:
                continue
            put(n, 1, bins, made, 0)
            put(other, 1, bins, made, n)
            gaps.setdefault(capacity - n - other, []).append((made, bins))
            made += bins
            if not left[n]:
                break
        if left[n]:
            gaps.setdefault(capacity - n, []).append((made, left[n]))
            bins = left[n]
            put(n, 1, bins, made, 0)
            made += bins
    for n in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        for gap in sorted(g for g in gaps if g >= n):
            runs, rest = gaps.pop(gap), []
            for first, bins in runs:
                most = gap // n
                full = min(bins, left[n] // most)  # best fit goes on in the same bin while the piece fits
                if full:
                    put(n, most, full, first, capacity - gap)
                    gaps.setdefault(gap - most * n, []).append((first, full))
                    first, bins = first + full, bins - full
                if bins and left[n]:
                    some = left[n]
                    put(n, some, 1, first, capacity - gap)
                    gaps.setdefault(gap - some * n, []).append((first, 1))
                    first, bins = first + 1, bins - 1
                if bins:
                    rest.append((first, bins))
            if rest:
                gaps.setdefault(gap, []).extend(rest)
            if not left[n]:
                break
        if left[n]:
            most = capacity // n
            full = left[n] // most
            if full:
                put(n, most, full, made, 0)
                gaps.setdefault(capacity - most * n, []).append((made, full))
                made += full
            if left[n]:
                some = left[n]
                put(n, some, 1, made, 0)
                gaps.setdefault(capacity - some * n, []).append((made, 1))
                made += 1
    return places


def pack(found: DataFrame, capacity: int = CAPACITY, ranked: int = RANKED) -> DataFrame:
    """`found` (PIECES) with ids of four bytes each, sequence_id and offset.

    `found` is read several times, and a full piece's sequence is numbered by its place in it, so it should be materialised.
    """
    spark = found.sparkSession
    counts = {r["length"]: r["n"] for r in found.groupBy("length").agg(F.count("*").alias("n")).collect()}  # capacity rows at most
    counts.pop(capacity, None)  # a full piece is a sequence of its own
    planned = plan(counts, capacity)
    made = max((first + bins for _, _, _, bins, first, _ in planned), default=0)
    full = found.where(F.col("length") == capacity).select("key", "piece", "start", "length", "ids", "ids_crc32", (F.lit(made) + F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))

    places = pd.DataFrame(planned, columns=["length", "p_rank", "p_each", "p_bins", "p_bin", "p_offset"]).astype("int64")
    places["salts"] = [-(-counts[n] // ranked) for n in places["length"]]
    # Of each length a sorted array of places: its last entry not above the rank is the piece's.
    fields = ["p_rank", "p_each", "p_bin", "p_offset"]
    table = spark.createDataFrame(places[["length", "salts", *fields]], "length int, salts long, " + ", ".join(f"{c} long" for c in fields))
    table = table.groupBy("length", "salts").agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("places"))

    def small(df: DataFrame, rows: int) -> DataFrame:
        return F.broadcast(df) if rows <= BROADCAST_ROWS else df

    # Repeated rows are told apart by where they stand, so that they don't share a salt.
    salted = found.where(F.col("length") < capacity).withColumn("row", F.monotonically_increasing_id()).join(small(table.select("length", "salts"), len(counts)), "length")
    salted = salted.withColumn("salt", F.pmod(F.xxhash64("key", "piece", "ids_crc32", "row"), F.col("salts")).cast("int")).drop("salts")
    per_salt = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    firsts = per_salt.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    ranks = salted.withColumn("own", F.row_number().over(Window.partitionBy("length", "salt").orderBy("key", "piece", "ids_crc32", "row")) - 1)
    ranks = ranks.join(small(firsts, sum(-(-n // ranked) for n in counts.values())), ["length", "salt"]).withColumn("rank", F.col("first") + F.col("own"))
    # Places of a length may be many: the one wanted is found by bisection.
    ranks = ranks.join(small(table.drop("salts"), len(planned)), "length")
    steps = 24
    bisect = f"""aggregate(sequence(1, {steps}), struct(0 as low, size(places) as high), (s, i) ->
        case when s.high - s.low <= 1 then s
             when places[cast((s.low + s.high) div 2 as int)].p_rank <= rank then struct(cast((s.low + s.high) div 2 as int) as low, s.high as high)
             else struct(s.low as low, cast((s.low + s.high) div 2 as int) as high) end, s -> places[s.low])"""
    at = ranks.withColumn("place", F.expr(bisect))
    step = F.expr("rank - place.p_rank")
    at = at.select("key", "piece", "start", "length", "ids", "ids_crc32", F.expr("place.p_bin + (rank - place.p_rank) div place.p_each").alias("sequence_id"), (F.col("place.p_offset") + F.pmod(step, F.col("place.p_each")) * F.col("length")).alias("offset")).unionByName(full)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [widen(data, n) for data, n in zip(batch.column("ids").to_pylist(), batch.column("length").to_pylist())]
            yield batch.set_column(batch.schema.get_field_index("ids"), batch.schema.field("ids"), pa.array(ids, batch.schema.field("ids").type))

    return at.mapInArrow(run, at.schema)


def pack_documents(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, separator: int = SEPARATOR) -> DataFrame:
    """key, piece, start, length, ids, ids_crc32, sequence_id, offset of every piece."""
    found = materialise(pieces(docs, path, key, text, capacity, separator))
    packed = pack(found, capacity)
    return packed.select(F.col("key").alias(key), "piece", "start", F.col("length").cast("long").alias("length"), "ids", "ids_crc32", "sequence_id", "offset")


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, n_pieces, length and ids (array<long>) of every sequence, its pieces beside each other by offset."""
    own = F.sort_array(F.collect_list(F.struct("offset", "length", "ids")))
    whole = packed.groupBy("sequence_id").agg(own.alias("own"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [np.frombuffer(b"".join(x["ids"] for x in own), dtype="<u4").astype(np.int64) for own in batch.column("own").to_pylist()]
            counts = [len(own) for own in batch.column("own")]
            yield pa.RecordBatch.from_arrays([batch.column("sequence_id"), pa.array(counts, pa.int32()), pa.array([len(x) for x in ids], pa.int64()), pa.array(ids, pa.list_(pa.int64()))], names=["sequence_id", "n_pieces", "length", "ids"])

    return whole.mapInArrow(run, "sequence_id long, n_pieces int, length long, ids array<long>")
