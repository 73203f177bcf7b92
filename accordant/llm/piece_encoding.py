"""SentencePiece BPE encoding and decoding with a public model, by vectorised merge rounds.

A text is normalised as the model says (a dummy prefix, blanks as U+2581) and parts into words at
each U+2581 that follows another character, which no piece of the vocabulary crosses. The distinct
words of a chunk are one flat numpy array of symbols. In each round every word finds its least pair
rank, all words merge their leftmost such pair at once (and its further occurrences, where no merge
can open a better pair), and the array is compacted, until no word has a pair left. Symbols
outside the vocabulary fall back to bytes. Words met before come from a bounded cache.

A long word is merged in segments, all in the same rounds; a cut between two of them holds where the
symbols beside it stay apart when merged together, and is merged anew with more symbols where they
don't, so time grows with a word's length and not with its square.

Defined results: a null text is empty, an empty text has no ids and decodes to an empty text; a null id
stays null beside any other; repeated rows are encoded each; of pairs of equal score, be they of one piece
or several, the leftmost is merged first; texts are encoded whole, in chunks of many texts; an
empty table gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, id_columns, ids_of

BLANK = "▁"
_WORD = re.compile(f"{BLANK}+[^{BLANK}]*|[^{BLANK}]+")
#: Distinct words a worker remembers at most.
CACHED_WORDS = 250_000
#: Words beyond LONG characters are merged in segments; a cut that doesn't hold is merged anew with MENDED symbols on
#: either side, and more, up to MOST_MENDED.
LONG, SEGMENT = 256, 64
MENDED, MOST_MENDED = 4, 64
NONE = np.iinfo(np.int64).max


class PieceModel:
    """The vocabulary of a BPE model with byte fallback, as arrays.

    A symbol is an id of the vocabulary, or len(vocabulary) + code point for a character outside it.
    """

    def __init__(self, path: str):
        import sentencepiece

        library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = library.vocab_size()
        pieces = [library.id_to_piece(i) for i in range(self.size)]
        plain = [not (library.is_control(i) or library.is_unknown(i) or library.is_unused(i) or library.is_byte(i)) for i in range(self.size)]
        self.ids = {p: i for i, p in enumerate(pieces) if plain[i]}
        crossing = [p for p in self.ids if re.search(f"[^{BLANK}]{BLANK}", p)]
        if crossing:
            raise ValueError(f"pieces cross words: {crossing[:3]}")
        self.bytes = {int(p[1:-1], 16): i for i, p in enumerate(pieces) if library.is_byte(i)}
        self.pieces, self.agreed = pieces, {}
        score = {p: library.get_score(i) for p, i in self.ids.items()}
        number = {x: n for n, x in enumerate(sorted(set(score.values()), reverse=True))}
        self.rank = {p: number[x] for p, x in score.items()}  # 0 is the best; pieces of equal score share a rank
        # Pairs of pieces whose join is a piece: key (left * (size) + right), sorted, with the join and its rank.
        keys, joins = [], []
        safe = np.ones(self.size, dtype=bool)
        for p, i in self.ids.items():
            for cut in range(1, len(p)):
                left, right = self.ids.get(p[:cut]), self.ids.get(p[cut:])
                if left is not None and right is not None:
                    keys.append(left * self.size + right)
                    joins.append(i)
                for part in (left, right):
                    if part is not None and self.rank[p] <= self.rank[pieces[part]]:
                        safe[part] = False  # merging `part` may open a pair that is as good
        at = np.argsort(np.array(keys, dtype=np.int64), kind="stable")
        self.keys, self.joins, self.safe = np.array(keys, dtype=np.int64)[at], np.array(joins, dtype=np.int64)[at], safe
        self.ranks = np.array([self.rank[pieces[i]] for i in self.joins.tolist()] + [NONE], dtype=np.int64)  # the last: no pair
        # Decoding: the bytes of each id.
        unknown = " ⁇ ".encode()
        self.spelt = [b"" if library.is_control(i) else unknown if library.is_unknown(i) else bytes([int(p[1:-1], 16)]) if library.is_byte(i) else p.replace(BLANK, " ").encode() for i, p in enumerate(pieces)]

    def pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The number of each pair, -1 where its join is no piece."""
        both = (left < self.size) & (right < self.size)
        want = np.where(both, left * self.size + right, -1)
        at = np.minimum(np.searchsorted(self.keys, want), len(self.keys) - 1)
        return np.where(self.keys[at] == want, at, -1)

    def _merge(self, words: list[str]) -> list[list[int]]:
        """The symbols of each word, by merge rounds over all of them."""
        if not words:
            return []
        get, size = self.ids.get, self.size
        symbols = np.array([s if (s := get(c)) is not None else size + ord(c) for w in words for c in w], dtype=np.int64)
        word = np.repeat(np.arange(len(words)), [len(w) for w in words])
        pair = np.full(len(symbols), -1, dtype=np.int64)
        if len(symbols) > 1:
            pair[:-1] = np.where(word[:-1] == word[1:], self.pairs(symbols[:-1], symbols[1:]), -1)
        done_symbols, done_words = [np.empty(0, dtype=np.int64)], [np.empty(0, dtype=np.int64)]
        while len(symbols):
            starts = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            sizes = np.diff(np.concatenate((starts, [len(symbols)])))
            rank = self.ranks[pair]
            least = np.minimum.reduceat(rank, starts)
            alive = np.repeat(least != NONE, sizes)
            if not alive.all():  # words without a pair are finished
                done_symbols.append(symbols[~alive])
                done_words.append(word[~alive])
                symbols, word, pair, rank = symbols[alive], word[alive], pair[alive], rank[alive]
                sizes, least = sizes[least != NONE], least[least != NONE]
                if not len(symbols):
                    break
            best = np.flatnonzero(rank == np.repeat(least, sizes))
            first = np.concatenate(([True], word[best][1:] != word[best][:-1]))
            # Of touching pairs every second goes, counted from the left of their run.
            fresh = first | np.concatenate(([True], np.diff(best) > 1))
            place = np.arange(len(best))
            parity = (place - np.maximum.accumulate(np.where(fresh, place, 0))) % 2 == 0
            merge = best[first | (parity & self.safe[self.joins[pair[best]]])]
            symbols[merge] = self.joins[pair[merge]]
            keep = np.ones(len(symbols), dtype=bool)
            keep[merge + 1] = False
            moved = np.cumsum(keep)[merge] - 1
            symbols, word, pair = symbols[keep], word[keep], pair[keep]
            # Only pairs beside a merge have another number than before.
            stale = np.concatenate((moved, moved[moved > 0] - 1))
            pair[-1] = -1
            stale = stale[stale < len(symbols) - 1]
            pair[stale] = np.where(word[stale] == word[stale + 1], self.pairs(symbols[stale], symbols[stale + 1]), -1)
        symbols, word = np.concatenate(done_symbols), np.concatenate(done_words)
        order = np.argsort(word, kind="stable")
        ends = np.cumsum(np.bincount(word, minlength=len(words))).tolist()
        all_symbols = symbols[order].tolist()
        return [all_symbols[a:b] for a, b in zip([0, *ends[:-1]], ends)]

    def _text(self, symbols) -> str:
        return "".join([self.pieces[s] if s < self.size else chr(s - self.size) for s in symbols])

    def _agree(self, pairs: list[tuple[int, int]]) -> list[bool]:
        """Whether the two symbols of each pair stay apart where their characters are merged together."""
        if len(self.agreed) > CACHED_WORDS:
            self.agreed.clear()
        fresh = list({p for p in pairs if p not in self.agreed})
        self.agreed.update((p, got == list(p)) for p, got in zip(fresh, self._merge([self._text(p) for p in fresh])))
        return [self.agreed[p] for p in pairs]

    def _stitched(self, word: str, parts: list[list[int]]) -> list[int]:
        """The symbols of a long word from those of its segments.

        Merging goes by rank and place alone. So what is merged on both sides of a cut is what the whole word gives
        wherever the symbols beside the cut, merged together, stay as they are: until something crosses the cut,
        the two see the same pairs in the same order there as in the whole word.
        """
        wrong = [n for n, ok in enumerate(self._agree([(a[-1], b[0]) for a, b in zip(parts, parts[1:])])) if not ok]
        # Cuts that don't hold are merged anew with some symbols on either side, all at once; where two of them are near, in turn.
        between = self._merge([self._text(parts[n][-MENDED:] + parts[n + 1][:MENDED]) for n in wrong])
        mended, out = dict(zip(wrong, between)), list(parts[0])
        for n, part in enumerate(parts[1:]):
            if out[-1] == parts[n][-1] and n not in mended or out[-1] != parts[n][-1] and self._agree([(out[-1], part[0])])[0]:
                out += part
                continue
            width = MENDED
            same = n in mended and out[-width:] == parts[n][-width:]
            middle = mended[n] if same else self._merge([self._text(out[-width:] + part[:width])])[0]
            while True:
                left, right = out[-width - 1 : -width], part[width:]
                if all(self._agree([(a[-1], b[0]) for a, b in ((left, middle), (middle, right)) if a and b])):
                    break
                width *= 2
                if width > MOST_MENDED:  # symbols lean on each other over a long way
                    return self._merge([word])[0]
                middle = self._merge([self._text(out[-width:] + part[:width])])[0]
            out[-width:] = middle
            out += right
        return out

    def encode_words(self, words: list[str]) -> list[tuple[int, ...]]:
        """The ids of each word."""
        cut = [[w] if len(w) <= LONG else [w[a : a + SEGMENT] for a in range(0, len(w), SEGMENT)] for w in words]
        merged = iter(self._merge([part for parts in cut for part in parts]))
        out = []
        for w, parts in zip(words, cut):
            own = [next(merged) for _ in parts]
            own = own[0] if len(own) == 1 else self._stitched(w, own)
            if own and max(own) >= self.size:
                own = [i for s in own for i in ([s] if s < self.size else [self.bytes[b] for b in chr(s - self.size).encode("utf-8", "replace")])]
            out.append(tuple(own))
        return out

    def decode(self, ids: list[int]) -> str:
        """As the library: bytes that aren't UTF-8 become U+FFFD each, and the dummy prefix goes."""
        spelt = self.spelt
        said = b"".join([spelt[i] for i in ids]).decode("utf-8", "replace")
        return said[1:] if said.startswith(" ") else said


@lru_cache(maxsize=2)
def load(path: str) -> PieceModel:
    return PieceModel(path)


class _Cache(dict):
    """Ids by word; filled a chunk at a time."""

    def fill(self, model: PieceModel, words: list[list[str]]) -> None:
        new = {w for own in words for w in own if w not in self}
        if len(self) > CACHED_WORDS:  # the older half, which holds the common words, stays
            for w in list(islice(self, CACHED_WORDS // 2, None)):
                if w not in new:
                    del self[w]
            new = {w for own in words for w in own if w not in self}
        fresh = sorted(new)
        self.update(zip(fresh, model.encode_words(fresh)))


@lru_cache(maxsize=2)
def cache_of(path: str) -> _Cache:
    """One cache for all tasks of a worker."""
    return _Cache()


def encode_texts(model: PieceModel, texts: list[str], cache: _Cache | None = None) -> list[list[int]]:
    cache = _Cache() if cache is None else cache
    out = []
    for a, b in chunks(texts):
        words = [_WORD.findall(BLANK + t.replace(" ", BLANK)) if t else [] for t in texts[a:b]]
        cache.fill(model, words)
        for own in words:
            ids: list[int] = []
            for got in map(cache.__getitem__, own):
                ids += got
            out.append(ids)
    return out


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", decoded: bool = False) -> DataFrame:
    """`key` and `ids`, an array of each row's ids; with `decoded` also the text that they decode to."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model, cache = load(path), cache_of(path)
        for batch in batches:
            texts, keys = batch["t"].tolist(), ids_of(batch)
            for a, b in chunks(texts):
                ids = encode_texts(model, texts[a:b], cache)
                back = {"decoded": [model.decode(x) for x in ids]} if decoded else {}
                yield pd.DataFrame({"key": keys[a:b], "ids": [np.array(x, dtype=np.int32) for x in ids]} | back)

    rows = docs.select(*id_columns(key), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("t"))
    return rows.mapInPandas(run, "key long, ids array<int>" + ", decoded string" * decoded).withColumnRenamed("key", key)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """The columns of `encoded` with `decoded`, the text of its `ids`."""

    @F.pandas_udf("string")
    def said(ids: pd.Series) -> pd.Series:
        model = load(path)
        return pd.Series([model.decode(x) for x in ids])

    return encoded.withColumn("decoded", said("ids"))
