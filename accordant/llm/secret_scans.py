"""Secret scans: patterns for known kinds, and a randomness test battery for the rest.

Known kinds are found by pattern. Every other long token is tested: its encoding is inferred from
its characters (hex, base32, base64; without a digit the letters of one case, of both, or those and
two signs), and tests hold it against uniform draws from that alphabet:
chi-squared of the character counts, once in classes and once for recurring characters, the
Wald-Wolfowitz runs test about the alphabet's middle, and the serial correlation of neighbours. The
least of their p-values says how much the token looks like a random string.

A discovery is a token called a secret, and a false one is a text called so. So what is tested is that a
token is text, against what text makes of the battery: all words of every document are joined
as names, paths and slugs are, in each of the encodings, and cut into tokens of the length classes in turn, end to end (and the license
templates' words are, so that a small corpus has some, too). A token's p-value is the share of these that look as random as it, and
the Benjamini-Hochberg step holds the share of texts among a class's secrets to a rate. It is aware of length:
where text passes for random, as in short words, nothing is called a secret. The battery's own p-values only rank, so
their approximations for short tokens don't enter the rate. Tokens and texts meet in histograms of fixed size.

Defined results: a null text is empty and has no spans; a null id stays null beside any other; repeated rows
are scanned each; tokens that tie in the battery are called secrets together or not at all; an empty
table gives no rows; matches and tokens are taken leftmost and non-overlapping in each kind, whole
texts, offsets in code points, end exclusive. Other columns are not looked at.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, id_columns, ids_of, materialise
from .license_scans import TEMPLATES

#: The known kinds, in the order in which ties are listed.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
#: A run this long has to be there before HEX is worth running.
_HEX_LONG = re.compile(r"[0-9a-f]{24,}")
#: Tokens the battery tests. One may follow '=', as a value does its name; behind a token '=' is padding.
TOKEN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}(?![A-Za-z0-9+/_=-])")
KINDS = ["assign", "access", "hex", "random"]

#: Length classes: the least length of each.
LENGTHS = [20, 28, 40, 64, 128]
ENCODINGS = ["hex", "base32", "base64", "letters", "both cases", "letters and signs"]
#: Share of texts among the tokens called secrets, at most.
FALSE_DISCOVERY = 0.01
#: -log10 of the battery's p-values are counted in bins of this width, up to MOST: the first bins look random.
BIN, MOST = 0.05, 20.0
#: Characters of the license templates from which one list of words is made.
SOURCE = 800
#: Characters of texts whose tokens are tested together.
COUNTED_CHARS = 250_000
#: An assignment holds one of these, whatever its case.
_NAMES = ("password", "passwd", "secret", "token", "api")

#: What a masked secret leaves.
MARK = "[secret]"

SPAN = "struct<kind:string,start:int,end:int>"
SCAN_SCHEMA = f"key long, spans array<{SPAN}>, tokens array<struct<start:int,end:int,stratum:int,bin:int>>, own array<struct<stratum:int,bin:int,n:long>>"


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind's number, end) of the known kinds, sorted."""
    low, found = text.lower(), []
    if any(name in low for name in _NAMES):
        found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    if _HEX_LONG.search(text):
        found += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if m.end() - m.start() >= 24]
    return sorted(found)


_VALUES = {
    "hex": {c: i for i, c in enumerate("0123456789abcdef")} | {c: i + 10 for i, c in enumerate("ABCDEF")},
    "base32": {c: i for i, c in enumerate("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")},
    "base64": {c: i for i, c in enumerate("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/")} | {"-": 62, "_": 63},
    "letters": {c: i % 26 for i, c in enumerate("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")},
}
_VALUES["both cases"] = {c: i for i, c in enumerate("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")}
_VALUES["letters and signs"] = _VALUES["both cases"] | {"+": 52, "-": 52, "/": 53, "_": 53}
_SIZES = {"hex": 16, "base32": 32, "base64": 64, "letters": 26, "both cases": 52, "letters and signs": 54}


def infer_encoding(token: str) -> str:
    body = token.rstrip("=")
    letters = {c for c in body if c.isalpha()}
    if not any(c.isdigit() for c in body):
        # Of a random string in any encoding that happens to have no digit, what is there is uniform over the rest.
        if len(letters) < len(set(body)):
            return "letters and signs"
        return "letters" if body.islower() or body.isupper() else "both cases"
    if all(c in _VALUES["hex"] for c in body) and not (any(c.islower() for c in letters) and any(c.isupper() for c in letters)):
        return "hex"
    if all(c in _VALUES["base32"] for c in body):
        return "base32"
    return "base64"


def _erfc(x: np.ndarray) -> np.ndarray:
    return np.fromiter(map(math.erfc, x.tolist()), np.float64, len(x))


def batteries(encoding: str, values: np.ndarray) -> np.ndarray:
    """The least p-value of the tests, under uniform and independent characters, of each row of `values`."""
    (m, n), size = values.shape, _SIZES[encoding]
    each = np.bincount((np.arange(0, m * size, size)[:, None] + values).ravel(), minlength=m * size).reshape(m, size).astype(np.float32)
    # Classes as wide as keep five expected in each, so that the approximation holds for short tokens.
    classes = int(max(2, min(size, n // 5)))
    of_class = np.arange(size) * classes // size
    counts = each @ (of_class[:, None] == np.arange(classes)).astype(np.float32)
    spread = np.bincount(of_class, minlength=classes) / size * n
    k = classes - 1
    uniform = (((((counts - spread) ** 2 / spread).sum(axis=1) / k) ** (1 / 3)) - (1 - 2 / (9 * k))) / math.sqrt(2 / (9 * k))  # Wilson and Hilferty's cube root
    # Characters that recur more often than chance: the chi-squared over the whole alphabet, for its mean and variance.
    pairs, mean = (np.einsum("ij,ij->i", each, each).astype(np.float64) - n) / 2, n * (n - 1) / 2 / size
    recur = (pairs - mean) / math.sqrt(mean * (1 - 1 / size))
    high = values >= size // 2
    ups = np.count_nonzero(high, axis=1)
    expected = 1 + 2 * ups * (n - ups) / n
    variance = np.maximum(1e-9, (expected - 1) * (expected - 2) / (n - 1))
    runs = 1 + np.count_nonzero(high[:, 1:] != high[:, :-1], axis=1)
    run = np.abs(runs - expected) / np.sqrt(variance)
    # Sums of products of whole numbers; of a token's 128 characters exact in float32, and of any length in float64.
    v = values.astype(np.float32 if n <= LENGTHS[-1] else np.float64)
    sums, squares, products = (x.astype(np.float64) for x in (v.sum(axis=1), np.einsum("ij,ij->i", v, v), np.einsum("ij,ij->i", v[:, 1:], v[:, :-1])))
    total = squares - sums * sums / n
    some = total > 1e-9
    shift = products - sums / n * (2 * sums - v[:, 0] - v[:, -1]) + (n - 1) * (sums / n) ** 2
    serial = np.abs(shift / np.where(some, total, 1) + 1 / n) * math.sqrt(n)
    # The least p-value is that of the largest deviation, one-sided of the first two and two-sided of the others.
    flat = (ups == 0) | (ups == n)
    p = np.minimum(0.5 * _erfc(np.maximum(uniform, recur) / math.sqrt(2)), _erfc(np.maximum(np.where(flat, 0, run), np.where(some, serial, 0)) / math.sqrt(2)))
    return np.where(some, np.where(flat, np.minimum(p, 2.0 ** (1 - n)), p), 0.0)


def _bins(p: np.ndarray) -> np.ndarray:
    return (np.minimum(MOST, -np.log10(np.maximum(p, 1e-300))) / BIN).astype(np.int64)


_TABLES = {}
for _encoding, _values in _VALUES.items():
    _TABLES[_encoding] = np.zeros(256, dtype=np.uint8)
    for _c, _v in _values.items():
        _TABLES[_encoding][ord(_c)] = _v


def values_of(encoding: str, token: str) -> np.ndarray:
    return _TABLES[encoding][np.frombuffer(token.encode("ascii"), dtype=np.uint8)]


def battery(token: str) -> tuple[str, int]:
    """The token's encoding and the bin of its p-value."""
    encoding = infer_encoding(token)
    return encoding, int(_bins(batteries(encoding, values_of(encoding, token.rstrip("="))[None, :]))[0])


_PLAIN = re.compile("[A-Za-z0-9]+")
_APART = bytes(c if chr(c).isalnum() and c < 128 else 32 for c in range(256))
_NOT_HEX = bytes(c for c in range(256) if chr(c) not in "0123456789abcdef")


@lru_cache(maxsize=100_000)
def _number(word: str) -> str:
    return str(zlib.crc32(word.encode()) % 1000)


def text_token(words: list[str], encoding: str, sign: str, names: list[str] | None = None) -> str:
    """What the words make as a token of an encoding: a name, path or slug, with numbers where the encoding has digits. `names`: those of letters alone."""
    if encoding == "hex":
        return "".join(words).lower().encode().translate(None, _NOT_HEX).decode()
    if encoding == "base64":
        said = list(words)
        said[2::3] = [f"{w}{sign}{_number(w)}" for w in said[2::3]]
        return sign.join(said)
    names = list(filter(str.isalpha, words)) if names is None else names
    if encoding == "base32":
        said = list(names)
        said[2::3] = [w + "234567"[len(w) % 6] for w in said[2::3]]
        return "".join(said).upper()
    if encoding == "letters":
        return "".join(names).lower()
    return sign.join(names) if encoding == "letters and signs" else " ".join(names).title().replace(" ", "")


def own_bins(many: list[list[str]], turns: list[int] | None = None) -> np.ndarray:
    """For each list of words the bins of the tokens that they make, by stratum; -1 where there is none.

    With `turns`, a list makes tokens in every third encoding, from its turn on.
    """
    out = np.full((len(many), len(ENCODINGS) * len(LENGTHS)), -1, dtype=np.int64)
    for e, encoding in enumerate(ENCODINGS):
        own = [i for i in range(len(many)) if turns is None or (turns[i] + e) % 3 == 0]
        made = [text_token(many[i], encoding, "_-/"[len(many[i]) % 3])[: LENGTHS[-1]] for i in own]
        for k, length in enumerate(LENGTHS):
            rows = [n for n, x in enumerate(made) if len(x) >= length]
            if rows:
                values = values_of(encoding, "".join([made[n][:length] for n in rows])).reshape(len(rows), length)
                out[np.array(own)[rows], e * len(LENGTHS) + k] = _bins(batteries(encoding, values))
    return out


def source_words(text: str) -> tuple[list[str], int]:
    """All words of a text, and a turn that its checksum names."""
    return _PLAIN.findall(text), zlib.crc32(text.encode("utf-8", "surrogatepass")) // 7 % 3


@lru_cache(maxsize=1024)
def cuts_of(n: int) -> list[tuple[int, int]]:
    """(start, class) of the tokens that n characters are cut into, one behind the other: of each length class in turn, and what is left
    into the longest that fit. Fewer than the least length make no token."""
    out, at, k = [], 0, 0
    while n - at >= LENGTHS[0]:
        while LENGTHS[k] > n - at:
            k -= 1
        out.append((at, k))
        at, k = at + LENGTHS[k], (k + 1) % len(LENGTHS)
    return out


def _all_cuts(sizes: list[int]) -> list[np.ndarray]:
    """By length class, where the tokens of strings of these sizes, end to end, start."""
    cycle = sum(LENGTHS)  # whole turns first
    turns, ends = np.array(sizes, dtype=np.int64) // cycle, np.cumsum(sizes)
    nth = np.arange(turns.sum()) - np.repeat(np.cumsum(turns) - turns, turns)
    base = np.repeat(ends - sizes, turns) + cycle * nth
    left = [[] for _ in LENGTHS]
    for n, whole, end in zip(sizes, turns.tolist(), ends.tolist()):
        for at, k in cuts_of(n - whole * cycle):
            left[k].append(end - n + whole * cycle + at)
    return [np.concatenate((base + sum(LENGTHS[:k]), np.array(x, dtype=np.int64))) for k, x in enumerate(left)]


def text_counts(texts: list[str]) -> np.ndarray:
    """Tokens that the whole texts make, in every encoding, by stratum and bin."""
    out = np.zeros((len(ENCODINGS) * len(LENGTHS), int(MOST / BIN) + 1), dtype=np.int64)
    words = [t.encode("utf-8", "surrogatepass").translate(_APART).decode().split() for t in texts]  # as _PLAIN finds them
    names = [list(filter(str.isalpha, own)) for own in words]
    for e, encoding in enumerate(ENCODINGS):
        made = [text_token(own, encoding, "_-/"[len(own) % 3], x) for own, x in zip(words, names)]
        values = values_of(encoding, "".join(made))
        for k, (starts, length) in enumerate(zip(_all_cuts([len(x) for x in made]), LENGTHS)):
            for a in range(0, len(starts), 4096):
                rows = values[starts[a : a + 4096, None] + np.arange(length)]
                out[e * len(LENGTHS) + k] += np.bincount(_bins(batteries(encoding, rows)), minlength=out.shape[1])
    return out


def stratum_of(encoding: str, length: int) -> int:
    return ENCODINGS.index(encoding) * len(LENGTHS) + int(np.searchsorted(LENGTHS, length, side="right")) - 1


def scan_text(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int, int]]]:
    """Known spans, and the tested tokens outside them as (start, end, stratum, bin)."""
    known, tested = base_spans(text), []
    if max(map(len, text.split()), default=0) >= LENGTHS[0]:
        for m in TOKEN.finditer(text):
            word = m[0]
            if any(a < m.end() and m.start() < b for a, _, b in known):
                continue
            encoding, bin_ = battery(word)
            tested.append((m.start(), m.end(), stratum_of(encoding, len(word)), bin_))
    return known, tested


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Known spans of each row, the tested tokens with stratum and bin; and in one row of a batch, how many tokens its texts make by stratum and bin. Keyed by `key` as a long."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            spans, tokens, texts = [], [], batch["t"].tolist()
            for value in texts:
                known, tested = scan_text(value)
                spans.append([(KINDS[k], a, b) for a, k, b in known])
                tokens.append(tested)
            own = [[] for _ in texts]
            if texts:
                counts = sum(text_counts(texts[a:b]) for a, b in chunks(texts, COUNTED_CHARS))
                own[0] = [(int(s), int(x), int(counts[s, x])) for s, x in zip(*np.nonzero(counts))]
            yield pd.DataFrame({"key": ids_of(batch), "spans": spans, "tokens": tokens, "own": own})

    return docs.select(*id_columns(key), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("t")).mapInPandas(run, SCAN_SCHEMA)


def _histograms(scanned: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Tokens, and texts, by stratum and bin: what is collected has a row for each of these at most, whatever the corpus."""
    shape = (len(ENCODINGS) * len(LENGTHS), int(MOST / BIN) + 1)
    tokens, texts = np.zeros(shape, dtype=np.int64), np.zeros(shape, dtype=np.int64)
    said = scanned.select(F.explode(F.concat(
        F.transform("tokens", lambda x: F.struct(F.lit(True).alias("token"), x["stratum"].alias("stratum"), x["bin"].alias("bin"), F.lit(1).cast("long").alias("n"))),
        F.transform("own", lambda x: F.struct(F.lit(False).alias("token"), x["stratum"].alias("stratum"), x["bin"].alias("bin"), x["n"].alias("n"))),
    )).alias("x"))
    for r in said.groupBy("x.token", "x.stratum", "x.bin").agg(F.sum("x.n").alias("n")).collect():
        (tokens if r["token"] else texts)[r["stratum"], r["bin"]] = r["n"]
    return tokens, texts + _template_texts()


def _template_texts() -> np.ndarray:
    """The license templates' tokens from each of their words on, by stratum and bin."""
    out = np.zeros((len(ENCODINGS) * len(LENGTHS), int(MOST / BIN) + 1), dtype=np.int64)
    words = [w for text in TEMPLATES.values() for w in _PLAIN.findall(text)]
    for own in own_bins([words[n : n + SOURCE // 6] for n in range(len(words))]):
        held = np.flatnonzero(own >= 0)
        out[held, own[held]] += 1
    return out


def cut_offs(scanned: DataFrame, rate: float = FALSE_DISCOVERY) -> list[int]:
    """By stratum, the first bin whose tokens the Benjamini-Hochberg step leaves as texts (0 if all)."""
    out = []
    for tokens, texts in zip(*_histograms(scanned)):
        p = (np.cumsum(texts) + 1) / (texts.sum() + 1)  # of a token in this bin
        called = np.cumsum(tokens)
        found = np.nonzero((tokens > 0) & (p <= rate * called / max(1, called[-1])))[0]
        out.append(int(found[-1]) + 1 if len(found) else 0)
    return out


def power(cuts: list[int], draws: int = 400, seed: int = 7) -> list[float]:
    """By stratum, the share of random strings of its least length that these cut-offs call secrets."""
    rng, out = np.random.default_rng(seed), []
    for encoding in ENCODINGS:
        for k, length in enumerate(LENGTHS):
            bins = _bins(batteries(encoding, rng.integers(0, _SIZES[encoding], (draws, length))))
            out.append(float((bins < cuts[ENCODINGS.index(encoding) * len(LENGTHS) + k]).mean()))
    return out


def find_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text", rate: float = FALSE_DISCOVERY) -> DataFrame:
    """`key` and `spans`: kind, start and end of each secret, by start and then kind as in KINDS."""
    scanned = materialise(scan(docs, key, text))  # spans and tokens alone, so that texts are scanned once
    cuts = F.array(*[F.lit(c) for c in cut_offs(scanned, rate)])
    random = F.transform(F.filter("tokens", lambda x: x["bin"] < F.get(cuts, x["stratum"])), lambda x: F.struct(F.lit(KINDS[3]).alias("kind"), x["start"].alias("start"), x["end"].alias("end")))
    rank = F.create_map(*[x for n, k in enumerate(KINDS) for x in (F.lit(k), F.lit(n))])
    joined = F.transform(F.concat("spans", random), lambda x: F.struct(x["start"].alias("start"), F.element_at(rank, x["kind"]).alias("rank"), x["end"].alias("end"), x["kind"].alias("kind")))
    ordered = F.transform(F.sort_array(joined), lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end")))
    return scanned.select(F.col("key").alias(key), ordered.alias("spans"))


def redact_documents(docs: DataFrame, text: str = "text", rate: float = FALSE_DISCOVERY, mark: str = MARK) -> DataFrame:
    """`docs` with every secret in its text replaced by `mark` (overlapping spans by one).

    The histogram's pass comes first; the second finds the spans again beside the text, which is
    cheaper than to shuffle texts to their spans. A null text stays null.
    """
    cuts = cut_offs(scan(docs.select(F.lit(0).alias("key"), F.col(f"`{text}`").alias("text")), "key", "text"), rate)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, out = batch.schema.get_field_index(text), []
            for value in batch.column(at).to_pylist():
                known, tested = scan_text(value or "")
                spans = sorted([(a, b) for a, _, b in known] + [(a, b) for a, b, stratum, bin_ in tested if bin_ < cuts[stratum]])
                out.append(_masked(value, spans, mark) if spans else value)
            yield batch.set_column(at, batch.schema.field(at), pa.array(out, batch.schema.field(at).type))

    return docs.mapInArrow(run, docs.schema)


def _masked(text: str, spans: list[tuple[int, int]], mark: str) -> str:
    said, at = [], 0
    for a, b in spans:
        if a >= at:
            said += [text[at:a], mark]
        at = max(at, b)
    return "".join(said) + text[at:]
