"""Fuzzy token ratios: Indel similarity over a bit-parallel longest common subsequence.

Spark has no such function, and a lambda over two character arrays is interpreted, so the kernel is
a pandas UDF; a worker computes each distinct pair of a batch once.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from accordant.functions.text import enhanced_tokens, tokens


def lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence: one big integer holds a row of the table."""
    if not a or not b:
        return 0
    masks: dict[str, int] = {}
    for i, c in enumerate(a):
        masks[c] = masks.get(c, 0) | 1 << i
    row = whole = (1 << len(a)) - 1
    for c in b:
        hit = row & masks.get(c, 0)
        row = ((row + hit) | (row - hit)) & whole
    return len(a) - row.bit_count()


def ratio(a: str, b: str) -> float:
    total = len(a) + len(b)
    return 100.0 if not total else 100.0 * (1 - (total - 2 * lcs(a, b)) / total)


def token_sort_ratio(a: str, b: str) -> float:
    return ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set_ratio(a: str, b: str) -> float:
    left, right = set(a.split()), set(b.split())
    if not left or not right:
        return 0.0
    both, only_left, only_right = left & right, " ".join(sorted(left - right)), " ".join(sorted(right - left))
    if both and (not only_left or not only_right):
        return 100.0
    s, x, y = len(" ".join(sorted(both))), len(only_left), len(only_right)
    gap = 1 if s else 0
    apart = x + y - 2 * lcs(only_left, only_right)
    best = 100.0 * (1 - apart / ((s + gap + x) + (s + gap + y)))
    if s:
        best = max(best, 100.0 * (1 - (gap + x) / (s + s + gap + x)), 100.0 * (1 - (gap + y) / (s + s + gap + y)))
    return best


def _rated(a: pd.Series, b: pd.Series) -> pd.DataFrame:
    known: dict[tuple[str, str], tuple[float, float]] = {}
    out = []
    for pair in zip(a.fillna(""), b.fillna("")):
        if pair not in known:
            known[pair] = (token_sort_ratio(*pair), token_set_ratio(*pair))
        out.append(known[pair])
    return pd.DataFrame(out, columns=["ratio_name", "ratio_set"])


def token_ratios(a, b) -> Column:
    """struct<ratio_name, ratio_set> of two columns. Made here, since workers import this module without a session."""
    return F.pandas_udf(_rated, "struct<ratio_name:double,ratio_set:double>")(a, b)


def jaccard(core_a, core_b, enhance: bool = False) -> Column:
    own = enhanced_tokens if enhance else tokens
    a, b = F.array_distinct(own(core_a)), F.array_distinct(own(core_b))
    union = F.size(F.array_union(a, b))
    return F.when(union > 0, F.size(F.array_intersect(a, b)) / union).otherwise(F.lit(0.0))


def numbers(text) -> Column:
    return F.regexp_extract_all(text, F.lit(r"(\d+)"), F.lit(1))


def punctuation(text) -> Column:
    return F.regexp_replace(text, r"[\w\s]", "")


def char_bigrams(text) -> Column:
    n = F.length(text)
    return F.when(n >= 2, F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: F.substring(text, i, F.lit(2))))).otherwise(F.array().cast("array<string>"))


def bigram_overlap(a, b) -> Column:
    x, y = char_bigrams(F.lower(a)), char_bigrams(F.lower(b))
    return F.when((F.size(x) > 0) & (F.size(y) > 0), F.size(F.array_intersect(x, y)) / F.size(F.array_union(x, y))).otherwise(F.lit(0.0))
