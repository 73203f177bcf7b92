"""The name functions for SQL: bodies of plain SQL, and the two token ratios as vectorised functions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from accordant.config import SYMBOLS
from accordant.functions.fuzzy import token_set_ratio, token_sort_ratio
from accordant.functions.text import ID_ALPHABET, SUFFIX_PATTERN


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _name_base() -> str:
    out = "lower(regexp_replace(trim(x), '^\\\\(\\\\d+\\\\)\\\\s*', ''))"
    for symbol, said in SYMBOLS:
        out = f"replace({out}, {_quoted(symbol)}, {_quoted(said)})"
    return f"trim(regexp_replace(regexp_replace({out}, '\\\\s+', ' '), '[^a-z0-9\\\\s]', ''))"


def _joined(x: str) -> str:
    return f"array_join(filter(split({x}, '\\\\s+'), t -> t <> ''), ' ')"


def _id_18() -> str:
    def check(chunk: int) -> str:
        bits = " + ".join(f"if(substr(x, {5 * chunk + i + 1}, 1) rlike '[A-Z]', {1 << i}, 0)" for i in range(5))
        return f"substr('{ID_ALPHABET}', 1 + {bits}, 1)"

    fits = "length(x) = 15 and x rlike '^[A-Za-z0-9]{15}$'"
    return f"case when x is null or x = '' or length(x) = 18 then x when {fits} then concat(x, {check(0)}, {check(1)}, {check(2)}) else raise_error(concat('not a 15 or 18 character id: ', x)) end"


def bodies() -> dict[str, str]:
    """Each function of one text `x` and its SQL."""
    return {
        "name_base": _name_base(),
        "name_core": f"trim(regexp_replace({_joined('x')}, {_quoted(SUFFIX_PATTERN)}, ''))",
        "raw_exact_key": "trim(regexp_replace(trim(coalesce(x, '')), '\\\\s+', ' '))",
        "id_15_to_18": _id_18(),
    }


def register(spark: SparkSession) -> list[str]:
    """Make the functions of `bodies`, normalize_name, token_sort_ratio and token_set_ratio callable from SQL; their names."""
    own = bodies()
    for name, body in own.items():
        spark.sql(f"create or replace temporary function {name}(x string) returns string return {body}")
    spark.sql("create or replace temporary function normalize_name(x string) returns string return name_core(name_base(x))")

    def ratios(f):
        @F.pandas_udf("double")
        def rated(a: pd.Series, b: pd.Series) -> pd.Series:
            return pd.Series([None if x is None or y is None else float(f(x, y)) for x, y in zip(a, b)], dtype="float64")

        return rated

    for name, f in (("token_sort_ratio", token_sort_ratio), ("token_set_ratio", token_set_ratio)):
        spark.udf.register(name, ratios(f))
    return [*own, "normalize_name", "token_sort_ratio", "token_set_ratio"]
