"""Name normalisation as Column expressions: everything here stays inside whole-stage code."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from accordant.config import LEGAL_SUFFIXES, PARENTHESES_BLACKLIST, PLURALS, RETAIL_TERMS, SYMBOLS, WEAK_TOKENS

#: A legal suffix at the end; leftmost matching makes it the longest trailing run of tokens.
SUFFIX_PATTERN = "(?:^| )(" + "|".join(re.escape(k) for k in sorted(LEGAL_SUFFIXES, key=lambda k: (-len(k), k))) + ")$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def literal_map(values: dict) -> Column:
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])


def tokens(text) -> Column:
    """Blank-separated tokens, none empty."""
    return F.filter(F.split(_col(text), r"\s+"), lambda t: t != "")


def name_raw(name) -> Column:
    return F.trim(_col(name))


def name_base(name) -> Column:
    """Lower case, symbols spelt out or blanked, other characters deleted after blanks were collapsed."""
    c = F.lower(F.regexp_replace(F.trim(_col(name)), r"^\(\d+\)\s*", ""))
    for symbol, said in SYMBOLS:
        c = F.replace(c, F.lit(symbol), F.lit(said))
    c = F.regexp_replace(c, r"\s+", " ")
    return F.trim(F.regexp_replace(c, r"[^a-z0-9\s]", ""))


def suffix_class(base) -> Column:
    joined = F.array_join(tokens(base), " ")
    found = F.regexp_extract(joined, SUFFIX_PATTERN, 1)
    return F.when(_col(base).isNull(), F.lit(None)).otherwise(F.coalesce(F.try_element_at(literal_map(LEGAL_SUFFIXES), found), F.lit("NONE")))


def name_core(base) -> Column:
    return F.trim(F.regexp_replace(F.array_join(tokens(base), " "), SUFFIX_PATTERN, ""))


def has_parentheses(raw) -> Column:
    return _col(raw).contains("(") & _col(raw).contains(")")


def has_semicolon(raw) -> Column:
    return _col(raw).contains(";")


def _occurrences(text: Column, what: str) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(what), F.lit("")))) / F.lit(len(what))


def has_multiple_names(raw) -> Column:
    c = _col(raw)
    many = _occurrences(F.lower(c), " and ") + _occurrences(c, "&") > 1
    return c.contains(";") | c.contains(":") | c.rlike(r"\(\d+\)|^\d+\.") | many


def valid_parenthesis(content: Column) -> Column:
    """Whether text in parentheses names a company."""
    low = F.lower(content)
    listed = F.exists(F.array(*[F.lit(t) for t in PARENTHESES_BLACKLIST]), lambda t: F.contains(low, t))
    suffixed = F.exists(tokens(low), lambda t: t.isin(list(LEGAL_SUFFIXES)))
    capitals = F.size(F.regexp_extract_all(content, F.lit(r"(?U)\b[A-Z][a-z]+"), F.lit(0))) >= 2
    return ~listed & ~content.rlike(r"^\d+$") & (suffixed | capitals)


def aliases(raw) -> Column:
    """array<struct<alias, source>>: segments between semicolons, then valid parentheses."""
    c = _col(raw)
    segments = F.transform(F.split(c, ";"), lambda s: F.trim(s))
    cleaned = F.filter(F.transform(segments, lambda s: F.regexp_replace(s, r"^\(\d+\)\s*", "")), lambda s: s != "")
    parts = F.when(c.contains(";"), F.transform(cleaned, lambda s: F.struct(s.alias("alias"), F.lit("semicolon").alias("source"))))
    inside = F.transform(F.regexp_extract_all(c, F.lit(r"\(([^)]+)\)"), F.lit(1)), lambda s: F.trim(s))
    inside = F.filter(inside, lambda s: ~(c.contains(";") & F.array_contains(segments, s)) & valid_parenthesis(s))
    none = F.array().cast("array<struct<alias:string,source:string>>")
    return F.coalesce(F.concat(F.coalesce(parts, none), F.transform(inside, lambda s: F.struct(s.alias("alias"), F.lit("parentheses").alias("source")))), none)


def raw_exact_key(name, trim: bool = True) -> Column:
    c = F.coalesce(_col(name), F.lit(""))
    return F.trim(F.regexp_replace(F.trim(c), r"\s+", " ")) if trim else c


def first_token_key(core, stop_tokens) -> Column:
    """The blocking key: the first token that isn't a stop token, else the first, else empty."""
    own = tokens(F.lower(_col(core)))
    useful = F.filter(own, lambda t: ~t.isin(list(stop_tokens)))
    return F.coalesce(F.get(useful, F.lit(0)), F.get(own, F.lit(0)), F.lit(""))


def bigram_key(core, allowed) -> Column:
    own = tokens(F.lower(_col(core)))
    pair = F.concat_ws(" ", F.get(own, F.lit(0)), F.get(own, F.lit(1)))
    return F.when((F.size(own) >= 2) & pair.isin(list(allowed)), pair).otherwise(F.lit(""))


def enhanced_tokens(core, weak=WEAK_TOKENS, plurals=PLURALS, retail=RETAIL_TERMS) -> Column:
    """Tokens with retail terms and plurals made canonical, weak ones left out."""
    retail_map, plural_map = literal_map(retail), literal_map(plurals)
    named = F.transform(tokens(core), lambda t: F.coalesce(F.try_element_at(retail_map, t), t))
    named = F.transform(named, lambda t: F.coalesce(F.try_element_at(plural_map, t), t))
    return F.array_except(named, F.array(*[F.lit(w) for w in weak]))


ID_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ012345"


def id_15_to_18(account_id) -> Column:
    """The 18-character form of a CRM id; 18 and empty pass, anything else raises."""
    c = _col(account_id)

    def check(chunk: int) -> Column:
        bits = sum((F.when(F.substring(c, 5 * chunk + i + 1, 1).rlike("[A-Z]"), F.lit(1 << i)).otherwise(F.lit(0)) for i in range(5)), F.lit(0))
        return F.substring(F.lit(ID_ALPHABET), bits + F.lit(1), F.lit(1))

    return (
        F.when(c.isNull() | (c == "") | (F.length(c) == 18), c)
        .when((F.length(c) == 15) & c.rlike("^[A-Za-z0-9]{15}$"), F.concat(c, check(0), check(1), check(2)))
        .otherwise(F.raise_error(F.concat(F.lit("not a 15 or 18 character id: "), c)).cast("string"))
    )


def valid_id(account_id) -> Column:
    return F.coalesce(_col(account_id).rlike("^(?:[A-Za-z0-9]{15}|[A-Za-z0-9]{18})$"), F.lit(False))


def content_hash(content) -> Column:
    """SHA-256 of a text that line ends and trailing blanks don't change."""
    return F.sha2(F.regexp_replace(F.regexp_replace(_col(content), "\r\n|\r", "\n"), r"\s+\z", ""), 256)


def parse_date(value) -> Column:
    """Strings in four formats, else a generic cast, else an Excel serial number; fractions of days are kept."""
    c = F.trim(_col(value).cast("string"))
    serial = c.try_cast("double")
    days = F.when(serial > 59, serial - 1).otherwise(serial) - 1
    sound = F.abs(days) < 3_000_000  # beyond it no calendar reaches
    whole = F.floor(F.when(sound, days))
    excel = F.lit("1900-01-01").cast("timestamp_ntz") + F.make_dt_interval(days=whole.cast("int"), secs=F.round((days - whole) * 86400, 6).cast("decimal(18,6)"))
    formats = [("yyyy-MM-dd", r"^\d{4}-\d{1,2}-\d{1,2}$"), ("MM/dd/yyyy", r"^\d{1,2}/\d{1,2}/\d{4}$"), ("dd/MM/yyyy", r"^\d{1,2}/\d{1,2}/\d{4}$"), ("yyyy/MM/dd", r"^\d{4}/\d{1,2}/\d{1,2}$")]
    parsed = [F.when(c.rlike(shape), F.try_to_timestamp(c, F.lit(f.replace("MM", "M").replace("dd", "d"))).cast("timestamp_ntz")) for f, shape in formats]
    return F.coalesce(*parsed, F.when(serial.isNotNull(), excel), F.when(serial.isNull(), c.try_cast("timestamp_ntz")))


def normalise(df, name: str = "account_name"):
    """`df` with every normalisation column."""
    out = df.withColumn("name_raw", name_raw(name)).withColumn("name_base", name_base("name_raw"))
    out = out.withColumns({"suffix_class": suffix_class("name_base"), "name_core": name_core("name_base")})
    return out.withColumns({
        "has_parentheses": has_parentheses("name_raw"), "has_semicolon": has_semicolon("name_raw"), "has_multiple_names": has_multiple_names("name_raw"),
        "aliases": aliases("name_raw"), "name_core_tokens": tokens("name_core"),
    })
