"""Settings: thresholds, word lists and maps, as plain values that callers may replace."""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from hashlib import sha1
import json

# Legal suffixes and their classes.
LEGAL_SUFFIXES = {
    "inc": "INC", "inc.": "INC", "incorporated": "INC",
    "llc": "LLC", "l.l.c.": "LLC", "limited liability company": "LLC",
    "ltd": "LTD", "ltd.": "LTD", "limited": "LTD",
    "corp": "CORP", "corp.": "CORP", "corporation": "CORP",
    "llp": "LLP", "limited liability partnership": "LLP",
    "lp": "LP", "limited partnership": "LP",
    "pllc": "PLLC", "professional limited liability company": "PLLC",
    "pc": "PC", "professional corporation": "PC",
    "co": "CO", "co.": "CO", "company": "CO",
    "gmbh": "GMBH", "gesellschaft mit beschränkter haftung": "GMBH",
}

# Text in parentheses that names no company.
PARENTHESES_BLACKLIST = [
    "paystub", "pay stubs", "paystubs", "not sure", "unsure", "unknown", "staffing agency", "temp", "temporary",
    "delaware", "california", "new york", "florida", "texas", "ohio", "illinois", "pennsylvania", "michigan",
    "georgia", "north carolina", "virginia", "washington", "massachusetts", "indiana", "tennessee", "missouri",
    "maryland", "colorado", "wisconsin", "minnesota", "alabama", "south carolina", "louisiana", "kentucky",
    "oregon", "oklahoma", "connecticut", "utah", "iowa", "nevada", "arkansas", "mississippi", "kansas",
    "nebraska", "idaho", "new mexico", "west virginia", "hawaii", "new hampshire", "maine", "montana",
    "rhode island", "south dakota", "north dakota", "alaska", "vermont", "wyoming", "district of columbia", "dc",
]

# Name symbols and what they become, in order.
SYMBOLS = [("&", " and "), ("/", " "), ("-", " "), ("@", " at "), ("+", " plus "), (",", " "), (".", " "), (";", " "), (":", " "), ("_", " ")]

# Cores that are noise.
NOISE = [r"^\d+$", r"^[A-Za-z]$", r"^(test|sample|temp|unknown|n/?a|none|tbd)$", r"^1099$"]

# Rank of a relationship; a smaller one survives.
RELATIONSHIP_RANKS = {
    "Company Name on 1099 form": 10, "Company Name on Paycheck": 10, "Company Name on Paystubs": 10, "Company Name on W-2": 10,
    "Company Logo on Paycheck": 15, "Company Logo on Paystubs": 15, "Franchise Name (Not a direct employee)": 15,
    "Company Name on Arbitration": 20, "Company Name on Background Check": 20, "Company Name on EEHB": 20,
    "Company Name on New Hire Docs": 20, "Company Name on Separation Letter": 20,
    "Company Logo on EEHB": 25, "Company Logo on Emails": 25, "Company Logo on New Hire Docs": 25,
    "Company Name on Email Signature Lines": 30, "Company Name on LC 2810.5": 30,
    "Per PNC, Company Name on the Paystub": 40, "Per PNC, Staffing Agency": 40, "Per PNC, Company Name": 45, "Other/Miscellaneous": 60,
}
DEFAULT_RANK = 60

# Words and phrases that have a record deleted.
BLACKLIST_TOKENS = ["temp", "temporary", "unknown", "na", "n/a", "tbd", "test", "sample", "paystub", "employees", "delete", "unsure"]
BLACKLIST_PHRASES = ["pnc is not sure", "pnc is unsure", "no paystub", "no paystubs", "1099", "1099 pnc", "none", "do not use", "not sure", "unknown company", "no company", "no employer"]
SUSPICIOUS = r"(?i)\b(unknown|unsure|not sure|no idea|test|sample|example|dummy|temp|temporary|temp agency|none|n/?a|tbd|delete|remove|do not use)\b"

# Words that say nothing about a name.
NAME_STOPWORDS = [
    "the", "a", "an", "and", "or", "but", "in", "on", "at", "to", "for", "of", "with", "by", "from", "up", "about", "into", "through",
    "during", "before", "after", "above", "below", "between", "among", "within", "without", "against", "toward", "towards", "upon",
    "over", "under", "behind", "beneath", "beside", "beyond",
]

# Blocking lists.
ALLOW_TOKENS = ["99", "7", "24", "1-800", "360", "1", "2", "3", "4", "5", "6", "8", "9", "10", "pnc"]
ALLOW_BIGRAMS = ["99 cents", "7 eleven", "24 hour", "1-800 got", "360 behavioral"]
DENY_TOKENS = [
    "the", "and", "of", "for", "in", "on", "at", "to", "from", "a", "an", "as", "by", "is", "it", "or", "be", "are", "was", "were", "been",
    "being", "have", "has", "had", "do", "does", "did", "will", "would", "could", "should", "may", "might", "must", "can", "shall",
]
STOP_TOKENS = ["inc", "llc", "ltd"]

# The retail normalisation's lists.
WEAK_TOKENS = ["only", "the", "and", "of", "for", "in", "on", "at", "to", "from"]
PLURALS = {"stores": "store", "services": "service", "holdings": "holding", "companies": "company", "shops": "shop", "centers": "center", "offices": "office", "locations": "location"}
RETAIL_TERMS = {"store": "store", "stores": "store", "shop": "store", "shops": "store"}

# Headers that mean a canonical column.
SYNONYMS = {
    "account_name": ["Account Name", "Company", "Company Name", "Customer", "Customer Name", "Name"],
    "account_id": ["Account ID", "Acct ID", "Id", "ID", "External Id", "ExternalID"],
    "parent_account_id": ["Parent Account ID", "Parent Id", "ParentID"],
    "created_date": ["Created Date", "Create Date", "CreatedOn", "Created_On"],
    "suffix_class": ["Suffix", "Company Suffix", "Entity Type"],
}


@dataclass(frozen=True)
class Settings:
    high: int = 92
    medium: int = 84
    suffix_penalty: int = 25
    numeric_penalty: int = 5
    punctuation_penalty: int = 3
    gate_cutoff: int | None = None  # of the set ratio; None leaves the gate out
    enhance: bool = False  # retail normalisation in the Jaccard tokens
    allow_tokens: tuple = tuple(ALLOW_TOKENS)
    allow_bigrams: tuple = tuple(ALLOW_BIGRAMS)
    deny_tokens: tuple = tuple(DENY_TOKENS)
    stop_tokens: tuple = tuple(STOP_TOKENS)
    shard_strategy: str = "second_token"
    fallback_shard: str = "char_trigram"
    max_shard_size: int = 200
    block_cap: int | None = 800  # None: blocks are never sharded
    char_bigram_gate: float = 0.1
    length_window: int = 150
    min_token_overlap: int = 1
    max_candidates: int | None = 50  # of a record in a soft-banned shard; None: all
    edge_gating: bool = True
    canopy_enabled: bool = True
    canopy_bound: int = 8
    allow_medium_plus_shared: bool = True
    union_order: str = "descending"
    tie_breakers: tuple = ("created_date", "account_id")
    max_alias_pairs: int | None = None  # the best so many of all matches; None: all
    blacklist_tokens: tuple = tuple(BLACKLIST_TOKENS)
    blacklist_phrases: tuple = tuple(BLACKLIST_PHRASES)
    suspicious: str = SUSPICIOUS
    ranks: dict = field(default_factory=lambda: dict(RELATIONSHIP_RANKS))

    def but(self, **changes) -> "Settings":
        return replace(self, **changes)

    def config_hash(self) -> str:
        """Eight hex digits of the settings' canonical JSON."""
        return sha1(json.dumps(self.__dict__, sort_keys=True, separators=(",", ":"), default=list).encode()).hexdigest()[:8]


DEFAULTS = Settings()
