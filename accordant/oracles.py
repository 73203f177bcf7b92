"""DuckDB SQL for the queries, from the same views; those that no SQL expresses have none."""

from __future__ import annotations

from accordant.config import BLACKLIST_PHRASES, BLACKLIST_TOKENS, DEFAULTS, LEGAL_SUFFIXES, NAME_STOPWORDS, NOISE, PARENTHESES_BLACKLIST, PLURALS, RELATIONSHIP_RANKS, RETAIL_TERMS, SUSPICIOUS, SYMBOLS, WEAK_TOKENS
from accordant.queries import UNBOUNDED
from accordant.views import ACCOUNTS, MEMBERS, RUNS


def _q(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ012345"


def _case(column: str, values: dict, default: str) -> str:
    return f"case {column} " + " ".join(f"when {_q(k)} then {_q(v) if isinstance(v, str) else v}" for k, v in values.items()) + f" else {default} end"


def _list(values) -> str:
    return "[" + ", ".join(_q(v) for v in values) + "]"


def _tokens(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, '\\s+'), lambda t: t <> '')"


def _base(x: str) -> str:
    out = f"lower(regexp_replace(trim({x}), '^\\(\\d+\\)\\s*', ''))"
    for symbol, said in SYMBOLS:
        out = f"replace({out}, {_q(symbol)}, {_q(said)})"
    return f"trim(regexp_replace(regexp_replace({out}, '\\s+', ' ', 'g'), '[^a-z0-9\\s]', '', 'g'))"


NORM = f"""
accounts as ({ACCOUNTS}),
based as (select *, trim(account_name) as name_raw, {_base("account_name")} as name_base from accounts),
joined as (select *, array_to_string({_tokens("name_base")}, ' ') as j from based),
ended as (select *, list_reduce(list_filter({_list(LEGAL_SUFFIXES)}, lambda s: j = s or ends_with(j, ' ' || s)), lambda p, q: case when length(q) > length(p) then q else p end, '') as ending from joined),
norm as (select *, {_case("ending", LEGAL_SUFFIXES, "'NONE'")} as suffix_class, trim(substr(j, 1, length(j) - length(ending))) as name_core,
  contains(name_raw, '(') and contains(name_raw, ')') as has_parentheses, contains(name_raw, ';') as has_semicolon,
  contains(name_raw, ';') or contains(name_raw, ':') or regexp_matches(name_raw, '\\(\\d+\\)|^\\d+\\.')
    or (length(name_raw) - length(replace(lower(name_raw), ' and ', ''))) / 5 + (length(name_raw) - length(replace(name_raw, '&', ''))) > 1 as has_multiple_names
  from ended)"""

_NOISE = " or ".join(f"regexp_matches(lower(trim(name_core)), {_q(p)})" for p in NOISE)
KEPT = f"""{NORM},
marked as (select *, case when trim(name_core) = '' then 'empty_name_core' when {_NOISE} then 'noise_string' end as reason from norm),
kept as (select * from marked where reason is null),
keyed as (select *, trim(regexp_replace(trim(account_name), '\\s+', ' ', 'g')) as raw_exact_key from kept),
heads as (select raw_exact_key, min(account_id) as representative_id, arg_min(account_name, account_id) as representative_name, count(*) as group_size from keyed where raw_exact_key <> '' group by 1 having count(*) >= 2),
mapped as (select account_id, account_name, raw_exact_key, representative_id, representative_name, group_size from keyed join heads using (raw_exact_key)),
uniq as (select * from kept where account_id not in (select account_id from mapped where account_id <> representative_id))"""

_FIRST = f"coalesce(list_filter({_tokens('lower(name_core)')}, lambda t: not list_contains({_list(DEFAULTS.stop_tokens)}, t))[1], {_tokens('lower(name_core)')}[1], '')"
PAIRS = f"""{KEPT},
blocked as (select account_id, row_seq, name_core, suffix_class, {_FIRST} as block_key from uniq),
pairs as (select a.account_id as account_id_a, b.account_id as account_id_b, a.name_core as name_core_a, b.name_core as name_core_b, a.suffix_class as suffix_class_a, b.suffix_class as suffix_class_b
  from blocked a join blocked b on a.block_key = b.block_key and a.row_seq < b.row_seq where a.block_key <> ''),
blocks as (select block_key as token, count(*) as count, case when list_contains({_list(DEFAULTS.allow_tokens)}, block_key) then 'allowlisted' else 'full_pairs' end as strategy,
  count(*) * (count(*) - 1) // 2 as pairs_generated, 0::bigint as pairs_capped from blocked where block_key <> '' group by 1 having count(*) > 1)"""


def _lcs(x: str, y: str) -> str:
    hits = f"list_transform(string_split({x}, ''), lambda c: list_transform(string_split({y}, ''), lambda d: case when c = d then 1 else 0 end))"
    row = f"list_transform(range(1, length({y}) + 1), lambda j: list_max(list_transform(range(1, j + 1), lambda k: greatest(acc[k], coalesce(acc[k - 1], 0) + m[k]))))"
    return f"case when length({x}) = 0 or length({y}) = 0 then 0 else list_reduce({hits}, lambda acc, m: {row}, list_transform(range(1, length({y}) + 1), lambda z: 0))[-1] end"


def _ratios(source: str, a: str, b: str) -> str:
    """CTEs from `source` (columns a, b) to `rated` (a, b, ratio_name, ratio_set)."""
    return f"""
named as (select distinct {a} as a, {b} as b from {source}),
parted as (select a, b, array_to_string(list_sort({_tokens("a")}), ' ') as sa, array_to_string(list_sort({_tokens("b")}), ' ') as sb, list_distinct({_tokens("a")}) as ta, list_distinct({_tokens("b")}) as tb from named),
sets as (select *, array_to_string(list_sort(list_filter(ta, lambda t: list_contains(tb, t))), ' ') as both_, array_to_string(list_sort(list_filter(ta, lambda t: not list_contains(tb, t))), ' ') as xa, array_to_string(list_sort(list_filter(tb, lambda t: not list_contains(ta, t))), ' ') as xb from parted),
common as (select *, {_lcs("sa", "sb")} as l1, {_lcs("xa", "xb")} as l2, length(both_) as s, length(xa) as m, length(xb) as n, case when length(both_) > 0 then 1 else 0 end as g from sets),
rated as (select a, b, case when length(sa) + length(sb) = 0 then 100.0::double else 100.0::double * (1 - (length(sa) + length(sb) - 2 * l1)::double / (length(sa) + length(sb))) end as ratio_name,
  case when len(ta) = 0 or len(tb) = 0 then 0.0::double when s > 0 and (m = 0 or n = 0) then 100.0::double
       when s = 0 then 100.0::double * (1 - (m + n - 2 * l2)::double / ((s + g + m) + (s + g + n)))
       else greatest(100.0::double * (1 - (m + n - 2 * l2)::double / ((s + g + m) + (s + g + n))), 100.0::double * (1 - (g + m)::double / (s + s + g + m)), 100.0::double * (1 - (g + n)::double / (s + s + g + n))) end as ratio_set,
  list_distinct(list_concat(ta, tb)) as tokens_all, list_filter(ta, lambda t: list_contains(tb, t)) as tokens_both from common)"""


SCORED = f"""{PAIRS},{_ratios("pairs", "name_core_a", "name_core_b")},
parts as (select pairs.*, r.ratio_name, r.ratio_set, case when len(tokens_all) = 0 then 0.0::double else len(tokens_both)::double / len(tokens_all) end as jaccard, len(list_filter(tokens_both, lambda t: not list_contains({_list(DEFAULTS.stop_tokens)}, t))) as shared_tokens_count,
  regexp_extract_all(name_core_a, '\\d+') = regexp_extract_all(name_core_b, '\\d+') as num_style_match, suffix_class_a = suffix_class_b as suffix_match
  from pairs join rated r on r.a = name_core_a and r.b = name_core_b),
scored as (select *, least(100, greatest(0, round_even(0.45::double * ratio_name + 0.35::double * ratio_set + 20.0::double * jaccard - case when num_style_match then 0.0::double else 5.0::double end - case when suffix_match then 0.0::double else 25.0::double end - 0.0::double, 0)::int)) as score from parts),
cand as (select account_id_a as id_a, account_id_b as id_b, score, shared_tokens_count from scored where score >= 84),
gated as (select id_a, id_b, score, case when score >= 92 then 'edge>=high' when score >= 84 and shared_tokens_count >= 1 then 'edge>=medium+shared_token' else 'insufficient_edge' end as reason, shared_tokens_count from cand)"""


def _components(edges: str, nodes: str) -> str:
    return f"""
ends as (select id_a as x, id_b as y from {edges} union select id_b, id_a from {edges}),
reach(x, y) as (select account_id, account_id from {nodes} union select reach.x, ends.y from reach join ends on reach.y = ends.x),
label as (select x as account_id, min(y) as root from reach group by 1)"""


GROUPS = f"""{SCORED},
edges as (select id_a, id_b from gated where reason <> 'insufficient_edge' union all select representative_id, account_id from mapped where account_id <> representative_id),{_components("edges", "kept")},
grps as (select kept.*, root as group_id, count(*) over (partition by root) as group_size from kept join label using (account_id)),
ranked as (select *, {_case("relationship", RELATIONSHIP_RANKS, "60")} as relationship_rank from grps),
surv as (select *, row_number() over (partition by group_id order by relationship_rank, created_date, account_id) = 1 as is_primary from ranked)"""


def _blacklisted(name: str) -> str:
    """Each term by itself: whole words, or anywhere in the name where the term has a blank."""
    terms = [*BLACKLIST_TOKENS, *BLACKLIST_PHRASES]
    words = [f"regexp_matches(lower({name}), {_q('(^|[^a-z0-9_])' + t + '([^a-z0-9_]|$)')})" for t in terms if " " not in t]
    return "(" + " or ".join([*words, *[f"contains(lower({name}), {_q(t)})" for t in terms if " " in t]]) + ")"


DISPOSED = f"""{GROUPS},
facts as (select *, {_blacklisted("account_name")} as black, min(suffix_class) over (partition by group_id) <> max(suffix_class) over (partition by group_id) as mismatch, regexp_matches(lower(account_name), {_q(SUSPICIOUS)}) as odd from surv),
disposed as (select account_id, group_id, is_primary, account_name, case when black then 'Delete' when has_multiple_names or mismatch then 'Verify' when group_size = 1 and odd then 'Verify' when group_size = 1 then 'Keep' when is_primary then 'Keep' else 'Update' end as disposition,
  case when black then 'blacklisted_name' when has_multiple_names then 'multi_name_string_requires_split' when mismatch then 'suffix_mismatch' when group_size = 1 and odd then 'suspicious_singleton' when group_size = 1 then 'clean_singleton' when is_primary then 'primary_record' else 'duplicate_record' end as disposition_reason from facts)"""

_VALID = f"""len(list_filter({_list(PARENTHESES_BLACKLIST)}, lambda t: contains(lower(x), t))) = 0 and not regexp_matches(x, '^\\d+$')
  and (len(list_filter({_tokens("lower(x)")}, lambda t: list_contains({_list(LEGAL_SUFFIXES)}, t))) > 0 or len(regexp_extract_all(x, '\\b[A-Z][a-z]+')) >= 2)"""
ALIASES = f"""
segments as (select account_id, unnest(string_split(name_raw, ';')) as s from SOURCE where contains(name_raw, ';')),
first_kind as (select account_id, regexp_replace(trim(s), '^\\(\\d+\\)\\s*', '') as alias, 'semicolon' as source from segments),
inside as (select account_id, name_raw, trim(unnest(regexp_extract_all(name_raw, '\\(([^)]+)\\)', 1))) as x from SOURCE),
second_kind as (select account_id, x as alias, 'parentheses' as source from inside where not (contains(name_raw, ';') and list_contains(list_transform(string_split(name_raw, ';'), lambda s: trim(s)), x)) and {_VALID}),
aliases as (select * from first_kind where alias <> '' union all select * from second_kind)"""

MATCHES = f"""{KEPT},{ALIASES.replace("SOURCE", "kept")},
told as (select a.account_id as record_id, k.suffix_class, alias as alias_text, source as alias_source, {_base("alias")} as alias_base from aliases a join kept k using (account_id)),
both_sides as (select t.*, o.account_id as match_record_id, o.name_core from (select *, {_tokens("alias_base")}[1] as ft from told) t join (select *, {_tokens("name_core")}[1] as ft from kept) o on t.ft = o.ft and t.suffix_class = o.suffix_class and t.record_id <> o.account_id),{_ratios("both_sides", "alias_base", "name_core")},
matches as (select record_id, alias_text, alias_source, match_record_id, name_core as match_group_id, ratio_name as score from both_sides join rated on a = alias_base and b = name_core where ratio_name >= 92)"""

STRICT = f"""(account_name <> '' and ({_blacklisted("account_name")} or length(trim(account_name)) < 3 or length(trim(account_name)) > 100 or contains(lower(account_name), '20-20')
  or length(regexp_replace(account_name, '[^a-zA-Z0-9]', '', 'g'))::double / length(trim(account_name)) < 0.3
  or (len(regexp_extract_all(lower(account_name), '\\b[a-zA-Z]+\\b')) > 0 and len(list_filter(regexp_extract_all(lower(account_name), '\\b[a-zA-Z]+\\b'), lambda w: list_contains({_list(NAME_STOPWORDS)}, w)))::double / len(regexp_extract_all(lower(account_name), '\\b[a-zA-Z]+\\b')) > 0.8)))"""

M = f"with members as ({MEMBERS})"
MSTATS = f"""{M}, stats as (select group_id, count(*) as group_size, max(coalesce(weakest_edge_to_primary, 0.0)) as max_score, coalesce(max(case when is_primary then account_name end), min(account_name)) as primary_name,
  coalesce(max(case when is_primary then disposition end), 'Update') as disposition from members group by 1)"""


def _enhanced(x: str) -> str:
    named = f"list_transform({_tokens(x)}, lambda t: {_case('t', RETAIL_TERMS, 't')})"
    named = f"list_transform({named}, lambda t: {_case('t', PLURALS, 't')})"
    return f"array_to_string(list_sort(list_distinct(list_filter({named}, lambda t: not list_contains({_list(WEAK_TOKENS)}, t)))), ' ')"


def _check(chunk: int) -> str:
    bits = " + ".join(f"case when regexp_matches(substr(id15, {5 * chunk + i + 1}, 1), '[A-Z]') then {1 << i} else 0 end" for i in range(5))
    return f"substr('{ALPHABET}', 1 + {bits}, 1)"


_SINGLE = f"""with recursive {SCORED.replace("where score >= 84),", "where score >= 60),", 1)},
near as (select id_a, id_b from cand where score >= 85), nodes as (select id_a as account_id from cand union select id_b from cand),{_components("near", "nodes")},
sized as (select account_id as id, root, count(*) over (partition by root) as size from label),
numbered as (select id, (dense_rank() over (order by root) - 1)::int as cluster_id from sized where size >= 2)"""



def _sharded(rows: str, cap: int, soft_cap: int, deny: list[str]) -> str:
    """CTEs from `rows` to `sharded`: blocks by first token, and the shard of each record, level by level."""
    limit = f"case when strategy = 'soft_ban_sharded' then {soft_cap} else {cap} end"
    levels, columns = [], {1: f"coalesce({_tokens('name_core')}[2], '')", 2: f"coalesce({_tokens('name_core')}[3], '')", 3: "substr(name_core, 1, 3)", 4: "substr(name_core, 1, 4)"}
    for n, finer in columns.items():
        over = "large" if n == 1 else f"large and count(*) over (partition by block_key, s{n - 1}) > {limit}"
        levels.append(f"level{n} as (select *, case when {over} then s{n - 1} || '|' || {finer} else s{n - 1} end as s{n} from level{n - 1})")
    return f"""
keyed_rows as (select account_id, row_seq, name_core, {_FIRST} as block_key from {rows}),
sized_rows as (select *, count(*) over (partition by block_key) as block_size from keyed_rows where block_key <> ''),
level0 as (select *, '' as s0, block_size > {cap} as large, case when list_contains({_list(DEFAULTS.allow_tokens)}, block_key) then case when block_size > {cap} then 'allowlisted_sharded' else 'allowlisted' end
  when list_contains({_list(deny)}, block_key) and block_size > {cap} then 'soft_ban_sharded' when block_size > {cap} then 'standard_sharded' else 'full_pairs' end as strategy from sized_rows where block_size > 1),
{", ".join(levels)},
sharded as (select account_id, row_seq, name_core, block_key, strategy, s4 as shard, {_tokens('name_core')} as own, list_distinct(list_transform(range(1, length(name_core)), lambda i: substr(name_core, i, 2))) as grams from level4)"""


def _shard_pairs(overlap: int, most: int | None) -> str:
    """CTE `shard_pairs` from `sharded`: all pairs of a shard, in soft-banned blocks those that pass the filters and the rank."""
    alike = f"abs(length(a.name_core) - length(b.name_core)) <= 150 and len(list_filter(list_distinct(a.own), lambda t: list_contains(b.own, t))) >= {overlap} and OVERLAP >= 0.1"
    alike = alike.replace("OVERLAP", "case when len(a.grams) = 0 or len(b.grams) = 0 then 0.0 else len(list_filter(a.grams, lambda g: list_contains(b.grams, g)))::double / len(list_distinct(list_concat(a.grams, b.grams))) end")
    rank = "" if most is None else f" qualify a.strategy <> 'soft_ban_sharded' or row_number() over (partition by a.account_id order by b.row_seq) <= {most}"
    return f"shard_pairs as (select a.block_key, a.account_id as account_id_a, b.account_id as account_id_b from sharded a join sharded b using (block_key, shard) where a.row_seq < b.row_seq and (a.strategy <> 'soft_ban_sharded' or ({alike})){rank})"


_MEMBERS_18 = "account_id || 'AAA'"
_RESOLVED = f"""with recursive {DISPOSED},{ALIASES.replace("SOURCE", "kept")},
ids as (select group_id, substr(sha1('{{"config_hash":"{UNBOUNDED.config_hash()}","members":[' || string_agg('"' || {_MEMBERS_18} || '"', ',' order by account_id) || ']}}'), 1, 10) as gid from disposed group by 1),
placed as (select account_id, account_name, gid, count(*) over (partition by group_id) as group_size, is_primary, disposition, disposition_reason from disposed join ids using (group_id)),
told as (select a.account_id as record_id, k.suffix_class, alias as alias_text, source as alias_source, {_base("alias")} as alias_base from aliases a join kept k using (account_id)),
both_sides as (select t.*, o.account_id as match_record_id, o.name_core from (select *, {_tokens("alias_base")}[1] as ft from told) t join (select *, {_tokens("name_core")}[1] as ft from kept) o on t.ft = o.ft and t.suffix_class = o.suffix_class and t.record_id <> o.account_id),{_ratios("both_sides", "alias_base", "name_core").replace("named as", "named2 as").replace("from named)", "from named2)").replace("parted", "parted2").replace("sets as", "sets2 as").replace("from sets)", "from sets2)").replace("common as", "common2 as").replace("from common)", "from common2)").replace("rated as", "rated2 as")},
refs as (select record_id, '{{"alias":"' || alias_text || '","group_id":"' || gid || '","score":' || ratio_name || ',"source":"' || alias_source || '"}}' as ref, alias_text, gid, ratio_name, alias_source
  from both_sides join rated2 on a = alias_base and b = name_core join placed on match_record_id = account_id where ratio_name >= 92),
listed as (select record_id, '[' || string_agg(ref, ',' order by alias_text, gid, ratio_name, alias_source) || ']' as refs from refs group by 1)
select account_id || 'AAA' as account_id, account_name, gid as group_id, group_size::int as group_size, is_primary, disposition, disposition_reason, coalesce(refs, '[]') as alias_cross_refs from placed left join listed on record_id = account_id"""

_PARITY = f"""{MSTATS}, others as (select group_id, count(*) as group_size, max(coalesce(weakest_edge_to_primary, 0.0)) as max_score, coalesce(max(case when is_primary then account_name end), min(account_name)) as primary_name,
  coalesce(max(case when is_primary then disposition end), 'Update') as disposition from members where account_id <> '17' group by 1),
paired as (select s.group_id as ka, o.group_id as kb, s.group_size as s1, o.group_size as o1, s.max_score as s2, o.max_score as o2, s.primary_name as s3, o.primary_name as o3, s.disposition as s4, o.disposition as o4 from stats s full join others o on s.group_id = o.group_id),
sides as (select count(*) filter (kb is null) as only_a, count(*) filter (ka is null) as only_b from paired)
""" + " union all ".join(f"select '{c}' as \"column\", count(*) filter (s{n} is not distinct from o{n}) as same, count(*) filter (s{n} is distinct from o{n}) as differ, any_value(only_a) as only_a, any_value(only_b) as only_b from paired, sides where ka is not null and kb is not null" for n, c in enumerate(("group_size", "max_score", "primary_name", "disposition"), 1))

_PAGE = f"""{_SINGLE}, both_ids as (select x.cluster_id, x.id as p, y.id as q from numbered x join numbered y on x.cluster_id = y.cluster_id and x.id < y.id), sims as (select cluster_id, coalesce(score / 100::double, 0.0) as sim from both_ids left join cand on (id_a = p and id_b = q) or (id_a = q and id_b = p)),
least_of as (select cluster_id, min(sim) as min_similarity from sims group by 1), shown as (select cluster_id, count(*) as size, min(account_name) as name from numbered join uniq on account_id = id group by 1),
everyone as (select '' || cluster_id as cluster, size, min_similarity, name, 0 as last from shown join least_of using (cluster_id) union all select 'outliers', count(*), 0.0, 'outliers', 1 from nodes where account_id not in (select id from numbered) having count(*) > 0)
select cluster, size, min_similarity, name from everyone order by last, size desc, cluster limit 10"""

ORACLES = {
    "s4_parquet_projection": "select c_custkey, c_mktsegment from customer",
    "p3_id_15_to_18": f"select p_partkey, id15 || {_check(0)} || {_check(1)} || {_check(2)} as id18, true as valid from (select p_partkey, case when p_partkey % 2 = 0 then upper(substr(md5('' || p_partkey), 1, 15)) else substr(md5('' || p_partkey), 1, 15) end as id15 from part)",
    "p5_dates": "select p_partkey, case when p_partkey % 3 = 0 then strftime(date '1900-01-01' + (40000 + p_size - 2)::int, '%Y-%m-%d') when p_partkey % 3 = 1 then '2024-02-' || lpad('' || (1 + p_size % 28), 2, '0') end as parsed from part",
    "p7_p8_normalise": f"with {NORM} select account_id, name_base, suffix_class, name_core, has_parentheses, has_semicolon, has_multiple_names, len({_tokens('name_core')})::int as n_tokens from norm",
    "p11_aliases": f"with {NORM},{ALIASES.replace('SOURCE', 'norm')} select account_id, alias, source from aliases",
    "p14_p15_enhanced_tokens": f"with {NORM} select account_id, {_enhanced('name_core')} as tokens from norm",
    "p16_p17_keys": f"with {NORM} select account_id, trim(regexp_replace(trim(account_name), '\\s+', ' ', 'g')) as raw_exact_key, {_FIRST} as block_key, case when len({_tokens('name_core')}) >= 2 and array_to_string({_tokens('name_core')}[1:2], ' ') in ('red bolt', 'hot gear') then array_to_string({_tokens('name_core')}[1:2], ' ') else '' end as bigram_key from norm",
    "f1_f2_filtered_out": f"with {KEPT} select account_id, account_name, reason from marked where reason is not null",
    "a17_reject_reasons": f"with {KEPT} select reason, count(*) as records from marked where reason is not null group by 1",
    "f7_f8_row_filters": f"{M} select group_id, account_id, disposition from members where disposition in ('Keep', 'Delete') and weakest_edge_to_primary >= 40",
    "f10_min_group_size": f"{M} select group_id, account_id from members where group_id in (select group_id from members group by 1 having count(*) >= 12)",
    "f11_suffix_mismatch": f"{M} select group_id, account_id from members where group_id in (select group_id from members group by 1 having count(distinct suffix_class) > 1)",
    "a1_exact_groups": f"with {KEPT} select raw_exact_key, min(account_id) as representative_id, count(*) as group_size, string_agg(account_id, ',' order by account_id) as ids from keyed where raw_exact_key <> '' group by 1 having count(*) >= 2",
    "c20_exact_map": f"with {KEPT} select * from mapped",
    "j8_unique_records": f"with {KEPT} select account_id, account_name from uniq",
    "c9_block_stats": f"with {PAIRS} select * from blocks",
    "j1_candidate_pairs": f"with {PAIRS} select account_id_a, account_id_b from pairs",
    "a18_strategy_summary": f"with {PAIRS} select strategy, count(*) as blocks, sum(count)::bigint as records, sum(pairs_generated)::bigint as pairs from blocks group by 1",
    "a19_block_sizes": f"with {PAIRS} select count(*) as blocks, sum(count)::bigint as records, max(count) as largest, avg(count) as mean, median(count) as median, count(*) filter (count > 60) as over_cap, coalesce(sum(count) filter (count > 60), 0)::bigint as records_over_cap from blocks",
    "a25_brand_suggestions": f"with {PAIRS}, rated_blocks as (select token, count, least(1.0::double, count / 100::double) as singleton_rate from blocks) select token, count, singleton_rate, 0.5::double * least(1.0::double, count / 50::double) + 0.5::double * greatest(0.0::double, least(1.0::double, (singleton_rate - 0.5) / 0.5::double)) as confidence from rated_blocks where count >= 10 and singleton_rate >= 0.5",
    "a26_allowlist_suggestions": f"with {PAIRS} select token, count, count * (1 + least(1.0::double, count / 100::double)) as score from blocks order by score desc, token limit 5",
    "c1_c2_token_ratios": f"with cores as (select {_base('n_name')} as core from nation), both_cores as (select x.core as p, y.core as q from cores x join cores y on substr(x.core, 1, 6) = substr(y.core, 1, 6) and x.core < y.core),{_ratios('both_cores', 'p', 'q')} select a, b, round(ratio_name, 6) as ratio_name, round(ratio_set, 6) as ratio_set from rated",
    "c4_scores": f"with {SCORED} select account_id_a, account_id_b, score, floor(ratio_name)::int as ratio_name, floor(ratio_set)::int as ratio_set, round(jaccard, 6) as jaccard, num_style_match, suffix_match from scored",
    "f4_candidates": f"with {SCORED} select id_a, id_b, score from cand",
    "t1_candidate_order": f"with {SCORED} select id_a, id_b, score from cand order by id_a, id_b, score desc limit 25",
    "c8_bulk_candidates": f"with {SCORED} select account_id_a as id_a, account_id_b as id_b, score from scored where score >= 50 and ratio_set >= 72",
    "a13_top_blocks": f"with {PAIRS} select * from blocks order by count desc, token limit 4",
    "v5_explained_block": f"with {PAIRS} select token as block_key, strategy, '' as shard, count as records from blocks where token = 'red'",
    "j2_bigram_pairs": f"""with {KEPT},{_sharded("uniq", 10, 5, ["red", "hot"])},{_shard_pairs(3, None)},
      two as (select account_id, row_seq, array_to_string({_tokens('name_core')}[1:2], ' ') as key, {_tokens('name_core')}[3] as third, name_core from uniq where array_to_string({_tokens('name_core')}[1:2], ' ') in ('red plate', 'hot ring')),
      keyed_two as (select *, count(*) over (partition by key) > 10 as large from two),
      shard_two as (select *, case when large and count(*) over (partition by key) > 10 then coalesce(third, '') else '' end as s from keyed_two),
      pairs_two as (select a.account_id as account_id_a, b.account_id as account_id_b from shard_two a join shard_two b on a.key = b.key and a.s = b.s and a.row_seq < b.row_seq)
      select account_id_a, account_id_b from shard_pairs union select account_id_a, account_id_b from pairs_two""",
    "j3_sharded_pairs": f"""with {KEPT},{_sharded("kept", 100, 20, ["red", "the"])},{_shard_pairs(1, 50)},
      made as (select block_key, count(*) as n from shard_pairs group by 1), sizes as (select block_key, strategy, count(*) as count from sharded group by 1, 2)
      select sizes.block_key as token, count, strategy, coalesce(n, 0) as pairs_generated, case when strategy = 'soft_ban_sharded' then greatest(0, count * (count - 1) // 2 - coalesce(n, 0)) else 0 end as pairs_capped from sizes left join made using (block_key)""",
    "c14_standard_groups": f"with recursive {SCORED},{_components('cand', 'uniq')} select account_id, (count(*) over (partition by root))::int as group_size, root as first_id from label",
    "sql_functions": f"with {NORM},{_ratios('norm', 'name_base', 'name_core')} select account_id, name_core, trim(regexp_replace(trim(account_name), '\\s+', ' ', 'g')) as raw_exact_key, round(ratio_name, 6) as ratio from norm join rated on a = name_base and b = name_core",
    "v9_content_hash": f"with accounts as ({ACCOUNTS}) select account_id, sha256(account_name || chr(10) || 'second' || chr(10) || relationship) as content_hash from accounts",
    "v1_parity": _PARITY,
    "t8_cluster_page": _PAGE,
    "whole_resolution": _RESOLVED,
    "d7_last_reasons": f"""with recursive {DISPOSED}, again as (select disposed.account_id, disposition, black, mismatch, odd, facts.is_primary as lead, has_multiple_names, group_size from disposed join facts using (account_id))
      select account_id, disposition, case when group_size > 1 and not lead then 'duplicate_record' when group_size > 1 then 'primary_record' when not black and not odd then 'clean_singleton' when not black and odd then 'suspicious_singleton'
        when mismatch then 'suffix_mismatch' when has_multiple_names then 'multi_name_string_requires_split' when black then 'blacklisted_name' else 'unknown' end as disposition_reason from again""",
    "d8_alias_reasons": f"""with {MATCHES}, told_of as (select record_id, count(*) as n, string_agg(distinct chr(39) || alias_source || chr(39), ', ' order by chr(39) || alias_source || chr(39)) as sources from matches group by 1),
      rows as (select account_id, {_blacklisted("account_name")} as black, regexp_matches(lower(account_name), {_q(SUSPICIOUS)}) as odd, n, sources from kept left join told_of on record_id = account_id)
      select account_id, case when black then 'Delete' when n is not null or odd then 'Verify' else 'Keep' end as disposition,
        case when black then 'blacklisted_name' when n is not null then 'alias_matches_' || n || '_groups_via_[' || sources || ']' when odd then 'suspicious_singleton' else 'clean_singleton' end as disposition_reason from rows""",
    "a15_candidate_stats": f"with {SCORED} select count(*) as total, count(*) as medium_or_more, count(*) filter (score >= 92) as high from cand",
    "c11_gated_edges": f"with {SCORED} select id_a, id_b, reason, shared_tokens_count::int as shared_tokens_count from gated",
    "a27_gating_reasons": f"with {SCORED} select reason, count(*) as edges from gated group by 1",
    "c13_groups": f"with recursive {GROUPS} select account_id, group_size::int as group_size, account_id = group_id as is_primary, group_id as first_id from grps",
    "c16_group_ids": f"""{M} select group_id, substr(sha1('{{"config_hash":"0badcafe","members":[' || string_agg('"' || account_id || '"', ',' order by account_id) || ']}}'), 1, 10) as stable_id from members group by 1""",
    "c17_single_clusters": f"{_SINGLE} select id, cluster_id from numbered",
    "a22_cluster_stats": f"{_SINGLE}, sizes as (select cluster_id, count(*) as size from numbered group by 1) select count(*) as clusters, sum(size)::bigint as members, avg(size) as avg_size, max(size) as max_size, min(size) as min_size from sizes",
    "a23_cluster_min_similarity": f"{_SINGLE}, both_ids as (select x.cluster_id, x.id as p, y.id as q from numbered x join numbered y on x.cluster_id = y.cluster_id and x.id < y.id), sims as (select cluster_id, coalesce(score / 100::double, 0.0) as sim from both_ids left join cand on (id_a = p and id_b = q) or (id_a = q and id_b = p)), least_of as (select cluster_id, min(sim) as min_similarity from sims group by 1) select cluster_id, (select count(*) from numbered n where n.cluster_id = l.cluster_id) as size, min_similarity from least_of l",
    "u5_outliers": f"{_SINGLE} select account_id as id from nodes where account_id not in (select id from numbered)",
    "w1_survivors": f"with recursive {GROUPS} select account_id, relationship_rank, is_primary from surv",
    "a8_conflicts": f"with recursive {GROUPS} select group_id, count(*) as group_size, count(distinct account_name) as n_account_name, count(distinct relationship) as n_relationship, count(distinct created_date) as n_created_date, greatest(count(distinct account_name), count(distinct relationship), count(distinct created_date)) > 1 as has_conflict from surv group by 1",
    "a10_preview_summary": f"{M}, g as (select group_id, greatest(count(distinct account_name), count(distinct suffix_class)) > 1 as c from members group by 1 having count(*) > 1) select count(*) filter (c) as conflicted, count(*) filter (not c) as clean, count(*) as total, count(*) filter (c) / count(*)::double as rate from g",
    "a20_group_quantiles": f"{M}, g as (select count(*) as size from members group by group_id having count(*) > 1), l as (select list_sort(list(size)) as s from g) select len(s)::bigint as groups, list_sum(s)::double / len(s) as avg_size, s[len(s) // 2 + 1] as p50, s[floor(len(s) * 0.9)::int + 1] as p90 from l",
    "d4_dispositions": f"with recursive {DISPOSED} select account_id, disposition, disposition_reason from disposed",
    "d1_d3_blacklists": f"with accounts as ({ACCOUNTS}) select account_id, {_blacklisted('account_name')} as listed, {STRICT} as strict from accounts",
    "a16_disposition_counts": f"with recursive {DISPOSED} select disposition, count(*) as records from disposed group by 1",
    "a7_group_metadata": f"{M} select group_id, count(*) as group_size, string_agg(distinct suffix_class, ',' order by suffix_class) as suffix_classes, count(distinct suffix_class) > 1 as has_suffix_mismatch, count(*) filter ({_blacklisted('account_name')}) as blacklist_hits, bool_or(is_primary) as has_primary from members group by 1",
    "g1_alias_matches": f"with {MATCHES} select record_id, alias_text, alias_source, match_record_id, match_group_id, round(score, 6) as score from matches",
    "a24_cross_references": f"with {MATCHES} select record_id as account_id, count(*)::int as n, min(alias_text) as first_alias from matches group by 1",
    "a2_group_stats": f"{MSTATS} select * from stats",
    "a3_group_stats_first": f"{M} select group_id, count(*) as group_size, max(weakest_edge_to_primary) as max_score, arg_min(account_name, account_id) filter (is_primary) as primary_name, arg_min(disposition, account_id) filter (is_primary) as disposition from members group by 1",
    "a12_size_histogram": f"{M}, s as (select count(*) over (partition by group_id) as n from members) select case when n >= 4 then '4_plus' else '' || n end as bucket, count(*) as n from s group by 1",
    "a21_in_group_scores": f"with {SCORED} select count(*) as edges, min(score)::double as min_score, avg(score) as mean_score, max(score)::double as max_score, count(*) filter (score >= 92) as high, count(*) filter (score >= 84 and score < 92) as medium, count(*) filter (score < 84) as low from cand",
    "t6_page_from_stats": f"{MSTATS} select * from stats where disposition in ('Keep', 'Update') and max_score >= 50 order by max_score desc nulls last, group_id limit 20 offset 20",
    "t6_page_from_rows": f"{M}, f as (select * from members where disposition = 'Keep' and weakest_edge_to_primary >= 20) select group_id, count(*) as group_size, max(coalesce(weakest_edge_to_primary, 0.0)) as max_score, coalesce(max(case when is_primary then account_name end), '') as primary_name from f group by 1 order by group_size desc, group_id limit 25",
    "t7_details_page": f"{M} select group_id, account_id, account_name, suffix_class, created_date, disposition from members where group_id = '7' order by account_name desc, account_id limit 10",
    "a6_count_groups": f"{MSTATS} select count(distinct group_id) as groups, 'rows' as source from members where disposition = 'Keep' and weakest_edge_to_primary >= 30 union all select count(*), 'stats' from stats where disposition = 'Keep' and max_score >= 30",
    "a29_badges": f"{M} select group_id, count(distinct suffix_class) as suffixes, count(*) filter (is_primary) as primaries, count(*) filter ({_blacklisted("account_name || case when account_id::bigint % 7 = 0 then ' sample' else '' end")}) as blacklist_hits, count(*) as group_size from members group by 1",
    "j14_refreshed_stats": f"{MSTATS} select * from stats",
    "w4_keep_first": "select event_id, user_id, event_type from (select *, row_number() over (partition by user_id order by event_id) as n from events) where n = 1",
    "a28_newest_runs": f"with runs as ({RUNS}) select run_id, input_hash, config_hash from (select *, row_number() over (partition by input_hash, config_hash order by \"timestamp\" desc, run_id) as n from runs) where n = 1",
    "t9_latest_runs": f"with runs as ({RUNS}) select run_id from runs order by \"timestamp\" desc, run_id limit 10",
    "j7_dangling_references": f"with {SCORED} select distinct id as account_id from (select id_a as id from cand union select id_b from cand) where id in (select account_id from uniq where row_seq % 10 = 0)",
    "u4_difference": f"{M}, a as (select group_id, disposition from members where disposition <> 'Keep'), b as (select group_id, disposition from members where disposition <> 'Delete') select side, disposition, count(*) as n from (select *, 'a' as side from (select * from a except all select * from b) union all select *, 'b' as side from (select * from b except all select * from a)) group by 1, 2",
}
