"""DuckDB SQL for the contract's queries, where SQL can express them."""

from __future__ import annotations

OP6 = r"""
with parts as (
  select page_id, case when contains(url, '://') then substr(url, instr(url, '://') + 3) else '' end as rest from pages
), split as (
  select page_id, regexp_extract(rest, '^[^/?#]*') as raw, rest from parts
), urls as (
  select page_id, row_number() over () as row_id,
    translate(coalesce(raw, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    coalesce(regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*'), '') as path
  from split
), rules(r_host, r_path, r_verdict) as (
  values ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), fits as (
  select row_id, r_host || r_path as rule, r_verdict, row_number() over (partition by row_id order by length(r_host || r_path) desc) as n
  from urls join rules on (host = r_host or ends_with(host, '.' || r_host)) and starts_with(path, r_path)
)
select page_id, host, path, rule, coalesce(r_verdict, 'allow') as verdict from urls left join fits on urls.row_id = fits.row_id and n = 1
"""

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _words(text: str) -> str:
    """docs (r, doc_id, w) and words (r, doc_id, pos, word); r numbers the rows, since ids may repeat."""
    return rf"""docs as (
  select row_number() over () as r, doc_id, regexp_extract_all(coalesce({text}, ''), '[^\x20\x09-\x0D]+') as w from documents
), words as (
  select r, doc_id, unnest(w) as word, generate_subscripts(w, 1) as pos from docs
)"""


def _windows(width: int) -> str:
    """The words from a row's on, null where fewer are left; no word holds a blank."""
    return "word" + "".join(f" || ' ' || lead(word, {n}) over ahead" for n in range(1, width))


OP1 = f"""
with recursive {_words(LOWER.format("text"))}, sets as (
  select distinct r, s from (select r, {_windows(5)} as s from words window ahead as (partition by r order by pos)) where s is not null
  union all
  select r, array_to_string(w, ' ') from docs where len(w) between 1 and 4
), named as (
  select r, count(*) as n, sha256(string_agg(s, chr(10) order by s)) as c from sets group by r
), held as (
  select doc_id, r, c, n from named join docs using (r) where doc_id is not null
), classes as (
  select c, min(doc_id) as first, any_value(n) as n, min(r) as r from held group by c
), shingles as (
  select c, n, s from classes join sets using (r)
), links as (
  select a.c as a, b.c as b from shingles a join shingles b on a.s = b.s and a.c < b.c
  group by a.c, b.c, a.n, b.n having 100 * count(*) >= 75 * (a.n + b.n - count(*))
), ends as (
  select a, b from links union all select b, a from links
), counts as (
  select a as c, count(*) as n_links from ends group by a
), tied as (
  select a, b from ends
  union all
  select x.c, y.c from held x join held y on x.doc_id = y.doc_id and x.c <> y.c
), reached(c, d) as (
  select c, c from classes
  union
  select reached.c, tied.b from reached join tied on reached.d = tied.a
), least as (
  select reached.c, min(first) as component_id from reached join classes on reached.d = classes.c group by reached.c
)
select docs.doc_id, coalesce(named.n, 0) as n_shingles, case when docs.doc_id is not null then coalesce(component_id, docs.doc_id) end as component_id,
  case when docs.doc_id is not null then coalesce(n_links, 0) else 0 end as n_links
from docs left join named using (r) left join least on named.c = least.c left join counts on named.c = counts.c
"""

OP7 = f"""
with {_words("text")}, windows as (
  select r, doc_id, pos, word, {_windows(13)} as s from words window ahead as (partition by r order by pos)
), firsts as (
  select s, min(doc_id) as first from windows where s is not null group by s
), told as (
  select r, pos, word, coalesce(first < doc_id, false) as later from windows left join firsts using (s)
), judged as (
  select r, pos, word, bool_or(later) over (partition by r order by pos rows between 12 preceding and current row) as gone from told
), kept as (
  select r, count(*) filter (gone) as n_removed, string_agg(word, ' ' order by pos) filter (not gone) as t from judged group by r
)
select doc_id, len(w) as n_words, coalesce(n_removed, 0) as n_removed, sha256(coalesce(t, '')) as kept_sha256 from docs left join kept using (r)
"""

ORACLES = {"op1_ngram_jaccard": OP1, "op6_url_filters": OP6, "op7_substring_dedup": OP7}
