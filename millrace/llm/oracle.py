"""DuckDB SQL of those queries that SQL can express."""

_RULES = "(values ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')) r(rule_host, rule_path, rule_verdict)"

OP1 = f"""
with parts as (
  select page_id, url,
    case when contains(coalesce(url, ''), '://') then substr(url, instr(url, '://') + 3) else '' end as rest
  from pages
), hosts as (
  select page_id, url, regexp_extract(rest, '^[^/?#]*') as raw,
    regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') as path
  from parts
), lowered as (select row_number() over () as rn, page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host, path from hosts),
fits as (
  select rn, rule_host || rule_path as rule, rule_verdict,
    row_number() over (partition by rn order by length(rule_host || rule_path) desc, length(rule_host) desc) as k
  from lowered, {_RULES}
  where (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)
)
select page_id, host, path, rule, coalesce(rule_verdict, 'allow') as verdict
from lowered left join fits on lowered.rn = fits.rn and fits.k = 1
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

OP2 = f"""
with items as (select item_id, regexp_extract_all({_LOWER}, '{_WORDS}') as w from benchmark),
windows as (
  select distinct item_id, least(13, len(w)) as k, array_to_string(list_slice(w, i, i + least(13, len(w)) - 1), ' ') as win
  from items, unnest(range(1, len(w) - least(13, len(w)) + 2)) t(i) where len(w) > 0
),
docs as (select row_number() over () as rn, doc_id, regexp_extract_all({_LOWER}, '{_WORDS}') as w from documents),
places as (
  select rn, i, k, array_to_string(list_slice(w, i, i + k - 1), ' ') as win
  from docs, (select distinct k from windows) ks, unnest(range(1, len(w) - k + 2)) t(i)
),
hits as (select rn, i, places.k, item_id from places join windows on places.win = windows.win and places.k = windows.k),
hit_words as (select rn, count(distinct j) as n_hit from hits, unnest(range(i, i + k)) t(j) group by rn),
hit_items as (select rn, count(distinct item_id) as n_items, string_agg(distinct cast(item_id as varchar), ',' order by cast(item_id as varchar)) as ids from hits group by rn)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from docs left join hit_words using (rn) left join hit_items using (rn)
"""

OP3 = r"""
with docs as (select row_number() over () as rn, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
windows as (select rn, doc_id, i, array_to_string(list_slice(w, i, i + 12), ' ') as win from docs, unnest(range(1, len(w) - 11)) t(i)),
least_doc as (select win, min(doc_id) as low from windows group by win),
gone as (select distinct rn, j from windows join least_doc using (win), unnest(range(i, i + 13)) t(j) where low < doc_id),
gone_lists as (select rn, count(*) as n_removed, list(j) as js from gone group by rn)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_removed, 0) as n_removed,
  sha256(coalesce(array_to_string(list_filter(w, lambda x, i: not coalesce(list_contains(js, i), false)), ' '), '')) as kept_sha256
from docs left join gone_lists using (rn)
"""

OP4 = r"""
with recursive docs as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
shingles as (
  select distinct doc_id, array_to_string(list_slice(w, i, i + least(2, len(w)) - 1), ' ') as s
  from docs, unnest(range(1, len(w) - least(2, len(w)) + 2)) t(i) where len(w) > 0
),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
common as (select a.doc_id as a, b.doc_id as b, count(*) as n from shingles a join shingles b on a.s = b.s and a.doc_id < b.doc_id group by all),
links as (select a, b from common join sizes x on x.doc_id = a join sizes y on y.doc_id = b where 100 * common.n >= 80 * (x.n + y.n - common.n)),
pairs as (select a, b from links union all select b, a from links),
reach(doc_id, root) as (select doc_id, doc_id from docs union select pairs.b, reach.root from reach join pairs on pairs.a = reach.doc_id)
select docs.doc_id, coalesce(sizes.n, 0) as n_shingles, r.root as component_id, docs.doc_id = r.root as kept
from docs left join sizes using (doc_id) join (select doc_id, min(root) as root from reach group by doc_id) r using (doc_id)
"""

ORACLES = {"op1_url_filters": OP1, "op2_decontamination": OP2, "op3_substring_dedup": OP3, "op4_near_duplicates": OP4}
