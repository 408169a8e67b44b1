"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP5 = rf"""
with item as (
  select item_id::varchar item, regexp_extract_all({_LOW}, '{_WORDS}') w from benchmark
), gram as (
  select distinct item, array_to_string(w[p:p + least(len(w), 10) - 1], ' ') g, least(len(w), 10) k
  from (select item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) p from item where len(w) > 0)
), doc as (
  select row_number() over () r, doc_id, regexp_extract_all({_LOW}, '{_WORDS}') w from documents
), size as (
  select distinct k from gram
), place as (
  select r, p, k, array_to_string(w[p:p + k - 1], ' ') g
  from (select r, w, k, unnest(range(1, len(w) - k + 2)) p from doc, size where len(w) >= k)
), found as (
  select r, p, place.k, item from place join gram using (g, k)
), hit as (
  select r, count(distinct q) n_hit from (select r, unnest(range(p, p + k)) q from found) group by r
), listed as (
  select r, count(*) n_items, string_agg(item, ',' order by item) items
  from (select distinct r, item from found where item is not null) group by r
)
select doc_id, len(w)::bigint n_words, coalesce(n_hit, 0)::bigint n_hit, coalesce(n_items, 0)::bigint n_items,
  sha256(coalesce(items, '')) items_sha256, coalesce(n_hit, 0) > 0 contaminated
from doc left join hit using (r) left join listed using (r)
"""


_FITS = "(host = '{0}' or ends_with(host, '.{0}')) and starts_with(path, '{1}')"
OP10 = f"""
with recursive url as (
  select page_id, case when strpos(coalesce(url, ''), '://') = 0 then ''
    else substr(url, strpos(url, '://') + 3) end rest from pages
), part as (
  select page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) path from url
), ruled as (
  select *, case when {_FITS.format('www.example.com', '/en/')} then 'www.example.com/en/'
    when {_FITS.format('example.com', '/en/')} then 'example.com/en/'
    when {_FITS.format('net', '/es/')} then 'net/es/' when {_FITS.format('net', '/fr/')} then 'net/fr/'
    when {_FITS.format('com', '/')} then 'com/' end as "rule",
    list_filter(string_split(path, '/'), lambda s: s <> '') parts from part
), shaped as (
  select page_id, host, path, "rule", case when "rule" in ('com/', 'www.example.com/en/') then 'allow'
    when "rule" is not null then 'block' end says,
    array_to_string(list_transform(parts, lambda s: case when length(s) >= 32 then '{{long}}'
      else regexp_replace(s, '[0-9]+', '{{n}}', 'g') end), '/') shape from ruled
), leaf as (
  select host, shape, count(*)::double n, count(says)::double m, count(*) filter (says = 'block')::double b
  from shaped group by all
), root as (
  select host, shape, n, m, b, g,
    (hb + 10.0 * g + 0.1 * (hn - hm) * g) / (hm + 10.0 + 0.1 * (hn - hm)) purity
  from leaf join (select host, sum(n) hn, sum(m) hm, sum(b) hb from leaf group by 1) using (host),
    (select (coalesce(sum(b), 0) + 1) / (coalesce(sum(m), 0) + 2) g from leaf)
), tree as (
  select host, shape, n, m, b, g, case when shape = '' then [] else string_split(shape, '/') end rest,
    '' template, purity, false ended, m own from root
  union all
  select host, shape, n, m, b, g, rest[k + 2:], template,
    (ob + 10.0 * purity + 0.1 * (onn - om) * g) / (om + 10.0 + 0.1 * (onn - om)), next = '', om
  from (
    select *, sum(n) over own onn, sum(m) over own om, sum(b) over own ob from (
      select * replace (template || array_to_string(list_transform(rest[:k], lambda s: '/' || s), '') || case
        when next = '' then '' when kinds >= 16 and kinds >= 0.5 * an then '/*'
        when nm > 0 and abs(nb / nm - ab / am) <= 1.96 * sqrt(ab / am * (1 - ab / am) / nm) then '/+'
        else '/' || next end as template) from (
        select *, sum(m) over node nm, sum(b) over node nb, count(distinct next) over (partition by host, template) kinds from (
          select *, coalesce(rest[k + 1], '') as next from (
            select *, list_position(list_transform(range(1, len(low) + 2), lambda i: coalesce(low[i] = high[i], false)), false) - 1 k
            from (
              select *, min(rest) over up low, max(rest) over up high, sum(n) over up an, sum(m) over up am, sum(b) over up ab
              from tree where not ended window up as (partition by host, template)
            )))
        window node as (partition by host, template, next)
      ))
    window own as (partition by host, template)
  )
)
select page_id, host, path, "rule", coalesce(says, case when purity >= 0.9 and own >= 5 then 'block' else 'allow' end) verdict,
  template, purity, own::bigint own_labels
from shaped join (from tree where ended) using (host, shape)
"""

_SPACE = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
OP12 = f"""
with doc as (
  select row_number() over () r, doc_id, string_split(coalesce(text, ''), chr(10)) ls from documents
), line as (
  select r, doc_id, unnest(ls) l, unnest(range(1, len(ls) + 1)) p from doc
), keyed as (
  select *, translate(trim(l, {_SPACE}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') k from line
), often as (
  select k, max(doc_id) owner from keyed where length(k) >= 20 group by k having count(distinct r) >= 3
), judged as (
  select keyed.*, often.k is null or owner is not distinct from doc_id stays
  from keyed left join often on keyed.k = often.k
)
select any_value(doc_id) doc_id, count(*)::bigint n_lines, count(*) filter (not stays)::bigint n_dropped,
  sha256(coalesce(string_agg(l, chr(10) order by p) filter (stays), '')) kept_sha256
from judged group by r
"""

ORACLES: dict[str, str] = {"op5_benchmark_hits": OP5, "op10_url_templates": OP10, "op12_line_dedup": OP12}
