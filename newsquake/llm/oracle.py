"""SQL counterparts of the registered queries, written apart from them, for DuckDB on the same tables."""

ORACLE: dict[str, str] = {}

ORACLE["op10_benchmark_decontamination"] = r"""
with dw as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w
  from documents
), iw as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w
  from benchmark
), win as (
  select distinct item_id, least(len(w), 10) n, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') g
  from (select item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) i from iw where len(w) > 0)
), sizes as (select distinct n from win), pos as (
  select doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') g
  from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) i from dw, sizes where len(w) >= n)
), hits as (select pos.doc_id, pos.n, pos.i, win.item_id from pos join win on pos.n = win.n and pos.g = win.g),
covered as (select doc_id, count(distinct p) n_hit from (select doc_id, unnest(range(i, i + n)) p from hits) group by 1),
named as (select doc_id, count(*) n_items, string_agg(s, ',' order by s) ids from (select distinct doc_id, cast(item_id as varchar) s from hits) group by 1)
select dw.doc_id, cast(len(w) as bigint) n_words, cast(coalesce(n_hit, 0) as bigint) n_hit, cast(coalesce(n_items, 0) as bigint) n_items,
  sha256(coalesce(ids, '')) items_sha256, coalesce(n_hit, 0) > 0 contaminated
from dw left join covered using (doc_id) left join named using (doc_id)
"""

ORACLE["op4_mixing_sources"] = r"""
with d as (
  select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) size from documents
), s as (
  select source, cast(sum(size) as bigint) source_size, row_number() over (order by source nulls last) r from d group by source
), w as (select source, source_size, 2.0::double * source_size cap, [3, 1, 2][(r - 1) % 3 + 1] weight, r from s),
tried as (
  select a.source, (1.5::double * (select sum(source_size) from w) - coalesce(sum(case when (b.cap / b.weight, b.r) < (a.cap / a.weight, a.r) then b.cap end), 0))
    / sum(case when (b.cap / b.weight, b.r) >= (a.cap / a.weight, a.r) then b.weight end) level, any_value(a.cap) cap, any_value(a.weight) weight
  from w a, w b group by a.source
), final as (select min_by(level, cap / weight) level from tried where level * weight <= cap),
t as (select w.source, source_size, least(cap, coalesce((select level from final), 1e300) * weight) target from w),
o as (
  select doc_id, size, source_size, target, cast(floor(target) as bigint) budget,
    coalesce(sum(size) over (partition by d.source order by md5(concat_ws(':', 'mix', doc_id, size)), doc_id, size rows between unbounded preceding and 1 preceding), 0) ahead
  from d join t on d.source is not distinct from t.source
)
select doc_id, size, source_size, target,
  cast(case when source_size = 0 then 0 else size * (budget // source_size) + greatest(0, least(size, budget - (budget // source_size) * source_size - ahead)) end as bigint) taken
from o
"""

ORACLE["op2_chat_formatting"] = r"""
with rows_ as (
  select conv_id, turn, coalesce(role, '') role, coalesce(text, '') body from conversations
  union all select -1, t, r, '<|im_end|><|im_start|>assistant ok' from (values (0, 'user'), (1, 'assistant')) v(t, r)
), told as (
  select *, contains(body, '<|im_start|>') or contains(body, '<|im_end|>') or regexp_matches(body, '<\\+\|') hard,
    contains(role, chr(10)) or contains(role, '<|im_start|>') or contains(role, '%25') or contains(role, '%0A') or contains(role, '%3C') odd
  from rows_
), level as (select conv_id, bool_or(hard or odd) one, bool_or(odd) two from told group by 1),
ready as (
  select t.*, len(case when two then replace(replace(replace(role, '%', '%25'), chr(10), '%0A'), '<', '%3C') else role end) role_chars,
    len(case when one then regexp_replace(body, '<(\\*)\|', '<\1\\|', 'g') else body end) body_chars
  from told t join level l on t.conv_id is not distinct from l.conv_id
)
select conv_id, count(*) n_turns,
  sha256(string_agg(role || chr(10) || body || chr(10), '' order by turn nulls first, role, body)) turns_sha256,
  cast(coalesce(sum(len(body)) filter (role = 'assistant'), 0) as bigint) loss_chars,
  sha256(coalesce(string_agg(body, '' order by turn nulls first, role, body) filter (role = 'assistant'), '')) loss_sha256,
  cast(sum(12 + role_chars + 1 + body_chars + 11) as bigint) formatted_chars
from ready group by conv_id
"""

ORACLE["op5_url_filters"] = r"""
with p as (
  select page_id, case when contains(url, '://') then url[strpos(url, '://') + 3 :] else '' end rest from pages
), h as (
  select page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) path from p
), r(rh, rp, v) as (values ('com', '/en/', 'block'), ('example.com', '/en/7', 'allow'), ('net', '/de/', 'allow'), ('example.net', '/de/8', 'block'), ('org', '/es/', 'block')),
best as (
  select page_id, arg_max(rh || rp, len(rh || rp)) rule, arg_max(v, len(rh || rp)) v
  from h join r on (host = rh or ends_with(host, '.' || rh)) and starts_with(path, rp) group by 1
)
select h.page_id, host, path, rule,
  coalesce(v, case when list_has_any(string_split(host, '.'), ['ads-track', 'adult-x', 'casino-win', 'cheap-pills', 'free-bets', 'spam-farm']) then 'block' else 'allow' end) verdict
from h left join best using (page_id)
"""

ORACLE["op11_exact_dedup"] = r"""
with d as (select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') body, row_number() over (order by doc_id nulls last) r from documents)
select doc_id, first_value(doc_id) over (partition by body order by r) keep_id, count(*) over (partition by body) group_size,
  r = min(r) over (partition by body) kept, sha256(body) text_sha256
from d
"""

ORACLE["op13_conversation_trie"] = r"""
with t as (
  select conv_id c, list({'r': coalesce(role, ''), 'x': coalesce(text, '')} order by turn nulls first) l from conversations group by 1
), heads as (
  select c, l, cast(xor(list_reduce(list_transform(string_split(cast(c as varchar), ''), lambda x: cast(ascii(x) as bigint)),
    lambda a, b: list_reduce(range(8), lambda v, k: xor(v >> 1, 3988292384 * (v & 1)), xor(a, b)), cast(4294967295 as bigint)), cast(4294967295 as bigint)) % 4 as bigint) h
  from t
), rebuilt as (
  select a.c, list_concat(coalesce(b.l[1 : a.h], []), a.l[a.h + 1 :]) l from heads a left join t b on b.c = a.c - a.c % 20
), paths as (select c, len(l) n, l[1 : d] k, d from (select c, l, unnest(range(0, len(l) + 1)) d from rebuilt)),
node as (
  select k, d, min(c) conv_id, count(*) n_convs, sha256(coalesce(string_agg(cast(c as varchar), ',' order by c) filter (n = d), '')) ends_sha256,
    case when d > 0 then (count(*) - 1) * len(regexp_extract_all(k[d].x, '[^\x20\x09-\x0D]+')) else 0 end saved
  from paths group by k, d
), kids as (select k[1 : d - 1] k, d - 1 d, count(*) n_children from node where d > 0 group by 1, 2),
full_ as (select node.*, coalesce(n_children, 0) n_children from node left join kids using (k, d)),
under as (
  select k[1 : a] k, a d, sum(saved) saved_tokens, count(*) filter (n_children = 0) n_leaves
  from (select k, d, saved, n_children, unnest(range(0, d + 1)) a from full_) group by 1, 2
)
select f.conv_id, f.d depth, p.conv_id parent_conv_id, f.n_convs, f.n_children, u.n_leaves, cast(u.saved_tokens as bigint) saved_tokens, f.ends_sha256
from full_ f join under u using (k, d) left join node p on p.k = f.k[1 : f.d - 1] and p.d = f.d - 1
"""

# The columns of op1 and op6 that their methods do not decide; tests compare them, the rest has brute-force tests.
BASE: dict[str, str] = {}

BASE["op1_license_scans"] = r"""
with d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w
  from documents
), p(phrase, label) as (values (['gnu', 'general', 'public', 'license'], 'gpl'), (['apache', 'license'], 'apache'), (['cc', 'by'], 'cc-by'), (['mit', 'license'], 'mit')),
spot as (select doc_id, w, unnest(range(len(w))) i from d where list_has_any(w, ['gnu', 'apache', 'cc', 'mit'])),
hit as (select doc_id, i, label from spot join p on w[i + 1] = phrase[1] and w[i + 1 : i + len(phrase)] = phrase),
told as (select doc_id, count(*) n_base, min(i) first_word, max(i) last_word, string_agg(distinct label, ',' order by label) base_labels from hit group by 1)
select doc_id, cast(len(w) as bigint) n_words, cast(coalesce(n_base, 0) as bigint) n_base, first_word, last_word, coalesce(base_labels, '') base_labels
from d left join told using (doc_id)
"""

BASE["op6_quality_rules"] = r"""
with d as (select doc_id, coalesce(text, '') body, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') w from documents),
l as (select doc_id, line, count(*) n from (select doc_id, unnest(string_split(body, chr(10))) line from d) where regexp_matches(line, '[^\x20\x09-\x0D]') group by 1, 2),
dup as (select doc_id, sum(n - 1) n_dup_lines from l group by 1),
g as (select doc_id, i, w[i : i + 2] g from (select doc_id, w, unnest(range(1, len(w) - 1)) i from d where len(w) > 2)),
r as (select doc_id, count(distinct p) n_repeat_words from (select doc_id, unnest(range(i, i + 3)) p from (select doc_id, i, count(*) over (partition by doc_id, g) n from g) where n > 1) group by 1)
select doc_id, cast(len(w) as bigint) n_words, cast(coalesce(list_sum(list_transform(w, lambda x: len(x))), 0) as bigint) word_chars,
  cast(len(regexp_extract_all(body, '[#*$%&|<>]')) as bigint) n_symbols, cast(coalesce(n_dup_lines, 0) as bigint) n_dup_lines,
  cast(coalesce(n_repeat_words, 0) as bigint) n_repeat_words, len(w) < 50 or 100 * coalesce(n_repeat_words, 0) > 50 * len(w) base_failed
from d left join dup using (doc_id) left join r using (doc_id)
"""
