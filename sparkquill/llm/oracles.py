"""SQL for the queries that SQL can express.

Personal data, main texts, token ids and counts, and secrets (2, 5, 8, 12, 10) need matching by position, parsing, merging
or a fitted field; tests hold them against brute-force versions.
"""

from __future__ import annotations

from itertools import permutations

from sparkquill.llm.quality import RULES, STOP_FORMS
from sparkquill.llm.urls import RULES as URL_RULES

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SPACE = r"[ \t\n\x0b\x0c\r]+"


def _words(text: str, mark: str = SPACE) -> str:
    return f"list_filter(string_split_regex(coalesce({text}, ''), '{mark}'), lambda x: x <> '')"


WARC = """with p as (select page_id, coalesce(html, '') as h from pages),
q as (select *, strlen(h) as n, min(page_id) over (partition by h) as first from p)
select page_id, n::bigint as payload_bytes, sha256(h) as payload_digest, case when n >= 100 and page_id > first then 'revisit' else 'response' end as record_type,
case when n >= 100 and page_id > first then first end as refers_to from q"""


def _urls() -> str:
    """The tables hold no canonical or redirect links, so urls without a rule are all allowed."""
    best = sorted(URL_RULES, key=lambda r: -len(r.rule))
    fits = [(f"(host = '{r.host}' or ends_with(host, '.{r.host}')) and starts_with(path, '{r.path}')", r) for r in best]
    rule = " ".join(f"when {c} then '{r.rule}'" for c, r in fits)
    verdict = " ".join(f"when {c} then '{r.verdict}'" for c, r in fits)
    host = LOWER.format("regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1)")
    return f"""with p as (select page_id, {host} as host, regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) as path from pages)
select page_id, host, path, case {rule} end as rule, case {verdict} else 'allow' end as verdict from p"""


NEAR = f"""with recursive w as (select doc_id, {_words(LOWER.format('text'))} as w from documents),
s as (select distinct doc_id, unnest(case when len(w) < 3 then [array_to_string(w, ' ')] else list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) end) as s from w where len(w) > 0),
n as (select doc_id, count(*) as n from s group by doc_id),
c as (select a.doc_id as a, b.doc_id as b, count(*) as common from s a join s b on a.s = b.s and a.doc_id < b.doc_id group by 1, 2),
e as (select c.a, c.b from c join n x on x.doc_id = c.a join n y on y.doc_id = c.b where 100 * common >= 85 * (x.n + y.n - common)),
u as (select a, b from e union select b, a from e),
r as (select doc_id as node, doc_id as reach from documents union select r.node, u.b from r join u on u.a = r.reach),
k as (select node, min(reach) as component from r group by node)
select d.doc_id, coalesce(n.n, 0) as n_shingles, k.component as component_id, d.doc_id = k.component as kept from documents d left join n using (doc_id) join k on k.node = d.doc_id"""


def _quality() -> str:
    stop = ", ".join(f"'{w}'" for w in STOP_FORMS)
    signal = {
        "n_words": "n_words",
        "mean_word_chars": "case when n_words > 0 then word_chars / n_words else 0 end",
        "symbol_ratio": "case when n_words > 0 then n_symbols / n_words else 0 end",
        "stop_word_ratio": "case when n_words > 0 then n_stop / n_words else 0 end",
        "stutter_ratio": "case when n_words > 0 then n_stutters / n_words else 0 end",
        "dup_line_ratio": "case when n_lines > 0 then n_dup_lines / n_lines else 0 end",
        "exclamation_ratio": "case when n_words > 0 then n_exclamations / n_words else 0 end",
    }
    good = [f"{signal[r.signal]} >= {r.least}" for r in RULES if r.least is not None] + [f"{signal[r.signal]} <= {r.most}" for r in RULES if r.most is not None]
    return f"""with w as (select doc_id, coalesce(text, '') as t, {_words('text')} as w from documents),
i as (select doc_id, unnest(range(1, greatest(len(w) - 6, 1))) as i, w from w where len(w) >= 8),
k as (select doc_id, i, array_to_string(w[i:i + 7], ' ') as k from i),
d as (select doc_id, i from k qualify count(*) over (partition by doc_id, k) > 1),
r as (select doc_id, count(distinct i + j) as n_repeat_words from d, range(0, 8) x(j) group by doc_id),
l as (select doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ \\t\\n\\x0b\\x0c\\r]')) as l from w),
c as (select w.doc_id, len(w)::bigint as n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::bigint as word_chars,
  length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols, length(regexp_replace(t, '[^!]', '', 'g')) as n_exclamations, (len(l) - len(list_distinct(l)))::bigint as n_dup_lines, len(l) as n_lines,
  len(list_filter(w, lambda x: x in ({stop}))) as n_stop, len(list_filter(range(2, len(w) + 1), lambda p: w[p] = w[p - 1])) as n_stutters, coalesce(n_repeat_words, 0)::bigint as n_repeat_words
  from w join l using (doc_id) left join r using (doc_id)),
b as (select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from c)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and {' and '.join(good)} as kept from b"""


SUBSTRINGS = f"""with w as (select doc_id, {_words('text')} as w from documents),
i as (select doc_id, w, unnest(range(1, greatest(len(w) - 18, 1))) as i from w where len(w) >= 20),
k as (select doc_id, i, md5(array_to_string(w[i:i + 19], ' ')) as k from i),
d as (select doc_id, i from k qualify row_number() over (partition by k order by doc_id, i) > 1),
g as (select doc_id, list_distinct(flatten(list(range(i, i + 20)))) as g from d group by doc_id)
select doc_id, len(w)::bigint as n_words, coalesce(len(g), 0)::bigint as n_removed,
sha256(array_to_string(case when g is null then w else list_transform(list_filter(range(1, len(w) + 1), lambda p: not list_contains(g, p)), lambda p: w[p]) end, ' ')) as kept_sha256
from w left join g using (doc_id)"""

PLAIN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
DECONTAMINATION = f"""with b as (select item_id, {_words(LOWER.format('text'), PLAIN)} as w from benchmark),
bw as (select distinct item_id, least(len(w), 10) as n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') as k from b, lateral (select unnest(range(1, len(w) - least(len(w), 10) + 2)) as i) where len(w) > 0),
d as (select doc_id, {_words(LOWER.format('text'), PLAIN)} as w from documents),
dw as (select doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') as k from d, (select distinct n from bw) s, lateral (select unnest(range(1, greatest(len(w) - n + 2, 1))) as i)),
h as (select doc_id, item_id, dw.n, i from dw join bw on bw.n = dw.n and bw.k = dw.k),
g as (select doc_id, count(distinct i + j) as n_hit from h, range(0, 10) x(j) where j < n group by doc_id),
t as (select doc_id, count(distinct item_id) as n_items, string_agg(distinct item_id::varchar, ',' order by item_id::varchar) as items from h group by doc_id)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join g using (doc_id) left join t using (doc_id)"""

FIM = """with t as (select doc_id, coalesce(text, '') as t, length(coalesce(text, ''))::bigint as n, sha256('1:' || coalesce(doc_id::varchar, '')) as h from documents),
k as (select *, ('0x' || h[1:8])::bigint as h1, ('0x' || h[9:16])::bigint as h2, ('0x' || h[17:24])::bigint as h3, ('0x' || h[25:32])::bigint as h4 from t),
c as (select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
  case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 90 then 'plain' when h4 % 100 < 20 then 'spm' else 'psm' end as form from k),
p as (select *, substring(t, 1, a) as pre, substring(t, a + 1, b - a) as mid, substring(t, b + 1) as suf from c)
select doc_id, n, form, case when form <> 'plain' then a end as prefix_chars, case when form <> 'plain' then b - a end as middle_chars,
sha256(case form when 'plain' then t when 'psm' then '<P>' || pre || '<S>' || suf || '<M>' || mid else '<S>' || suf || '<P>' || pre || '<M>' || mid end) as output_sha256,
sha256(t) as restored_sha256 from p"""


def _audit() -> str:
    """Each order is run step by step over all documents."""
    orders = ", ".join(f"('{''.join(p)}')" for p in permutations("ABCDE"))
    return f"""with l as (select doc_id, coalesce(bool_or(quality = 1), false) as good, coalesce(bool_or(toxic = 1), false) as toxic from labels group by doc_id),
w as (select doc_id, coalesce(source, '') as part, coalesce(text, '') as t, {_words('text')} as w from documents),
f as (select w.doc_id, part, coalesce(good, false) as good, coalesce(toxic, false) as toxic,
  (case when len(w) < 200 then 'A' else '' end) || (case when 100 * len(list_distinct(w)) < 50 * len(w) then 'B' else '' end) ||
  (case when 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) then 'C' else '' end) || (case when regexp_matches(t, '[#$%&*|]') then 'D' else '' end) ||
  (case when w.doc_id > min(w.doc_id) over (partition by t) then 'E' else '' end) as fails from w left join l using (doc_id)),
p as (select part, fails, count(*) as n, count(*) filter (good) as good, count(*) filter (toxic) as toxic from f group by part, fails),
o as (select o, unnest(range(1, 6)) as step from (values {orders}) t(o)),
s as (select part, o, step, o[step] as x, n, good, toxic, fails, contains(fails, o[step]) as hit, regexp_matches(fails, '[' || o[1:step - 1] || '_]') as gone from p, o),
r as (select part, o as filter_order, step::int as step, x, sum(n) filter (not gone and not hit) as kept, sum(n) filter (hit and not gone) as removed, sum(n) filter (hit and gone) as redundant,
  sum(n) filter (fails = x) as unique_fails, sum(good) filter (hit and not gone) as good_lost, sum(toxic) filter (hit and not gone) as toxic_lost from s group by all)
select part, filter_order, step, coalesce(kept, 0)::bigint as kept, coalesce(removed, 0)::bigint as removed, coalesce(redundant, 0)::bigint as redundant, coalesce(unique_fails, 0)::bigint as unique_fails,
coalesce(good_lost, 0)::bigint as good_lost, coalesce(toxic_lost, 0)::bigint as toxic_lost, (sum(coalesce(removed, 0)) over (partition by part, x))::bigint as shapley from r"""


ORACLES = {
    "op1_warc": WARC,
    "op3_url_filters": _urls(),
    "op4_near_dup": NEAR,
    "op6_quality_rules": _quality(),
    "op7_substring_dedup": SUBSTRINGS,
    "op9_decontamination": DECONTAMINATION,
    "op11_fill_in_middle": FIM,
    "op13_filter_audit": _audit(),
}
