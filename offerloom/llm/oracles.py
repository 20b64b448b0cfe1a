"""DuckDB SQL of the registered queries that SQL can express."""

from __future__ import annotations

from offerloom.llm import licences, urls
from offerloom.llm.frames import LOWER, UPPER


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _lower(text: str) -> str:
    return f"translate(coalesce({text}, ''), '{UPPER}', '{LOWER}')"


EXACT = f"""
with t as (select doc_id, {_lower("text")} as norm from documents),
g as (select norm, max(doc_id) as keep_id, count(*) as group_size from t group by norm)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(norm) as text_sha256
from t join g using (norm)
"""


def licence_sql() -> str:
    """Patterns and spellings are written out here; only the licence texts are those of the code."""
    words = "replace(replace(replace(lower(coalesce(text, '')), 'licence', 'license'), 'https://', 'http://'), '&', ' and ')"
    right = r"(?:copyright|copr\.)[ \t]*(?:\(c\)|©|[\[<{(]?(?:[0-9]{4}|yyyy|year))|©|\(c\)[ \t]*[0-9]{4}"
    words = f"regexp_replace({words}, '(?m)^[^\\p{{L}}\\p{{N}}\\n]*(?:{right})[^\\n]*$', '', 'g')"
    words = f"regexp_replace({words}, '[^\\p{{L}}\\p{{N}}\\n]+', ' ', 'g')"
    lines = f"list_filter(list_transform(string_split({words}, chr(10)), lambda x: trim(x, ' ')), lambda x: x <> '')"

    def canon(x: str) -> str:
        padded = f"replace(replace(' ' || {x} || ' ', ' sub license', ' sublicense'), 'non commercial', 'noncommercial')"
        return f"trim(replace({padded}, ' version ', ' v '), ' ')"

    whole = canon("array_to_string(ls, ' ')")
    known = ", ".join(f"({_text(name)}, {_text(text)})" for name, text in licences.KNOWN)
    digests = ", ".join(f"('{name}', '{digest}')" for name, digest in licences.DIGESTS)
    return f"""
with known as (
  select digest, min(licence) as licence from (
    select sha256({whole}) as digest, licence from (select licence, {lines} as ls from (values {known}) v(licence, text))
    union all select digest, licence from (values {digests}) w(licence, digest)) group by 1),
t as (select doc_id, {lines} as ls from documents),
u as (
  select doc_id, {canon("x")} as canon, false as entire from (select doc_id, unnest(ls) as x from t where len(ls) > 1)
  union all select doc_id, {whole}, true from t where len(ls) > 0),
f as (
  select doc_id, list_sort(list_distinct(list(licence))) as found, min(case when entire then licence end) as whole
  from u join known on sha256(canon) = digest group by doc_id)
select t.doc_id, coalesce(len(found), 0)::bigint as n_licences,
  coalesce(array_to_string(found, ','), '') as licences, whole
from t left join f using (doc_id)
"""


# The patterns are written out here: the statement shares nothing with the code it is compared with.
SITE_LINES = r"""
with p as (
  select page_id, row_number() over () as k,
    {host} as host,
    list_filter(list_transform(string_split({text}, chr(10)), lambda x: trim(x, ' ')), lambda x: x <> '') as ls
  from pages),
totals as (select host, count(*) as n from p group by host),
line as (select distinct k, host, unnest(ls) as line from p),
over as (
  select host, line from line join totals using (host)
  group by host, line, n having n >= 5 and count(*) >= 2 and count(*) > 0.1 * n),
list as (select host, list(line) as common from over group by host),
kept as (
  select page_id, p.host, ls, list_filter(ls, lambda x: not coalesce(list_contains(common, x), false)) as rest
  from p left join list on p.host = list.host)
select page_id, host, len(ls)::bigint as n_lines, (len(ls) - len(rest))::bigint as n_dropped,
  sha256(array_to_string(rest, chr(10))) as text_sha256
from kept
"""


def site_line_sql() -> str:
    text = "regexp_replace(coalesce(html, ''), '(?is)<script\\b.*?</script>|<style\\b.*?</style>|<!--.*?-->', chr(10), 'g')"
    block = "p|div|li|ul|ol|h1|h2|h3|h4|h5|h6|br|tr|td|th|table|article|aside|nav|footer|header|section|main|title|head|body|html"
    text = f"regexp_replace({text}, '(?i)</?(?:{block})\\b[^>]*>', chr(10), 'g')"
    text = f"regexp_replace({text}, '<[^>]*>', '', 'g')"
    for reference, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "\'\'"), ("&nbsp;", " "), ("&amp;", "&")):
        text = f"replace({text}, '{reference}', '{char}')"
    text = f"regexp_replace({text}, '[ \\t\\r\\f]+', ' ', 'g')"
    host = _lower("regexp_extract(case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end, '^[^/?#]*')")
    return SITE_LINES.replace("{host}", host).replace("{text}", text)


# Patterns are written out here, as above.
QUOTATIONS = r"""
with recursive m as (select row_number() over () as k, * from conversations),
raw as (
  select k, conv_id, turn, unnest(string_split(coalesce(text, ''), chr(10))) as l,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos
  from m),
cut as (
  select k, conv_id, turn, pos,
    len(regexp_replace(regexp_extract(l, '^((?:[ \t]*>)+)', 1), '[^>]', '', 'g'))::bigint as level,
    trim(regexp_replace(regexp_replace(l, '^((?:[ \t]*>)+)', ''), '\s+', ' ', 'g'), ' ') as line
  from raw),
quoting as (select distinct k from cut where level > 0 and line <> ''),
lines as (
  select * exclude (line), case when level = 0 and k in (select k from quoting)
      and regexp_matches(line, '(?i)^(on|le|am|el) .* (wrote|écrit|schrieb|escribió) ?:$') then '' else line end as line
  from cut),
marked as (
  select *, (lag(level) over w is distinct from level)::int as turns,
    (line <> '' and (lag(level) over w is distinct from level or lag(line) over w = ''))::int as begins
  from lines window w as (partition by k order by pos)),
numbered as (
  select *, sum(turns) over w as block, sum(begins) over w as paragraph
  from marked window w as (partition by k order by pos rows unbounded preceding)),
paragraphs as (
  select k, conv_id, turn, level, string_agg(line, ' ' order by pos) as passage
  from numbered where line <> '' group by k, conv_id, turn, level, paragraph),
said as (
  select k, conv_id, turn, level, string_agg(line, ' ' order by pos) as passage from lines where line <> '' group by k, conv_id, turn, level
  union
  select k, conv_id, turn, level, string_agg(line, ' ' order by pos) from numbered where line <> '' group by k, conv_id, turn, level, block
  union select * from paragraphs
  union select k, conv_id, turn, level, unnest(string_split(regexp_replace(passage, '([.!?])\s+', '\1' || chr(10), 'g'), chr(10))) from paragraphs
  union select k, conv_id, turn, level, line from lines where line <> ''),
unit as (
  select * from (select conv_id, turn, level, trim(regexp_replace(lower(passage), '[^\p{L}\p{N}]+', ' ', 'g'), ' ') as normal from said)
  where normal <> ''),
first as (select conv_id, normal, min(turn) as origin from unit where level = 0 group by all),
answer as (
  select conv_id, turn, arg_max(origin, (-level) * 1000000000 + origin) as answers
  from unit join first using (conv_id, normal) where level > 0 and origin < turn group by all),
chain as (
  select conv_id, turn, answers as top, 1::bigint as depth from answer
  union all
  select c.conv_id, c.turn, a.answers, c.depth + 1 from chain c join answer a on a.conv_id = c.conv_id and a.turn = c.top),
placed as (select conv_id, turn, arg_max(top, depth) as thread, max(depth) as depth from chain group by all),
body as (select k, string_agg(line, chr(10) order by pos) as text from lines where level = 0 and line <> '' group by k)
select m.conv_id, m.turn, m.role, answers,
  coalesce(thread, case when m.conv_id is not null then m.turn end) as thread,
  coalesce(depth, 0) as depth, coalesce(body.text, '') as text
from m left join body using (k)
left join answer on answer.conv_id = m.conv_id and answer.turn = m.turn
left join placed on placed.conv_id = m.conv_id and placed.turn = m.turn
"""


def url_sql() -> str:
    rules = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in urls.RULES)
    rest = "case when strpos({0}, '://') > 0 then substr({0}, strpos({0}, '://') + 3) else '' end"

    def host(x: str) -> str:
        return _lower(f"regexp_extract({rest.format(x)}, '^[^/?#]*')")

    def path(x: str) -> str:
        return f"coalesce(regexp_extract({rest.format(x)}, '^[^/?#]*([^?#]*)', 1), '')"

    def key(x: str) -> str:
        return f"({host(x)} || coalesce(regexp_extract({rest.format(x)}, '^[^/?#]*([^#]*)', 1), ''))"

    fit = """
  select s.host, s.path, arg_max(r.host || r.path, len(r.host || r.path)) as rule,
    arg_max(verdict, len(r.host || r.path)) as verdict
  from (select distinct host, path from {0}) s join rules r
    on (s.host = r.host or ends_with(s.host, '.' || r.host)) and starts_with(s.path, r.path)
  group by all"""
    return f"""
with recursive rules(verdict, host, path) as (values {rules}),
p as (select page_id, {host("url")} as host, {path("url")} as path, {key("url")} as key, url, html from pages),
tags as (select url, key, unnest(regexp_extract_all(coalesce(html, ''), {_text(urls.TAG)})) as tag from p where host <> ''),
links as (
  select url, key, case
    when regexp_matches(tag, {_text(urls.CANONICAL)}) then regexp_extract(tag, {_text(urls.HREF)}, 1)
    when regexp_matches(tag, {_text(urls.REFRESH)}) then regexp_extract(tag, {_text(urls.TARGET)}, 1) end as goal
  from tags),
whole as (
  select key as a, case when strpos(goal, '://') > 0 then goal
    when starts_with(goal, '//') then split_part(url, '://', 1) || ':' || goal
    when starts_with(goal, '/') then split_part(url, '://', 1) || '://' || {host("url")} || goal
    else split_part(url, '://', 1) || '://' || {host("url")}
      || coalesce(nullif(regexp_extract({path("url")}, '^(.*/)', 1), ''), '/') || goal end as goal
  from links where goal <> ''),
edge as (select a, {key("goal")} as b from whole),
twoway as (select a, b from edge where a <> b and b <> '' union select b, a from edge where a <> b and b <> ''),
reach as (select a, b from twoway union select r.a, e.b from reach r join twoway e on r.b = e.a),
node as (select distinct b as key, 'any://' || b as url from twoway),
site as (select key, {host("url")} as host, {path("url")} as path from node),
node_rule as ({fit.format("site")}),
bad as (select distinct r.a as key from reach r join site on r.b = site.key join node_rule using (host, path) where verdict = 'block'),
page_rule as ({fit.format("p")})
select page_id, p.host, p.path, rule,
  coalesce(verdict, case when bad.key is not null then 'block' else 'allow' end) as verdict
from p left join page_rule on p.host = page_rule.host and p.path = page_rule.path
left join bad on p.key = bad.key
"""


COLLOCATIONS = r"""
with t as (select row_number() over () as k, coalesce(lang, 'und') as lang, {text} as text from documents),
p as (select lang, unnest(regexp_split_to_array(text, '[.,;:!?\n\x0B\x0C\r]')) as piece from t),
w as (select lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda x: x <> '') as ws from p),
g as (
  select lang, 1 as size, unnest(ws) as phrase from w
  union all select lang, 2, unnest(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) from w
  union all
  select lang, 3, unnest(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) from w),
f as (select lang, size, phrase, count(*) as f from g group by all),
n as (select lang, sum(f)::bigint as n from f where size = 1 group by lang),
c as (select lang, size, phrase, f as a, string_split(phrase, ' ') as ws from f where size > 1 and f >= 10),
cuts as (
  select c.*, k, array_to_string(ws[1:k], ' ') as head, array_to_string(ws[k + 1:], ' ') as tail
  from c, (values (1), (2)) v(k) where k < size),
scored as (
  select cuts.*, h.f as l, s.f as r, (1000000::hugeint * a * a // (h.f::hugeint * s.f))::bigint as score
  from cuts join f h on h.lang = cuts.lang and h.phrase = head join f s on s.lang = cuts.lang and s.phrase = tail),
lowest as (select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1),
inside as (
  select distinct b.lang, b.phrase from c b join c t
    on t.size = 3 and b.size = 2 and t.lang = b.lang and 100 * t.a >= 50 * b.a
    and (b.phrase = array_to_string(t.ws[1:2], ' ') or b.phrase = array_to_string(t.ws[2:3], ' '))),
ranked as (
  select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, score
  from lowest anti join inside using (lang, phrase))
select lang, rank, phrase, a, l, r, n, score from ranked join n using (lang) where rank <= 2000
""".replace("{text}", _lower("text"))


HARD_NEGATIVES = """
with v as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * x::double)) as v
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
  select a.vec_id as anchor_id, b.vec_id as other, a.label = b.label as same, list_dot_product(a.v, b.v)::bigint as score
  from v a join v b on a.vec_id <> b.vec_id where a.vec_id % 100 = 0),
p as (
  select anchor_id, other as positive_id, score as positive_score from s where same
  qualify row_number() over (partition by anchor_id order by score desc, other) <= 5)
select p.anchor_id, positive_id,
  row_number() over (partition by p.anchor_id, positive_id order by score desc, other)::int as rank,
  other as negative_id, positive_score, score as negative_score
from p join s on s.anchor_id = p.anchor_id and not same
  and 80 * positive_score <= 100 * score and 100 * score <= 100 * positive_score
qualify rank <= 5
"""


def statements() -> dict[str, str]:
    return {
        "op2_quotation_linking": QUOTATIONS,
        "op3_site_line_dedup": site_line_sql(),
        "op8_url_filters": url_sql(),
        "op9_exact_dedup": EXACT,
        "op10_license_scans": licence_sql(),
        "op12_phrase_collocations": COLLOCATIONS,
        "op13_hard_negatives": HARD_NEGATIVES,
    }
