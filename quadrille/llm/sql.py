"""DuckDB SQL with the same answers."""

ORACLES: dict[str, str] = {}

ORACLES["op1_url_filters"] = r"""
with r(host, path, verdict) as (values ('org','/','allow'), ('example.org','/es/','block'), ('example.org','/en/1','block'),
                                       ('com','/fr/','allow'), ('com','/de/','block')),
u as (select page_id, coalesce(translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as host,
             coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') as path
      from pages),
d as (select distinct host, path from u),
m as (select d.host, d.path, max_by(struct_pack(rule := r.host || r.path, verdict := r.verdict), length(r.host || r.path) * 1000 + length(r.host)) as best
      from d join r on (d.host = r.host or ends_with(d.host, '.' || r.host)) and starts_with(d.path, r.path)
      group by d.host, d.path)
select page_id, u.host, u.path, best.rule as rule, coalesce(best.verdict, 'allow') as verdict
from u left join m on u.host = m.host and u.path = m.path
"""

ORACLES["op3_exact_dedup"] = """
select doc_id,
       max(doc_id) over w as keep_id,
       count(*) over w as group_size,
       row_number() over (partition by coalesce(text, '') order by doc_id desc nulls last) = 1 as kept,
       sha256(coalesce(text, '')) as text_sha256
from documents
window w as (partition by coalesce(text, ''))
"""

ORACLES["op6_mixing"] = r"""
with d as (select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size,
                  (('0x' || substr(md5('17:' || coalesce(doc_id::varchar, 'null') || ':' || md5(coalesce(text, ''))), 1, 13))::bigint + 0.5) / 4503599627370496.0 as u,
                  greatest(0.05, 1 - (length(coalesce(text, '')) - length(translate(coalesce(text, ''), '#*$%&|<>{}[]\^~`@!', '')))
                                     / greatest(length(coalesce(text, '')), 1)::double) as quality
           from documents),
s as (select source, sum(size)::bigint as source_size, row_number() over (order by source nulls last) as k from d group by source),
w as (select source, source_size, 2.0 * source_size as cap, (case (k - 1) % 3 when 0 then 3.0 when 1 then 1.0 else 2.0 end) as w from s),
l as (select *, (sum(source_size) over () * 1.5 - coalesce(sum(cap) over (o rows between unbounded preceding and 1 preceding), 0.0))
              / sum(w) over (o rows between current row and unbounded following) as level
      from w window o as (order by cap / w, source nulls last)),
t as (select *, (select max(level) from l where cap / w > level) as held from l),
g as (select source, source_size, round(least(cap, coalesce(held * w, cap)), 6)::double as target from t),
p as (select source, source_size, target, case when source_size > 0 then floor(target / source_size)::bigint else 0 end as epochs from g),
x as (select d.doc_id, d.size::bigint as size, p.source_size, p.target, p.epochs, p.target - p.epochs * p.source_size as budget,
             sum(d.size) over (partition by d.source order by -ln(u) / quality, d.doc_id rows between unbounded preceding and current row) as upto
      from d join p on d.source is not distinct from p.source)
select doc_id, size, source_size, target, ((epochs + case when size > 0 and upto - size / 2.0 <= budget then 1 else 0 end) * size)::bigint as taken
from x
"""

_SECRETS = (
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    ("access", r"AKIA[A-Z0-9]+", 0, 18),
    ("hex", r"[0-9a-f]+", 0, 16),
    ("owned", r"[A-Za-z0-9_-]{24,}", 0, 24),
)


def _spans(rank: int, kind: str, pattern: str, group: int, least: int) -> str:
    """Places of one kind's matches, from the texts between them."""
    return f"""m{rank} as (select doc_id, source, regexp_extract_all(x, '{pattern}', 0) as ws, regexp_extract_all(x, '{pattern}', {group}) as vs,
    string_split_regex(x, '{pattern}') as ps from t),
u{rank} as (select doc_id, source, unnest(ws) as w, unnest(vs) as v, unnest(ps[:len(ws)]) as p, generate_subscripts(ws, 1) as i from m{rank}),
s{rank} as (select doc_id, source, {rank} as rank, '{kind}' as kind, v, length(w) as n,
    sum(length(p) + length(w)) over (partition by doc_id order by i)::bigint as e from u{rank}),
k{rank} as (select doc_id, source, rank, kind, v, e - n as s, e from s{rank} where length(v) >= {least})"""


ORACLES["op8_secret_scans"] = (
    "with t as (select doc_id, source, coalesce(text, '') as x from documents),\n"
    + ",\n".join(_spans(i, *kind) for i, kind in enumerate(_SECRETS))
    + r""",
base as (select * from k0 union all select * from k1 union all select * from k2),
owned as (select * from k3 o where regexp_matches(v, '[0-9]') and regexp_matches(v, '[a-z]') and regexp_matches(v, '[A-Z]')
    and not exists (select 1 from base b where b.doc_id = o.doc_id and b.s < o.e and o.s < b.e)),
found as (select * from base union all select * from owned),
first as (select v, min({'owner': coalesce('s' || t.source, ''), 'repository': t.doc_id::varchar}) as d from found join t using (doc_id) group by v, t.x),
held as (select v, count(distinct d.owner) as owners, count(distinct d.repository) as repositories from first group by v),
judged as (select f.*, kind || ':' || s || ':' || e as span, owners <= 1 and repositories <= 5 as live from found f join held using (v)),
rows as (select doc_id, count(*) filter (rank = 0) as n_assign, count(*) filter (rank = 1) as n_access, count(*) filter (rank = 2) as n_hex,
    coalesce(string_agg(span, ',' order by s, rank) filter (rank < 3), '') as base,
    coalesce(string_agg(span, ',' order by s, rank), '') as spans,
    count(*) filter (live) as n_live, count(*) filter (not live) as n_example
  from judged where rank < 3 or live group by doc_id)
select t.doc_id, coalesce(n_assign, 0)::bigint as n_assign, coalesce(n_access, 0)::bigint as n_access, coalesce(n_hex, 0)::bigint as n_hex,
  sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans, coalesce(n_live, 0)::bigint as n_live, coalesce(n_example, 0)::bigint as n_example
from t left join rows on t.doc_id = rows.doc_id
"""
)

_MEASURES = ("symbol_share", "repeat_share", "dup_line_share", "capital_share")


def _quality_sql(risk: float, delta: float = 0.05) -> str:
    ranks = ", ".join(f"max(below) filter (b.measure = '{m}') as rank_{m}" for m in _MEASURES)
    long = " union all ".join(f"select doc_id, lang, '{m}' as measure, {m} as value, scale, test from p" for m in _MEASURES)
    reasons = ", ".join(f"case when rank_{m} > cutoff then '{m}' end" for m in _MEASURES)
    return rf"""
with d as (select doc_id, lang, coalesce(text, '') as x, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) as lines from documents),
win as (select doc_id, i, w[i] as a, w[i + 1] as b, w[i + 2] as c from (select doc_id, w, unnest(range(1, len(w) - 1)) as i from d)),
twice as (select doc_id, i from (select *, count(*) over (partition by doc_id, a, b, c) as n from win) where n > 1),
covered as (select doc_id, count(distinct i + j) as n from twice, (select unnest([0, 1, 2]) as j) group by doc_id),
m as (select d.doc_id, lang, len(w)::bigint as n_words, length(x) - length(regexp_replace(x, '[^\x20\x09-\x0D]', '', 'g')) as word_chars,
    length(x) - length(translate(x, '#*$%&|<>', '')) as n_symbols, (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines,
    coalesce(c.n, 0)::bigint as n_repeat_words, len(lines) as n_lines,
    len(list_filter(w, lambda y: regexp_matches(y, '[A-Z]') and not regexp_matches(y, '[a-z]'))) as capitals
  from d left join covered c on d.doc_id = c.doc_id),
r as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed, 1000 * n_symbols // greatest(1, word_chars) as symbol_share,
    1000 * n_repeat_words // greatest(1, n_words) as repeat_share, 1000 * n_dup_lines // greatest(1, n_lines) as dup_line_share,
    1000 * capitals // greatest(1, n_words) as capital_share from m),
p as (select *, good and left(md5(doc_id::varchar), 1) <= '3' as scale, good and left(md5(doc_id::varchar), 1) > '3' as test
  from (select *, not base_failed and doc_id in (select doc_id from labels where quality = 1) as good from r)),
long as ({long}),
below as (select lang, measure, value, coalesce(sum(sum(scale::int)) over (partition by lang, measure order by value rows between unbounded preceding and 1 preceding), 0) as below
  from long group by lang, measure, value),
ranked as (select doc_id, max(below) as score, {ranks} from long join below b on long.lang is not distinct from b.lang and long.measure = b.measure and long.value = b.value
  group by doc_id),
scaled as (select lang from p group by lang having bool_or(scale)),
scores as (select p.lang, score, count(*) as held from p join ranked using (doc_id) where test and exists (select 1 from scaled s where s.lang is not distinct from p.lang) group by all),
above as (select *, coalesce(sum(held) over (partition by lang order by score desc rows between unbounded preceding and 1 preceding), 0) as above,
    sum(held) over (partition by lang) as total from scores),
sizes as (select distinct lang, total from above),
tests as (select greatest(1, coalesce(max(j) filter (total * ln(1 - {risk}) <= ln({delta} / j)), 0)) as n from (select total, row_number() over (order by total desc) as j from sizes)),
terms as (select total, k, exp(lgamma(total + 1) - lgamma(k + 1) - lgamma(total - k + 1) + k * ln({risk}) + (total - k) * ln(1 - {risk})) as p
  from (select total, unnest(range(0, least(total, 100000)::bigint + 1)) as k from (select distinct total from above))),
most as (select total, count(*) filter (cdf <= (select {delta} / n from tests)) - 1 as most
  from (select total, sum(p) over (partition by total order by k) as cdf from terms) group by total),
cuts as (select lang, min(score) as cutoff from above join most using (total) where above <= most group by lang),
j as (select p.*, concat_ws(',', {reasons}) as reasons from p join ranked using (doc_id) left join cuts on p.lang is not distinct from cuts.lang)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and reasons = '' as kept, reasons from j
"""


ORACLES["op9_quality_rules"] = _quality_sql(0.01)
ORACLES["quality_rules_on_few_labels"] = _quality_sql(0.2)

ORACLES["op10_minhash_near_dedup"] = r"""
with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') as ws from documents),
i as (select doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) as i from w where len(ws) > 0),
s as (select distinct doc_id, array_to_string(ws[i:i + 4], ' ') as x from i),
n as (select doc_id, count(*) as n from s group by doc_id),
p as (select a.doc_id as a, b.doc_id as b, count(*) as c from s a join s b on a.x = b.x and a.doc_id < b.doc_id group by all),
e as (select a, b from p join n na on na.doc_id = a join n nb on nb.doc_id = b where 100 * c >= 85 * (na.n + nb.n - c)),
links as (select a, b from e union all select b, a from e),
reach(node, root) as (select doc_id, doc_id from n union select links.b, reach.root from reach join links on reach.node = links.a),
label as (select node, min(root) as component_id from reach group by node)
select w.doc_id, coalesce(n.n, 0)::bigint as n_shingles, coalesce(component_id, w.doc_id) as component_id, coalesce(component_id, w.doc_id) = w.doc_id as kept
from w left join n on w.doc_id = n.doc_id left join label on w.doc_id = label.node
"""


def _tree_sql(name: str, levels: int) -> str:
    """CTEs ``{name}1`` ... from ``{name}0`` (grp, pos, n, hash): nodes of each level, sixteen to a parent."""
    parts = []
    for k in range(1, levels + 1):
        parts.append(
            f"{name}{k} as (select grp, pos // 16 as pos, (any_value(n) + 15) // 16 as n, "
            f"case when any_value(n) = 1 then any_value(hash) else sha256(string_agg(hash, '' order by pos)) end as hash, "
            f"list(hash order by pos) as run from {name}{k - 1} group by grp, pos // 16)"
        )
    return ",\n".join(parts)


def _path_sql(leaves: str, name: str, levels: int) -> tuple[str, str, str]:
    """Joins from ``leaves`` along the tree ``name``, the siblings on the way, and the digest of ``claimed`` folded up."""
    joins, proof, folded = [], [], "claimed"
    for k in range(1, levels + 1):
        joins.append(f"join {name}{k} on {name}{k}.grp = {leaves}.grp and {name}{k}.pos = {leaves}.pos // {16**k}")
        slot = f"({leaves}.pos // {16 ** (k - 1)} % 16)"
        left = f"array_to_string({name}{k}.run[1:{slot}], '')"
        right = f"array_to_string({name}{k}.run[{slot} + 2:], '')"
        many = f"({leaves}.n + {16 ** (k - 1) - 1}) // {16 ** (k - 1)} > 1"
        proof.append(f"case when {many} then {left} || {right} else '' end")
        folded = f"case when {many} then sha256({left} || {folded} || {right}) else {folded} end"
    return "\n".join(joins), " || ".join(proof), folded


def _merkle_sql(levels: int = 6, top_levels: int = 3) -> str:
    def field(value: str) -> str:
        return f"coalesce(strlen({value}) || ':' || {value}, '-')"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(field(v) for v in ("doc_id::varchar", "source", "lang", "n_chars::varchar", text)) + ")"

    joins, proof, folded = _path_sql("a0", "a", levels)
    top_joins, top_proof, top_folded = _path_sql("b0", "b", top_levels)
    # A byte at a time into the remainder of the CRC, eight bits each.
    bit = "lambda c, z: xor(c >> 1, 3988292384 * (c & 1))"
    byte = f"lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], {bit})"
    crc = f"xor(list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::varchar, ''), lambda d: ascii(d)::bigint)), {byte}), 4294967295)"
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
with leaves as (select doc_id, coalesce('+' || source, '') as grp, {leaf("text")} as hash,
                       case when {crc} % 5 = 0 then {leaf(lowered)} else {leaf("text")} end as claimed
                from documents),
a0 as (select *, row_number() over (partition by grp order by doc_id nulls first, hash) - 1 as pos, count(*) over (partition by grp) as n
       from leaves),
{_tree_sql("a", levels)},
b0 as (select '' as grp, grp as name, row_number() over (order by grp) - 1 as pos, count(*) over () as n, hash from a{levels}),
{_tree_sql("b", top_levels)},
own as (select doc_id, a0.grp as name, a0.hash as leaf, {proof} as proof, {folded} as claimed from a0
{joins}),
ends as (select b0.*, claimed, doc_id, leaf, proof from b0 join own using (name))
select doc_id, leaf, ends.hash as subroot, b{top_levels}.hash as root, sha256(proof || {top_proof.replace("b0.", "ends.")}) as proof_sha256,
       {top_folded.replace("b0.", "ends.")} as folded_root, folded_root = root as verified
from ends
{top_joins.replace("b0.", "ends.")}
"""


ORACLES["op13_merkle_manifest"] = _merkle_sql()

ORACLES["op12_collocations"] = r"""
with pieces as (select coalesce(lang, 'und') as lang, doc_id,
                       unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
                from documents),
cut as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces),
total as (select lang, sum(len(w))::bigint as n from cut group by lang),
grams as (select lang, m, array_to_string(w[i:i + m - 1], ' ') as phrase
          from (select lang, w, m, unnest(range(1, len(w) - m + 2)) as i from cut, range(1, 6) r(m))),
f as (select lang, m, phrase, count(*) as f from grams group by all having count(*) >= 100),
longer as (select lang, f, array_to_string(string_split(phrase, ' ')[i:i + s - 1], ' ') as phrase
           from (select *, unnest(range(1, m - s + 2)) as i from f, range(2, 5) z(s) where s < m)),
around as (select lang, phrase, max(f) as f from longer group by all),
kept as (select c.lang, c.phrase, c.f as a, c.m, string_split(c.phrase, ' ') as w
         from f c left join around l on c.lang = l.lang and c.phrase = l.phrase where c.m > 1 and coalesce(l.f, 0) < c.f),
cuts as (select *, unnest(range(1, m)) as k from kept),
scored as (select c.lang, c.phrase, a, c.k, x.f as l, y.f as r, n, ((1000::hugeint * a * n) // (x.f::hugeint * y.f))::bigint as score
           from cuts c join total t on t.lang = c.lang
           join f x on x.lang = c.lang and x.phrase = array_to_string(w[1:k], ' ')
           join f y on y.lang = c.lang and y.phrase = array_to_string(w[k + 1:], ' ')),
best as (select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score
from best qualify rank <= 2000
"""
