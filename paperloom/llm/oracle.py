"""SQL that gives the same rows as the queries, where SQL can express them."""

from __future__ import annotations

#: Upper-case letters to lower-case ones.
LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SPACED = r"list_filter(regexp_split_to_array({}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"
ALNUM = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

BUCKET = "case when value < 32 then value else floor(log2(value) + 1e-9)::bigint * 32 + ((value >> (floor(log2(value) + 1e-9)::bigint - 5)) & 31) end"
START = "case when {0} < 32 then {0} else (32 + ({0} & 31)) << ({0} // 32 - 5) end"

OP3 = f"""
with item as (
  select item_id, {ALNUM.format(LOWER.format("coalesce(text, '')"))} as w from benchmark
), cut as (
  select item_id, w, least(10, len(w)) as k from item where len(w) > 0
), win as (
  select distinct item_id, k, array_to_string(w[i:i + k - 1], ' ') as win
  from (select item_id, w, k, unnest(range(1, len(w) - k + 2)) as i from cut)
), doc as (
  select doc_id, {ALNUM.format(LOWER.format("coalesce(text, '')"))} as w from documents
), place as (
  select doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') as win
  from (select doc_id, w, k, unnest(range(1, len(w) - k + 2)) as i from doc, (select distinct k from win) where len(w) >= k)
), hit as (
  select doc_id, i, k, item_id from place join win using (k, win)
), places as (
  select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(i, i + k)) as p from hit) group by doc_id
), items as (
  select doc_id, list_sort(list_distinct(list(item_id::varchar))) as ids from hit group by doc_id
)
select doc.doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(len(ids), 0)::bigint as n_items,
  sha256(coalesce(array_to_string(ids, ','), '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from doc left join places using (doc_id) left join items using (doc_id)
"""


def _fence_sql(p: str, measure: str) -> str:
    """Fences of (doc_id, lang, source, m, value) by sketches of buckets, and who is within them."""
    return f"""{p}_sketch as (
  select coalesce(lang, '-') as lang, coalesce(source, '-') as source, m, {BUCKET} as bucket, count(*) as n from {measure} group by all
), {p}_level as (
  select 0 as level, lang, source, m, bucket, sum(n) as n from {p}_sketch group by all
  union all select 1, lang, '', m, bucket, sum(n) from {p}_sketch group by lang, m, bucket
  union all select 2, '', '', m, bucket, sum(n) from {p}_sketch group by m, bucket
), {p}_cumulated as (
  select *, sum(n) over (partition by level, lang, source, m order by bucket) as seen, sum(n) over (partition by level, lang, source, m) as total from {p}_level
), {p}_quantile as (
  select level, lang, source, m, max(total) as total, min(bucket) filter (100 * seen >= 25 * total) as b1,
    min(bucket) filter (100 * seen >= 75 * total) as b3, min(bucket) filter (100 * seen >= 99 * total) as b9
  from {p}_cumulated group by level, lang, source, m
), {p}_width as (
  select *, {START.format("b1")} as q1, {START.format("b3")} as q3, {START.format("b9")} as q9, case when b3 < 32 then 1 else 1 << (b3 // 32 - 5) end as one from {p}_quantile
), {p}_fence as (
  select level, lang, source, m, total, case when m = 'word_length' then q1 - 3 * greatest(q3 - q1, one) else 0 end as low,
    case when m = 'word_length' then q3 + 3 * greatest(q3 - q1, one) else 4 * q9 + 1 end as high from {p}_width
), {p}_verdict as (
  select doc_id, bool_and(coalesce(value between
    case when f0.total >= 200 then f0.low when f1.total >= 200 then f1.low else f2.low end and
    case when f0.total >= 200 then f0.high when f1.total >= 200 then f1.high else f2.high end, false)) as inside
  from {measure} v
  left join {p}_fence f0 on f0.level = 0 and f0.lang = coalesce(v.lang, '-') and f0.source = coalesce(v.source, '-') and f0.m = v.m
  left join {p}_fence f1 on f1.level = 1 and f1.lang = coalesce(v.lang, '-') and f1.m = v.m
  left join {p}_fence f2 on f2.level = 2 and f2.m = v.m
  group by doc_id
)"""


OP4 = f"""
with doc as (
  select doc_id, lang, source, coalesce(text, '') as text, {SPACED.format("coalesce(text, '')")} as w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as l from documents
), win as (
  select doc_id, i, array_to_string(w[i:i + 2], ' ') as win from (select doc_id, w, unnest(range(1, len(w) - 1)) as i from doc where len(w) >= 3)
), twice as (
  select doc_id, unnest([i, i + 1, i + 2]) as p from (select *, count(*) over (partition by doc_id, win) as n from win) where n > 1
), rep as (
  select doc_id, count(distinct p) as n from twice group by doc_id
), base as (
  select doc.doc_id, lang, source, len(w)::bigint as n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::bigint as word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::bigint as n_symbols, (len(l) - len(list_distinct(l)))::bigint as n_dup_lines,
    len(l) as n_lines, coalesce(rep.n, 0)::bigint as n_repeat_words
  from doc left join rep using (doc_id)
), judged as (
  select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from base
), length_measure as (
  select doc_id, lang, source, 'word_length' as m, case when n_words > 0 then 100 * word_chars // n_words else 0 end as value from judged where not base_failed
), {_fence_sql("length", "length_measure")}, inside as (
  select doc_id from length_verdict where inside
), upper_measure as (
  select doc_id, lang, source, x.m as m, x.value as value from (select doc_id, lang, source, unnest([
    {{'m': 'symbols', 'value': case when word_chars > 0 then 1000 * n_symbols // word_chars else 0 end}},
    {{'m': 'dup_lines', 'value': case when n_lines > 0 then 1000 * n_dup_lines // n_lines else 0 end}},
    {{'m': 'repeats', 'value': case when n_words > 0 then 1000 * n_repeat_words // n_words else 0 end}}]) as x from judged join inside using (doc_id))
), {_fence_sql("upper", "upper_measure")}
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, coalesce(upper_verdict.inside, false) as kept
from judged left join upper_verdict using (doc_id)
"""

OP10 = f"""
with recursive doc as (
  select doc_id, {SPACED.format(LOWER.format("coalesce(text, '')"))} as w from documents
), shingle as (
  select distinct doc_id, array_to_string(w[i:i + 3], ' ') as s
  from (select doc_id, w, unnest(case when len(w) >= 4 then range(1, len(w) - 2) when len(w) > 0 then [1] else [] end) as i from doc)
), size as (
  select doc_id, count(*) as n from shingle group by doc_id
), pair as (
  select x.doc_id as a, y.doc_id as b, count(*) as shared from shingle x join shingle y on x.s = y.s and x.doc_id < y.doc_id group by all
), link as (
  select a, b from pair join size p on p.doc_id = a join size q on q.doc_id = b where 100 * shared >= 80 * (p.n + q.n - shared)
), edge as (
  select a, b from link union all select b, a from link
), reach as (
  select doc_id as a, doc_id as b from doc union select r.a, e.b from reach r join edge e on r.b = e.a
), component as (
  select a as doc_id, min(b) as component_id from reach group by a
)
select doc.doc_id, coalesce(size.n, 0)::bigint as n_shingles, component_id, doc.doc_id = component_id as kept
from doc join component using (doc_id) left join size using (doc_id)
"""

OP7 = r"""
with page as (
  select page_id as id, coalesce(url, '') as url, coalesce(html, '') as body from pages
), named as (
  select *, md5(coalesce(id::varchar, '') || '|' || url) as name from page
), ours as (
  select id, 'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10)
    || 'WARC-Record-ID: <urn:uuid:' || name[1:8] || '-' || name[9:12] || '-' || name[13:16] || '-' || name[17:20] || '-' || name[21:32] || '>' || chr(13) || chr(10)
    || 'WARC-Target-URI: ' || regexp_replace(url, '[\r\n]', '', 'g') || chr(13) || chr(10) || 'WARC-Date: 1970-01-01T00:00:00Z' || chr(13) || chr(10)
    || 'Content-Type: text/html' || chr(13) || chr(10) || 'Content-Length: ' || strlen(body) || chr(13) || chr(10) || chr(13) || chr(10) || body as record
  from named
), numbered as (
  select *, row_number() over (order by id nulls first, sha256(record)) - 1 as place from ours
), located as (
  select id, record, place // 1000 as archive, place % 1000 as ordinal, count(*) over (partition by place // 1000) as n,
    instr(record, chr(13) || chr(10) || chr(13) || chr(10)) as head from numbered
), rotten as (
  select *, case when id % 101 = 7 and ends_with(record, '>') then record[1:length(record) - 1] || '~' else record end as a from located
), misstated as (
  select *, case when id % 211 = 5 then a[1:head - 2] || translate(a[head - 1:head - 1], '0123456789', '9876543210') || a[head:] else a end as b from rotten
), shortened as (
  select *, case when archive % 5 = 2 and ordinal = n // 2 then b[1:7] || b[9:] else b end as c, archive % 3 = 1 and ordinal > greatest(n - 2, 0) as lost from misstated
), copies as (
  select *, case when archive % 3 = 1 and ordinal = greatest(n - 2, 0) then c[1:20] else c end as other,
    sum(strlen(record) + 4) over o as stop, sum(strlen(c) + 4) over o as found_stop from shortened
  window o as (partition by archive order by ordinal)
), judged as (
  select *, case when lost then 'missing' when other <> record then 'changed'
    when stop - strlen(record) <> found_stop - strlen(c) then 'moved' end as fault from copies
)
select archive, ordinal, fault, (stop - strlen(record) - 4)::bigint as start, stop::bigint as stop, sha256(record) as expected,
  case when lost then null else sha256(other) end as found
from judged where fault is not null
"""


def _field(value: str) -> str:
    return f"coalesce(strlen(({value})::varchar) || ':' || ({value})::varchar, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(map(_field, ["doc_id", "source", "lang", "n_chars", text])) + ")"


def _tree(name: str, leaves: str) -> str:
    """All nodes over `leaves` (tree, pos, hash, n): a level is made while the last has several nodes."""
    return f"""{name} as (
  select tree, 0 as level, pos, hash, n from {leaves}
  union all
  select tree, level + 1, pos // 3, sha256(string_agg(hash, '' order by pos)), (n + 2) // 3 from {name} where n > 1 group by tree, level, pos // 3, n
)"""


#: The crc32 of a decimal number, bit by bit.
CRC = """crc as (
  select doc_id, 4294967295::bigint as c, doc_id::varchar as s, 0 as k from (select distinct doc_id from documents where doc_id is not null)
  union all
  select doc_id, list_reduce([xor(c, ascii(s[1:1]))::bigint, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, _: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end), s[2:], k + 1
  from crc where s <> ''
), hashed as (
  select doc_id, xor(c, 4294967295) as h from crc where s = ''
)"""

OP11 = f"""
with recursive {CRC}, leaf as (
  select doc_id, coalesce('=' || source, '') as tree, {_leaf("text")} as leaf,
    case when h % 2 = 0 then {_leaf("replace(text, chr(10), '')")} else {_leaf("text")} end as found
  from documents left join hashed using (doc_id)
), placed as (
  select *, row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as pos, count(*) over (partition by tree) as n from leaf
), level0 as (
  select tree, pos, leaf as hash, n from placed
), {_tree("node", "level0")}, subroot as (
  select tree, hash, level as depth from node where n = 1
), level1 as (
  select '' as tree, row_number() over (order by tree) - 1 as pos, hash, count(*) over () as n, tree as name from subroot
), {_tree("above", "level1")}, root as (
  select hash, level as depth from above where n = 1
), step as (
  select p.tree, p.pos, x.level, x.pos % 3 as place, (p.pos // (3 ** x.level)::bigint) % 3 as own, x.hash
  from placed p join node x on x.tree = p.tree and x.pos // 3 = p.pos // (3 ** (x.level + 1))::bigint and x.n > 1
  union all
  select p.tree, p.pos, s.depth + x.level, x.pos % 3, (l.pos // (3 ** x.level)::bigint) % 3, x.hash
  from placed p join subroot s using (tree) join level1 l on l.name = p.tree join above x on x.pos // 3 = l.pos // (3 ** (x.level + 1))::bigint and x.n > 1
), sides as (
  select tree, pos, level, coalesce(string_agg(hash, '' order by place) filter (place < own), '') as before,
    coalesce(string_agg(hash, '' order by place) filter (place > own), '') as behind from step group by all
), folded as (
  select tree, pos, 0 as level, found as hash from placed
  union all
  select tree, pos, level + 1, sha256(before || hash || behind) from folded join sides using (tree, pos, level)
), last as (
  select tree, pos, max_by(hash, level) as folded_root from folded group by all
), proof as (
  select tree, pos, sha256(string_agg(before || behind, '' order by level)) as proof_sha256 from sides group by all
)
select doc_id, leaf, subroot.hash as subroot, root.hash as root, coalesce(proof_sha256, sha256('')) as proof_sha256, folded_root, folded_root = root.hash as verified
from placed join subroot using (tree) join last using (tree, pos) left join proof using (tree, pos), root
"""

OP12 = """
with sound as (
  select row_number() over () as pos, vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), met as (
  select q.pos, q.vec_id as query_id, c.vec_id, coalesce(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])), 0)::bigint as score
  from sound q join sound c on q.pos <> c.pos where q.vec_id % 50 = 0
), ranked as (
  select *, row_number() over (partition by pos order by score desc, vec_id nulls last)::integer as rank from met
)
select query_id, rank, vec_id, score from ranked where rank <= 5
"""

OP13 = f"""
with recursive {CRC}, spaced as (
  select doc_id, h, {SPACED.format("coalesce(text, '')")} as w from documents left join hashed using (doc_id)
), periodic as (
  select doc_id, w, len(w) as n, h, (h // 10) % len(w) as a, h // 10 as g from spaced
), doc as (
  select row_number() over () as pos, doc_id, n, case when h % 10 = 0 and n > 0 then list_transform(range(n), lambda i: w[1 + case when i < a then i else
    a + (i - a) % (1 + (n - a) // (3 + g % 8)) end]) else w end as w from periodic
), word as (
  select pos, n, unnest(w) as word, unnest(range(n)) as i from doc
), pair as (
  select x.pos, y.i - x.i as q, x.i as i from word x join word y on x.pos = y.pos and x.word = y.word and y.i > x.i and 3 * (y.i - x.i) <= x.n
), island as (
  select pos, q, i, i - row_number() over (partition by pos, q order by i) as island from pair
), stretch as (
  select pos, q as period, min(i) as start, count(*) + q as length from island group by pos, q, island having count(*) + q >= greatest(24, 3 * q)
), run as (
  select * from stretch s where not exists (
    select 1 from stretch t where t.pos = s.pos and t.period < s.period and t.start <= s.start and t.start + t.length >= s.start + s.length)
), best as (
  select *, row_number() over (partition by pos order by length / period desc, start, period) as k from run
), listed as (
  select pos, count(*) as n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' order by start, period) as lines from run group by pos
), gone as (
  select distinct pos, unnest(range(start + period, start + length)) as i from run
), left_over as (
  select pos, string_agg(word, ' ' order by i) as words from word anti join gone using (pos, i) group by pos
)
select doc_id, coalesce(n_runs, 0)::bigint as n_runs, start::bigint as start, length::bigint as length, period::bigint as period,
  (1000 * length // period)::bigint as exponent_milli, sha256(coalesce(lines, '')) as runs_sha256, sha256(coalesce(words, '')) as collapsed_sha256
from doc left join listed using (pos) left join (select * from best where k = 1) using (pos) left join left_over using (pos)
"""

ORACLE_SQL = {
    "op3_benchmark_decontamination": OP3,
    "op4_quality_rules": OP4,
    "op7_warc_fixity": OP7,
    "op10_minhash_near_dedup": OP10,
    "op11_merkle_manifest": OP11,
    "op12_exact_top_k": OP12,
    "op13_periodic_runs": OP13,
}
