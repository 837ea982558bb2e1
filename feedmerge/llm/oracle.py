"""DuckDB SQL for the operators that SQL can express, over the same whole tables."""

from __future__ import annotations

_WORDS5 = r"regexp_extract_all(translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

#: 13-word windows of items met in documents, then the words that any of them covers.
OP5 = rf"""
with item_words as (
  select item_id, {_WORDS5.format(text="text")} as w from benchmark where text is not null
), doc_words as (
  select doc_id, case when text is null then [] else {_WORDS5.format(text="text")} end as w from documents
), windows as (
  select item_id, least(len(w), 13) as n, array_to_string(list_slice(w, i, i + least(len(w), 13) - 1), ' ') as g
  from (select item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) as i from item_words where len(w) > 0)
), sizes as (
  select distinct n from windows
), grams as (
  select doc_id, i, n, array_to_string(list_slice(w, i, i + n - 1), ' ') as g
  from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i from doc_words, sizes where len(w) >= n)
), met as (
  select distinct doc_id, i, grams.n, item_id from grams join windows on grams.g = windows.g and grams.n = windows.n
), hits as (
  select doc_id, count(distinct p) as n_hit
  from (select doc_id, unnest(range(i, i + n)) as p from met) group by doc_id
), items as (
  select doc_id, count(*) as n_items, string_agg(s, ',' order by s) as ids
  from (select distinct doc_id, cast(item_id as varchar) as s from met) group by doc_id
)
select d.doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(ids, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from doc_words d left join hits using (doc_id) left join items using (doc_id)
"""

#: All pairs that share a shingle, counted, and the least id that is reachable.
OP8 = r"""
with recursive words as (
  select doc_id, case when text is null then [] else
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') end as w
  from documents
), grams as (
  select distinct doc_id, array_to_string(list_slice(w, i, i + 4), ' ') as g
  from (select doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as i from words where len(w) > 0)
), sizes as (
  select doc_id, count(*) as n from grams group by doc_id
), links as (
  select a.doc_id as a, b.doc_id as b
  from grams a join grams b on a.g = b.g and a.doc_id < b.doc_id
  join sizes x on x.doc_id = a.doc_id join sizes y on y.doc_id = b.doc_id
  group by a.doc_id, b.doc_id having 100 * count(*) >= 75 * (min(x.n) + min(y.n) - count(*))
), ends as (
  select a, b from links union all select b, a from links
), reach as (
  select a as doc_id, a as other from ends union select reach.doc_id, ends.b from reach join ends on reach.other = ends.a
), least_of as (
  select doc_id, min(other) as component_id from reach group by doc_id
)
select w.doc_id, coalesce(n, 0) as n_shingles, coalesce(component_id, w.doc_id) as component_id,
  coalesce(component_id, w.doc_id) = w.doc_id as kept
from words w left join sizes using (doc_id) left join least_of using (doc_id)
"""

#: Vectors of one label with a cosine of at least 0.93, and the least id that is reachable.
OP4 = r"""
with recursive vectors as (
  select vec_id, label, [cast(x as double) for x in embedding] as v from embeddings
), usable as (
  select * from vectors
  where label is not null and v is not null and len([x for x in v if x is null or not isfinite(x)]) = 0
    and list_sum([x * x for x in v]) > 0
), links as (
  select a.vec_id as a, b.vec_id as b from usable a join usable b
    on a.label = b.label and a.vec_id <> b.vec_id and len(a.v) = len(b.v)
  where list_cosine_similarity(a.v, b.v) >= 0.93
), reach as (
  select a as vec_id, a as other from links union select reach.vec_id, links.b from reach join links on reach.other = links.a
), least_of as (
  select vec_id, min(other) as component_id from reach group by vec_id
), counts as (
  select a as vec_id, count(*) as n_links from links group by a
)
select vec_id, coalesce(n_links, 0) as n_links, coalesce(component_id, vec_id) as component_id,
  coalesce(component_id, vec_id) = vec_id as kept
from vectors left join counts using (vec_id) left join least_of using (vec_id)
"""


def _codes_sql(parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> str:
    """Plain k-means in integers: every part meets every entry, one step after the other."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
chosen{r} as materialized (
  select vec_id, part, entry, d from (
    select x.vec_id, x.part, c.entry, sum((x.v - c.v) * (x.v - c.v)) as d,
      row_number() over (partition by x.vec_id, x.part order by sum((x.v - c.v) * (x.v - c.v)), c.entry) as place
    from points x join book{r} c on x.part = c.part and x.pos = c.pos group by x.vec_id, x.part, c.entry
  ) where place = 1
)""")
        if r < rounds:
            steps.append(f"""
mean{r} as (
  select x.part, h.entry, x.pos, sum(x.v) as s, count(*) as n
  from points x join chosen{r} h on x.vec_id = h.vec_id and x.part = h.part group by x.part, h.entry, x.pos
), book{r + 1} as materialized (
  select c.part, c.entry, c.pos, coalesce((s - ((s % n) + n) % n) // n, c.v) as v
  from book{r} c left join mean{r} m on c.part = m.part and c.entry = m.entry and c.pos = m.pos
)""")
    return f"""
with kept as (
  select vec_id, label, embedding from embeddings
  where embedding is not null and len([x for x in embedding if x is null or not isfinite(x)]) = 0
), points as materialized (
  select vec_id, (i - 1) // (len(embedding) // {parts}) as part, (i - 1) % (len(embedding) // {parts}) as pos,
    cast(floor({scale} * cast(embedding[i] as double)) as hugeint) as v
  from (select vec_id, embedding, unnest(range(1, len(embedding) + 1)) as i from kept)
), book0 as materialized (
  select part, entry, pos, v from points join (
    select vec_id, row_number() over (order by vec_id) - 1 as entry from kept order by vec_id limit {entries}
  ) using (vec_id)
), {",".join(steps)}, coded as (
  select vec_id, string_agg(printf('%02x', entry), '' order by part) as code, cast(sum(d) as bigint) as error
  from chosen{rounds} group by vec_id
), sums as (
  select label, cast(sum(error) as bigint) as label_error from coded join kept using (vec_id) group by label
)
select vec_id, code, error, label_error,
  (select sha256(string_agg(cast(v as varchar), ',' order by part, entry, pos)) from book{rounds}) as codebooks_sha256
from coded join kept using (vec_id) join sums on kept.label is not distinct from sums.label
"""


OP13 = _codes_sql()

#: Every phrase of one to four words counted, every cut scored, every longer candidate looked at.
OP11 = r"""
with pieces as (
  select lang, regexp_extract_all(p, '[^\x20\x09]+') as w from (
    select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as p
    from documents)
), grams as materialized (
  select lang, size, phrase, cast(count(*) as bigint) as a from (
    select lang, size, array_to_string(list_slice(w, i, i + size - 1), ' ') as phrase
    from (select lang, w, size, unnest(range(1, len(w) - size + 2)) as i from pieces, (values (1), (2), (3), (4)) as sizes(size) where len(w) >= size)
  ) group by lang, size, phrase
), totals as (
  select lang, cast(sum(a) as bigint) as n from grams where size = 1 group by lang
), candidates as materialized (
  select lang, size, phrase, a, string_split(phrase, ' ') as w from grams where size > 1 and a >= 30
), keyed as materialized (
  select lang || chr(10) || phrase as key, a from grams where size < 4 and a >= 30
), cuts as (
  select c.lang, c.size, c.phrase, c.a, c.k, f.a as l, s.a as r,
    cast((cast(2000000 as hugeint) * c.a) // (f.a + s.a) as bigint) as score
  from (select *, unnest(range(1, size)) as k from candidates) c
  join keyed f on f.key = c.lang || chr(10) || array_to_string(list_slice(c.w, 1, c.k), ' ')
  join keyed s on s.key = c.lang || chr(10) || array_to_string(list_slice(c.w, c.k + 1, c.size), ' ')
), lowest as (
  select * from cuts qualify row_number() over (partition by lang, phrase order by score, k) = 1
), inner_phrases as (
  select lang, a, array_to_string(list_slice(w, i, i + m - 1), ' ') as phrase from (
    select lang, w, a, m, unnest(range(1, size - m + 2)) as i
    from (select lang, w, a, size, unnest(range(2, size)) as m from candidates))
), covered as (
  select lang, phrase, max(a) as most from inner_phrases group by lang, phrase
), ranked as (
  select x.lang, row_number() over (partition by x.lang order by score desc, x.a desc, x.phrase) as rank, x.phrase, x.a, l, r, score
  from lowest x left join covered c on x.lang = c.lang and x.phrase = c.phrase
  where most is null or cast(100 as hugeint) * most < cast(80 as hugeint) * x.a
)
select lang, rank, phrase, a, l, r, n, score from ranked join totals using (lang) where rank <= 2000
"""

SQL = {"op4_embedding": OP4, "op5_decontamination": OP5, "op8_minhash": OP8, "op11_collocations": OP11, "op13_vector_codes": OP13}
