"""DuckDB SQL of the operators that SQL can express, over the driver's tables."""

from __future__ import annotations

from ledgerline.llm import line_frequency as lf
from ledgerline.llm import minhash, repeats

WORD = r"'[^\x20\x09-\x0D]+'"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

LINE_FREQUENCY = rf"""
with doc as (
  select row_number() over () as k, doc_id, coalesce(text, '') as text, coalesce(source, '') as host,
         regexp_extract_all(coalesce(text, ''), {WORD}) as w
  from documents),
line as (
  select k, host, text, unnest(string_split(text, chr(10))) as raw from doc),
worded as (
  select k, host, text, raw,
         regexp_extract_all(translate(raw, '{UPPER}0123456789', '{UPPER.lower()}0000000000'), {WORD}) as w
  from line where regexp_matches(raw, {WORD})),
frequent as (
  select host, line from (select distinct k, host, array_to_string(w, ' ') as line from worded)
  group by host, line having count(*) > {lf.MAX_DOCS_PER_HOST}),
removed as (
  select k, sum(len(w)) as n from worded join frequent using (host)
  where array_to_string(w, ' ') = frequent.line group by k),
repeated_line as (
  select k, count(*) - count(distinct raw) as n from worded group by k),
run as (
  select k, i, array_to_string(w[i:i + {lf.REPEAT_SIZE - 1}], ' ') as s
  from (select k, w, unnest(range(1, len(w) - {lf.REPEAT_SIZE - 2})) as i from doc)),
repeated_run as (
  select k, i from run qualify count(*) over (partition by k, s) > 1),
repeated_word as (
  select k, count(distinct p) as n from (select k, unnest(range(i, i + {lf.REPEAT_SIZE})) as p from repeated_run) group by k),
counted as (
  select doc_id, cast(len(w) as bigint) as n_words,
         cast(length(array_to_string(w, '')) as bigint) as word_chars,
         cast(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
         cast(coalesce(l.n, 0) as bigint) as n_dup_lines, cast(coalesce(r.n, 0) as bigint) as n_repeat_words,
         cast(coalesce(g.n, 0) as bigint) as n_removed_words
  from doc left join repeated_line l using (k) left join repeated_word r using (k) left join removed g using (k)),
judged as (
  select *, n_words < {lf.MIN_WORDS} or 100 * n_repeat_words > {lf.MAX_REPEAT_PERCENT} * n_words as base_failed,
         n_words - n_removed_words < {lf.MIN_WORDS}
           or n_words - n_removed_words < {lf.MIN_KEPT_SHARE} * n_words as depleted
  from counted)
select *, not base_failed and not depleted as kept from judged"""

VECTORS = """
usable as (
  select row_number() over () as r, vec_id, label, [cast(floor(256 * cast(x as double)) as bigint) for x in embedding] as c
  from embeddings where embedding is not null and len([x for x in embedding if x is null or not isfinite(x)]) = 0)"""

TOP_K = f"""
with {VECTORS},
scored as (
  select q.r as query, q.vec_id as query_id, o.vec_id, cast(list_inner_product(q.c, o.c) as bigint) as score
  from usable q join usable o on q.r <> o.r where q.vec_id % 50 = 0 and o.vec_id is not null)
select query_id, cast(row_number() over (partition by query order by score desc, vec_id) as integer) as rank, vec_id, score
from scored qualify rank <= 5"""

SUBSTRING = rf"""
with doc as (
  select doc_id, regexp_extract_all(coalesce(text, ''), {WORD}) as w from documents),
run as (
  select doc_id, i, array_to_string(w[i:i + {repeats.SIZE - 1}], ' ') as s
  from (select doc_id, w, unnest(range(1, len(w) - {repeats.SIZE - 2})) as i from doc)),
later as (
  select doc_id, i from run qualify row_number() over (partition by s order by doc_id, i) > 1),
gone as (
  select distinct doc_id, unnest(range(i, i + {repeats.SIZE})) as p from later),
word as (
  select doc_id, w[p] as word, p from (select doc_id, w, unnest(range(1, len(w) + 1)) as p from doc)),
kept as (
  select doc_id, string_agg(word, ' ' order by p) as kept, count(*) as n
  from word anti join gone using (doc_id, p) group by doc_id)
select doc_id, cast(len(w) as bigint) as n_words, cast(len(w) - coalesce(n, 0) as bigint) as n_removed,
       sha256(coalesce(kept, '')) as kept_sha256
from doc left join kept using (doc_id)"""


NEAR_DUPLICATES = rf"""
with recursive doc as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), {WORD}) as w from documents),
body as (
  select row_number() over () as n, w from (select distinct w from doc where len(w) > 0)),
element as (
  select distinct n, array_to_string(w[i:i + {minhash.SIZE - 1}], ' ') as s
  from (select n, w, unnest(range(1, greatest(len(w) - {minhash.SIZE - 2}, 2))) as i from body)),
size as (
  select n, count(*) as c from element group by n),
shared as (
  select a.n as a, b.n as b, count(*) as c from element a join element b using (s) where a.n < b.n group by a.n, b.n),
link as (
  select a, b from shared join size x on x.n = a join size y on y.n = b
  where 100 * shared.c >= {minhash.PERCENT} * (x.c + y.c - shared.c)),
both_ways as (
  select a, b from link union all select b, a from link),
reach(n, m) as (
  select n, n from body union select reach.n, both_ways.b from reach join both_ways on both_ways.a = reach.m),
least as (
  select reach.n, min(doc_id) as component_id from reach join body on body.n = reach.m join doc using (w) group by reach.n),
named as (
  select doc_id, cast(coalesce(size.c, 0) as bigint) as n_shingles,
         case when body.n is null then doc_id else component_id end as component_id
  from doc left join body using (w) left join size using (n) left join least using (n))
select doc_id, n_shingles, component_id, coalesce(doc_id = component_id, false) as kept from named"""

HARD_NEGATIVES = f"""
with {VECTORS},
relabelled as (
  select r, vec_id, c, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label
  from usable where vec_id is not null and label is not null),
scored as (
  select a.r as anchor, a.vec_id as anchor_id, o.vec_id, a.label = o.label as same,
         cast(list_inner_product(a.c, o.c) as bigint) as score
  from relabelled a join relabelled o on a.r <> o.r where a.vec_id % 100 = 0),
positive as (
  select anchor, anchor_id, vec_id as positive_id, score as positive_score,
         row_number() over (partition by anchor order by score desc, vec_id) as place
  from scored where same qualify place <= 5),
band as (
  select p.anchor_id, p.positive_id, p.positive_score, s.vec_id as negative_id, s.score as negative_score,
         row_number() over (partition by p.anchor, p.place order by s.score desc, s.vec_id) as rank
  from positive p join scored s on s.anchor = p.anchor and not s.same
    and 80 * p.positive_score <= 100 * s.score and 100 * s.score <= 100 * p.positive_score)
select anchor_id, positive_id, cast(rank as integer) as rank, negative_id, positive_score, negative_score
from band where rank <= 5"""


def _codes(rounds: int = 2, parts: int = 16, entries: int = 64) -> str:
    """Lloyd rounds spelled out: every part against every entry of its codebook."""
    steps = [f"""
with {VECTORS},
piece as (
  select r, vec_id, label, p, c[p * w + 1:(p + 1) * w] as v
  from (select *, len(c) // {parts} as w, unnest(range({parts})) as p from usable)),
book0 as (
  select p, e, v from piece join (
    select r, row_number() over (order by vec_id nulls last, c) - 1 as e from usable qualify e < {entries}) using (r))"""]
    for i in range(rounds + 1):
        steps.append(f"""
near{i} as (
  select r, vec_id, label, p, a.v, min(struct_pack(
           d := cast(list_sum([(a.v[k] - b.v[k]) * (a.v[k] - b.v[k]) for k in range(1, len(a.v) + 1)]) as bigint),
           e := b.e)) as best
  from piece a join book{i} b using (p) group by r, vec_id, label, p, a.v)""")
        if i < rounds:
            steps.append(f"""
mean{i} as (
  select p, e, list(m order by k) as v from (
    select p, best.e as e, k, cast(floor(sum(v[k]) / count(*)) as bigint) as m
    from (select *, unnest(range(1, len(v) + 1)) as k from near{i}) group by all) group by p, e),
book{i + 1} as (
  select b.p, b.e, coalesce(m.v, b.v) as v from book{i} b left join mean{i} m using (p, e))""")
    return ",".join(steps) + f""",
coded as (
  select r, vec_id, label, string_agg(printf('%02x', best.e), '' order by p) as code, cast(sum(best.d) as bigint) as error
  from near{rounds} group by r, vec_id, label)
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error,
       (select sha256(string_agg(array_to_string(v, ','), ',' order by p, e)) from book{rounds}) as codebooks_sha256
from coded"""


VECTOR_CODES = _codes()
