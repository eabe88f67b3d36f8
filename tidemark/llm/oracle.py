"""Plain SQL of those numbered queries that SQL can express."""

from __future__ import annotations


def vector_codes_sql(rounds: int = 4, entries: int = 256) -> str:
    """The vector codes with every distance worked out, one named part per round."""
    parts = [
        "cells as (select vec_id, label, len(embedding) // 4 as width, unnest(embedding)::double as x, generate_subscripts(embedding, 1) - 1 as i from embeddings where len(embedding) > 0)",
        "wrong as (select vec_id from cells where x is null or not isfinite(x))",
        "grid as (select vec_id, label, i // width as part, i % width as position, floor(1024 * x)::bigint as g from cells where vec_id not in (select vec_id from wrong))",
        "vectors as (select vec_id, part, list(g::double order by position) as v from grid group by all)",
        f"first as (select vec_id, row_number() over (order by vec_id) - 1 as entry from (select distinct vec_id from grid) order by vec_id limit {entries})",
        "book0 as (select part, entry, v from vectors join first using (vec_id))",
    ]
    for k in range(rounds + 1):
        away = "list_inner_product(vectors.v, vectors.v) - 2 * list_inner_product(vectors.v, b.v) + list_inner_product(b.v, b.v)"
        # the distance and the entry in one number, so that the lower entry wins a tie
        parts.append(
            f"near{k} as (select vec_id, part, min(({away})::bigint * {entries} + entry) as best from vectors join book{k} b using (part) group by all)"
        )
        if k < rounds:
            sums = f"select part, best % {entries} as entry, position, sum(g)::bigint as s, count(*) as n from near{k} join grid using (vec_id, part) group by all"
            # floored: what is left above the next lower multiple goes first
            parts.append(
                f"moved{k} as (select part, entry, list(((s - ((s % n) + n) % n) // n)::double order by position) as v from ({sums}) group by all)"
            )
            parts.append(f"book{k + 1} as (select part, entry, coalesce(m.v, b.v) as v from book{k} b left join moved{k} m using (part, entry))")
    numbers = f"select part, entry, unnest(v)::bigint as c, generate_subscripts(v, 1) as position from book{rounds}"
    parts.append(f"digest as (select sha256(string_agg(c::varchar, ',' order by part, entry, position)) as codebooks_sha256 from ({numbers}))")
    parts.append(
        f"coded as (select vec_id, string_agg(printf('%02x', best % {entries}), '' order by part) as code, sum(best // {entries})::bigint as error from near{rounds} group by vec_id)"
    )
    return (
        "with " + ",\n".join(parts) + "\nselect vec_id, code, error, sum(error) over (partition by label)::bigint as label_error, codebooks_sha256 "
        "from coded join (select vec_id, any_value(label) as label from cells group by vec_id) using (vec_id), digest"
    )


def jaccard_groups_sql(percent: int = 80, words: int = 5) -> str:
    """Groups of near duplicates with every pair that shares a shingle counted, and links followed step by step."""
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"""with recursive
texts as (select doc_id, regexp_extract_all({lower}, '[^\x20\x09-\x0D]+') as w from documents),
places as (select doc_id, w, unnest(generate_series(1, greatest(1, len(w) - {words - 1}))) as i from texts where len(w) > 0),
shingles as (select distinct doc_id, array_to_string(list_slice(w, i, i + {words - 1}), ' ') as s from places),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
common as (select a.doc_id as a, b.doc_id as b, count(*) as c from shingles a join shingles b on a.s = b.s and a.doc_id <> b.doc_id group by all),
links as (select a, b from common join sizes x on a = x.doc_id join sizes y on b = y.doc_id where 100 * c >= {percent} * (x.n + y.n - c)),
reached as (select doc_id, doc_id as other from texts union select r.doc_id, l.b from reached r join links l on r.other = l.a)
select doc_id, coalesce(any_value(n), 0)::bigint as n_shingles, min(other)::bigint as component_id
from reached left join sizes using (doc_id) group by doc_id"""


def passage_digests_sql(size: int = 200, block: int = 256) -> str:
    """Bytes covered by strings of ``size`` bytes that start twice, from the hex form of all texts.

    Texts are cut into blocks first, since a substring counts from the start of its string.
    """
    return f"""with texts as (select row_number() over () as r, doc_id, hex(encode(coalesce(text, ''))) as h, length(h) // 2 as n from documents),
blocks as (select r, first, least({block}, n - first - {size - 1}) as own, substring(h, 2 * first + 1, {2 * (block + size - 1)}) as piece
  from (select r, n, h, unnest(range(0, n - {size - 1}, {block})) as first from texts)),
windows as (select r, first + i as i, md5_number(substring(piece, 2 * i + 1, {2 * size})) as k from (select r, first, piece, unnest(range(own)) as i from blocks)),
twice as (select k from windows group by k having count(*) > 1),
hits as (select r, i, lag(i) over (partition by r order by i) as before from windows semi join twice using (k)),
runs as (select r, min(i) as low, max(i) + {size} as high
  from (select r, i, count(*) filter (before is null or i > before + {size}) over (partition by r order by i) as run from hits) group by r, run),
kept as (select r, high as low, lead(low) over (partition by r order by high) as high from (select * from runs union all select r, -1, 0 from texts)),
digests as (select r, sha256(unhex(string_agg(substring(h, 2 * kept.low + 1, 2 * (coalesce(kept.high, n) - kept.low)), '' order by kept.low))) as kept_sha256
  from texts join kept using (r) group by r),
removed as (select r, sum(high - low)::bigint as n_removed, count(*) as n_spans from runs group by r)
select doc_id, n::bigint as n_bytes, coalesce(n_removed, 0)::bigint as n_removed, coalesce(n_spans, 0)::bigint as n_spans, kept_sha256
from texts join digests using (r) left join removed using (r)"""


def leaks_sql(window: int = 13, span: int = 9, substitutions: int = 2) -> str:
    """Benchmark items in texts: words compared as they are around every meeting of equal seeds."""
    before = window - span
    words = r"regexp_extract_all(lower(coalesce(text, '')), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    seeds = "select {row}, place, m, list_transform(m, lambda o: w[place + o + 1]) as seed from (select {row}, w, m, unnest(range(len(w) - m[-1])) as place from {table}, masks)"
    return f"""with docs as (select row_number() over () as r, doc_id, coalesce(text, '') as t, {words} as w from documents),
items as (select row_number() over () as item, * from (select distinct item_id, {words} as w from benchmark) where len(w) > 0),
masks as (select [0, 1, 2, 3, 5, 8]::bigint[] as m union all select [0, 3, 4, 6, 7, 8]::bigint[] union all select distinct range(len(w)) from items where len(w) < {span}),
met as (select r, item, a.place as doc_at, b.place as item_at from ({seeds.format(row="r", table="docs")}) a join ({seeds.format(row="item", table="items")}) b using (m, seed)),
around as (select doc_id, t, item_id, docs.w as x, items.w as y, doc_at - item_at as shift, len(items.w) as n,
  greatest(item_at - {before}, 0, item_at - doc_at) as low, least(item_at + {window}, len(items.w), len(docs.w) - doc_at + item_at) as high
  from met join docs using (r) join items using (item)),
differ as (select *, least(n, {window}) as size, list_transform(range(low, high), lambda j: (x[j + shift + 1] <> y[j + 1])::int) as d from around),
runs as (select *, list_min(list_transform(range(len(d) - size + 1), lambda s: {{'n': list_sum(d[s + 1:s + size])::bigint, 'start': low + s}})) as best from differ),
found as (select doc_id, item_id, min({{'n': best.n, 'start': best.start, 'shift': shift}}) as f, count(*) as n_seeds from runs
  where best.n <= case when n >= {window} then {substitutions} else 0 end group by doc_id, t, item_id)
select doc_id, item_id, (f.start + f.shift)::bigint as doc_word, f.start::bigint as item_word, f.n::bigint as n_differ, n_seeds from found"""


def _crc32(bytes_of: str) -> tuple[str, str]:
    """CRC-32 of a list of bytes by a table ``crc``, and that table."""
    shift = "list_reduce(list_prepend({c}, range(8)), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)"
    table = f"(select list({shift.format(c='b')} order by b) from range(256) t(b))"
    return f"xor(list_reduce(list_prepend(4294967295, {bytes_of}), lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1])), 4294967295)", table


def spelling_variants_sql(divisor: int = 31, letters: int = 7, often: int = 2, times: int = 10) -> str:
    """Near words by their forms with one letter left out: equal to a word, or equal to another's at the same place."""
    crc, table = _crc32("list_transform(range(length(h) // 2), lambda i: ('0x' || substring(h, 2 * i + 1, 2))::bigint)")
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"""with recursive
found as (select doc_id, unnest(regexp_extract_all({lower}, '[a-z\x{{00C0}}-\x{{00FF}}]+')) as run from documents),
counted as (select run, count(*) as n, hex(encode(doc_id || ':' || run)) as h from found group by doc_id, run),
hashed as (select run, n, {crc} as h from counted, (select {table} as crc)),
spelled as (select case when h % {divisor} = 0 then substring(run, 1, h % length(run)) || substring(run, h % length(run) + 2) else run end as word, n from hashed),
words as (select word, sum(n)::bigint as n from spelled where length(word) >= {letters} group by word having sum(n) >= {often}),
shorter as (select word, i, substring(word, 1, i) || substring(word, i + 2) as left_out from (select word, unnest(range(length(word))) as i from words)),
pairs as (
  select a.word as a, b.word as b from shorter a join shorter b using (i, left_out) where a.word <> b.word
  union select word, left_out from shorter semi join words w on left_out = w.word
  union select left_out, word from shorter semi join words w on left_out = w.word),
near as (select a as word, count(*) as n_near, arg_min(b, (-n, b)) as best, max(n) as best_n from pairs join words on b = word group by a),
forms as (select word, n, coalesce(n_near, 0)::bigint as n_near, case when best_n >= {times} * n then best end as form,
  case when best_n >= {times} * n then best_n end as form_n from words left join near using (word)),
followed as (select word, word as root, form from forms union all
  select followed.word, f.word, f.form from followed join forms f on followed.form = f.word)
select word, forms.form, root, n, n_near, form_n from forms join (select word, root from followed where form is null) using (word)"""
