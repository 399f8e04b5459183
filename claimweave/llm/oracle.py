"""DuckDB SQL for the rows of the registered text queries, where SQL can express them."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

ORACLE["op8_exact_dedup"] = r"""
with texts as (
    select doc_id, length(coalesce(text, '')) as points,
           sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) as text_sha256
    from documents
),
ranked as (
    select *, first_value(doc_id) over best as keep_id, count(*) over (partition by text_sha256) as group_size,
           row_number() over best = 1 as kept
    from texts
    window best as (partition by text_sha256 order by points desc, doc_id nulls last)
)
select doc_id, keep_id, group_size, kept, text_sha256 from ranked
"""

# DuckDB has no CRC-32: the table of the reflected polynomial, then one step per byte of the text.
_CRC32 = """
crc_table as (
    select list_transform(range(256), lambda b: list_reduce(
        list_prepend(b, range(8)), lambda c, step: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end
    )) as t
)
"""

ORACLE["op4_sharding"] = f"""
with {_CRC32},
bytes as (
    select doc_id, source, encode(coalesce(text, '')) as b, md5('17:' || doc_id) as draw from documents
),
hexed as (
    select doc_id, source, draw, octet_length(b) as n, hex(b) as h from bytes
),
rows as (
    select doc_id, source, draw, n + 1 as size,
           xor(list_reduce(
               list_prepend(4294967295::bigint, list_transform(range(n), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::bigint)),
               lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])
           ), 4294967295) as text_crc32
    from hexed, crc_table
),
ranked as (
    select *, (row_number() over (partition by source order by draw, doc_id, size, text_crc32) - 0.5::double)
              / (count(*) over (partition by source))::double as fraction
    from rows
),
placed as (
    select *, row_number() over (order by fraction, draw, doc_id, size, text_crc32, source) - 1 as place,
           count(*) over () as total
    from ranked
)
select doc_id, size, text_crc32, 'rows' as law, (place * 16 // total)::int as shard,
       place - ((place * 16 // total) * total + 15) // 16 as slot, null::int as grown_shard
from placed
"""

ORACLE["op11_collocations"] = r"""
with pieces as (
    select coalesce(lang, 'und') as lang,
           unnest(regexp_split_to_array(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]'
           )) as piece
    from documents
),
listed as (
    select lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') as w from pieces
),
totals as (select lang, sum(len(w))::hugeint as n from listed group by lang),
sized as (select lang, w, unnest(range(1, 6)) as size from listed),
placed as (select lang, w, size, unnest(range(1, len(w) - size + 2)) as pos from sized),
counts as (
    select lang, size, w[pos : pos + size - 1] as words, count(*)::hugeint as f from placed group by all
),
often as (select * from counts where f >= 100),
candidates as (select * from often where size > 1),
inner_parts as (
    select lang, words, f, size, unnest(range(2, size)) as k from candidates
),
inside as (
    select distinct lang, words[pos : pos + k - 1] as words, f
    from (select *, unnest(range(1, size - k + 2)) as pos from inner_parts)
),
kept as (
    select c.* from candidates c left join (select lang, words, max(f) as longer from inside group by all) i using (lang, words)
    where longer is null or 100 * longer < 100 * f
),
cuts as (
    select c.lang, c.words, c.f as a, k, l.f as l, r.f as r, n, (1000 * c.f * n) // (l.f * r.f) as score
    from (select *, unnest(range(1, size)) as k from kept) c
    join totals using (lang)
    join often l on l.lang = c.lang and l.words = c.words[1 : k]
    join often r on r.lang = c.lang and r.words = c.words[k + 1 : c.size]
),
lowest as (
    select * from cuts qualify row_number() over (partition by lang, words order by score, k) = 1
),
ranked as (
    select lang, array_to_string(words, ' ') as phrase, a::bigint as a, l::bigint as l, r::bigint as r, n::bigint as n,
           score::bigint as score,
           row_number() over (partition by lang order by score desc, a desc, encode(array_to_string(words, ' '))) as rank
    from lowest
)
select lang, rank, phrase, a, l, r, n, score from ranked where rank <= 2000
"""
