"""DuckDB equivalents of the queries that SQL can express."""

from __future__ import annotations

WORD = r"[^\x20\x09-\x0D]+"

# Base32 by five bits of the digest's 160 at a time.
WARC = """
with p as (
    select page_id, coalesce(html, '') as body from pages
), d as (
    select page_id, cast(octet_length(encode(body)) as bigint) as payload_bytes, sha1(body) as hex
    from p
), b as (
    select page_id, payload_bytes, hex,
        list_reduce(list_transform(range(1, 41), lambda i:
            ['0000','0001','0010','0011','0100','0101','0110','0111',
             '1000','1001','1010','1011','1100','1101','1110','1111']
            [instr('0123456789abcdef', substr(hex, i, 1))]), lambda a, b: a || b) as bits
    from d
), c as (
    select page_id, payload_bytes,
        list_reduce(list_transform(range(0, 32), lambda i:
            substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', cast(1
                + 16 * cast(substr(bits, 5 * i + 1, 1) as int)
                + 8 * cast(substr(bits, 5 * i + 2, 1) as int)
                + 4 * cast(substr(bits, 5 * i + 3, 1) as int)
                + 2 * cast(substr(bits, 5 * i + 4, 1) as int)
                + cast(substr(bits, 5 * i + 5, 1) as int) as int), 1)), lambda a, b: a || b)
            as payload_digest
    from b
), f as (
    select *, min(page_id) over (partition by payload_digest) as first_id from c
)
select page_id, payload_bytes, payload_digest,
    case when page_id = first_id then 'response' else 'revisit' end as record_type,
    case when page_id = first_id then null else first_id end as refers_to
from f
"""

TOP_K = """
with v as materialized (
    select row_number() over () as r, vec_id,
        list_transform(embedding, lambda x: floor(64 * cast(x as double))) as v
    from embeddings
    where embedding is not null
        and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), s as (
    select q.r as query, q.vec_id as query_id, c.vec_id as vec_id, c.r as r,
        cast(list_inner_product(q.v, c.v) as bigint) as score
    from v q join v c on q.r <> c.r
    where q.vec_id % 20 = 0
), o as (
    select *, row_number() over (partition by query order by score desc, vec_id nulls last, r) as rank
    from s
)
select query_id, cast(rank as int) as rank, vec_id, score from o where rank <= 20
"""

DECONTAMINATION = r"""
with dw as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
    from documents
), iw as (
    select item_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
    from benchmark
), windows as (
    select distinct item_id, least(10, len(w)) as n,
        unnest(list_transform(range(1, len(w) - least(10, len(w)) + 2),
            lambda i: list_aggregate(w[i:i + least(10, len(w)) - 1], 'string_agg', ' '))) as body
    from iw where len(w) > 0
), sizes as (
    select distinct n from windows
), places as (
    select doc_id, n, unnest(range(1, len(w) - n + 2)) as pos,
        unnest(list_transform(range(1, len(w) - n + 2),
            lambda i: list_aggregate(w[i:i + n - 1], 'string_agg', ' '))) as body
    from dw, sizes where len(w) >= n
), found as (
    select p.doc_id, p.pos, p.n, x.item_id
    from places p join windows x on p.body = x.body and p.n = x.n
), hit as (
    select doc_id, count(*) as n_hit from (
        select distinct doc_id, unnest(range(pos, pos + n)) as word from found
    ) group by doc_id
), items as (
    select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as listed from (
        select distinct doc_id, cast(item_id as varchar) as item from found where item_id is not null
    ) group by doc_id
)
select d.doc_id, cast(len(d.w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
    cast(coalesce(n_items, 0) as bigint) as n_items, sha256(coalesce(listed, '')) as items_sha256,
    coalesce(n_hit, 0) > 0 as contaminated
from dw d left join hit using (doc_id) left join items using (doc_id)
"""

SOURCE_MIX = r"""
with d as (
    select doc_id, source,
        md5('20240601:' || coalesce(cast(doc_id as varchar), '') || ':' || md5(coalesce(text, ''))) as key,
        cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as size
    from documents
), s as (
    select source, cast(sum(size) as bigint) as source_size from d group by source
), p as (
    select *, [5, 2, 1][(row_number() over (order by source nulls last) - 1) % 3 + 1] as weight
    from s
), r as (
    select *, source_size * 2.0::double as cap, source_size * 2.0::double / weight as ratio,
        sum(source_size) over () * 1.5::double as wanted
    from p
), o as (
    select *, row_number() over w as turn,
        coalesce(sum(cap) over (w rows between unbounded preceding and 1 preceding), 0) as clamped,
        sum(weight) over (w rows between current row and unbounded following) as open
    from r window w as (order by ratio, source nulls last)
), l as (
    select *, (wanted - clamped) / open as level from o
), f as (
    select *, min(case when level * weight < cap then turn end) over () as first from l
), t as (
    select source, source_size, case when turn >= first
        then max(case when turn = first then level end) over () * weight else cap end as target
    from f
), e as (
    select *, case when source_size > 0 then cast(floor(target / source_size) as bigint) else 0 end as epochs
    from t
), b as (
    select d.doc_id, d.size, e.source_size, e.target, e.epochs,
        cast(round(e.target) as bigint) - e.epochs * e.source_size as rest,
        sum(d.size) over (partition by d.source order by d.key, d.doc_id, d.size
            rows between unbounded preceding and current row) - d.size as begins
    from d join e on d.source is not distinct from e.source
)
select doc_id, size, source_size, target,
    cast(epochs * size + least(size, greatest(0, rest - begins)) as bigint) as taken
from b
"""

HARD_NEGATIVES = """
with v as materialized (
    select row_number() over () as r, vec_id,
        case when vec_id % 7 = 0 then (cast(label as bigint) + 1) % 10 else label end as label,
        list_transform(embedding, lambda x: floor(256 * cast(x as double))) as v
    from embeddings
    where embedding is not null and label is not null
        and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), s as (
    select a.r as anchor, a.vec_id as anchor_id, c.r as other, c.vec_id as other_id,
        a.label = c.label as alike, cast(list_inner_product(a.v, c.v) as bigint) as score
    from v a join v c on a.r <> c.r
    where a.vec_id % 100 = 0
), p as (
    select anchor, other as positive, other_id as positive_id, score as positive_score from s
    where alike
    qualify row_number() over (partition by anchor order by score desc, other_id nulls last, other) <= 5
)
select anchor_id, positive_id, cast(row_number() over w as int) as rank, other_id as negative_id,
    positive_score, score as negative_score
from p join s using (anchor)
where not alike and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score
window w as (partition by anchor, positive order by score desc, other_id nulls last, other)
qualify row_number() over w <= 10
"""

# The checksum bit by bit; subtree totals by all pairs of a node and a node below it.
PREFIX_TRIE = """
with t as (
    select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
        row_number() over (partition by conv_id
            order by turn nulls first, coalesce(role, ''), md5(coalesce(text, ''))) as place
    from conversations where conv_id is not null
), n as (
    select conv_id, max(place) as n, conv_id - conv_id % 5 as base,
        xor(4294967295, list_reduce(
            list_prepend(4294967295, list_transform(
                string_split(cast(conv_id as varchar), ''), lambda x: cast(ord(x) as bigint))),
            lambda a, b: list_reduce(
                list_prepend(xor(a, b), [0::bigint, 0, 0, 0, 0, 0, 0, 0]),
                lambda c, d: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end
            ))) % 9 as head
    from t group by conv_id
), c as (
    select n.*, least(n.head, coalesce(b.n, 0)) as taken from n left join n b on b.conv_id = n.base
), r as (
    select c.conv_id, t.place, role, text from c join t on t.conv_id = c.base where t.place <= c.head
    union all
    select c.conv_id, t.place - c.head + c.taken, role, text
    from c join t on t.conv_id = c.conv_id where t.place > c.head
), p as (
    select conv_id, place as depth, strlen(text) as size,
        md5(string_agg(md5(role) || md5(text), '') over (partition by conv_id order by place)) as node
    from r
    union all
    select conv_id, 0, 0, '' from c
), m as (
    select *, lag(node) over (partition by conv_id order by depth) as parent,
        max(depth) over (partition by conv_id) as turns
    from p
), v as (
    select node, depth, min(conv_id) as conv_id, count(*) as n_convs, any_value(parent) as parent,
        (count(*) - 1) * max(size) as saved,
        sha256(coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id)
            filter (depth = turns), '')) as ends_sha256
    from m group by node, depth
), k as (
    select parent as node, count(*) as n_children from v where depth > 0 group by parent
), pairs as (
    select distinct a.node as node, b.node as below
    from p a join p b on a.conv_id = b.conv_id and a.depth <= b.depth
), totals as (
    select pairs.node, sum(saved) as saved_tokens,
        count(*) filter (k.n_children is null) as n_leaves
    from pairs join v on v.node = pairs.below left join k on k.node = pairs.below
    group by pairs.node
)
select v.conv_id, cast(v.depth as bigint) as depth, u.conv_id as parent_conv_id, v.n_convs,
    coalesce(k.n_children, 0) as n_children, n_leaves, cast(saved_tokens as bigint) as saved_tokens,
    v.ends_sha256
from v join totals using (node) left join k using (node) left join v u on u.node = v.parent
"""

ORACLES = {
    "op1_warc": WARC,
    "op7_topk": TOP_K,
    "op8_decontamination": DECONTAMINATION,
    "op9_source_mix": SOURCE_MIX,
    "op11_hard_negatives": HARD_NEGATIVES,
    "op13_prefix_trie": PREFIX_TRIE,
}
