"""DuckDB statements for the queries that SQL can express."""

from verbalance.llm import url_filter

LINE_DEDUP = r"""
with parts as (
    select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
        generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as place
    from documents
), keyed as (
    select *, translate(trim(line, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
    from parts
), frequent as (
    select key, max(doc_id) as largest from keyed where length(key) >= 40
    group by key having count(distinct doc_id) >= 5
), marked as (
    select doc_id, place, line, coalesce(doc_id <> largest, false) as gone
    from keyed left join frequent using (key)
)
select doc_id, count(*) as n_lines, count(*) filter (where gone) as n_dropped,
    sha256(coalesce(string_agg(line, chr(10) order by place) filter (where not gone), '')) as kept_sha256
from marked group by doc_id
"""

EXACT_DEDUP = r"""
with normal as (
    select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as norm
    from documents
), groups as (
    select norm, min(doc_id) as keep_id, count(*) as group_size from normal group by norm
)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(norm) as text_sha256
from normal join groups using (norm)
"""

EMBEDDING_DEDUP = """
with recursive fit as (
    select vec_id, label, embedding::double[] as v from embeddings
    where label is not null and embedding is not null and len(embedding) > 0
        and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
        and len(list_filter(embedding, lambda x: x <> 0)) > 0
), links as (
    select a.vec_id as a, b.vec_id as b from fit a join fit b
    on a.label = b.label and len(a.v) = len(b.v) and a.vec_id <> b.vec_id
    where list_cosine_similarity(a.v, b.v) >= 0.98
), reach(node, other) as (
    select a, b from links
    union
    select reach.node, links.b from reach join links on reach.other = links.a
), lowest as (
    select node, min(other) as low from reach group by node
), counted as (
    select a, count(*) as n from links group by a
)
select vec_id, coalesce(n, 0) as n_links, least(vec_id, coalesce(low, vec_id)) as component_id,
    vec_id = least(vec_id, coalesce(low, vec_id)) as kept
from embeddings left join lowest on node = vec_id left join counted on a = vec_id
"""


def _url_filter():
    """The whole reputation in SQL, without the columns of its rates and bounds."""
    rules = "".join(
        f"when (host = '{host}' or ends_with(host, '.{host}')) and starts_with(path, '/{rest}') then '{host}/{rest}' "
        for host, rest in (
            rule.split("/", 1)
            for _, rule in sorted(url_filter.RULES, key=lambda r: -len(r[1]))
        )
    )
    verdicts = "".join(f"when '{rule}' then '{verdict}' " for verdict, rule in url_filter.RULES)
    second = ", ".join(f"'{name}'" for name in url_filter.SECOND_LEVEL)

    def strength(table):
        return f"""
        select case when count(*) = 0 or sum(n) <= count(*) then {url_filter.STRONGEST}
            when sum(n * pow(bad / n - mean, 2) / (mean * (1 - mean))) <= count(*) then {url_filter.STRONGEST}
            else least(greatest((sum(n) - count(*)) / (sum(n * pow(bad / n - mean, 2) / (mean * (1 - mean))) - count(*)) - 1,
                {url_filter.WEAKEST}), {url_filter.STRONGEST}) end as k
        from {table} where n > 0 and mean > 0 and mean < 1"""

    return rf"""
with own as (
    select page_id,
        translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
        regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') as path
    from pages
), outcome as (
    select doc_id, max((quality = 0)::int) as bad from labels
    where doc_id is not null and quality is not null group by doc_id
), counts as (
    select host, count(bad) as n, coalesce(sum(bad), 0) as bad
    from own left join outcome on page_id = doc_id group by host
), parts as (
    select *, string_split(regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', ''), '.') as p from counts
), sized as (
    select *, case when len(p) > 2 and length(p[-1]) = 2 and p[-2] in ({second}) then 2 else 1 end as s from parts
), hosts as (
    select host, n, bad, array_to_string(p[greatest(len(p) - s, 1):], '.') as domain,
        array_to_string(p[greatest(len(p) - s + 1, 1):], '.') as suffix from sized
), domains as (
    select domain, suffix, sum(n) as n, sum(bad) as bad from hosts group by domain, suffix
), suffixes as (
    select suffix, sum(n) as n, sum(bad) as bad,
        (select coalesce(sum(bad) / nullif(sum(n), 0), 0) from domains) as mean
    from domains group by suffix
), k1 as ({strength("suffixes")}),
level1 as (
    select d.*, (s.bad + k * s.mean) / (s.n + k) as mean from domains d join suffixes s using (suffix), k1
), k2 as ({strength("level1")}),
level2 as (
    select h.*, (d.bad + k * d.mean) / (d.n + k) as mean
    from hosts h join level1 d using (domain, suffix), k2
), k3 as ({strength("level2")}),
rated as (
    select host, (bad + k * mean) / (n + k) as rate, n + k + 1 as size from level2, k3
), ruled as (
    select *, case {rules}else null end as rule from own
)
select page_id, host, path, rule, case rule {verdicts}else
    case when rate - {url_filter.DEVIATIONS} * sqrt(rate * (1 - rate) / size) > {url_filter.BLOCK_ABOVE}
        then 'block' else 'allow' end end as verdict
from ruled join rated using (host)
"""


def _merkle_manifest(levels=8):
    """Trees of up to 16 ** levels leaves; more levels would only repeat a lone node."""

    def digest(text):
        framed = [
            f"case when {v} is null then '-' else concat(strlen({v}::varchar), ':', {v}::varchar) end"
            for v in ("doc_id", "source", "lang", "n_chars", text)
        ]
        return f"sha256(concat({', '.join(framed)}))"

    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    # CRC-32 of the decimal digits, bit by bit; 3988292384 is its reversed polynomial.
    shift = "lambda x, y: xor(x >> 1, (x & 1) * 3988292384::bigint)"
    crc = f"""xor(4294967295::bigint, list_reduce(
        list_transform(string_split(doc_id::varchar, ''), lambda c: ord(c)::bigint),
        lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0], {shift}),
        4294967295::bigint))"""

    def tree(name, group):
        """CTEs of all levels and, per member of a level, the digests beside it in its run."""
        parts = []
        for k in range(levels):
            parts.append(f"""{name}{k + 1} as (
    select {group}, pos // 16 as pos, (n + 15) // 16 as n,
        case when n > 1 then sha256(string_agg(digest, '' order by pos)) else min(digest) end as digest
    from {name}{k} group by {group}, pos // 16, n
)""")
        for k in range(levels):
            run = f"over (partition by {group}, pos // 16 order by pos rows between"
            parts.append(f"""{name}_side{k} as (
    select {group}, pos, n, coalesce(string_agg(digest, '') {run} unbounded preceding and 1 preceding), '') as l,
        coalesce(string_agg(digest, '') {run} 1 following and unbounded following), '') as r
    from {name}{k}
)""")
        return parts

    def climb(start, name, own, source):
        """CTEs that take each row from a leaf up to the root of its tree."""
        parts, before = [], start
        for k in range(levels):
            here = f"{start}_{name}{k}"
            parts.append(f"""{here} as (
    select b.* replace (b.proof || s.l || s.r as proof,
        case when s.n > 1 then sha256(s.l || b.folded || s.r) else b.folded end as folded)
    from {before} b join {name}_side{k} s
    on {source} and s.pos = b.{own} // {16 ** k}::bigint
)""")
            before = here
        return parts, before

    below, inner = climb("begun", "src", "pos", "s.source is not distinct from b.source")
    above, outer = climb(inner, "top", "rank", "true")
    parts = [
        f"""leaves as (
    select doc_id, source, {digest("text")} as leaf,
        case when doc_id is not null and ({crc}) % 5 = 0 then {digest(lower)} end as tampered
    from documents
)""",
        """placed as (
    select *, row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as pos,
        count(*) over (partition by source) as n
    from leaves
)""",
        "src0 as (select source, pos, n, leaf as digest from placed)",
        *tree("src", "source"),
        f"""subroots as (
    select source, digest, row_number() over (order by source nulls first) - 1 as rank from src{levels}
)""",
        """top0 as (
    select 0 as all_sources, rank as pos, count(*) over () as n, digest from subroots
)""",
        *tree("top", "all_sources"),
        """begun as (
    select doc_id, p.source, leaf, pos, rank, digest as subroot, '' as proof,
        coalesce(tampered, leaf) as folded
    from placed p join subroots s on p.source is not distinct from s.source
)""",
        *below,
        *above,
    ]
    return f"""with {", ".join(parts)}
select doc_id, leaf, subroot, t.digest as root, sha256(proof) as proof_sha256, folded as folded_root,
    folded = t.digest as verified
from {outer}, top{levels} t
"""


def statements():
    return {
        "op1_line_dedup": LINE_DEDUP,
        "op4_embedding_dedup": EMBEDDING_DEDUP,
        "op7_exact_dedup": EXACT_DEDUP,
        "op8_url_filter": _url_filter(),
        "op12_merkle_manifest": _merkle_manifest(),
    }
