"""The queries that SQL can express, as SQL for a second engine."""

from __future__ import annotations

from opinionlens.llm import lexical, merkle, mixing, secrets


def _literal(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _mixing() -> str:
    weights = "[" + ", ".join(map(str, mixing.WEIGHTS)) + "]"
    return f"""
with sized as (
    select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '{mixing.WORD}')) as bigint) as size,
           cast(coalesce(length(text), 0) as double) as chars
    from documents
), drawn as (
    select *, -ln((cast('0x' || substr(md5('{mixing.SEED}:' || coalesce(cast(doc_id as varchar), '')), 1, 13) as bigint)
                   + 0.5::double) / {1 << 52}::double)
              / greatest(0.001::double, greatest(0.1::double, 1::double - abs(chars / greatest(size, 1) - 6::double) / 12::double)) as draw
    from sized
), sources as (
    select source, cast(sum(size) as bigint) as source_size,
           {weights}[1 + (row_number() over (order by source nulls last) - 1) % {len(mixing.WEIGHTS)}] as weight
    from sized group by source
), filled as (
    select *, {mixing.MAX_EPOCHS} * source_size as most, ({mixing.MAX_EPOCHS} * source_size)::double / weight as brim from sources
), levels as (
    select *, row_number() over by_brim as place,
           ((sum(source_size) over ()) - coalesce(sum(most) over (by_brim rows between unbounded preceding and 1 preceding), 0))::double
           / (sum(weight) over (by_brim rows between current row and unbounded following))::double as level
    from filled window by_brim as (order by brim, source nulls last)
), goals as (
    select source, source_size,
           least(weight * (select arg_min(level, place) from levels where level <= brim), most::double) as target
    from levels
), planned as (
    select *, case when source_size > 0 then cast(floor(target / source_size) as bigint) else 0 end as epochs from goals
), placed as (
    select *, coalesce(sum(size) over (partition by source order by draw, doc_id, size
                                       rows between unbounded preceding and 1 preceding), 0) as before
    from drawn
)
select d.doc_id, d.size, p.source_size, p.target,
       cast(d.size * (p.epochs + case when 2 * d.before + d.size <= 2 * (p.target - p.epochs * p.source_size)
                                       and p.target > p.epochs * p.source_size then 1 else 0 end) as bigint) as taken
from placed d join planned p on d.source is not distinct from p.source
"""


def _secrets() -> str:
    columns, spans = [], []
    for k, rule in enumerate(secrets.RULES):
        pattern = _literal(rule.pattern)
        columns.append(
            f"regexp_extract_all(body, {pattern}, 0) as m{k}, regexp_extract_all(body, {pattern}, {rule.group}) as g{k}, "
            f"string_split_regex(body, {pattern}) as p{k}"
        )
        start = (
            f"(list_sum([length(x) for x in p{k}[1:i]]) + coalesce(list_sum([length(x) for x in m{k}[1:i - 1]]), 0))"
        )
        spans.append(
            f"[{{'start': {start}, 'place': {k}, 'stop': {start} + length(m{k}[i]), 'kind': '{rule.kind}'}} "
            f"for i in range(1, len(m{k}) + 1) if length(g{k}[i]) >= {rule.least}]"
        )
    gathered = " || ".join(spans)
    base = ", ".join(f"'{r.kind}'" for r in secrets.BASE_RULES)
    counts = ", ".join(
        f"cast(len([s for s in found if s.kind = '{r.kind}']) as bigint) as n_{r.kind}" for r in secrets.BASE_RULES
    )
    joined = "array_to_string([s.kind || ':' || s.start || ':' || s.stop for s in {}], ',')"
    return f"""
with bodies as (select doc_id, coalesce(text, '') as body from documents),
matched as (select doc_id, {", ".join(columns)} from bodies),
spans as (select doc_id, list_sort({gathered}) as found from matched)
select doc_id, {counts}, sha256({joined.format(f"[s for s in found if s.kind in ({base})]")}) as base_sha256,
       {joined.format("found")} as spans
from spans
"""


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _levels(name: str, base: str, most: int) -> str:
    """Tables ``name0`` to the highest level of the trees in ``base``: tree, i, n and h."""
    found = [f"{name}0 as materialized (select tree, i, n, h from {base})"]
    for k in range(most):
        found.append(
            f"{name}{k + 1} as materialized (select tree, i // {merkle.RUN} as i, (n + {merkle.RUN - 1}) // {merkle.RUN} as n, "
            f"sha256(string_agg(h, '' order by i)) as h from {name}{k} where n > 1 group by tree, i // {merkle.RUN}, n)"
        )
    return ",\n".join(found)


def _siblings(name: str, leaves: str, most: int) -> str:
    """Columns ``l0, r0, c0, ...`` of ``leaves``: what stands left and right of each node on the way up, and if it has a parent."""
    columns, joins = [], []
    for k in range(most):
        at = f"(x.i // {merkle.RUN**k})"
        run = f"y.tree = x.tree and y.n > 1 and y.i // {merkle.RUN} = {at} // {merkle.RUN}"
        columns.append(
            f"coalesce((select string_agg(h, '' order by i) from {name}{k} y where {run} and y.i < {at}), '') as l{k}, "
            f"coalesce((select string_agg(h, '' order by i) from {name}{k} y where {run} and y.i > {at}), '') as r{k}, "
            f"exists (select 1 from {name}{k} y where {run}) as c{k}"
        )
    return f"select x.*, {', '.join(columns)} from {leaves} x"


def _merkle(levels: int = 6, top_levels: int = 3) -> str:
    """Trees of up to 16 ** 6 leaves, of which there are up to 16 ** 3."""

    def leaf(text: str) -> str:
        parts = [f"coalesce(octet_length(encode(cast({c} as varchar))) || ':' || cast({c} as varchar), '-')" for c in ("doc_id", "source", "lang", "n_chars", text)]
        return f"sha256({' || '.join(parts)})"

    byte = "list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, z: xor(a >> 1, 3988292384 * (a & 1)))"
    letters = "list_transform(string_split(cast(doc_id as varchar), ''), lambda c: cast(ascii(c) as bigint))"
    crc = f"xor(list_reduce([4294967295::bigint] || {letters}, lambda a, b: xor(a >> 8, remainders[(xor(a, b) & 255) + 1])), 4294967295)"
    places = [(side, k) for side, most in (("s", levels), ("t", top_levels)) for k in range(most)]
    named = ", ".join(f"{side}.{c}{k} as {side}_{c}{k}" for side, k in places for c in "lrc")
    joined = " || ".join(f"{side}_{c}{k}" for side, k in places for c in "lr")
    steps, inner = [], "presented"
    for step, (side, k) in enumerate(places, 1):
        folded = f"case when {side}_c{k} then sha256({side}_l{k} || {inner} || {side}_r{k}) else {inner} end"
        steps.append(f"f{step} as (select *, {folded} as x{step} from f{step - 1})")
        inner = f"x{step}"
    return f"""
with crc as materialized (select list_transform(range(256), lambda n: {byte}) as remainders),
leaves as materialized (
    select doc_id, coalesce('=' || source, '-') as tree, {leaf("text")} as h,
           case when {crc} % 5 = 0 then {leaf(f"translate(text, '{UPPER}', '{LOWER}')")} else {leaf("text")} end as presented
    from documents, crc
), placed as materialized (
    select *, row_number() over (partition by tree order by doc_id nulls first, h) - 1 as i, count(*) over (partition by tree) as n from leaves
), {_levels("s", "placed", levels)},
subroots as materialized ({" union all ".join(f"select tree as name, h from s{k} where n = 1" for k in range(levels + 1))}),
groups as materialized (select 'top' as tree, name, h, row_number() over (order by name) - 1 as i, count(*) over () as n from subroots),
{_levels("t", "groups", top_levels)},
own as ({_siblings("s", "placed", levels)}),
above as ({_siblings("t", "groups", top_levels)}),
f0 as (select s.doc_id, s.h as leaf, s.presented, t.h as subroot, {named} from own s join above t on t.name = s.tree),
{", ".join(steps)},
roots as ({" union all ".join(f"select h from t{k} where n = 1" for k in range(top_levels + 1))})
select doc_id, leaf, subroot, h as root, sha256({joined}) as proof_sha256, {inner} as folded_root, {inner} = h as verified
from f{len(steps)}, roots
"""


def _lexical() -> str:
    term = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    lowered = f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{term}')"
    return f"""
with held as (select row_number() over () as row, doc_id, unnest({lowered}) as term from documents),
tf as (select row, doc_id, term, count(*) as tf from held group by row, doc_id, term),
sizes as (select row, sum(tf)::bigint as n from tf group by row),
totals as (select count(*) as documents, sum(n)::bigint as length from sizes),
weights as (select term, cast(floor(1000 * ln((2 * documents + 2)::double / (2 * count(*) + 1)::double)) as bigint) as w from tf, totals group by term, documents),
asked as (select distinct item, item_id, term from (select row_number() over () as item, item_id, unnest({lowered}) as term from benchmark)),
scores as (
    select item, item_id, row, doc_id,
           sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * documents) // length))))::bigint as score
    from asked join tf using (term) join weights using (term) join sizes using (row), totals
    group by item, item_id, row, doc_id
), ranked as (
    select *, row_number() over (partition by item order by score desc, doc_id nulls last) as rank from scores where score > 0
)
select item_id, cast(rank as int) as rank, doc_id, score from ranked where rank <= {lexical.TOP}
"""


ORACLES = {"op5_mixing": _mixing(), "op7_secrets": _secrets(), "op12_merkle": _merkle(), "op13_lexical": _lexical()}
