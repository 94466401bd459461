"""The secret scan as DuckDB SQL."""

from __future__ import annotations

from millrace.llm.secrets import BASE_RULES, RULES, Rule


def _found(rule: Rule) -> str:
    """Places of one rule: pieces between matches and matches in turn."""
    pattern = rule.pattern.replace("'", "''")
    return f"""
        select doc_id, n, spans_of from (select doc_id, n, list_filter(list_transform(range(1, len(m) + 1), lambda i: struct_pack(
            kind := '{rule.kind}', first := coalesce(list_sum(list_transform(p[1:i], lambda x: length(x))), 0)::bigint
                + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0)::bigint,
            size := length(m[i]), proof := length(g[i]))), lambda s: s.proof >= {rule.min_length}) as spans_of
        from (select doc_id, n, regexp_extract_all(t, '{pattern}', 0) as m, regexp_extract_all(t, '{pattern}', {rule.group}) as g,
                     string_split_regex(t, '{pattern}') as p from texts))"""


_SPAN = "s.kind || ':' || s.first::varchar || ':' || (s.first + s.size)::varchar"
_RANK = "case s.kind " + " ".join(f"when '{r.kind}' then {i}" for i, r in enumerate(RULES)) + " end"
_BASE = ", ".join(f"'{r.kind}'" for r in BASE_RULES)

SECRETS_SQL = f"""
    with texts as (select doc_id, coalesce(text, '') as t, row_number() over () as n from documents),
    found as ({' union all '.join(_found(r) for r in RULES)}),
    spans as (select n, unnest(spans_of) as s from found),
    listed as (
        select n, string_agg({_SPAN}, ',' order by s.first, {_RANK}) as every,
               string_agg({_SPAN}, ',' order by s.first, {_RANK}) filter (s.kind in ({_BASE})) as base,
               {', '.join(f"count(*) filter (s.kind = '{r.kind}') as n_{r.kind}" for r in BASE_RULES)}
        from spans group by n)
    select doc_id, {', '.join(f'coalesce(n_{r.kind}, 0)::bigint as n_{r.kind}' for r in BASE_RULES)},
           sha256(coalesce(base, '')) as base_sha256, coalesce(every, '') as spans
    from texts left join listed using (n)
"""
