"""Secret scans through a trigram index. DataFrame functions only: nothing here runs Python on executors."""

from __future__ import annotations

import re
from dataclasses import dataclass
from re import _constants as sre
from re import _parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A Boolean query over trigrams: True, a trigram, or ("and" | "or", parts).
Query = bool | str | tuple

MOST_ALTERNATIVES = 64


@dataclass(frozen=True)
class Rule:
    """``pattern`` is found leftmost and without overlaps; matches then need ``min_length`` code points in ``group``."""

    kind: str
    pattern: str
    min_length: int = 0
    group: int = 0


BASE_RULES = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2),
    Rule("access", r"AKIA[A-Z0-9]+", 20),
    Rule("hex", r"[0-9a-f]+", 24),
)
# A private key reaches from BEGIN to END, over all that has no five dashes in a row. Where END is missing it takes
# the header lines and base64 that follow, and a short last line of it that stands alone. RE2 has no lookahead and
# multiplies nested repeats up to 1000, Java takes stack for each repeat of a group: hence the form and the bounds.
_KEY_BEGIN, _KEY_END = "-----BEGIN [A-Z ]*PRIVATE KEY-----", "-----END [A-Z ]*PRIVATE KEY-----"
_KEY_GAP, _KEY_LETTER = r"""[\x20\t\r\n\\"'+,>|#*]*""", "[A-Za-z0-9+/=]"
_KEY_HEADERS = rf"(?:{_KEY_GAP}(?:Proc-Type|DEK-Info|Comment|Version):[^\r\n\\]*){{0,4}}"
_KEY_REST = rf"{_KEY_HEADERS}(?:{_KEY_GAP}{_KEY_LETTER * 16}+){{1,200}}(?:\r?\n[\x20\t]*{_KEY_LETTER}{{1,15}}(?:\r?\n|$))?"
MORE_RULES = (
    Rule("private_key", rf"{_KEY_BEGIN}(?:[^-]*(?:--?-?-?[^-]+){{0,400}}{_KEY_END}|{_KEY_REST})?"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("code_host", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("url_login", r"://[^\x00-\x20:/@]{1,64}:[^\x00-\x20:/@]{3,64}@"),
)
RULES = BASE_RULES + MORE_RULES


# --- from a pattern to a query

def _cross(left: set[str] | None, right: set[str] | None) -> set[str] | None:
    """Concatenations of two sets of strings; None stands for any string."""
    if left is None or right is None or len(left) * len(right) > MOST_ALTERNATIVES:
        return None
    return {a + b for a in left for b in right}


def _all(parts: list[Query]) -> Query:
    parts = sorted({p for p in parts if p is not True}, key=str)
    return True if not parts else parts[0] if len(parts) == 1 else ("and", *parts)


def _any(parts: list[Query]) -> Query:
    if not parts or any(p is True for p in parts):
        return True
    parts = sorted(set(parts), key=str)
    return parts[0] if len(parts) == 1 else ("or", *parts)


def _of_strings(strings: set[str] | None) -> Query:
    """Trigrams that a text with one of the strings must have."""
    if strings is None:
        return True
    return _any([_all([s[i:i + 3] for i in range(len(s) - 2)]) for s in strings])


def _walk(tokens) -> tuple[set[str] | None, list[Query]]:
    """Strings that the tokens may match, if few, and queries that any match satisfies."""
    exact: set[str] | None = {""}
    whole = True
    needs: list[Query] = []
    for kind, value in tokens:
        strings: set[str] | None = None
        if kind is sre.LITERAL:
            strings = {chr(value).lower()}
        elif kind is sre.IN and all(k is sre.LITERAL for k, _ in value):
            strings = {chr(v).lower() for _, v in value}
        elif kind is sre.SUBPATTERN:
            strings, inner = _walk(value[-1])
            needs += inner
        elif kind is sre.BRANCH:
            branches = [_walk(branch) for branch in value[1]]
            sets = [b[0] for b in branches]
            strings = None if any(s is None for s in sets) else set().union(*sets)
            if strings is None:
                needs.append(_any([_all([*inner, _of_strings(s)]) for s, inner in branches]))
        elif kind in (sre.MAX_REPEAT, sre.MIN_REPEAT):
            low, high, body = value
            inner_strings, inner = _walk(body)
            if low:
                needs += inner
                strings = inner_strings if (low, high) == (1, 1) else None
                if strings is None:
                    needs.append(_of_strings(inner_strings))
            elif high == 1 and inner_strings is not None:
                strings = inner_strings | {""}
        joined = _cross(exact, strings)
        if joined is None:
            needs.append(_of_strings(exact))
            joined = strings if strings is not None else None
        exact = joined if joined is not None else {""}
        if joined is None or strings is None:
            exact = {""}
            whole = False
    if not whole:
        return None, [*needs, _of_strings(exact)]
    return exact, needs


def trigram_query(pattern: str) -> Query:
    """What trigrams of the lower-cased text every match of the pattern implies; True where nothing is mandatory."""
    exact, needs = _walk(_parser.parse(pattern))
    return _all([*needs, _of_strings(exact)])


def trigrams_of(query: Query) -> set[str]:
    if isinstance(query, bool):
        return set()
    if isinstance(query, str):
        return {query}
    return set().union(*(trigrams_of(part) for part in query[1:]))


def satisfied(query: Query, held: Column) -> Column:
    """The query over a document's postings."""
    if isinstance(query, bool):
        return F.lit(query)
    if isinstance(query, str):
        return F.array_contains(held, query)
    out = satisfied(query[1], held)
    for part in query[2:]:
        out = (out & satisfied(part, held)) if query[0] == "and" else (out | satisfied(part, held))
    return out


# --- index, intersection, verification

def postings(docs: DataFrame, trigrams: set[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Inverted index: ``(trigram, doc_id)`` for the wanted trigrams of the lower-cased texts."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.lower(F.col(text_col)).alias("text"))
    held = F.filter(F.array(*[F.lit(t) for t in sorted(trigrams)]), lambda t: F.contains(F.col("text"), t))
    return rows.select("doc_id", F.explode(held).alias("trigram"))


def candidates(index: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``(doc_id, rules)``: the rules whose query the document's postings satisfy, for documents with one at least."""
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    held = index.groupBy("doc_id").agg(F.collect_set("trigram").alias("held"))
    met = F.filter(F.array(*[
        F.when(satisfied(q, F.col("held")), F.lit(kind)) for kind, q in queries.items() if q is not True
    ]), lambda k: k.isNotNull())
    return held.select("doc_id", met.alias("rules")).where("size(rules) > 0")


def _spans(text: Column, rule: Rule) -> Column:
    """All matches of a rule in a text as ``(kind, start, end)`` in code points, end exclusive.

    The pieces between the matches give the places: each match starts where the pieces and matches before it end.
    """
    pattern = F.lit(rule.pattern)
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    proofs = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else matches
    joined = F.arrays_zip(F.split(text, rule.pattern, -1).alias("piece"), matches.alias("match"), proofs.alias("proof"))
    start = F.aggregate(
        joined, F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<kind:string,start:int,end:int>>").alias("spans")),
        lambda acc, x: F.struct(
            (acc["at"] + F.length(x["piece"]) + F.coalesce(F.length(x["match"]), F.lit(0))).alias("at"),
            F.when(
                x["match"].isNotNull() & (F.length(x["proof"]) >= rule.min_length),
                F.concat(acc["spans"], F.array(F.struct(
                    F.lit(rule.kind).alias("kind"), (acc["at"] + F.length(x["piece"])).alias("start"),
                    (acc["at"] + F.length(x["piece"]) + F.length(x["match"])).alias("end"),
                ))),
            ).otherwise(acc["spans"]).alias("spans"),
        ),
        lambda acc: acc["spans"],
    )
    return F.when(text.rlike(rule.pattern if rule.min_length == 0 or rule.group else _at_least(rule)), start).otherwise(
        F.array().cast("array<struct<kind:string,start:int,end:int>>"))


def _at_least(rule: Rule) -> str:
    """A pattern that any text with a long enough match has: the last repeat must go on for the missing characters."""
    parsed = list(_parser.parse(rule.pattern))
    fixed = sum(kind is sre.LITERAL for kind, _ in parsed)
    if parsed[-1][0] is sre.MAX_REPEAT and fixed == len(parsed) - 1 and rule.pattern.endswith("+"):
        return f"{rule.pattern[:-1]}{{{rule.min_length - fixed},}}"
    return rule.pattern


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``(doc_id, text, spans)`` per row; spans are ``(kind, start, end)`` by start, then in the order of the rules.

    Rules with mandatory trigrams are verified only in the documents that the index names for them; the others
    scan every text. A null text is empty and has no spans; repeated rows and repeated ids are scanned alike, a
    null id too. An empty table gives no rows. Other columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    wanted = set().union(*(trigrams_of(q) for q in queries.values()))
    if wanted:
        named = candidates(postings(rows, wanted), rules).select(F.col("doc_id").alias("named_id"), "rules")
        rows = rows.join(named, F.col("doc_id").eqNullSafe(F.col("named_id")), "left").drop("named_id")
    none = F.array().cast("array<struct<kind:string,start:int,end:int>>")
    found = [
        _spans(F.col("text"), r) if queries[r.kind] is True else
        F.when(F.array_contains("rules", r.kind), _spans(F.col("text"), r)).otherwise(none) for r in rules
    ]
    order = F.create_map(*[F.lit(x) for i, r in enumerate(rules) for x in (r.kind, i)])
    ranked = F.transform(F.concat(*found), lambda s: F.struct(s["start"], order[s["kind"]].alias("rank"), s["end"], s["kind"]))
    spans = F.transform(F.array_sort(ranked), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return rows.select("doc_id", "text", spans.alias("spans"))


def span_text(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with each stretch that spans cover replaced by the mark once; overlapping spans merge."""
    state = F.aggregate(
        spans, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda acc, s: F.when(s["end"] <= acc["at"], acc).otherwise(F.struct(
            s["end"].alias("at"),
            F.when(s["start"] < acc["at"], acc["out"]).otherwise(
                F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark))).alias("out"),
        )),
    )
    done = F.concat(state["out"], F.substring(text, state["at"] + 1, F.length(text)))
    return F.when(F.size(spans) == 0, text).otherwise(done)
