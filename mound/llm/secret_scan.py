"""Secret scan behind a trigram inverted index (DataFrame functions only).

1. Each rule's regex is turned into a Boolean trigram query: an OR of ANDs
   of trigrams that every match must contain (letters lower-cased).  A rule
   whose regex forces no trigram has no query and scans every text.
2. The inverted index holds, for each trigram that a query names and each
   block of documents, the sorted set of document keys whose text contains it.
   Blocks are hash classes of about ``BLOCK_KEYS`` keys, so a posting list is
   bounded whatever the trigram's frequency.
3. Postings are intersected and united per block; the surviving (key, rule)
   pairs come back to the documents as one small row per key.
4. The regex verifies the candidates and yields the spans.

A document's key is a 64-bit hash of its id and text.  Two rows with equal
keys share their candidate rules; verification is exact per row, so repeated
ids, null ids and hash collisions cannot change a result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from itertools import product
from re import _constants as C
from re import _parser as P

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mound.llm.columns import let, prefix_sums

BLOCK_KEYS = 8192
#: Literal strings that a regex node may stand for; beyond it, the node counts as unknown.
MAX_STRINGS = 64


@dataclass(frozen=True)
class Rule:
    """A kind of secret: ``regex`` (syntax common to Java, RE2 and Python), the
    group whose length is judged, and its least length."""

    kind: str
    regex: str
    group: int
    least: int


#: The order is the order of kinds at equal starts.
BASE_RULES = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?)([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", r"[0-9a-f]+", 0, 32),
)
MORE_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
    Rule("git_token", r"gh[pousr]_[A-Za-z0-9]+", 0, 40),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]+", 0, 15),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]+[.]eyJ[A-Za-z0-9_-]+[.][A-Za-z0-9_-]+", 0, 40),
)
RULES = BASE_RULES + MORE_RULES


# -- regex to trigram query -------------------------------------------------

def _strings(node) -> set[str] | None:
    """All strings that a regex node can match, or None where they are unknown or many."""
    op, arg = node
    if op is C.LITERAL:
        return {chr(arg).lower()}
    if op is C.IN:
        if any(kind is not C.LITERAL for kind, _ in arg) or len(arg) > MAX_STRINGS:
            return None
        return {chr(value).lower() for _, value in arg}
    if op is C.SUBPATTERN:
        return _sequence_strings(arg[3])
    if op is C.BRANCH:
        parts = [_sequence_strings(branch) for branch in arg[1]]
        return None if any(p is None for p in parts) else set().union(*parts)
    if op is C.MAX_REPEAT and arg[:2] == (0, 1):
        inner = _sequence_strings(arg[2])
        return None if inner is None else inner | {""}
    return None


def _sequence_strings(nodes) -> set[str] | None:
    found = {""}
    for node in nodes:
        inner = _strings(node)
        if inner is None or len(found) * len(inner) > MAX_STRINGS:
            return None
        found = {a + b for a, b in product(found, inner)}
    return found


def trigrams(text: str) -> frozenset[str]:
    return frozenset(text[i:i + 3] for i in range(len(text) - 2))


def _and(a: list, b: list) -> list:
    """Conjunction of two ORs of ANDs; an empty AND stands for no condition."""
    return [x | y for x in a for y in b] if len(a) * len(b) <= MAX_STRINGS else max(a, b, key=lambda q: min(map(len, q)))


def _query(nodes) -> list[frozenset[str]]:
    query, known = [frozenset()], {""}
    for node in [*nodes, None]:
        inner = _strings(node) if node else None
        if inner is not None and len(known) * len(inner) <= MAX_STRINGS:
            known = {a + b for a, b in product(known, inner)}
            continue
        query = _and(query, [trigrams(s) for s in known])
        known = inner if inner is not None else {""}
        if node and inner is None:
            op, arg = node
            if op is C.SUBPATTERN:
                query = _and(query, _query(arg[3]))
            elif op is C.BRANCH:
                query = _and(query, [q for branch in arg[1] for q in _query(branch)])
            elif op is C.MAX_REPEAT and arg[0] > 0:
                query = _and(query, _query(arg[2]))
    return query


def trigram_query(regex: str) -> list[frozenset[str]] | None:
    """OR of ANDs of lower-cased trigrams that each match contains; None if some match needs none."""
    query = [q for q in dict.fromkeys(_query(P.parse(regex)))]
    if any(not q for q in query):
        return None
    return [q for q in query if not any(other < q for other in query)]


# -- index and candidates ---------------------------------------------------

def postings(docs: DataFrame, key: Column, text: Column, grams: list[str], blocks: int) -> DataFrame:
    """The inverted index: (block, gram, keys), keys distinct, at most a block's keys each."""
    lower = docs.select(key.alias("key"), F.lower(text).alias("low"))
    held = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(g)), F.lit(g)) for g in grams]))
    return (lower.select("key", F.explode(held).alias("gram"))
            .groupBy(F.pmod(F.col("key"), F.lit(blocks)).alias("block"), "gram")
            .agg(F.collect_set("key").alias("keys")))


def _matches(query: list[frozenset[str]], index: Column) -> Column:
    """Document keys that satisfy a trigram query, from one block's index (gram -> keys)."""
    none = F.array().cast("array<long>")
    keys = lambda gram: F.coalesce(F.element_at(index, F.lit(gram)), none)
    found = none
    for needed in query:
        first, *rest = sorted(needed)
        both = keys(first)
        for gram in rest:
            both = F.array_intersect(both, keys(gram))
        found = F.array_union(found, both)
    return found


def candidates(docs: DataFrame, key: Column, text: Column, rules: tuple[Rule, ...], blocks: int) -> DataFrame | None:
    """(key, rules): the indexed rules that can match, for keys that have any."""
    queries = {r.kind: q for r in rules if (q := trigram_query(r.regex))}
    if not queries:
        return None
    grams = sorted({g for q in queries.values() for needed in q for g in needed})
    index = (postings(docs, key, text, grams, blocks).groupBy("block")
             .agg(F.map_from_entries(F.collect_list(F.struct("gram", "keys"))).alias("index")))
    found = F.array(*[F.struct(F.lit(kind).alias("kind"), _matches(q, F.col("index")).alias("keys"))
                      for kind, q in queries.items()])
    return (index.select(F.explode(found).alias("f"))
            .select("f.kind", F.explode("f.keys").alias("key"))
            .groupBy("key").agg(F.collect_set("kind").alias("rules")))


# -- verification -----------------------------------------------------------

def _spans(text: Column, rule: Rule, order: int) -> Column:
    """Spans of a rule's matches: struct(start, order, end), code points, end exclusive."""
    value = F.regexp_extract_all(text, F.lit(rule.regex), F.lit(rule.group))
    whole = F.regexp_extract_all(text, F.lit(rule.regex), F.lit(0))
    lengths = lambda strings: F.transform(strings, lambda s: F.length(s).cast("long"))
    found = F.struct(lengths(F.split(text, rule.regex, -1)).alias("gaps"), lengths(whole).alias("whole"),
                     lengths(value).alias("judged"))

    def build(m: Column) -> Column:
        steps = F.zip_with(F.slice(m["gaps"], F.lit(1), F.size(m["whole"])), m["whole"], lambda g, w: g + w)
        ends = let(steps, lambda s: let(prefix_sums(s), lambda p: F.zip_with(p, s, lambda a, b: a + b)))
        spans = F.zip_with(ends, m["whole"], lambda end, w: F.struct(
            (end - w).alias("start"), F.lit(order).alias("kind"), end.alias("end")))
        return let(spans, lambda all_spans: F.filter(all_spans, lambda _, i: F.element_at(m["judged"], i + 1) >= rule.least))

    return let(found, build)


def _presieve(rule: Rule) -> str:
    """A cheap necessary test for a rule that scans every text."""
    return f"{rule.regex[:-1]}{{{rule.least}}}" if rule.group == 0 and rule.regex.endswith("]+") else rule.regex


def scan(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id",
         rules: tuple[Rule, ...] = RULES, out: str = "secret_spans", block_keys: int = BLOCK_KEYS) -> DataFrame:
    """``docs`` with ``out``: array of struct(start long, kind int, end long), by start, then kind.

    ``kind`` indexes ``rules``.  Null and empty texts have no spans.  Every
    other column passes through, whatever its name; ``out`` replaces a column
    of that name.  Repeated rows are scanned alike; an empty table stays empty.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    key = F.xxhash64(F.col(id_col), F.col(text_col))
    blocks = max(1, math.ceil(docs.count() / block_keys))
    found = candidates(docs, key, text, rules, blocks)
    inner = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    body = docs.select(inner, key.alias("key"))
    if found is None:
        body = body.withColumn("rules", F.array().cast("array<string>"))
    else:
        body = body.join(found, "key", "left")
    text = F.coalesce(F.col("doc").getField(text_col), F.lit(""))
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
    parts = []
    for order, rule in enumerate(rules):
        may = (F.array_contains("rules", rule.kind) if trigram_query(rule.regex)
               else text.rlike(_presieve(rule)))
        parts.append(F.when(may, _spans(text, rule, order)).otherwise(none))
    spans = F.array_sort(F.concat(*parts))
    return body.select("doc", spans.alias("spans")).select(
        *[F.col("doc").getField(c).alias(c) for c in docs.columns if c != out], F.col("spans").alias(out))


def span_text(spans: Column, rules: tuple[Rule, ...]) -> Column:
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(kinds, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """``text`` with each maximal run of covered code points replaced by ``mark``.

    The text is cut at the spans in one pass: a span that starts inside what
    is already covered only prolongs the cover.
    """
    start = F.struct(F.array().cast("array<string>").alias("parts"), F.lit(0).cast("long").alias("at"))

    def step(state: Column, s: Column) -> Column:
        gap = s["start"] > state["at"]
        first = (F.size(state["parts"]) == 0)
        piece = F.substring(text, (state["at"] + 1).cast("int"), F.greatest(F.lit(0), s["start"] - state["at"]).cast("int"))
        parts = F.when(gap | first, F.concat(state["parts"], F.array(piece))).otherwise(state["parts"])
        return F.struct(parts.alias("parts"), F.greatest(state["at"], s["end"]).alias("at"))

    done = F.aggregate(spans, start, step, lambda state: F.concat(
        F.array_join(state["parts"], mark), F.lit(mark),
        F.substring(text, (state["at"] + 1).cast("int"), F.lit(2**31 - 1))))
    return F.when(F.size(spans) > 0, done).otherwise(text)


def digest(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans for every row of ``docs``."""
    base = F.filter("secret_spans", lambda s: s["kind"] < len(BASE_RULES))
    of_kind = lambda k: F.filter("secret_spans", lambda s: s["kind"] == k)
    counts = [F.size(of_kind(k)).cast("long").alias(f"n_{r.kind}") for k, r in enumerate(BASE_RULES)]
    found = scan(docs.select("doc_id", "text"), rules=rules)
    return found.select("doc_id", *counts, F.sha2(span_text(base, rules), 256).alias("base_sha256"),
                        span_text(F.col("secret_spans"), rules).alias("spans"))


def oracle_sql(rules: tuple[Rule, ...] = RULES) -> str:
    """DuckDB twin of ``digest``: every regex over every text, no index."""
    quoted = lambda r: r.regex.replace("'", "''")
    cols, parts = [], []
    for k, r in enumerate(rules):
        cols.append(f"list_transform(string_split_regex(t, '{quoted(r)}'), lambda x: length(x)) AS g{k}, "
                    f"list_transform(regexp_extract_all(t, '{quoted(r)}'), lambda x: length(x)) AS w{k}, "
                    f"list_transform(regexp_extract_all(t, '{quoted(r)}', {r.group}), lambda x: length(x)) AS v{k}")
        parts.append(f"list_filter(list_transform(range(1, len(w{k}) + 1), lambda i: {{'s': (list_sum(g{k}[1:i]) + coalesce(list_sum(w{k}[1:i-1]), 0))::BIGINT, "
                     f"'k': {k}, 'e': (list_sum(g{k}[1:i]) + list_sum(w{k}[1:i]))::BIGINT, 'v': v{k}[i]}}), lambda x: x.v >= {r.least})")
    kinds = "[" + ", ".join(f"'{r.kind}'" for r in rules) + "]"
    joined = lambda a: f"coalesce(array_to_string(list_transform({a}, lambda x: {kinds}[x.k + 1] || ':' || x.s || ':' || x.e), ','), '')"
    base = f"list_filter(a, lambda x: x.k < {len(BASE_RULES)})"
    counts = ", ".join(f"len(list_filter(a, lambda x: x.k = {k}))::BIGINT AS n_{r.kind}" for k, r in enumerate(BASE_RULES))
    return (f"WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), m AS (SELECT doc_id, {', '.join(cols)} FROM d), "
            f"s AS (SELECT doc_id, list_sort(list_concat({', '.join(parts)})) AS a FROM m) "
            f"SELECT doc_id, {counts}, sha256({joined(base)}) AS base_sha256, {joined('a')} AS spans FROM s")
