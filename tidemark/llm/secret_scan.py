"""Secrets in texts, found through an inverted index of trigrams. DataFrame functions only.

From each rule's regular expression follows a Boolean query: trigrams of which one set or another must stand in the lower-cased
text of any match. The index has a posting for each such trigram of a document. Intersecting postings gives the candidates of each rule, and only
those are matched. A rule for which no trigram is mandatory is matched against all documents.
"""

from __future__ import annotations

import re._constants as sre
import re._parser as parser
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm.common import saved, table, texts_only

#: Rows of candidates up to which they are broadcast, at well under 100 bytes each; beyond, the join shuffles.
BROADCAST_ROWS = 100_000
#: Strings that are followed one by one through an expression, and sets of trigrams in a query. Beyond, the query asks for less.
MOST = 64

Query = frozenset  # of frozensets of trigrams: any of them, all of its trigrams
ANYTHING: Query = frozenset([frozenset()])


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern``, leftmost and not overlapping, whose group ``group`` has ``least`` characters or more."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


BASE = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    # A run of 24 or more is the same match as a run that is then measured.
    Rule("hex", r"[0-9a-f]{24,}"),
)
MORE = (
    # A class, not a repeated group of words: Java's matcher goes one call deeper with each repeat of a group.
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("forge", r"gh[opsu]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abps]-[A-Za-z0-9-]{10,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
)
RULES = BASE + MORE


def least_sets(sets) -> Query:
    """Without sets that contain another one."""
    kept: list[frozenset] = []
    for s in sorted(set(sets), key=len):
        if not any(k <= s for k in kept):
            kept.append(s)
    return frozenset(kept)


def either(a: Query, b: Query) -> Query:
    both = least_sets(a | b)
    return both if len(both) <= MOST else ANYTHING


def both(a: Query, b: Query) -> Query:
    if len(a) * len(b) > MOST:
        return min(a, b, key=len)
    return least_sets(x | y for x in a for y in b)


def grams_of(strings: set[str]) -> Query:
    return least_sets(frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings)


def _class(items) -> set[str] | None:
    found: set[str] = set()
    for op, value in items:
        if op is sre.LITERAL:
            found.add(chr(value).lower())
        elif op is sre.RANGE and value[1] - value[0] < 8:
            found |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
        else:
            return None
    return found if len(found) <= 8 else None


def _read(nodes) -> tuple[set[str] | None, Query]:
    """All strings that match, if they are few, and what any match asks for besides."""
    query, run = ANYTHING, {""}
    for op, value in nodes:
        strings, asks = None, ANYTHING
        if op is sre.LITERAL:
            strings = {chr(value).lower()}
        elif op is sre.IN:
            strings = _class(value)
        elif op is sre.SUBPATTERN:
            strings, asks = _read(value[-1])
        elif op is sre.BRANCH:
            parts = [_read(branch) for branch in value[1]]
            if all(s is not None for s, _ in parts):
                strings = set().union(*(s for s, _ in parts))
            else:
                asks = frozenset()
                for s, q in parts:
                    asks = either(asks, q if s is None else grams_of(s))
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
            low, high, inner = value
            inner_strings, inner_asks = _read(inner)
            if low == 0:
                strings = {"", *inner_strings} if high == 1 and inner_strings is not None else None
            elif low == high == 1:
                strings, asks = inner_strings, inner_asks
            else:
                asks = inner_asks if inner_strings is None else grams_of(inner_strings)
        elif op is sre.AT:
            strings = {""}
        if strings is not None and len(run) * len(strings) <= MOST:
            run = {a + b for a, b in product(run, strings)}
            continue
        query = both(query, grams_of(run))
        run = {""}
        if strings is not None:
            run = strings
        else:
            query = both(query, asks)
    return (run, query) if query == ANYTHING and _whole(nodes) else (None, both(query, grams_of(run)))


def _whole(nodes) -> bool:
    """Whether each part has few strings, so that the run is all that matches."""
    return all(
        op in (sre.LITERAL, sre.AT)
        or op is sre.IN and _class(v) is not None
        or op is sre.SUBPATTERN and _whole(v[-1])
        or op is sre.BRANCH and all(map(_whole, v[1]))
        or op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and v[1] == 1 and _whole(v[2])
        for op, v in nodes
    )


def trigram_query(pattern: str) -> Query:
    strings, asks = _read(parser.parse(pattern))
    return asks if strings is None else grams_of(strings)


def build_index(docs: DataFrame, grams: list[str]) -> DataFrame:
    """Postings ``gram``, ``doc_id``: that the document's lower-cased text holds the trigram. Null ids have none."""
    low = texts_only(docs).filter("doc_id IS NOT NULL").select("doc_id", F.lower("text").alias("low"))
    held = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(g)), F.lit(g)) for g in grams]))
    return low.select("doc_id", F.explode(held).alias("gram"))


def candidates(postings: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """``doc_id``, ``_kinds``: the rules that may match, by intersecting postings."""
    rows = [(r.kind, n, gram, len(one)) for r in rules for n, one in enumerate(sorted(map(sorted, trigram_query(r.pattern)))) for gram in one]
    clauses = docs_of(postings, rows, "kind string, clause int, gram string, size int")  # a few rows for each rule
    hits = postings.join(F.broadcast(clauses), "gram").groupBy("doc_id", "kind", "clause", "size").agg(F.count_distinct("gram").alias("n"))
    return hits.filter("n = size").groupBy("doc_id").agg(F.collect_set("kind").alias("_kinds"))


def docs_of(like: DataFrame, rows: list[tuple], schema: str) -> DataFrame:
    return like.sparkSession.createDataFrame(rows, schema)


def rule_spans(text: Column, rule: Rule, rank: int) -> Column:
    """Array of (start, rank, end, kind), in code points: the text between matches gives where they begin."""
    between = F.transform(F.split(text, rule.pattern, -1), F.length)
    wholes = F.transform(F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0)), F.length)
    values = wholes if not rule.group else F.transform(F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)), F.length)
    steps = F.arrays_zip(F.slice(between, 1, F.size(wholes)).alias("gap"), wholes.alias("whole"), values.alias("value"))
    span = "struct<start:int,rank:int,end:int,kind:string>"

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        end = start + x["whole"]
        one = F.array(F.struct(start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), F.lit(rule.kind).alias("kind")).cast(span))
        return F.struct(end.alias("at"), F.when(x["value"] >= rule.least, F.concat(acc["out"], one)).otherwise(acc["out"]).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{span}>").alias("out"))
    return F.aggregate(steps, start, step, lambda acc: acc["out"])


def scan(docs: DataFrame, *carry: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``doc_id``, the ``carry`` columns, ``text`` and ``spans``: array of (start, rank, end, kind), sorted.

    ``start`` and ``end`` count code points, the end is exclusive; ``rank`` is the rule's place in ``rules``. A null text counts as
    empty and has no spans. Rows that repeat an id are matched one by one; those without an id are matched against every rule.
    """
    indexed = tuple(r for r in rules if frozenset() not in trigram_query(r.pattern))
    grams = sorted({g for r in indexed for one in trigram_query(r.pattern) for g in one})
    found = saved(candidates(saved(build_index(docs, grams)), indexed))
    few = found.count() <= BROADCAST_ROWS
    found = found.withColumnRenamed("doc_id", "_of")
    whole = texts_only(docs, *carry)
    with_kinds = whole.join(F.broadcast(found) if few else found, F.col("doc_id") == F.col("_of"), "left")
    none = F.array().cast("array<struct<start:int,rank:int,end:int,kind:string>>")
    parts = []
    for rank, rule in enumerate(rules):
        may = F.col("text").rlike(rule.pattern)
        if rule in indexed:
            may = (F.array_contains("_kinds", rule.kind) | F.col("doc_id").isNull()) & may
        parts.append(F.when(may, rule_spans(F.col("text"), rule, rank)).otherwise(none))
    return with_kinds.select("doc_id", *carry, "text", F.array_sort(F.flatten(F.array(*parts))).alias("spans"))


def span_list(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def masked(text: Column, spans: Column) -> Column:
    """The text with ``[kind]`` in place of each span; of spans that overlap, the first gives the name."""

    def step(acc: Column, s: Column) -> Column:
        new = s["start"] >= acc["at"]
        gap = F.concat(F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit("["), s["kind"], F.lit("]"))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(new, F.concat(acc["out"], F.array(gap))).otherwise(acc["out"]).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    rest = lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(text, acc["at"] + 1, F.length(text)))
    return F.when(F.size(spans) > 0, F.aggregate(spans, start, step, rest)).otherwise(text)


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"))
    of = lambda *kinds: F.filter("spans", lambda s: s["kind"].isin(*kinds))
    return found.select(
        "doc_id",
        *[F.size(of(r.kind)).cast("long").alias(f"n_{r.kind}") for r in BASE],
        F.sha2(span_list(of(*[r.kind for r in BASE])).cast("binary"), 256).alias("base_sha256"),
        span_list(F.col("spans")).alias("spans"),
    )


def _kind_sql(rank: int, rule: Rule) -> str:
    pattern = rule.pattern.replace("'", "''")
    return f"""SELECT doc_id, '{rule.kind}' AS kind, {rank} AS rank, i,
    list_sum(list_transform(parts[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(wholes[1:i - 1], lambda x: length(x))), 0) AS start,
    length(wholes[i]) AS size, length(vals[i]) >= {rule.least} AS fits
  FROM (SELECT *, unnest(range(1, len(wholes) + 1)) AS i FROM (
    SELECT doc_id, string_split_regex(text, '{pattern}') AS parts, regexp_extract_all(text, '{pattern}', 0) AS wholes, regexp_extract_all(text, '{pattern}', {rule.group}) AS vals
    FROM documents WHERE regexp_matches(text, '{pattern}')))"""


SQL = f"""
WITH found AS (
  {" UNION ALL ".join(_kind_sql(k, r) for k, r in enumerate(RULES))}
), named AS (
  SELECT *, kind || ':' || CAST(CAST(start AS BIGINT) AS VARCHAR) || ':' || CAST(CAST(start + size AS BIGINT) AS VARCHAR) AS span FROM found WHERE fits
)
SELECT d.doc_id, {", ".join(f"count(*) FILTER (WHERE kind = '{r.kind}') AS n_{r.kind}" for r in BASE)},
  sha256(coalesce(string_agg(span, ',' ORDER BY start, rank) FILTER (WHERE rank < {len(BASE)}), '')) AS base_sha256,
  coalesce(string_agg(span, ',' ORDER BY start, rank), '') AS spans
FROM documents d LEFT JOIN named n ON d.doc_id = n.doc_id GROUP BY d.doc_id
"""
