"""Secret scans through a trigram inverted index, in DataFrame operations only.

Every rule is a regular expression. From it follows a Boolean query of trigrams that each match must
contain. Postings of the asked trigrams are intersected into candidate rows for each rule; only those
are run through the regular expression. A rule without mandatory trigrams scans every row.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product
from re import _constants as op
from re import _parser as parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import col, fresh, replace_columns, stored

MAX_STRINGS = 64
MAX_TERMS = 64


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of ``pattern`` whose ``group`` has ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


# Fixed values. A run of 24 or more is the same as a run that has 24 characters or more.
RULES = [
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
                   r"([A-Za-z0-9+/_.=-]+)", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}"),
]

# --- trigram queries ---------------------------------------------------------------------------
# A query is a list of alternatives, each a set of trigrams that must all be there.

Query = list[frozenset[str]]


def _either(terms: Query) -> Query:
    """Alternatives without those that another one already covers."""
    terms = sorted(set(terms), key=len)
    kept: Query = []
    for t in terms:
        if not any(k <= t for k in kept):
            kept.append(t)
    return kept if len(kept) <= MAX_TERMS else [frozenset()]


def _both(a: Query, b: Query) -> Query:
    if len(a) * len(b) > MAX_TERMS:
        return a  # fewer conditions: more candidates, none lost
    return _either([x | y for x in a for y in b])


def _of_strings(strings: set[str]) -> Query:
    return _either([frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in strings])


def _strings(kind, value) -> set[str] | None:
    """All lower-case strings that an element stands for, if they are few and ASCII."""
    if kind is op.LITERAL:
        return {chr(value).lower()} if value < 128 else None
    if kind is op.IN:
        found: set[str] = set()
        for k, v in value:
            if k is op.LITERAL and v < 128:
                found.add(chr(v).lower())
            elif k is op.RANGE and v[1] < 128 and v[1] - v[0] < 4:
                found |= {chr(c).lower() for c in range(v[0], v[1] + 1)}
            else:
                return None
        return found if len(found) <= 4 else None
    if kind is op.SUBPATTERN:
        return _sequence_strings(value[-1])
    if kind is op.BRANCH:
        parts = [_sequence_strings(x) for x in value[1]]
        return None if None in parts else set().union(*parts)
    if kind in (op.MAX_REPEAT, op.MIN_REPEAT) and value[1] == 1:
        inner = _sequence_strings(value[2])
        return None if inner is None else inner | ({""} if value[0] == 0 else set())
    return {""} if kind is op.AT else None


def _sequence_strings(items) -> set[str] | None:
    out = {""}
    for kind, value in items:
        got = _strings(kind, value)
        if got is None or len(out) * len(got) > MAX_STRINGS:
            return None
        out = {a + b for a, b in product(out, got)}
    return out


def _element(kind, value) -> Query:
    if kind is op.SUBPATTERN:
        return _sequence(value[-1])
    if kind is op.BRANCH:
        return _either([t for x in value[1] for t in _sequence(x)])
    if kind in (op.MAX_REPEAT, op.MIN_REPEAT) and value[0] >= 1:
        return _sequence(value[2])
    return [frozenset()]


def _sequence(items) -> Query:
    needed, run = [frozenset()], {""}
    for kind, value in items:
        got = _strings(kind, value)
        if got is not None and len(run) * len(got) <= MAX_STRINGS:
            run = {a + b for a, b in product(run, got)}
            continue
        needed, run = _both(needed, _of_strings(run)), {""}
        if got is None:
            needed = _both(needed, _element(kind, value))
        else:
            run = got
    return _both(needed, _of_strings(run))


def trigram_query(pattern: str) -> Query | None:
    """What every match holds, as alternatives of trigrams; None if nothing is mandatory."""
    found = _sequence(parser.parse(pattern))
    return None if frozenset() in found else found


# --- index ---------------------------------------------------------------------------------------


def postings(df: DataFrame, key: str, text: str, trigrams: list[str]) -> DataFrame:
    """Inverted index of the given trigrams over lower-cased texts: ``trigram``, ``key``."""
    low = F.lower(col(text))
    held = F.array_compact(F.array(
        *[F.when(F.contains(low, F.lit(t)), F.lit(t)) for t in trigrams]
    ))
    return df.select(F.explode(held).alias("trigram"), col(key).alias("key"))


def candidates(index: DataFrame, wanted: dict[str, Query]) -> DataFrame:
    """Keys whose postings meet a rule's query: ``key`` and the ``kinds`` to verify."""
    terms = [
        F.struct(F.lit(t).alias("trigram"), F.lit(kind).alias("kind"), F.lit(n).alias("term"),
                 F.lit(len(term)).alias("size"))
        for kind, alternatives in wanted.items()
        for n, term in enumerate(alternatives) for t in sorted(term)
    ]
    asked = index.sparkSession.range(0, 1, 1, 1).select(F.explode(F.array(*terms)).alias("t"))
    met = index.join(F.broadcast(asked.select("t.*")), "trigram")
    whole = met.groupBy("key", "kind", "term", "size").agg(
        F.size(F.collect_set("trigram")).alias("n")
    ).filter("n = size")
    return whole.groupBy("key").agg(F.collect_set("kind").alias("kinds"))


# --- verification --------------------------------------------------------------------------------

_SPANS = "array<struct<start:int,order:int,end:int,kind:string>>"


def find(text: Column, rule: Rule, order: int) -> Column:
    """Spans of a rule in a text, in code points.

    The pieces between the matches give their places, since Spark returns the matches alone.
    """
    pattern = F.lit(rule.pattern)
    item = F.arrays_zip(
        F.split(text, rule.pattern, -1).alias("gap"),
        F.regexp_extract_all(text, pattern, F.lit(0)).alias("hit"),
        F.regexp_extract_all(text, pattern, F.lit(rule.group)).alias("value"),
    )

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["gap"])
        end = start + F.length(x["hit"])
        span = F.struct(start.alias("start"), F.lit(order).alias("order"), end.alias("end"),
                        F.lit(rule.kind).alias("kind"))
        return F.struct(
            end.alias("at"),
            F.when(F.length(x["value"]) >= rule.least, F.concat(acc["found"], F.array(span)))
            .otherwise(acc["found"]).alias("found"),
        )

    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("found"))
    hits = F.filter(item, lambda x: x["hit"].isNotNull())
    spans = F.aggregate(hits, start, step, lambda acc: acc["found"])
    return F.when(F.rlike(text, pattern), spans).otherwise(F.array().cast(_SPANS))


def scan(
    df: DataFrame, text: str = "text", out: str = "secrets", *, key: str = "doc_id",
    rules: list[Rule] = RULES,
) -> DataFrame:
    """Adds the spans of all rules, by start, then in the order of the rules.

    ``out`` is an array of (start, order, end, kind) with code points, end exclusive. A null text
    counts as empty and has none. Rows are told apart by ``key`` and text; repeated rows share their
    index entries and are each returned, a null key is a value like any other. Rules without a
    mandatory trigram are run on every row. An input column called ``out`` is replaced.
    """
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    wanted = {k: q for k, q in queries.items() if q is not None}
    row_key, kinds, plain = fresh(df, "row_key", "kinds", "plain")
    keyed = df.withColumn(plain, F.coalesce(col(text).cast("string"), F.lit("")))
    keyed = keyed.withColumn(row_key, F.xxhash64(col(key), col(plain)))
    if wanted:
        trigrams = sorted({t for q in wanted.values() for term in q for t in term})
        index = stored(postings(keyed, row_key, plain, trigrams), "trigram-postings")
        hits = candidates(index, wanted).select(
            F.col("key").alias(row_key), F.col("kinds").alias(kinds)
        )
        keyed = keyed.join(hits, row_key, "left")
    none = F.array().cast(_SPANS)
    found = [
        F.when(F.array_contains(col(kinds), r.kind), find(col(plain), r, n)).otherwise(none)
        if r.kind in wanted else find(col(plain), r, n)
        for n, r in enumerate(rules)
    ]
    keyed = replace_columns(keyed, **{out: F.array_sort(F.concat(*found))})
    return keyed.drop(row_key, kinds, plain)


def redact(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """A text with every span replaced by ``mark``; spans that overlap become one mark."""

    def step(acc: Column, s: Column) -> Column:
        between = F.substring(text, acc["at"] + 1, s["start"] - acc["at"])
        apart = s["start"] >= acc["at"]
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(apart, F.concat(acc["parts"], F.array(between, F.lit(mark))))
            .otherwise(acc["parts"]).alias("parts"),
        )

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))
    return F.aggregate(
        spans, start, step,
        lambda acc: F.concat(F.array_join(acc["parts"], ""),
                             F.substring(text, acc["at"] + 1, F.length(text))),
    )
