"""Secret scan over a trigram inverted index, in DataFrame operations only.

For each rule a Boolean query over trigrams is derived from its regular
expression: a document can hold a match only if it holds all trigrams of one of
the query's alternatives.  The index has one posting (trigram, text key) per
trigram that some rule asks for; equal texts share their postings.  Postings
are intersected per alternative by counting, and only the candidate texts are
verified with the regular expressions themselves.  A rule whose expression
forces no trigram is run over every text.

The index is restricted to trigrams that rules ask for: a posting for every
trigram of every text would shuffle several times the input to answer the same
queries.
"""

from __future__ import annotations

import re._constants as tok
import re._parser as parser
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from refinery.llm.common import written

#: most strings that an exact set may hold before the analysis falls back to trigrams
MOST_EXACT = 64
#: most characters of a class that are spelled out
MOST_CLASS = 10

Query = list[frozenset[str]] | None  # alternatives of trigrams that are all needed; None: anything matches


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern``, leftmost and non-overlapping, whose ``group`` has ``least`` characters or more."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


#: fixed values of the base kinds, in their order; a minimum on a run that ends the pattern stands in it, because
#: a run that is too short can hold no other match
BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
#: further kinds that the operator reports beside the base ones
FURTHER = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[opsu]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 0, 15),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+", 0, 20),
)


def _both(a: Query, b: Query) -> Query:
    if a is None or b is None:
        return b if a is None else a
    if len(a) * len(b) > MOST_EXACT:
        return min(a, b, key=len)
    return _simple([x | y for x, y in product(a, b)])


def _simple(q: list[frozenset[str]]) -> Query:
    """Without alternatives that another one already covers; None where one of them asks for nothing."""
    kept = [x for x in dict.fromkeys(q) if not any(y < x for y in q)]
    return None if frozenset() in kept else kept


def _grams(texts: set[str]) -> Query:
    return _simple([frozenset(t[i:i + 3] for i in range(len(t) - 2)) for t in sorted(texts)])


def _analyse(nodes) -> tuple[set[str] | None, Query]:
    """(all strings that match, if few; the trigram query) of a parsed sequence, letters lower-cased."""
    run, asked, whole = {""}, None, True
    for op, arg in nodes:
        exact, query = _one(op, arg)
        if exact is not None and len(run) * len(exact) <= MOST_EXACT:
            run = {a + b for a, b in product(run, exact)}
            continue
        asked = _both(asked, _grams(run))
        run, whole = ({""} if exact is None else exact), False
        asked = _both(asked, query)
    return (run, None) if whole else (None, _both(asked, _grams(run)))


def _one(op, arg) -> tuple[set[str] | None, Query]:
    if op is tok.LITERAL:
        return {chr(arg).lower()}, None
    if op is tok.AT:
        return {""}, None
    if op is tok.IN and all(o in (tok.LITERAL, tok.RANGE) for o, _ in arg):
        spans = [(a, a) if o is tok.LITERAL else a for o, a in arg]
        if sum(b - a + 1 for a, b in spans) <= MOST_CLASS:
            return {chr(c).lower() for a, b in spans for c in range(a, b + 1)}, None
    if op is tok.SUBPATTERN:
        return _analyse(arg[-1])
    if op is tok.BRANCH:
        parts = [_analyse(x) for x in arg[1]]
        if all(e is not None for e, _ in parts) and sum(len(e) for e, _ in parts) <= MOST_EXACT:
            return set().union(*[e for e, _ in parts]), None
        asked = [q if e is None else _grams(e) for e, q in parts]
        return None, None if any(q is None for q in asked) else _simple([x for q in asked for x in q])
    if op in (tok.MAX_REPEAT, tok.MIN_REPEAT):
        low, high, sub = arg
        exact, query = _analyse(sub)
        if (low, high) == (0, 1) and exact is not None:
            return exact | {""}, None
        if low and exact is not None and len(exact) ** min(low, 4) <= MOST_EXACT:
            texts = {"".join(x) for x in product(exact, repeat=min(low, 4))}
            return (texts, None) if low == high <= 4 else (None, _grams(texts))
        return None, query if low else None
    return None, None


def trigram_query(pattern: str) -> Query:
    """Alternatives of lower-case trigrams that a text must hold for the pattern to match; None: no demand."""
    exact, query = _analyse(parser.parse(pattern))
    return query if exact is None else _grams(exact)


def _key(text: Column) -> Column:
    return F.xxhash64(text)


def postings(texts: DataFrame, grams: Sequence[str]) -> DataFrame:
    """The inverted index over the column ``__text``: distinct ``gram`` (its number) and ``key``."""
    low = texts.select(_key(F.col("__text")).alias("key"), F.lower("__text").alias("low"))
    held = F.array_compact(F.array(*[F.when(F.col("low").contains(g), F.lit(i)) for i, g in enumerate(grams)]))
    return low.select("key", F.explode(held).alias("gram")).distinct()


def candidates(spark: SparkSession, texts: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``key`` and ``__mask``: the rules (bit i: rule i) whose trigram query the text's postings satisfy."""
    asked = [(i, alt) for i, r in enumerate(rules) for alt in trigram_query(r.pattern) or []]
    grams = sorted({g for _, alt in asked for g in alt})
    terms = spark.createDataFrame([(n, grams.index(g), len(alt), 1 << i) for n, (i, alt) in enumerate(asked) for g in alt],
                                  "alt int, gram int, size int, bit long")  # bounded by the rules
    held = (postings(texts, grams).join(F.broadcast(terms), "gram")
            .groupBy("key", "alt", "size", "bit").agg(F.count("*").alias("n")).where("n = size"))
    return written(held.groupBy("key").agg(F.bit_or("bit").alias("__mask")), "secret-candidates")


SPANS = "array<struct<start:int,kind:int,end:int>>"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _blocks(items: Column) -> Column:
    """An array in consecutive blocks of about the square root of its size (one empty block for an empty array)."""
    n = F.size(items)
    width = F.greatest(F.ceil(F.sqrt(n)).cast("int"), F.lit(1))
    return F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)), width), lambda i: F.slice(items, i + 1, width))


def _spans(rule: Rule, number: int) -> Column:
    """Spans of one rule in ``__text``: from the lengths of the matches and of what lies between them.

    A fold that appends copies what it holds at every step, so it runs block by block: n matches cost n times the
    square root of n copies, not n squared.
    """
    between, match = F.split(F.col("__text"), rule.pattern, -1), F.regexp_extract_all("__text", F.lit(rule.pattern), F.lit(0))
    steps = F.zip_with(between, match, lambda gap, one: F.struct(  # the last gap has no match
        F.char_length(gap).alias("gap"), F.char_length(one).alias("len"), F.char_length(one).alias("val")))
    if rule.group:
        value = F.regexp_extract_all("__text", F.lit(rule.pattern), F.lit(rule.group))
        steps = F.zip_with(steps, value, lambda x, v: F.struct(
            x["gap"].alias("gap"), x["len"].alias("len"), F.char_length(v).alias("val")))
    none = F.array().cast(SPANS)

    def step(acc, x):
        end = (acc["at"] + x["gap"] + x["len"]).cast("int")
        one = F.array(F.struct((acc["at"] + x["gap"]).cast("int").alias("start"), F.lit(number).alias("kind"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(x["val"] >= rule.least, F.concat(acc["out"], one)).otherwise(acc["out"]).alias("out"))

    def block(acc, xs):
        return F.aggregate(xs, F.struct(acc["at"].alias("at"), none.alias("out")), step, lambda r: F.struct(
            r["at"].alias("at"), F.concat(acc["out"], F.array(r["out"])).alias("out")))

    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPANS}>").alias("out"))
    found = _let(F.filter(steps, lambda x: x["len"].isNotNull()),
                 lambda xs: F.aggregate(_blocks(xs), start, block, lambda acc: F.flatten(acc["out"])))
    return F.when(F.col("__text").rlike(rule.pattern), found).otherwise(none)


def scan(df: DataFrame, text_col: str = "text", rules: Sequence[Rule] = BASE + FURTHER) -> DataFrame:
    """``df`` with the column ``found``: spans (start, kind number, end) of every rule, by start, then kind.

    Offsets count code points, the end is exclusive.  A null or empty text has no spans; repeated rows and null
    ids are kept row by row; an empty table gives an empty one.  ``df`` may hold any other columns; one named
    ``found`` is replaced.
    """
    spark, named = df.sparkSession, [c for c in df.columns if c != "found"]
    rows = df.select(*[F.col(f"`{c}`") for c in named], F.coalesce(F.col(text_col), F.lit("")).alias("__text"))
    rows = rows.withColumn("__key", _key(F.col("__text")))
    forced = {i for i, r in enumerate(rules) if trigram_query(r.pattern)}
    none = F.array().cast(SPANS)
    sorts = lambda parts: F.array_sort(F.concat(*parts)) if parts else none
    full = [_spans(r, i) for i, r in enumerate(rules) if i not in forced]
    if not forced:
        return rows.select(*named, sorts(full).alias("found"))
    at = candidates(spark, rows.select("__text"), rules).withColumnRenamed("key", "__key")
    some = [F.when(F.col("__mask").bitwiseAND(F.lit(1 << i)) != 0, _spans(r, i)).otherwise(none)
            for i, r in enumerate(rules) if i in forced]
    hits = rows.join(at, "__key").select(*named, sorts(full + some).alias("found"))
    rest = rows.select(*named, "__key", sorts(full).alias("found")).join(at, "__key", "left_anti").select(*named, "found")
    return hits.unionByName(rest)


def redact(text: Column, found: Column, mark: str = "[SECRET]") -> Column:
    """``text`` with every run of overlapping spans replaced by ``mark``.

    Spans are taken in blocks, each with the stretch of text that it covers: cutting from a string walks to the place,
    and appending copies, so both stay within a block.
    """
    def block(acc, xs):
        base = acc["at"]
        far = F.greatest(base, F.array_max(F.transform(xs, lambda x: x["end"])))

        def cut(part):
            def step(r, x):
                gap = F.concat(r["out"], F.substring(part, r["at"] - base + 1, x["start"] - r["at"]), F.lit(mark))
                return F.struct(F.greatest(r["at"], x["end"]).alias("at"),
                                F.when(x["start"] >= r["at"], gap).otherwise(r["out"]).alias("out"))

            return F.aggregate(xs, F.struct(base.alias("at"), F.lit("").alias("out")), step, lambda r: F.struct(
                r["at"].alias("at"), F.concat(acc["out"], F.array(r["out"])).alias("out")))

        return _let(F.substring(text, base + 1, far - base), cut)

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    whole = F.aggregate(_blocks(found), start, block, lambda acc: F.concat(
        F.array_join(acc["out"], ""), F.substring(text, acc["at"] + 1, F.char_length(text))))
    return F.when(F.size(found) > 0, whole).otherwise(text)
