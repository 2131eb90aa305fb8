"""Document fingerprints by consistent weighted sampling, in DataFrame operations only.

A document is its set of words, each weighted by its number of occurrences.  For
sample ``i`` and word ``k`` a hash of both gives ``r`` and ``c``, distributed as
Gamma(2, 1), and ``b``, uniform in [0, 1).  With weight ``w``, ``t = floor(ln w / r + b)``
and ``ln a = ln c - r * (t - b + 1)``; the sample is the word of the smallest ``a``.
``a`` is a function of the word and ``t`` alone, so two documents have the same
minimum exactly where they drew the same (word, t), and the share of equal
samples estimates the sum of the smaller weights over the sum of the larger.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F

SAMPLES = 32
#: hexadecimal digits that stand for one sample
DIGITS = 8
#: rows of one range of ids, and the most ranges (the driver holds one row of each)
RANGE_ROWS, MOST_RANGES = 200, 50_000


def uniform(term: str, number: int, high: bool) -> str:
    """SQL of a uniform variate in (0, 1): one half of a hash of ``term`` and ``number``."""
    return f"(((shiftrightunsigned(xxhash64({term}, {number}), {32 if high else 0}) & 4294967295) + 0.5D) / 4294967296D)"


def gamma(term: str, number: int) -> str:
    """SQL of a Gamma(2, 1) variate: the sum of two exponential ones."""
    return f"(-ln({uniform(term, number, False)} * {uniform(term, number, True)}))"


def terms(rows: DataFrame, keys: list[str], text_col: str) -> DataFrame:
    """``keys``, ``term`` (hash of a word; null for a text without words) and ``lnw``, the logarithm of its count."""
    word = F.explode(F.split(F.col(text_col), r"[\x20\x09-\x0D]+")).alias("word")
    found = rows.select(*keys, word).select(*keys, F.expr("if(word = '', null, xxhash64(word))").alias("term"))
    return found.groupBy(*keys, "term").agg(F.count("*").alias("n")).select(
        *keys, "term", F.ln(F.col("n").cast("double")).alias("lnw"))


def signatures(rows: DataFrame, keys: list[str], text_col: str, samples: int = SAMPLES) -> DataFrame:
    """``keys`` and ``fp``: ``samples`` samples of each text, as ``DIGITS`` hexadecimal digits each.

    ``keys`` must tell the rows apart.  Where ``rows`` is already partitioned by some of them, nothing is
    shuffled.  A text without words (null texts must be made empty before) has a fingerprint of zeros.
    """
    def smallest(i: int) -> Column:
        r, c, b = gamma("term", 3 * i), gamma("term", 3 * i + 1), uniform("term", 3 * i + 2, False)
        return F.expr(f"min(if(term is null, null, ln({c}) - {r} * (floor(lnw / {r} + {b}) - {b} + 1)))").alias(f"a{i}")

    found = terms(rows, keys, text_col)
    drawn = found.groupBy(*keys).agg(*[smallest(i) for i in range(samples)])
    digits = [F.expr(f"if(a{i} is null, '{'0' * DIGITS}', lpad(lower(hex(xxhash64(a{i}) & 4294967295)), {DIGITS}, '0'))")
              for i in range(samples)]
    return drawn.select(*keys, F.concat(*digits).alias("fp"))


def likeness(a: Column, b: Column, samples: int = SAMPLES) -> Column:
    """Share of equal samples of two fingerprints."""
    same = [F.substring(a, i * DIGITS + 1, DIGITS) == F.substring(b, i * DIGITS + 1, DIGITS) for i in range(samples)]
    return sum((s.cast("int") for s in same), F.lit(0)) / F.lit(float(samples))


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows in descending id, each beside the next one's text, by ranges of ids.

    Returns ``part`` (the range), ``no`` (1, 2, ... within it), ``own``, ``id``, ``text``, ``next_text``.  The
    last row of a range sees a copy of the row that follows it in another range (``own`` false, always the
    highest ``no``); the last row of all is followed by the first.  Equal ids go by a hash of the text, null
    ids come last, a null text is empty.  The texts are shuffled once; the driver holds the top row's id of
    each range, at most ``MOST_RANGES``.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("ord", F.coalesce("id", F.lit(-(1 << 63)))).withColumn("h", F.xxhash64("text"))
    rows = rows.withColumn("_x", F.col("ord").cast("double"))
    n = rows.count()
    ranges = int(min(MOST_RANGES, max(1, n // RANGE_ROWS)))
    inner = sorted(set(rows.approxQuantile("_x", [i / ranges for i in range(1, ranges)], 0.25 / ranges))) if ranges > 1 else []
    edges = [float("-inf"), *inner, float("inf")]
    if len(edges) == 2:
        rows = rows.withColumn("part", F.lit(0.0))
    else:
        rows = Bucketizer(splits=edges, inputCol="_x", outputCol="part").transform(rows)
    rows = rows.select(F.col("part").cast("int").alias("part"), "ord", "h", "id", "text")
    tops = rows.groupBy("part").agg(F.max(F.struct("ord", (-F.col("h").cast("decimal(20,0)")).alias("g"))).alias("top"))
    tops = [(r["part"], r["top"]["ord"], -int(r["top"]["g"])) for r in tops.sort("part").collect()]
    heads = spark.createDataFrame([(tops[(i + 1) % len(tops)][0], o, h) for i, (_, o, h) in enumerate(tops)],
                                  "_to int, _o long, _h long")
    copies = (rows.join(F.broadcast(heads), (rows["ord"] == heads["_o"]) & (rows["h"] == heads["_h"]))
              .select(F.col("_to").alias("part"), "ord", "h", "id", "text", F.lit(False).alias("own")).dropDuplicates(["part"]))
    order = Window.partitionBy("part").orderBy(F.desc("own"), F.desc("ord"), "h")
    return (rows.withColumn("own", F.lit(True)).unionByName(copies)
            .withColumn("next_text", F.lead("text").over(order)).withColumn("no", F.row_number().over(order))
            .select("part", "no", "own", "id", "text", "next_text"))


def edited(text: Column, after: Column) -> Column:
    """``text`` with its last half (rounded down) replaced by as many first characters of ``after`` (or all)."""
    half = F.floor(F.char_length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.char_length(text) - half), F.substring(after, F.lit(1), half))


def compare_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", samples: int = SAMPLES) -> DataFrame:
    """One row per document: its fingerprint, that of its edited text, and its likeness to that and to the next document's.

    Returns ``id_col``, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``, ``near_edited``,
    ``near_next``.  See :func:`with_next` for ties and nulls; a single document is its own next one; texts
    without words are alike (1.0) and unlike all others (0.0); an empty table gives an empty one; other
    columns are ignored.
    """
    rows = with_next(docs, id_col, text_col)
    rows = rows.withColumn("edited", F.when(F.col("own"), edited(F.col("text"), F.col("next_text"))))
    # the facts of a document travel as a third text without words, so that nothing has to be joined to it again
    facts = F.concat_ws("|", F.col("own").cast("string"), F.char_length("text").cast("string"), F.sha2("edited", 256))
    one = lambda which, text, fact: F.struct(
        F.lit(which).alias("which"), text.alias("text"), fact.alias("facts"))
    none, empty = F.lit(None).cast("string"), F.lit("")
    three = F.explode(F.array(one(0, F.col("text"), none), one(1, F.coalesce("edited", empty), none), one(2, empty, facts)))
    texts = rows.select("part", "no", "id", three.alias("one")).select("part", "no", "id", "one.which", "one.facts", "one.text")
    prints = signatures(texts, ["part", "no", "id", "which", "facts"], "text", samples).groupBy("part", "no").agg(
        F.max("id").alias("id"), F.max("facts").alias("facts"),
        F.max(F.when(F.col("which") == 0, F.col("fp"))).alias("fingerprint"),
        F.max(F.when(F.col("which") == 1, F.col("fp"))).alias("edited_fingerprint"))
    after = F.lead("fingerprint").over(Window.partitionBy("part").orderBy("no"))
    fact = F.split("facts", r"\|")
    return (prints.withColumn("_after", after).where(F.get(fact, F.lit(0)) == "true").select(
        F.col("id").alias(id_col), F.get(fact, F.lit(1)).cast("long").alias("n_chars"),
        F.get(fact, F.lit(2)).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint"), samples).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("_after"), samples).alias("near_next")))
