"""Mixing sources to target weights by Efraimidis-Spirakis sampling (operator 7).

Targets: sources in code-point order (null last) weigh 3, 1, 2 and so on in
turn and share ``SHARE`` of all words; no target exceeds ``MAX_REPEAT`` times
its source, and what is over goes to the others by weight.

Selection: each source first gives its complete epochs (every document
``floor(target / size of the source)`` times). The rest is sampled without
replacement: a document's key is ``-ln(u) / weight``, u being a hash of the
document and weight its quality; documents are taken in the order of their
keys until the budget is full. The one at the budget's edge gives the words
still missing, so a source's total is its target, rounded down.

A source's documents are never sorted in one task: keys fall into ``BUCKETS``
ranges of their logarithm whose sizes are summed per task; running totals, first
over groups of ``2 ** GROUP_BITS`` ranges and then inside one group, find the
range holding the edge. That range is cut into ``BUCKETS`` finer ones in the
same way, and only the rows of the one that holds the edge are put in order. An
exponential key's logarithm has a density of at most 1/e whatever its weight, so
no range holds more than about a thousandth of its source at the first cut.
Texts are never shuffled; documents learn their share from one small row per
source (key of the edge, words there, epochs).

Defined cases: null and empty texts have size 0 and take nothing; a null
source is a source; documents equal in id and text share what the edge
leaves in equal parts; empty tables give an empty result; ``mix`` keeps all
input columns, others are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from twinlens.llm.common import SPACES, packed, unpacked, whole_text, words
from twinlens.session import materialize

#: Contract values.
WEIGHTS = [3, 1, 2]
SHARE = 1.5
MAX_REPEAT = 2.0
#: Parameters of the sampling.
SEED = 7
BUCKET_BITS = 14
BUCKETS = 1 << BUCKET_BITS
GROUP_BITS = 7
#: Logarithms of keys lie between LOG_LEAST and LOG_LEAST + LOG_WIDTH (u has 53 bits, weights are MIN_QUALITY to 1).
LOG_LEAST, LOG_WIDTH = -40.0, 50.0
MIN_QUALITY = 0.1


def size_of(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def quality_of(text: Column) -> Column:
    """Sampling weight between MIN_QUALITY and 1: the share of letters among what is no separator."""
    solid = F.char_length(F.regexp_replace(text, SPACES, ""))
    letters = F.char_length(F.regexp_replace(text, r"[^\p{L}]+", ""))
    return F.when(solid > 0, F.greatest(F.lit(MIN_QUALITY), letters / solid)).otherwise(F.lit(MIN_QUALITY))


def uniform(*parts: Column) -> Column:
    """A number in (0, 1) from 52 bits of a hash, the same in every run."""
    bits = F.shiftrightunsigned(F.xxhash64(*parts, F.lit(SEED)), 12).cast("double")
    return (bits + 0.5) / float(1 << 52)


def targets(sizes: DataFrame, share: float = SHARE) -> DataFrame:
    """``(src, source_size, target)`` from ``(src, source_size)``, one row per source.

    In the order of cap over weight, the sources before some point are held at
    their cap and the rest share what is left by weight; the windows run over
    the sources, not over documents.
    """
    order = Window.orderBy(F.col("src").isNull(), F.col("src").cast("binary"))
    w = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.pmod(F.row_number().over(order) - 1, F.lit(len(WEIGHTS))) + 1)
                     .cast("int")).cast("double")
    df = sizes.withColumn("w", w).withColumn("cap", F.col("source_size") * MAX_REPEAT)
    line = Window.orderBy(F.col("cap") / F.col("w"), F.col("src").isNull(), F.col("src").cast("binary"))
    upto = line.rowsBetween(Window.unboundedPreceding, -1)
    every = line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    df = (df.withColumn("held", F.coalesce(F.sum("cap").over(upto), F.lit(0.0)))
          .withColumn("rest_w", F.sum("w").over(every) - F.coalesce(F.sum("w").over(upto), F.lit(0.0)))
          .withColumn("budget", F.sum("source_size").over(every) * share))
    # level: what a weight of one gets if all sources before this one are held at their caps
    df = df.withColumn("level", (F.col("budget") - F.col("held")) / F.col("rest_w"))
    df = df.withColumn("free", F.col("level") * F.col("w") <= F.col("cap"))
    df = df.withColumn("final", F.min(F.when(F.col("free"), F.struct(F.col("cap") / F.col("w"), "level"))).over(every))
    return df.select("src", "source_size", F.when(
        F.col("final").isNull() | (F.col("cap") / F.col("w") < F.col("final.col1")), F.col("cap"))
        .otherwise(F.least("cap", F.col("final.level") * F.col("w"))).alias("target"))


def _keyed(docs: DataFrame) -> DataFrame:
    """Adds ``_size``, ``_key``, ``_tie``, ``_bucket`` and ``_fine``; the key's order is the sampling order.

    ``_bucket`` and ``_fine`` are the first and second digit of the key's logarithm.
    """
    text = whole_text("text")
    df = docs.withColumn("_size", size_of(text)).withColumn("_tie", F.xxhash64("doc_id", text)).withColumn(
        "_key", -F.log(uniform(F.col("doc_id"), text)) / quality_of(text))
    place = F.floor((F.log("_key") - LOG_LEAST) / LOG_WIDTH * (1 << 2 * BUCKET_BITS)).cast("long")
    return df.withColumn("_bucket", F.shiftright(place, BUCKET_BITS).cast("int")).withColumn(
        "_fine", place.bitwiseAND(BUCKETS - 1).cast("int"))


def _holding(parts: DataFrame, key: str) -> DataFrame:
    """The part of each source, in the order of ``key``, in which ``base`` and the sums so far reach ``left_over``."""
    line = Window.partitionBy("src").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("before", F.col("base") + F.coalesce(F.sum("n").over(line), F.lit(0)))
    return parts.where((F.col("before") < F.col("left_over")) & (F.col("before") + F.col("n") >= F.col("left_over")))


def _edge_range(ranges: DataFrame, left: DataFrame, key: str) -> DataFrame:
    """``(s, b, base, left_over)``: the range of each source that holds the edge, and the sums before it.

    ``ranges`` is ``(src, key, n)``, ``left`` is ``(s, base, left_over)``, base being what lies before all the ranges.
    """
    groups = ranges.groupBy("src", F.shiftright(key, GROUP_BITS).alias("g")).agg(F.sum("n").alias("n"))
    group = _holding(groups.join(left, F.col("src").eqNullSafe(F.col("s"))), "g").select(
        F.col("src").alias("s"), F.col("g").alias("e_g"), F.col("before").alias("base"), "left_over")
    own = ranges.join(group, F.col("src").eqNullSafe(F.col("s")) & (F.shiftright(key, GROUP_BITS) == F.col("e_g")))
    return materialize(_holding(own, key).select(
        F.col("src").alias("s"), F.col(key).alias("b"), F.col("before").alias("base"), "left_over"), "mix-edge")


def _edges(rows: DataFrame, share: float) -> DataFrame:
    """``(src, source_size, target, epochs, e_key, e_tie, e_words)``, one row per source.

    Keys before (e_key, e_tie) take one more copy, those equal to it take
    ``e_words``; both are null where no fraction is left.
    """
    ranges = materialize(rows.groupBy("src", "_bucket").agg(F.sum("_size").alias("n")), "mix-ranges")
    sizes = ranges.groupBy("src").agg(F.sum("n").alias("source_size"))
    plan = targets(sizes, share).withColumn("epochs", F.when(
        F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
    plan = materialize(plan.withColumn("left_over", F.floor(
        F.col("target") - F.col("epochs") * F.col("source_size")).cast("long")), "mix-plan")
    left = plan.select(F.col("src").alias("s"), F.lit(0).cast("long").alias("base"), "left_over")
    edge = _edge_range(ranges, left, "_bucket")
    inside = rows.join(edge, F.col("src").eqNullSafe(F.col("s")) & (F.col("_bucket") == F.col("b")))
    fine = materialize(inside.groupBy("src", "_fine").agg(F.sum("_size").alias("n")), "mix-ranges")
    finest = _edge_range(fine, edge.drop("b"), "_fine").withColumnsRenamed({"s": "s2", "b": "b2"}).drop("left_over")
    # only the rows of one fine range per source; equal documents are one row
    inside = (inside.drop("base").join(finest, F.col("src").eqNullSafe(F.col("s2")) & (F.col("_fine") == F.col("b2")))
              .groupBy("src", "_key", "_tie", F.col("base").alias("before"), "left_over")
              .agg(F.sum("_size").alias("n"), F.count(F.lit(1)).alias("copies")))
    line = Window.partitionBy("src").orderBy("_key", "_tie").rowsBetween(Window.unboundedPreceding, -1)
    inside = inside.withColumn("done", F.col("before") + F.coalesce(F.sum("n").over(line), F.lit(0)))
    cut = inside.where((F.col("done") < F.col("left_over")) & (F.col("done") + F.col("n") >= F.col("left_over"))).select(
        F.col("src").alias("s"), F.col("_key").alias("e_key"), F.col("_tie").alias("e_tie"),
        F.floor((F.col("left_over") - F.col("done")) / F.col("copies")).cast("long").alias("e_words"))
    return materialize(plan.join(cut, F.col("src").eqNullSafe(F.col("s")), "left").drop("s", "left_over"), "mix-edges")


def mix(docs: DataFrame, share: float = SHARE) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target``, ``epochs``, ``edge_words`` and ``taken``.

    A document is taken whole ``epochs`` times (its own copy from the fraction
    counted in), plus its first ``edge_words`` words; ``taken`` counts all words.
    Columns of the input with these names are replaced.
    """
    made = ["size", "source_size", "target", "epochs", "edge_words", "taken"]
    docs = docs.drop(*made)
    rows = materialize(_keyed(docs.select("doc_id", "text", F.col("source").alias("src")))
                       .select("src", "_size", "_key", "_tie", "_bucket", "_fine"), "mix-rows")
    edges = _edges(rows, share).withColumnsRenamed({"src": "e_src", "epochs": "e_epochs"})
    # the input's columns travel in one struct: no name of theirs can clash
    df = docs.select(packed(docs).alias("row"), "doc_id", "text", F.col("source").alias("src"))
    df = _keyed(df).join(edges, F.col("src").eqNullSafe(F.col("e_src")), "left")
    here, there = F.struct("_key", "_tie"), F.struct(F.col("e_key").alias("_key"), F.col("e_tie").alias("_tie"))
    more = F.when(F.col("e_key").isNotNull() & (here < there), 1).otherwise(0)
    edge = F.when(F.col("e_key").isNotNull() & (here == there), F.least("_size", "e_words")).otherwise(0).cast("long")
    df = (df.withColumn("epochs", F.col("e_epochs") + more).withColumn("edge_words", edge)
          .withColumn("size", F.col("_size"))
          .withColumn("taken", F.col("epochs") * F.col("_size") + F.col("edge_words")))
    return df.select(*unpacked(docs.columns), *made)
