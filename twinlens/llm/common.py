"""Column helpers and the component labelling that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinlens.session import materialize

#: Word separators (space, tab to carriage return).
SPACES = r"[\x20\x09-\x0D]+"
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def whole_text(text: Column | str) -> Column:
    """The text, a null one as the empty text."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def words(text: Column) -> Column:
    """Maximal runs of characters that are no separator."""
    return F.array_remove(F.split(text, SPACES), "")


def packed(df: DataFrame) -> Column:
    """All columns of ``df`` in one struct, whatever their names (``unpacked`` gives them back)."""
    return F.struct(*[F.col(f"`{c.replace('`', '``')}`") for c in df.columns])


def unpacked(columns: list[str], of: str = "row") -> list[Column]:
    return [F.col(of)[c].alias(c) for c in columns]


def ascii_lower(c: Column) -> Column:
    return F.translate(c, ASCII_UPPER, ASCII_UPPER.lower())


def bounded_sample(df: DataFrame, n: int, *key: str) -> DataFrame:
    """At most ``n`` rows, about the least by the key's hash; the same rows in every run.

    A share of the hash range sized by the row count is cut out first, so that
    tasks together pass on little more than ``n`` rows however many they are.
    """
    share = min(1.0, (1.2 * n + 200) / max(1, df.count()))
    h = F.xxhash64(*key)
    cut = df if share == 1.0 else df.where(F.shiftrightunsigned(h, 1) < int(share * (1 << 63)))
    return cut.orderBy(h, *key).limit(n)


def let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, inside one projection."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


#: Matches whose positions are summed up together.
_STRIDE = 256


def match_spans(text: Column, pattern: str) -> Column:
    """``array<struct<start, end, m>>`` of the pattern's matches, positions in code points.

    Positions are running sums of the lengths of what lies between matches and
    of the matches; sums over strides of matches keep this near linear in
    their number.
    """
    def build(pieces: Column, found: Column) -> Column:
        steps = F.transform(found, lambda m, i: F.char_length(F.get(pieces, i)) + F.char_length(m))

        def upto(lens: Column, start: Column, n: Column) -> Column:
            return F.aggregate(F.slice(lens, start, n), F.lit(0), lambda s, x: s + x)

        def place(lens: Column) -> Column:
            strides = F.transform(F.sequence(F.lit(0), F.floor((F.size(lens) - 1) / _STRIDE).cast("int")),
                                  lambda c: upto(lens, c * _STRIDE + 1, F.lit(_STRIDE)))
            ahead = F.aggregate(strides, F.array(F.lit(0)), lambda acc, s: F.concat(
                acc, F.array(F.element_at(acc, -1) + s)))

            def one(offsets: Column) -> Column:
                def span(m: Column, i: Column) -> Column:
                    c = F.floor(i / _STRIDE).cast("int")
                    end = F.get(offsets, c) + upto(lens, c * _STRIDE + 1, i - c * _STRIDE + 1)
                    return let(end, lambda e: F.struct((e - F.char_length(m)).alias("start"), e.alias("end"),
                                                       m.alias("m")))
                return F.transform(found, span)
            return let(ahead, one)
        return let(steps, place)

    none = F.array().cast("array<struct<start:int,end:int,m:string>>")
    spans = let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda found: F.when(
        F.size(found) == 0, none).otherwise(let(F.split(text, pattern, -1), lambda pieces: build(pieces, found))))
    return F.coalesce(spans, none)


def _not_stars(edges: DataFrame) -> bool:
    """True if some node hangs from two roots, or a root hangs from another node."""
    roles = (edges.select(F.explode(F.array(
        F.struct(F.col("hi").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")),
        F.struct(F.col("lo").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))).alias("r"))
        .groupBy("r.node").agg(F.sum("r.up").alias("up"), F.max("r.down").alias("down")))
    return not roles.where((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0))).isEmpty()


def _closest(edges: DataFrame) -> DataFrame:
    """Per node of column ``u``, the least of itself and its neighbours ``v``.

    Written out, so that the join on it has an exchange of its own on both
    sides, which adaptive execution can split where a hub has many links.
    """
    return materialize(edges.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), "closest")


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``(node, root)`` of every node that has a link; root is the least node reached.

    Alternates the large-star and small-star steps (each links a node's
    neighbours to the least of them) until every component is a star. Rounds
    grow with the logarithm of the longest path, links never multiply, minima
    are pre-aggregated before they are shuffled, and each round is written to
    the shared folder, so a lost executor costs no more than that round.
    Links of a node to itself and null ends are dropped.
    """
    e = materialize(edges.where(F.col(a) != F.col(b))
                    .select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).distinct(), "links")
    while _not_stars(e):
        both = e.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(
            e.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        large = materialize(both.join(_closest(both), "u").where(F.col("v") > F.col("u"))
                            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "links")
        e = materialize(
            large.join(_closest(large), "u")
            .select(F.explode(F.array(F.struct(F.col("v").alias("hi"), F.col("m").alias("lo")),
                                      F.struct(F.col("u").alias("hi"), F.col("m").alias("lo")))).alias("x"))
            .select("x.*").where(F.col("hi") != F.col("lo")).distinct(), "links")
    return e.select(F.col("hi").alias("node"), F.col("lo").alias("root")).union(
        e.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct())
