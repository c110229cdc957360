"""Benchmark decontamination by BM25 with block-max WAND (operator 10).

An inverted index of the test items is built once from the benchmark table and
broadcast; every training text is cut into overlapping passages, each passage
is a query, and all items that score above the threshold are checked for
overlap of both their question and their answer with the passage. A part of
few shingles, which one altered word can bring below the limit, also passes by
its words, if the item as a whole keeps enough of its shingles.

Scores are shares of the item's own score (the sum of its terms' weights), so
one threshold fits long and short items. A passage is twice as long as the
longest item and starts every half passage, so an item inside a text lies
wholly in some passage. No item and no passage is left out: WAND only skips
what its upper bounds exclude.

What is broadcast is bounded: at most ``MAX_ITEMS`` items are indexed at once;
a larger benchmark is taken in as many passes as it needs, all with the
statistics of the whole, so its size changes no score and no hit.

Defined cases: null and empty texts match nothing, nor do items without a
word; equal rows of ``documents`` give equal hits, repeated item ids give a
hit each; empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

import bisect
import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twinlens.session import materialize

#: Parameters of the search and of the check.
K1, B = 1.2, 0.75
THRESHOLD = 0.7
POSTING_BLOCK = 4
MIN_PASSAGE = 128
SHINGLE = 5
MIN_OVERLAP = 0.8
#: Parts of fewer shingles than this lose the overlap by one altered word.
SHORT_PART = round(SHINGLE / (1 - MIN_OVERLAP))
MAX_ITEMS = 20_000

_TO_TERMS = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in range(256))
_SENTENCE = re.compile(r"(?<=[.?!])\s+")

HIT = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("score", T.DoubleType()),
                    T.StructField("question_overlap", T.DoubleType()),
                    T.StructField("answer_overlap", T.DoubleType()), T.StructField("at_word", T.LongType())])


def terms(text: str | None) -> list[bytes]:
    """Lower-cased runs of ASCII letters, digits and characters beyond ASCII."""
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(_TO_TERMS).split()


def _shingles(ts: list[bytes]) -> set[tuple[bytes, ...]]:
    n = min(SHINGLE, len(ts))
    return {tuple(ts[i:i + n]) for i in range(len(ts) - n + 1)} if n else set()


def question_and_answer(text: str) -> tuple[list[bytes], list[bytes]]:
    """Terms of the item's question and of its answer: its last sentence (all of it, if it is one sentence)."""
    parts = [p for p in _SENTENCE.split(text) if terms(p)]
    if len(parts) < 2:
        return terms(text), terms(text)
    return terms(" ".join(parts[:-1])), terms(parts[-1])


def words_there(part: list[bytes], other: list[bytes], whole: set[tuple[bytes, ...]], passage: list[bytes]) -> bool:
    """True if the part's words, all but one or a fifth of them and never under half, lie where the item's shingles do.

    The place reaches from the first of the passage's words in a shingle of the item to the last,
    and as many words beyond as the part has; the words of the item's other part there don't count.
    """
    n = len(next(iter(whole)))
    at = [i for i in range(len(passage) - n + 1) if tuple(passage[i:i + n]) in whole]
    near = Counter(passage[max(0, at[0] - len(part)):at[-1] + n + len(part)])
    there = sum((Counter(part) & (near - Counter(other))).values())
    return len(part) - there <= max(1.0, (1 - MIN_OVERLAP) * len(part)) and 2 * there >= len(part)


@dataclass(frozen=True)
class Stats:
    """Of the whole benchmark: items with a term, their terms, those of the longest, and how many items hold a term."""
    items: int
    words: int
    longest: int
    seen: dict[bytes, int]


class Index:
    """Postings by item, and the largest weight of each term in each block of items.

    Items are numbered so that those with the same everyday words (of one
    language) are neighbours, which keeps the blocks' maxima tight.
    """

    def __init__(self, items: list[tuple[int, str]], stats: Stats | None = None):
        bags = [(i, Counter(terms(t)), t) for i, t in items]
        bags = [x for x in bags if x[1]]
        lengths = [sum(c.values()) for _, c, _ in bags]
        if stats is None:
            held = Counter(t for _, c, _ in bags for t in c)
            stats = Stats(len(bags), sum(lengths), max(lengths, default=0), held)
        seen = stats.seen
        bags.sort(key=lambda x: (max(x[1], key=lambda t: (seen[t], t)), sum(x[1].values()), x[0] is not None, x[0] or 0,
                                 x[2]))
        self.ids = [i for i, _, _ in bags]
        self.words = [question_and_answer(t) for _, _, t in bags]
        self.parts = [tuple(map(_shingles, qa)) for qa in self.words]
        self.whole = [_shingles(terms(t)) for _, _, t in bags]
        lengths = [sum(c.values()) for _, c, _ in bags]
        mean = stats.words / max(1, stats.items)
        idf = {t: math.log(1 + (stats.items - n + 0.5) / (n + 0.5)) for t, n in seen.items()}
        lists: dict[bytes, list[tuple[int, float]]] = defaultdict(list)
        for k, (_, c, _) in enumerate(bags):
            norm = K1 * (1 - B + B * lengths[k] / mean)
            raw = {t: idf[t] * n * (K1 + 1) / (n + norm) for t, n in c.items()}
            whole = sum(raw.values())
            for t, w in raw.items():
                lists[t].append((k, w / whole))
        self.passage = max(MIN_PASSAGE, 2 * stats.longest)
        self.terms = {t: j for j, t in enumerate(lists)}
        self.items = [[k for k, _ in p] for p in lists.values()]
        self.weights = [[w for _, w in p] for p in lists.values()]
        self.most = [max(w) for w in self.weights]
        self.blocks = -(-len(bags) // POSTING_BLOCK)
        # block maxima, term after term
        most = [defaultdict(float) for _ in lists]
        for t, p in enumerate(lists.values()):
            for k, w in p:
                most[t][k // POSTING_BLOCK] = max(most[t][k // POSTING_BLOCK], w)
        self.first = np.cumsum([0] + [len(m) for m in most])
        self.block_of = np.array([b for m in most for b in m], np.int64)
        self.block_most = np.array([w for m in most for w in m.values()], np.float64)

    def live_blocks(self, ids: np.ndarray, starts: np.ndarray, threshold: float) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """``(start, query, blocks)`` of the passages that some block's maxima let reach the threshold.

        ``ids`` are term numbers by word (-1: in no item); the query is the passage's distinct terms.
        """
        at = np.flatnonzero(ids >= 0)
        n_terms = len(self.items)
        for chunk in range(0, len(starts), 256):
            own = starts[chunk:chunk + 256]
            lo, hi = np.searchsorted(at, own), np.searchsorted(at, own + self.passage)
            n = hi - lo
            passage = np.repeat(np.arange(len(own)), n)
            word = at[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)]
            pairs = np.unique(passage * n_terms + ids[word])
            passage, term = pairs // n_terms, pairs % n_terms
            size = self.first[term + 1] - self.first[term]
            entry = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(self.first[term], size)
            bound = np.bincount(np.repeat(passage, size) * self.blocks + self.block_of[entry],
                                self.block_most[entry], len(own) * self.blocks).reshape(len(own), self.blocks)
            for k in np.flatnonzero((bound >= threshold).any(axis=1)):
                yield int(own[k]), term[passage == k], np.flatnonzero(bound[k] >= threshold)

    def search(self, query: list[int], blocks: list[int], threshold: float) -> list[tuple[int, float]]:
        """All ``(item, score)`` with at least the threshold, for distinct terms and the blocks that may hold some.

        WAND: lists stand in the order of their next item, the pivot is the
        first whose summed maxima reach the threshold; a pivot in a block that
        is ruled out sends all lists to the next block that isn't.
        """
        at = dict.fromkeys(query, 0)
        found = []
        while True:
            live = sorted((self.items[t][at[t]], t) for t in query if at[t] < len(self.items[t]))
            bound, pivot = 0.0, None
            for item, t in live:
                bound += self.most[t]
                if bound >= threshold:
                    pivot = item
                    break
            if pivot is None:
                return found
            j = bisect.bisect_left(blocks, pivot // POSTING_BLOCK)
            if j == len(blocks):
                return found
            goal = max(pivot, blocks[j] * POSTING_BLOCK)
            for item, t in live:
                if item < goal:
                    at[t] = bisect.bisect_left(self.items[t], goal, at[t])
            if goal > pivot:
                continue
            score = 0.0
            for t in query:
                if at[t] < len(self.items[t]) and self.items[t][at[t]] == pivot:
                    score += self.weights[t][at[t]]
                    at[t] += 1
            if score >= threshold:
                found.append((pivot, score))

    def hits(self, text: str | None, threshold: float = THRESHOLD) -> list[tuple]:
        """Checked items of a whole text, the best passage of each: ``HIT`` fields by item."""
        if not self.ids:
            return []
        ts = terms(text)
        get = self.terms.get
        ids = np.fromiter([get(t, -1) for t in ts], np.int64, len(ts))
        step = self.passage // 2
        starts = np.arange(0, max(1, len(ts) - step), step)
        best: dict[int, tuple] = {}
        for a, query, blocks in self.live_blocks(ids, starts, threshold):
            found = self.search(query.tolist(), blocks.tolist(), threshold)
            inside = _shingle_sets(ts[a:a + self.passage]) if found else {}
            for k, score in found:
                q, w = (_overlap(part, inside) for part in self.parts[k])
                if (k not in best or score > best[k][1]) and self._copied(k, (q, w), inside, ts[a:a + self.passage]):
                    best[k] = (self.ids[k], score, q, w, a)
        return [best[k] for k in sorted(best)]

    def _copied(self, k: int, overlaps: tuple[float, float], inside: dict[int, set], passage: list[bytes]) -> bool:
        """True if question and answer of an item overlap enough, a short one by its words."""
        low = [j for j in (0, 1) if overlaps[j] < MIN_OVERLAP]
        if not low:
            return True
        return (all(len(self.parts[k][j]) < SHORT_PART for j in low)
                and _overlap(self.whole[k], inside) >= MIN_OVERLAP
                and all(words_there(self.words[k][j], self.words[k][1 - j], self.whole[k], passage) for j in low))


def _overlap(part: set[tuple[bytes, ...]], inside: dict[int, set[tuple[bytes, ...]]]) -> float:
    """The share of the part's shingles that the passage has."""
    return sum(s in inside[len(s)] for s in part) / len(part)


def _shingle_sets(ts: list[bytes]) -> dict[int, set[tuple[bytes, ...]]]:
    return {n: {tuple(ts[i:i + n]) for i in range(len(ts) - n + 1)} for n in range(1, SHINGLE + 1)}


@F.pandas_udf(T.StructType([T.StructField("n", T.LongType()), T.StructField("distinct", T.ArrayType(T.BinaryType()))]))
def _bag(texts: pd.Series) -> pd.DataFrame:
    bags = [terms(t) for t in texts]
    distinct = pd.Series([sorted(set(b)) for b in bags], dtype=object)
    return pd.DataFrame({"n": [len(b) for b in bags], "distinct": distinct})


def indexes(benchmark: DataFrame, max_items: int = MAX_ITEMS) -> Iterator[Index]:
    """Indexes of about ``max_items`` items each at most, one after another, over all of ``benchmark``.

    A larger benchmark is split by row, so that repeated or null ids don't gather;
    its statistics are counted once over the whole, so scores and hits are
    those of a single index. The driver holds one part's items and terms at a time.
    """
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"),
                             F.coalesce("text", F.lit("")).alias("text"))
    n = items.count()
    if n <= max_items:
        yield Index([tuple(r) for r in items.collect()])
        return
    parts = 2 * -(-n // max_items)
    rows = materialize(items.withColumn("row", F.monotonically_increasing_id()), "items")
    rows = materialize(rows.withColumn("part", F.pmod(F.xxhash64("row"), F.lit(parts)))
                       .withColumn("bag", _bag.asNondeterministic()(F.col("text"))), "bags").where("bag.n > 0")
    total = rows.agg(F.count(F.lit(1)), F.sum("bag.n"), F.max("bag.n")).first()
    held = rows.select("part", F.explode("bag.distinct").alias("term"))
    seen = held.groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    seen = materialize(held.distinct().join(seen, "term"), "terms")
    for k in range(parts):
        own = [tuple(r) for r in rows.where(F.col("part") == k).select("item_id", "text").collect()]
        if own:
            counts = {bytes(r.term): r.n for r in seen.where(F.col("part") == k).collect()}
            yield Index(own, Stats(total[0], total[1], total[2], counts))


def hits_column(spark, index: Index, text: Column, threshold: float = THRESHOLD) -> Column:
    """The text's checked items as an array of ``HIT``."""
    shared = spark.sparkContext.broadcast(index)

    @F.pandas_udf(T.ArrayType(HIT))
    def hits(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        names = HIT.fieldNames()
        for texts in batches:
            yield pd.Series([[dict(zip(names, h, strict=True)) for h in shared.value.hits(t, threshold)]
                             for t in texts], dtype=object)

    return hits.asNondeterministic()(text)


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``(doc_id, item_id, score, question_overlap, answer_overlap, at_word)``: every checked hit."""
    out = None
    for index in indexes(benchmark):
        hits = docs.select("doc_id", hits_column(docs.sparkSession, index, F.col("text"), threshold).alias("hits"))
        hits = hits.select("doc_id", F.explode("hits").alias("h")).select("doc_id", "h.*")
        out = hits if out is None else out.union(hits)
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` without a hit, all columns as they are."""
    name = "_hits"
    while name in docs.columns:
        name += "_"
    kept = docs
    for index in indexes(benchmark):
        found = hits_column(docs.sparkSession, index, F.col("text"), threshold)
        kept = kept.withColumn(name, found).where(F.size(name) == 0).drop(name)
    return kept
