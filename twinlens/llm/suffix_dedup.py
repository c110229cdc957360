"""Exact substring dedup by names of sampled suffixes (operator 8).

This is a fingerprinting method: no suffix array is built, no common-prefix
values are kept and nothing recurses, unlike external induced sorting.

Removes every byte covered by a ``LENGTH``-byte string that also starts
elsewhere. Sorting all suffixes would carry a tuple per byte through every
level; here only a sample of suffixes is named and the rest follow from it:

1. Sample. A suffix is sampled where a ``GRAM``-byte gram has the least hash
   among those of some LENGTH-byte window. Equal windows sample equal places,
   so two equal windows always meet at a sampled suffix of equal name.
2. Names. A suffix's name is the hash of its gram, a second name that of its
   whole context (all windows that hold the gram). Names that occur once are
   out; contexts that occur twice are duplicates in all their windows. Both
   are counted with partial sums before any shuffle.
3. Steps. Where one gram name has several contexts, windows are compared
   step by step leftwards of the sampled suffix: a window's name follows from
   that of the window one byte to its right. The tuples of a name lie together
   after Spark's external sort (sorted runs on disk, merged by a priority
   queue), and stream through a task in bounded batches.
4. Names with very many contexts are never brought together. Their windows are
   told apart in levels: a range of offsets is named by the bytes that all its
   windows share, ranges whose name occurs once are out, the others are cut
   into smaller ranges, down to single windows. A level only counts names, with
   partial sums before any shuffle.

All windows of a context hold its gram, so those found twice cover one run of
bytes, given by the least and the greatest offset. Texts are read as UTF-8
bytes and never joined to each other, so no match crosses documents.

Defined cases: null and empty texts have no bytes; texts below LENGTH bytes
stay whole; equal rows are duplicates of each other and get equal results; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinlens.llm.common import whole_text
from twinlens.session import materialize

#: Contract value: length of the strings.
LENGTH = 400
#: Parameters: gram length, bytes handled at once, contexts of a name handled by one task, tuples per batch,
#: offsets in a range by level (each a multiple of the next).
GRAM = 48
STEP = 1 << 19
NAME_ROWS = 8192
BATCH = 4096
WIDTHS = (48, 8, 1)

LEFT = LENGTH - GRAM
_MULT = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd multiplier and of its inverse, modulo 2**64."""
    base = 0x5851F42D4C957F2D
    return tuple(np.multiply.accumulate(np.array([1] + [b] * (n - 1), np.uint64))
                 for b in (base, pow(base, -1, 1 << 64)))


_BYTE = np.random.default_rng(5).integers(1, 1 << 63, 256).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_POW, _INV = _powers(STEP + 2 * LENGTH)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX
    return (h ^ (h >> np.uint64(29))) * _MULT


def _prefix(data: np.ndarray) -> np.ndarray:
    """Running sums over the last axis whose differences, scaled by an inverse power, are window hashes."""
    n = data.shape[-1]
    sums = np.zeros((*data.shape[:-1], n + 1), np.uint64)
    np.cumsum(_BYTE[data] * _POW[:n], axis=-1, out=sums[..., 1:])
    return sums


def sampled(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """``(offset, gram name)`` of the text's sampled suffixes."""
    data = np.frombuffer(raw, np.uint8)
    offsets, names = [], []
    width = LEFT + 1
    low = np.uint64((1 << 20) - 1)
    for start in range(0, max(0, len(data) - LENGTH + 1), STEP):
        part = data[start:start + STEP + LENGTH - 1]
        sums = _prefix(part)
        grams = _mixed((sums[GRAM:] - sums[:-GRAM]) * _INV[:len(part) - GRAM + 1])
        # the leftmost least gram of each window: minima from both ends of blocks of the window's width
        packed = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
        fill = -len(packed) % width
        blocks = np.concatenate([packed, np.full(fill, np.iinfo(np.uint64).max)]).reshape(-1, width)
        ahead = np.minimum.accumulate(blocks, axis=1).ravel()
        behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        n = len(part) - LENGTH + 1
        at = np.unique(np.minimum(behind[:n], ahead[width - 1:width - 1 + n]) & low).astype(np.int64)
        offsets.append(at + start)
        names.append(grams[at])
    if not offsets:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at, first = np.unique(np.concatenate(offsets), return_index=True)
    return at, np.concatenate(names)[first]


def _context(raw: bytes, at: int) -> tuple[int, bytes]:
    """How many bytes of the context lie before the suffix, and the context."""
    left = min(LEFT, at)
    return left, raw[at - left:at + LENGTH]


def _raw(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def suffixes(docs: DataFrame) -> DataFrame:
    """``(doc_id, key, at, gram, context)`` of all sampled suffixes; ``key`` is a hash of the row."""
    def sample(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            row, at, gram, context = [], [], [], []
            for i, text in enumerate(b["text"]):
                raw = _raw(text)
                o, g = sampled(raw)
                row.append(np.full(len(o), i))
                at.append(o)
                gram.append(g)
                for p in o.tolist():
                    left, c = _context(raw, p)
                    context.append(xxhash.xxh3_64_intdigest(c, left))
            row = np.concatenate([np.zeros(0, np.int64), *row])
            yield pd.DataFrame({
                "doc_id": b["doc_id"].array[row], "key": b["key"].array[row],
                "at": np.concatenate([np.zeros(0, np.int64), *at]),
                "gram": np.concatenate([np.zeros(0, np.uint64), *gram]).view(np.int64),
                "context": np.array(context, np.uint64).view(np.int64)})

    return _keyed(docs).mapInPandas(sample, "doc_id long, key long, at long, gram long, context long")


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), F.xxhash64("doc_id", whole_text("text")).alias("key"),
                       whole_text("text").alias("text"))


def range_names(contexts: list[bytes], left: np.ndarray, grams: np.ndarray, width: int = 1
                ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(name, row, first)`` of each context's ranges of ``width`` offsets that hold a whole window.

    An offset counts bytes leftwards from the sampled suffix to the window's
    start. A range starts at ``first``; its name covers gram, ``first`` and the
    bytes that all its windows share. With a width of one, that is the window.
    """
    data = np.zeros((len(contexts), LEFT + LENGTH), np.uint8)
    size = np.zeros(len(contexts), np.int64)
    for i, c in enumerate(contexts):
        size[i] = len(c)
        data[i, LEFT - left[i]:LEFT - left[i] + len(c)] = np.frombuffer(c, np.uint8)
    sums = _prefix(data)
    first = np.arange(0, LEFT + 1, width)
    last = np.minimum(first + width - 1, LEFT)
    h = (sums[:, LEFT - last + LENGTH] - sums[:, LEFT - first]) * _INV[LEFT - first]
    h = _mixed(h ^ (first.astype(np.uint64) * _MULT)) ^ (grams[:, None] * _MIX)
    least = LENGTH - (size - left)  # the first offset whose window ends inside the text
    row, at = np.nonzero(np.maximum(first, least[:, None]) <= np.minimum(last, left[:, None]))
    return h[row, at], row, first[at]


def _twice(name: np.ndarray) -> np.ndarray:
    """True where a name occurs at least twice."""
    order = np.argsort(name, kind="stable")
    s = name[order]
    same = s[1:] == s[:-1]
    out = np.zeros(len(name), bool)
    out[order] = np.append(same, False) | np.insert(same, 0, False)
    return out


def _induce(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Least and greatest offset of the windows found twice, per context; rows arrive ordered by gram.

    Keeps the window names of whole grams only, up to BATCH contexts and one gram's more.
    """
    ids: list[np.ndarray] = []
    parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    count, last_gram = 0, None

    def flush() -> pd.DataFrame:
        name, row, offset = (np.concatenate(x) for x in zip(*parts, strict=True))
        hit = _twice(name)
        low, high = np.full(count, LENGTH), np.full(count, -1)
        np.minimum.at(low, row[hit], offset[hit])
        np.maximum.at(high, row[hit], offset[hit])
        found = high >= 0
        gram, context = (np.concatenate(x)[found] for x in zip(*ids, strict=True))
        return pd.DataFrame({"gram": gram, "context": context, "low": low[found], "high": high[found]})

    for b in batches:
        if not len(b):
            continue
        gram = b["gram"].to_numpy(np.int64)
        edges = np.flatnonzero(gram[1:] != gram[:-1]) + 1
        start = 0
        for end in [*edges.tolist(), len(b)]:
            if end < len(b) and end - start < BATCH and count + end - start < BATCH:
                continue  # take several grams together
            for i in range(start, end, BATCH):
                rows = b.iloc[i:min(end, i + BATCH)]
                if count >= BATCH and int(gram[i]) != last_gram:
                    yield flush()
                    ids, parts, count = [], [], 0
                own = rows["gram"].to_numpy(np.int64)
                name, row, offset = range_names(rows["bytes"].tolist(), rows["left"].to_numpy(np.int64),
                                                own.view(np.uint64))
                parts.append((name, row + count, offset))
                ids.append((own, rows["context"].to_numpy(np.int64)))
                count += len(rows)
                last_gram = int(own[-1])
            start = end
    if count:
        yield flush()


def _named(width: int, above: int | None):
    """Names of the ranges of ``width`` offsets, of those inside the ``open`` ranges of width ``above`` if given."""
    def names(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for i in range(0, len(b), BATCH // 4):
                rows = b.iloc[i:i + BATCH // 4]
                gram = rows["gram"].to_numpy(np.int64)
                name, row, first = range_names(rows["bytes"].tolist(), rows["left"].to_numpy(np.int64),
                                               gram.view(np.uint64), width)
                if above is not None:
                    is_open = np.zeros((len(rows), LEFT // above + 1), bool)
                    for j, own in enumerate(rows["open"]):
                        is_open[j, np.asarray(own) // above] = True
                    keep = is_open[row, first // above]
                    name, row, first = name[keep], row[keep], first[keep]
                yield pd.DataFrame({"gram": gram[row], "context": rows["context"].to_numpy(np.int64)[row],
                                    "first": first, "name": name.view(np.int64)})

    return names


def told_apart(tuples: DataFrame) -> DataFrame:
    """``(gram, context, low, high)``: what ``_induce`` gives, level by level without bringing a gram together."""
    above, ranges = None, None
    for width in WIDTHS:
        rows = tuples if above is None else tuples.join(
            ranges.groupBy("gram", "context").agg(F.collect_list("first").alias("open")), ["gram", "context"])
        named = materialize(rows.mapInPandas(
            _named(width, above), "gram long, context long, first long, name long"), "range-names")
        twice = materialize(named.groupBy("name").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
                            .select("name"), "range-twice")
        ranges, above = named.join(twice, "name"), width
    return ranges.groupBy("gram", "context").agg(F.min("first").alias("low"), F.max("first").alias("high"))


def repeated(docs: DataFrame) -> DataFrame:
    """``(doc_id, key, start, end)``: runs of bytes that cover all repeated strings, possibly overlapping."""
    all_suffixes = materialize(suffixes(docs), "suffixes")
    grams = materialize(all_suffixes.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
                        .select("gram"), "grams")
    found = materialize(all_suffixes.join(grams, "gram"), "repeated-grams")
    contexts = materialize(found.groupBy("gram", "context").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("at", "doc_id", "key")).alias("where")), "contexts")
    several = materialize(contexts.groupBy("gram").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > 1).select(
        "gram", (F.col("m") > NAME_ROWS).alias("many")), "names")
    wanted = contexts.join(several, "gram").select(
        "where.doc_id", "where.key", F.struct("where.at", "gram", "context", "many").alias("w"))
    wanted = wanted.groupBy(F.col("doc_id").alias("d"), F.col("key").alias("k")).agg(F.collect_list("w").alias("w"))

    def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for text, want in zip(b["text"], b["w"], strict=True):
                raw = _raw(text)
                for w in want:
                    out.append((w["gram"], w["context"], w["many"], *_context(raw, w["at"])))
                    if len(out) >= 4 * BATCH:
                        yield pd.DataFrame(out, columns=["gram", "context", "many", "left", "bytes"])
                        out = []
            yield pd.DataFrame(out, columns=["gram", "context", "many", "left", "bytes"])

    texts = _keyed(docs).join(wanted, (F.col("key") == F.col("k")) & F.col("doc_id").eqNullSafe(F.col("d")))
    # equal rows fetch the same contexts: one of them is enough
    texts = texts.select("text", "w", "doc_id", "key").dropDuplicates(["doc_id", "key"]) if _has_twins(docs) else texts
    tuples = texts.select("text", "w").mapInPandas(
        fetch, "gram long, context long, many boolean, left long, bytes binary")
    crowded = not several.where("many").isEmpty()
    if crowded:
        tuples = materialize(tuples, "tuples")
    induced = (tuples.where(~F.col("many")).repartition("gram").sortWithinPartitions("gram")
               .mapInPandas(_induce, "gram long, context long, low long, high long"))
    if crowded:
        induced = induced.union(told_apart(tuples.where("many")))
    induced = induced.select("gram", "context", "low", "high", F.lit(False).alias("whole"))
    twice = contexts.where(F.col("n") > 1).select("gram", "context", F.lit(0).cast("long").alias("low"), F.lit(LEFT).cast(
        "long").alias("high"), F.lit(True).alias("whole"))
    spans = materialize(induced.union(twice).groupBy("gram", "context").agg(
        F.min("low").alias("low"), F.max("high").alias("high"), F.max("whole").alias("whole")), "spans")
    # a context that occurs twice is covered as far as its text goes
    return found.join(spans, ["gram", "context"]).select(
        "doc_id", "key", F.greatest(F.col("at") - F.col("high"), F.lit(0)).alias("start"),
        (F.col("at") + LENGTH - F.col("low")).alias("end"))


def _has_twins(docs: DataFrame) -> bool:
    """True if some row occurs twice."""
    keys = docs.select("doc_id", F.xxhash64(whole_text("text")).alias("key"))
    return not keys.groupBy("doc_id", "key").count().where(F.col("count") > 1).isEmpty()


def cut(raw: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int]:
    """The bytes outside the spans, and the number of maximal runs removed."""
    kept, at, runs = [], 0, 0
    end = -1
    for a, b in sorted(spans):
        b = min(b, len(raw))
        if a > end:
            runs += 1
            kept.append(raw[at:a])
        end = max(end, b)
        at = end
    kept.append(raw[at:])
    return b"".join(kept), runs


def deduplicated(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept)``, one row per document; ``kept`` is binary."""
    spans = repeated(docs).groupBy(F.col("doc_id").alias("d"), F.col("key").alias("k")).agg(
        F.collect_set(F.struct("start", "end")).alias("spans"))
    texts = _keyed(docs).join(spans, (F.col("key") == F.col("k")) & F.col("doc_id").eqNullSafe(F.col("d")), "left")

    def remove(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for text, own in zip(b["text"], b["spans"], strict=True):
                raw = _raw(text)
                kept, runs = cut(raw, [] if own is None else [(s["start"], s["end"]) for s in own])
                out.append((len(raw), len(raw) - len(kept), runs, kept))
            res = pd.DataFrame(out, columns=["n_bytes", "n_removed", "n_spans", "kept"])
            res.insert(0, "doc_id", b["doc_id"].array)
            yield res

    return texts.select("doc_id", "text", "spans").mapInPandas(
        remove, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def report(docs: DataFrame) -> DataFrame:
    """Counts per document and the digest of what is kept."""
    return deduplicated(docs).select("doc_id", "n_bytes", "n_removed", "n_spans",
                                     F.sha2("kept", 256).alias("kept_sha256"))
