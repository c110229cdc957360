"""SimHash near-dedup with vantage-point trees (operator 4).

1. ``fingerprints``: one 64-bit SimHash per whole text (Arrow batches).
2. Equal fingerprints collapse to one row each, pre-aggregated.
3. Vantage-point trees deal the fingerprints into shards by Hamming distance.
   Distances of whole 64-bit fingerprints crowd around 32, where a radius of 4
   prunes next to nothing, so each tree works on one block of bits: two
   fingerprints at most 4 bits apart differ by at most ``4 // BLOCKS`` bits in
   one of the blocks. In each tree a fingerprint is stored in one shard and
   queries every shard that the triangle bound (block distance to the vantage
   point against the node's radius) can't rule out, so no pair is missed.
4. Each shard checks whole fingerprints, walks its linked sets and returns one
   link per reached fingerprint rather than all pairs.
5. Links become components by distributed star contraction.

The trees' vantage points come from a bounded sample (``SAMPLE`` fingerprints,
the least by hash); every fingerprint is routed. Shards above ``SHARD_ROWS``
stored rows are split, each part being queried by all that the shard is.

Defined cases: null and empty texts have fingerprint zero and link like any
other; equal rows keep one result row each; a null doc_id is never a
component's id unless nothing else is there; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinlens.llm.common import bounded_sample, connected_components, packed, unpacked
from twinlens.session import materialize

#: Contract values: shingle length in words, seed and largest bit distance.
SHINGLE = 4
SEED = 42
MAX_BITS = 4
#: Bit ranges of the trees; two fingerprints within MAX_BITS differ by at most RADIUS bits in one of them.
BLOCKS = [(0, 21), (21, 42), (42, 64)]
RADIUS = MAX_BITS // len(BLOCKS)
SHARD_ROWS = 2048
SAMPLE = 1 << 14
MAX_DEPTH = 16
_STEP = 1 << 16

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: str | None, n: int = SHINGLE) -> int:
    """SimHash of the text's word shingles: a bit is set if it is in over half of their XXH64."""
    parts = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not parts:
        return 0
    n = min(n, len(parts))
    line = b" ".join(parts)
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    total, counts = len(parts) - n + 1, np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for i in range(0, total, _STEP):
        k = min(_STEP, total - i)
        h = np.fromiter((digest(line[a:b], SEED) for a, b in
                         zip(starts[i:i + k].tolist(), ends[i + n - 1:i + n - 1 + k].tolist(), strict=True)),
                        np.uint64, k)
        counts += np.unpackbits(h.view(np.uint8).reshape(k, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(2 * counts > total, bitorder="little")
    return int(bits.view(np.uint64)[0])


def fingerprints(docs: DataFrame, n: int = SHINGLE) -> DataFrame:
    """``(doc_id, fp)``: fp is the fingerprint as a signed 64-bit integer."""
    return docs.select("doc_id", _fp_column(n)(F.col("text")).alias("fp"))


def _fp_column(n: int):
    @F.pandas_udf("long")
    def fp(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(np.array([fingerprint(t, n) for t in texts], np.uint64).view(np.int64))

    return fp.asNondeterministic()


class Trees:
    """A vantage-point tree of the same depth for each block of bits."""

    def __init__(self, sample: np.ndarray, depth: int):
        self.depth = depth
        rng = np.random.default_rng(7)
        self.vantage, self.radius = [], []
        for lo, hi in BLOCKS:
            size = (1 << depth) - 1
            vantage, radius = np.zeros(size, np.uint64), np.zeros(size, np.int64)
            points = (sample >> np.uint64(lo)) & np.uint64((1 << (hi - lo)) - 1)
            sets = [points]
            for node in range(size):
                own = sets[node]
                tries = rng.choice(own, 8) if len(own) else rng.integers(0, 1 << (hi - lo), 1).astype(np.uint64)
                best = None
                for v in tries:  # the vantage point with the fewest points at the boundary, and even halves
                    d = np.bitwise_count(own ^ v).astype(np.int64)
                    mid = int(np.median(d)) if len(d) else (hi - lo) // 2
                    for r in (mid - 1, mid):
                        inside = int((d <= r).sum())
                        cost = (max(inside, len(own) - inside)
                                + int(((d > r - RADIUS) & (d <= r + RADIUS)).sum()))
                        if best is None or cost < best[0]:
                            best = (cost, v, r, d)
                _, vantage[node], radius[node], d = best
                sets += [own[d <= radius[node]], own[d > radius[node]]]
                sets[node] = points[:0]
            self.vantage.append(vantage)
            self.radius.append(radius)

    def route(self, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(row, shard, stored)`` of every shard each fingerprint is stored in or must query."""
        rows, shards, kept = [], [], []
        for block, (lo, hi) in enumerate(BLOCKS):
            part = (fp >> np.uint64(lo)) & np.uint64((1 << (hi - lo)) - 1)
            row, node, home = np.arange(len(fp)), np.zeros(len(fp), np.int64), np.ones(len(fp), bool)
            for _ in range(self.depth):
                d = np.bitwise_count(part[row] ^ self.vantage[block][node]).astype(np.int64)
                r = self.radius[block][node]
                left, right = d - RADIUS <= r, d + RADIUS > r
                row, node, home = (np.concatenate([row[left], row[right]]),
                                   np.concatenate([2 * node[left] + 1, 2 * node[right] + 2]),
                                   np.concatenate([home[left] & (d[left] <= r[left]),
                                                   home[right] & (d[right] > r[right])]))
            rows.append(row)
            shards.append(node - ((1 << self.depth) - 1) + (block << self.depth))
            kept.append(home)
        return np.concatenate(rows), np.concatenate(shards), np.concatenate(kept)


def shard_links(fp: np.ndarray, stored: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links ``(fingerprint, root)`` that join all within MAX_BITS, one side being stored here.

    Walks outwards from each stored fingerprint; whatever is reached leaves the
    open set, so at most one link per fingerprint comes out.
    """
    signed = fp.view(np.int64)
    own, guests = np.flatnonzero(stored), np.flatnonzero(~stored)
    open_own, open_guests = own, guests
    hi, lo = [], []
    done = np.zeros(len(fp), bool)
    for seed in own:
        if done[seed]:
            continue
        done[seed] = True
        reached, front = [np.array([seed])], [int(seed)]
        while front:
            i = front.pop()
            near = open_own[(np.bitwise_count(fp[open_own] ^ fp[i]) <= MAX_BITS)]
            near = near[~done[near]]
            if stored[i]:
                more = open_guests[(np.bitwise_count(fp[open_guests] ^ fp[i]) <= MAX_BITS)]
                near = np.concatenate([near, more[~done[more]]])
            if len(near):
                done[near] = True
                reached.append(near)
                front += near.tolist()
                if len(near) > 16:
                    open_own, open_guests = open_own[~done[open_own]], open_guests[~done[open_guests]]
        if len(reached) > 1:
            members = signed[np.concatenate(reached)]
            root = members.min()
            members = members[members != root]
            hi.append(members)
            lo.append(np.full(len(members), root))
    empty = np.zeros(0, np.int64)
    return np.concatenate([empty, *hi]), np.concatenate([empty, *lo])


def links(distinct: DataFrame) -> DataFrame:
    """Links ``(hi, lo)`` among distinct fingerprints (column ``fp``) that connect all within MAX_BITS."""
    spark = distinct.sparkSession
    n = distinct.count()
    depth = min(MAX_DEPTH, max(0, math.ceil(math.log2(max(n, 1) / SHARD_ROWS))))
    # the sample's size is fixed, so what reaches the driver is bounded
    sample = bounded_sample(distinct.select("fp"), SAMPLE, "fp").toPandas()["fp"]
    trees = spark.sparkContext.broadcast(Trees(sample.to_numpy(np.int64).view(np.uint64), depth))

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            fp = b["fp"].to_numpy(np.int64)
            for i in range(0, len(fp), 4096):
                row, shard, stored = trees.value.route(fp[i:i + 4096].view(np.uint64))
                yield pd.DataFrame({"shard": shard, "fp": fp[i:i + 4096][row], "stored": stored})

    dealt = materialize(distinct.select("fp").mapInPandas(deal, "shard long, fp long, stored boolean"), "shards")
    sizes = dealt.where("stored").groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / SHARD_ROWS / 2).alias("parts"))
    # a split shard's rows query all of its parts, and are stored in one
    parted = dealt.join(sizes, "shard").withColumn(
        "all_parts", F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))
    parted = parted.select("shard", "parts", F.explode("all_parts").alias("part"), "fp", "stored").withColumn(
        "stored", F.col("stored") & (F.col("part") == F.pmod(F.xxhash64("fp"), "parts")))

    def search(group: pd.DataFrame) -> pd.DataFrame:
        hi, lo = shard_links(group["fp"].to_numpy(np.int64).view(np.uint64), group["stored"].to_numpy(bool))
        return pd.DataFrame({"hi": hi, "lo": lo})

    return parted.groupBy("shard", "part").applyInPandas(search, "hi long, lo long").distinct()


def components(fps: DataFrame) -> DataFrame:
    """``(doc_id, fp, component_id, root)`` for ``(doc_id, fp)``: the smallest doc_id reachable over links.

    ``root`` names the component also where no member has a doc_id.
    """
    distinct = materialize(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "fps")
    roots = connected_components(links(distinct), "hi", "lo")
    # both sides are written out, so that the join on the root can be split where a component has many fingerprints
    rooted = materialize(distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")), "rooted")
    ids = materialize(rooted.groupBy("root").agg(F.min("first_id").alias("component_id")), "roots")
    # written out, so that the join with all documents can be split where one fingerprint holds many
    of = materialize(rooted.join(ids, "root").select(F.col("fp").alias("of_fp"), "component_id", "root"), "components")
    return fps.join(of, F.col("fp") == F.col("of_fp"), "left").select(
        "doc_id", "fp", "component_id", "root")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``(doc_id, fingerprint, component_id)``, one row per document."""
    fps = materialize(fingerprints(docs, shingle), "fingerprints")
    return components(fps).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with one row of each component, all columns as they are.

    It is a row with the component's smallest doc_id, among those the one with
    the least fingerprint, then text; one without a doc_id only where the whole
    component has none. Rows that share a doc_id but not a component each stand for
    their own. Fingerprints are computed again only for doc_ids that several rows have.
    """
    fps = materialize(fingerprints(docs, shingle), "fingerprints")
    found = materialize(components(fps), "members")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "fp"))
    first = found.groupBy("root").agg(least.alias("x"))
    ids = fps.groupBy(F.col("doc_id").alias("id")).agg(F.count(F.lit(1)).alias("n"))
    chosen = materialize(first.select("x.doc_id", "x.fp").join(ids, F.col("doc_id").eqNullSafe(F.col("id")))
                         .select("id", "fp", ((F.col("n") > 1) | F.col("id").isNull()).alias("shared")), "chosen")
    rows = docs.select(packed(docs).alias("row"))
    at = F.col("row")["doc_id"]
    alone = rows.join(chosen.where("not shared"), at == F.col("id"), "left_semi")
    several = rows.join(materialize(chosen.where("shared").select("id").distinct(), "shared-ids"),
                        at.eqNullSafe(F.col("id")), "left_semi")
    several = several.select("row", _fp_column(shingle)(F.col("row")["text"]).alias("of"))
    others = [F.col("row")[c] for c, t in docs.dtypes if c not in ("doc_id", "text") and "map<" not in t]
    tie = F.struct(F.col("row")["text"].alias("text"), F.xxhash64(F.lit(0), *others).alias("h"))
    several = several.join(chosen.where("shared"), at.eqNullSafe(F.col("id")) & (F.col("of") == F.col("fp")),
                           "left_semi")
    several = several.groupBy(at.alias("id"), "of").agg(F.min_by("row", tie).alias("row")).select("row")
    return alone.union(several).select(*unpacked(docs.columns))
