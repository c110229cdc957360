"""Embedding near-dedup by dual traversal of cover trees (operator 13).

Unit vectors with cosine ``c`` are ``sqrt(2 - 2c)`` apart, so pairs above a
cosine are pairs within a distance. Three levels of nodes, each with a centre
and the exact covering radius of what lies below it:

1. cells: every vector goes to the nearest of ``k`` centres, the top of a cover
   tree over a bounded sample (``SAMPLE`` vectors);
2. parts: a cell of a label is dealt by hash into parts of about ``PART_ROWS``
   rows, so that no task holds more, however common a label or a vector is;
3. inside a part a cover tree: nested levels with halving radii.

Node pairs of one label are pruned where centre distance less both radii
exceeds the threshold, and taken whole where centre distance plus both radii
stays below it: then every row of one side counts all of the other, without a
pair being formed. Only what lies between goes down to the next level, at the
end to exact cosines in double precision. The result is exact; the radii only
save work. How much depends on the data: for vectors without near
neighbours in many dimensions the cells overlap, and work nears all parts
against all parts of a label (bounded tasks, in parallel).

Links found become components by distributed star contraction. ``link_counts``
gives counts and spanning links, ``near_duplicates`` one row per vector.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components, and vectors without a label, link with nothing and are their own
component; vectors of different lengths never link; equal rows are vectors of
their own (each counts the other), also with equal or null ids; a null vec_id
is a component's id only where it has no other, and is not kept then; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinlens.llm.common import bounded_sample, connected_components
from twinlens.session import materialize

#: Contract value.
COSINE = 0.98
PART_ROWS = 2048
SAMPLE = 4096
MAX_CELLS = 1024
#: Bounds within this of the threshold decide nothing; exact cosines do.
SLACK = 1e-9
#: Node pairs of up to so many row pairs are compared row by row.
LEAF_PAIRS = 4096


def distance_of(cosine: float) -> float:
    return math.sqrt(max(0.0, 2.0 - 2.0 * cosine))


class CoverTree:
    """Nested levels with halving radii over the rows of ``x``.

    A node's children cover its members within half its level's radius, the
    first of them with the node's own centre. ``radius`` is the exact distance
    of the farthest member; nodes of one place have no children.
    """

    def __init__(self, x: np.ndarray):
        self.x = x
        self.norm = np.sqrt(np.einsum("ij,ij->i", x, x))
        self.unit = x / self.norm[:, None]
        self.centre: list[int] = []
        self.radius: list[float] = []
        self.members: list[np.ndarray] = []
        self.children: list[np.ndarray] = []
        todo = [self._add(0, np.arange(len(x)), 2.0)] if len(x) else []
        while todo:
            node, level = todo.pop()
            if self.radius[node] < SLACK:
                continue
            while level >= self.radius[node]:  # levels that would hold one child are skipped
                level /= 2
            kids, left, c = [], self.members[node], self.centre[node]
            while len(left):
                near = self.unit[left] @ self.unit[c] >= 1.0 - level * level / 2
                near |= left == c
                kids.append(self._add(c, left[near], level))
                left = left[~near]
                c = int(left[0]) if len(left) else -1
            self.children[node] = np.array([k for k, _ in kids])
            todo += kids
        self.radii, self.centres = np.array(self.radius), np.array(self.centre, np.int64)
        self.inner = np.array([len(k) > 0 for k in self.children], bool)

    def _add(self, c: int, rows: np.ndarray, level: float) -> tuple[int, float]:
        far = 0.0
        if len(rows) > 1:
            d = self.unit[rows] - self.unit[c]
            far = float(np.sqrt(np.einsum("ij,ij->i", d, d).max()))
        self.centre.append(c)
        self.members.append(rows)
        self.radius.append(far)
        self.children.append(np.zeros(0, np.int64))
        return len(self.centre) - 1, level

    def below(self, nodes: np.ndarray) -> np.ndarray:
        """Members of ``nodes``."""
        return np.concatenate([self.members[k] for k in nodes]) if len(nodes) else np.zeros(0, np.int64)


class _Links:
    """Links of every row, and what is connected so far."""

    def __init__(self, n: int):
        self.count = np.zeros(n, np.int64)
        self.label = np.arange(n)

    def join(self, rows: np.ndarray) -> None:
        found = np.unique(self.label[rows])
        if len(found) > 1:
            self.label[np.isin(self.label, found)] = found[0]


def dual_links(a: CoverTree, b: CoverTree | None, cosine: float = COSINE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(links of each row, row, root)`` of all pairs at or above the cosine; ``b`` None: within ``a``.

    Rows of ``b`` follow those of ``a``. ``(row, root)`` spans what is linked.
    """
    same = b is None
    b, off = (a, 0) if same else (b, len(a.x))
    t, out = distance_of(cosine), _Links(len(a.x) + (0 if same else len(b.x)))
    wide = SLACK + 2e-8  # a centre distance from a product is off by the root of its rounding

    def compare(p: np.ndarray, q: np.ndarray, itself: bool) -> None:
        step = max(1, (1 << 20) // max(1, len(q)))
        for s in range(0, len(p), step):
            own = p[s:s + step]
            near = (a.x[own] @ b.x[q].T) / (a.norm[own][:, None] * b.norm[q]) >= cosine
            if itself:
                near[np.arange(len(own)), np.arange(s, s + len(own))] = False
            else:
                out.count[q + off] += near.sum(0)
            out.count[own] += near.sum(1)
            for r in np.flatnonzero(near.any(1)):
                out.join(np.append(q[near[r]] + off, own[r]))

    def gaps(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (a.unit[a.centres[i]] @ b.unit[b.centres[j]].T)))

    def descend(i: np.ndarray, j: np.ndarray, upper: bool) -> list[tuple[int, int]]:
        """Node pairs that the radii don't rule out; ``upper``: of a pair and its mirror image only one."""
        pairs = []
        step = max(1, (1 << 20) // max(1, len(j)))
        for s in range(0, len(i), step):
            part = i[s:s + step]
            near = gaps(part, j) <= t + wide + a.radii[part][:, None] + b.radii[j]
            if upper:
                near &= part[:, None] <= j
            x, y = np.nonzero(near)
            pairs += zip(part[x].tolist(), j[y].tolist(), strict=True)
        return pairs

    todo = [(0, 0)] if len(a.x) and len(b.x) else []
    while todo:
        i, j = todo.pop()
        itself, p, q = same and i == j, a.members[i], b.members[j]
        gap = 0.0 if itself else float(gaps(np.array([i]), np.array([j]))[0, 0])
        if gap + a.radii[i] + b.radii[j] <= t - wide:  # all of one side with all of the other
            out.count[p] += len(q) - itself
            if not itself:
                out.count[q + off] += len(p)
            out.join(np.concatenate([p, q + off]))
        elif len(p) * len(q) <= LEAF_PAIRS or not (a.inner[i] or b.inner[j]):
            compare(p, q, itself)
        else:
            ka = a.children[i] if a.inner[i] else np.array([i])
            kb = b.children[j] if b.inner[j] else np.array([j])
            leaf_a, leaf_b = ka[~a.inner[ka]], kb[~b.inner[kb]]
            inner_a, inner_b = ka[a.inner[ka]], kb[b.inner[kb]]
            compare(a.below(leaf_a), b.below(leaf_b), itself)
            todo += descend(inner_a, inner_b, itself) + descend(inner_a, leaf_b, False)
            if not itself:
                todo += descend(leaf_a, inner_b, False)
    rows = np.flatnonzero(out.label != np.arange(len(out.label)))
    return out.count, rows, out.label[rows]


def top_centres(sample: np.ndarray, k: int) -> np.ndarray:
    """At most ``k`` centres of the top levels of a cover tree: each the farthest from those before it."""
    if not len(sample):
        return sample
    chosen = [0]
    far = np.linalg.norm(sample - sample[0], axis=1)
    while len(chosen) < min(k, len(sample)) and far.max() > 0:
        c = int(far.argmax())
        chosen.append(c)
        far = np.minimum(far, np.linalg.norm(sample - sample[c], axis=1))
    return sample[chosen]


def _matrix(s: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, np.float64) for v in s]) if len(s) else np.zeros((0, 0))


def valid_vectors(vectors: DataFrame) -> DataFrame:
    """``(row, vec_id, label, dim, v)`` of what can link, from ``vectors`` with a ``row`` of its own each."""
    v = F.col("embedding").cast("array<double>")
    finite = ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    peak = F.aggregate("v", F.lit(0.0), lambda m, x: F.greatest(m, F.abs(x)))
    good = (vectors.where(F.col("label").isNotNull() & finite).select("row", "vec_id", "label", v.alias("v"))
            .withColumn("peak", peak).where("peak > 0"))
    # scaled by a power of two, which is exact, so that squares neither overflow nor vanish
    unit = F.pow(F.lit(2.0), -F.floor(F.log2("peak")))
    return good.withColumn("unit", unit).select("row", "vec_id", "label", F.size("v").alias("dim"),
                                                F.transform("v", lambda x: x * F.col("unit")).alias("v"))


def _assign(centres: dict[int, np.ndarray]):
    """Column of the nearest centre's number."""
    @F.pandas_udf("int")
    def cell(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            out = np.zeros(len(s), np.int32)
            dims = s.map(len).to_numpy()
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                if int(d) in centres:
                    x = _matrix(s.iloc[at])
                    out[at] = (x @ centres[int(d)].T).argmax(1)
            yield pd.Series(out)

    return cell.asNondeterministic()


def deal(valid: DataFrame, part_rows: int = PART_ROWS) -> DataFrame:
    """``valid`` with ``cell`` and ``part``, written out; parts have about ``part_rows`` rows at most."""
    most = valid.groupBy("label", "dim").count().agg(F.max("count")).first()[0] or 0
    k = min(MAX_CELLS, math.ceil(most / part_rows))
    centres = {}
    if k > 1:
        rows = bounded_sample(valid.select("row", "dim", "v"), SAMPLE, "row").toPandas()
        for d, own in rows.groupby("dim"):
            x = _matrix(own["v"])
            centres[int(d)] = top_centres(x / np.linalg.norm(x, axis=1)[:, None], k)
    celled = materialize(valid.withColumn("cell", _assign(centres)(F.col("v"))), "celled")
    sizes = celled.groupBy("label", "dim", "cell").agg(F.ceil(F.count(F.lit(1)) / part_rows).alias("parts"))
    part = F.pmod(F.xxhash64("row"), F.col("parts"))
    return materialize(celled.join(sizes, ["label", "dim", "cell"]).withColumn("part", part).drop("parts"), "parts")


_FOUND = "row long, n long, root long"
_PART = ["label", "dim", "cell", "part"]


def _found(rows: np.ndarray, count: np.ndarray, at: np.ndarray, roots: np.ndarray) -> pd.DataFrame:
    """Rows with links: how many, and the row that their linked set is joined at."""
    root = rows.copy()
    root[at] = rows[roots]
    some = count > 0
    return pd.DataFrame({"row": rows[some], "n": count[some], "root": root[some]})


def _distance(a: Column, b: Column) -> Column:
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))


def link_counts(dealt: DataFrame, cosine: float = COSINE) -> DataFrame:
    """``(row, n, root)`` pieces: links of ``row`` to some of the others, and a row that it is connected with."""
    t = distance_of(cosine)
    kinds = dict(dealt.dtypes)

    def inside(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        """Links inside a part, and the part as a node: its mean direction, radius and row count."""
        rows, tree = group["row"].to_numpy(np.int64), CoverTree(_matrix(group["v"]))
        links = _found(rows, *dual_links(tree, None, cosine)).assign(radius=-1.0, centre=None)
        mean = tree.unit.mean(0)
        far = float(np.linalg.norm(tree.unit - mean, axis=1).max())
        node = pd.DataFrame({"row": [rows.min()], "n": [len(rows)], "root": [rows.min()], "radius": [far],
                             "centre": [mean]})
        out = pd.concat([node, links]) if len(links) else node
        for i, c in enumerate(_PART):
            out.insert(i, c, key[i])
        return out

    own = materialize(dealt.groupBy(*_PART).applyInPandas(
        inside, ", ".join(f"{c} {kinds[c]}" for c in _PART) + f", {_FOUND}, radius double, centre array<double>"),
        "inside")
    nodes = own.where("radius >= 0").select(*_PART, F.struct("cell", "part").alias("id"), F.col("row").alias("first"),
                                            F.col("n").alias("size"), "radius", "centre")
    # parts against parts of their label, less what the radii rule out
    left = nodes.select(*[F.col(c).alias(f"{c}_l") for c in nodes.columns])
    gap, radii = _distance(F.col("centre_l"), F.col("centre")), F.col("radius") + F.col("radius_l")
    pairs = left.join(nodes, (F.col("label") == F.col("label_l")) & (F.col("dim") == F.col("dim_l"))
                      & (F.col("id_l") < F.col("id"))).withColumn("gap", gap).where(F.col("gap") - radii <= t + SLACK)
    pairs = materialize(pairs.withColumn("whole", F.col("gap") + radii <= t - SLACK).drop("centre", "centre_l"),
                        "part-pairs")
    both = pairs.select(*[F.col(f"{c}_l").alias(c) for c in _PART], F.col("first").alias("root"),
                        F.col("size").alias("n"), "id_l", "id", "whole", F.lit(True).alias("at_left")).union(
        pairs.select(*_PART, F.col("first_l").alias("root"), F.col("size_l").alias("n"), "id_l", "id", "whole",
                     F.lit(False).alias("at_left")))
    # taken whole: every row of a part counts all of the other and is joined with its first row
    sums = both.where("whole").groupBy(*_PART).agg(F.sum("n").alias("n"), F.min("root").alias("root"))
    whole = dealt.join(sums, _PART).select("row", "n", "root").union(
        pairs.where("whole").select(F.col("first_l"), F.lit(0).cast("long"), "first"))
    # left open: the rows of both parts meet
    meet = both.where("not whole").select(*_PART, "id_l", "id", "at_left").join(dealt, _PART)

    def between(group: pd.DataFrame) -> pd.DataFrame:
        side = group["at_left"].to_numpy(bool)
        a, b = group[side], group[~side]
        rows = np.concatenate([a["row"].to_numpy(np.int64), b["row"].to_numpy(np.int64)])
        return _found(rows, *dual_links(CoverTree(_matrix(a["v"])), CoverTree(_matrix(b["v"])), cosine))

    apart = meet.select("label", "dim", "id_l", "id", "at_left", "row", "v").groupBy(
        "label", "dim", "id_l", "id").applyInPandas(between, _FOUND)
    return own.where("radius < 0").select("row", "n", "root").union(whole).union(apart)


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, part_rows: int = PART_ROWS) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``, one row per row of ``vectors``."""
    numbered = materialize(vectors.select("vec_id", "label", "embedding")
                           .withColumn("row", F.monotonically_increasing_id()), "vectors")
    valid = materialize(valid_vectors(numbered), "valid-vectors")
    found = materialize(link_counts(deal(valid, part_rows), cosine), "vector-links")
    counts = materialize(found.groupBy("row").agg(F.sum("n").alias("n_links")), "link-counts")
    roots = materialize(connected_components(found, "row", "root"), "vector-roots")
    ids = numbered.select("row", "vec_id")
    named = materialize(roots.join(ids, roots["node"] == ids["row"]).select("node", "root", "vec_id"), "named")
    least = materialize(named.groupBy("root").agg(F.min("vec_id").alias("component_id")), "component-ids")
    # written tables on both sides: adaptive execution can split a component that holds much of the rows
    of = materialize(named.select("node", "root").join(least, "root").select("node", "component_id"), "components")
    out = ids.join(counts, "row", "left").join(of, F.col("row") == F.col("node"), "left")
    component = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
