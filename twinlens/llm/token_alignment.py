"""Cross-tokenizer alignment (operator 11).

Every text is encoded by a byte-level BPE (A) and by a sentencepiece BPE (B).
Where a token of A and a token of B end at the same byte, the text is cut into
groups; tokens of a group overlap and are linked. The common ends come from a
galloping intersection: each end of the shorter list goes into the longer one
by an exponential search from where it is expected, then a binary search.
Differences of the ranks of common ends are the group's tokens on either side.

1. ``align``: one pass in Arrow batches. Texts are gathered into chunks of
   ``CHUNK_BYTES``; a chunk keeps its distinct id pairs once, with the number of
   its documents that hold them, and its documents' results as a compressed
   Arrow table that points into that list.
2. ``pair_counts``: documents a pair is linked in, over the corpus, and whether
   that is the highest of its A id. Sums are partly done in the chunks.
3. ``alignments``: counts go back to the chunks by a join on the pair, and each
   chunk's documents are read out again with them.

So pairs travel once a chunk and not once a document, and no task holds more
than a chunk and its pairs. A chunk is the unit of recovery, too.

Neither tokenizer joins across a single space between two characters that are no
white space (``Pair`` checks that no piece of B's vocabulary holds a space after
another character), so texts are cut there into units. A chunk encodes and
aligns each distinct unit once, and a document is the sequence of its units; a
very long text is never one string to a tokenizer unless it has no spaces. A group of
many tokens is counted by its distinct ids and never spelled out as pairs of positions.

Defined cases: null and empty texts and texts that either tokenizer doesn't
give back byte for byte have no tokens: zeros and an empty hash; equal rows are
counted as documents of their own; a null doc_id stays; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinlens.session import materialize

#: Parameters: the tokenizers' files (never copied here), characters of a chunk of documents and of a tokenizer's
#: line, lines of a call.
TOKENIZERS = "/opt/tokenizers"
FILE_A, FILE_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
CHUNK_BYTES = 4 << 20
LINE_CHARS = 1 << 12
LINES = 64
#: Links of a group that are spelled out one by one; larger groups are counted by distinct ids.
SPELLED = 4096
#: An id pair as one number: A's id, then B's in this many bits.
SHIFT = 32

_CUT = re.compile(r"(?<=\S) (?=\S)")


def _byte_letters() -> dict[str, int]:
    """The characters that stand for bytes in A's vocabulary: printable ones for themselves, the others from U+0100."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Pair:
    """Both tokenizers with the bytes of every token."""

    def __init__(self, folder: str = TOKENIZERS):
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = Tokenizer.from_file(os.path.join(folder, FILE_A))
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=os.path.join(folder, FILE_B))
        letters = _byte_letters()
        vocab = self.a.get_vocab()
        self.bytes_a = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.bytes_a[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(n[3:5], 16)]) if self.b.is_byte(i) else n.replace("▁", " ").encode()
                        for i, n in enumerate(names)]
        if any(re.search("[^▁]▁", n) for n in names):
            raise ValueError("pieces that go on after a space: long texts can't be cut")
        self.length_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.length_b = np.array([len(x) for x in self.bytes_b], np.int64)
        self.text_a = [str(i) for i in range(len(self.bytes_a))]
        self.text_b = [str(i) for i in range(len(self.bytes_b))]

    def encode(self, units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """``(ids of A, ids of B, A's tokens in each unit, B's, given back whole)`` of a space and each unit.

        Units that either side doesn't give back byte for byte have no tokens. They go to the tokenizers in
        lines, whose tokens are told apart by their bytes. A unit that begins with white space opens a line
        and one that ends with it closes its line: beside another space, tokens would run on into the next unit.
        """
        lines, line, size = [], [], 0
        for u in units:
            if line and u[0].isspace():
                lines.append(line)
                line, size = [], 0
            line.append(u)
            size += len(u) + 1
            if size >= LINE_CHARS or u[-1].isspace():
                lines.append(line)
                line, size = [], 0
        lines += [line] if line else []
        found, good = [], []
        for i in range(0, len(lines), LINES):
            for f, g in self._lines(lines[i:i + LINES]):
                found.append(f)
                good += g
        join = lambda k: np.concatenate([np.zeros(0, np.int64), *[f[k] for f in found]])
        return join(0), join(1), join(2), join(3), np.array(good, bool)

    def _lines(self, lines: list[list[str]]) -> Iterator[tuple[list[np.ndarray], list[bool]]]:
        texts = [" ".join(x) for x in lines]
        ids_a = [e.ids for e in self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]
        for line, text, a, b in zip(lines, texts, ids_a, self.b.encode(texts, num_threads=1), strict=True):
            whole = (" " + text).encode()
            if b"".join([self.bytes_a[i] for i in a]) == whole and b"".join([self.bytes_b[i] for i in b]) == whole:
                ends = np.cumsum(np.fromiter(((len(u) if u.isascii() else len(u.encode())) + 1 for u in line), np.int64,
                                             len(line)))
                a, b = np.array(a, np.int64), np.array(b, np.int64)
                n_a, n_b = (np.diff(np.searchsorted(np.cumsum(size[ids]), ends, side="right"), prepend=0)
                            for size, ids in ((self.length_a, a), (self.length_b, b)))
                yield [a, b, n_a, n_b], [True] * len(line)
            elif len(line) > 1:  # one by one, so that only what isn't given back is left out
                one = list(self._lines([[u] for u in line]))
                yield [np.concatenate([f[k] for f, _ in one]) for k in range(4)], [g[0] for _, g in one]
            else:
                none, zero = np.zeros(0, np.int64), np.zeros(1, np.int64)
                yield [none, none, zero, zero], [False]


def gallop(short: np.ndarray, long: np.ndarray, guess: np.ndarray) -> np.ndarray:
    """For each of ``short`` the first place in ``long`` that is not less; both ascend, ``long`` ends no earlier.

    From ``guess`` the step doubles, up or down, until the value is enclosed;
    then the bracket is halved. All ends go side by side.
    """
    last = len(long) - 1
    at = np.clip(guess, 0, last)
    up = long[at] < short
    lo, hi = np.where(up, at, -1), np.where(up, last, at)  # long[lo] < value <= long[hi]
    for rising in (True, False):
        lanes, step = np.flatnonzero(up == rising), 1
        while len(lanes):
            probe = at[lanes] + step if rising else at[lanes] - step
            inside = probe <= last if rising else probe >= 0
            less = np.zeros(len(lanes), bool)
            less[inside] = long[probe[inside]] < short[lanes[inside]]
            if rising:
                lo[lanes[inside & less]] = probe[inside & less]
                hi[lanes[inside & ~less]] = probe[inside & ~less]
                lanes = lanes[inside & less]
            else:
                hi[lanes[inside & ~less]] = probe[inside & ~less]
                lo[lanes[inside & less]] = probe[inside & less]
                lanes = lanes[inside & ~less]
            step *= 2
    lanes = np.flatnonzero(hi - lo > 1)
    while len(lanes):
        mid = (lo[lanes] + hi[lanes]) >> 1
        less = long[mid] < short[lanes]
        lo[lanes[less]], hi[lanes[~less]] = mid[less], mid[~less]
        lanes = lanes[hi[lanes] - lo[lanes] > 1]
    return hi


def common_ends(ends_a: np.ndarray, ends_b: np.ndarray, starts_a: np.ndarray,
                starts_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranks in both lists of the ends they share; ``starts``: each text's first rank, and the list's length."""
    flip = len(ends_a) > len(ends_b)
    short, long, s, t = (ends_b, ends_a, starts_b, starts_a) if flip else (ends_a, ends_b, starts_a, starts_b)
    if not len(short):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    n, m = np.diff(s), np.diff(t)
    rank = np.arange(len(short)) - np.repeat(s[:-1], n)
    guess = np.repeat(t[:-1], n) + rank * np.repeat(m, n) // np.repeat(np.maximum(n, 1), n)
    place = gallop(short, long, guess)
    hit = np.flatnonzero(long[place] == short)
    return (place[hit], hit) if flip else (hit, place[hit])


def _runs(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """``start[i] .. start[i] + n[i] - 1`` for every i, one after another."""
    total = int(n.sum())
    return np.arange(total) + np.repeat(start - np.concatenate([[0], np.cumsum(n)[:-1]]), n) if total else np.zeros(
        0, np.int64)


def linked(ids_a: np.ndarray, ids_b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray, text_of: np.ndarray):
    """Links in the groups that start at ``cut_a`` and ``cut_b`` (with the lists' lengths), in order of ``text_of``.

    ``(text, pair)`` one by one, and ``(text, pair, times)`` of groups with over ``SPELLED`` links.
    """
    na, nb = np.diff(cut_a), np.diff(cut_b)
    plain = na * nb <= SPELLED
    ga = np.flatnonzero(plain)
    a_at = _runs(cut_a[ga], na[ga])
    group = np.repeat(ga, na[ga])
    left, right = np.repeat(a_at, nb[group]), _runs(cut_b[group], nb[group])
    one = np.repeat(text_of[group], nb[group]), (ids_a[left] << SHIFT) | ids_b[right]
    text, pair, times = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for g in np.flatnonzero(~plain):
        ua, ca = np.unique(ids_a[cut_a[g]:cut_a[g + 1]], return_counts=True)
        ub, cb = np.unique(ids_b[cut_b[g]:cut_b[g + 1]], return_counts=True)
        pair.append(((ua[:, None] << SHIFT) | ub).ravel())
        times.append((ca[:, None] * cb).ravel())
        text.append(np.full(len(pair[-1]), text_of[g]))
    return one, (np.concatenate(text), np.concatenate(pair), np.concatenate(times))


def _starts(n: np.ndarray) -> np.ndarray:
    """First ranks of runs of lengths ``n``, and their total."""
    out = np.zeros(len(n) + 1, np.int64)
    np.cumsum(n, out=out[1:])
    return out


def _chunk(pair: Pair, ids: list, texts: list[str | None], name: str) -> dict:
    """One chunk's row: its pairs, their documents, and its documents as a compressed table."""
    cut = [_CUT.split(t) if t else [] for t in texts]
    doc_starts = _starts(np.array([len(c) for c in cut], np.int64))
    places: dict[str, int] = {}  # pandas' hash of strings would end at a NUL
    seq = np.fromiter((places.setdefault(u, len(places)) for c in cut for u in c), np.int64, doc_starts[-1])
    units = list(places)
    del cut, places
    ids_a, ids_b, n_a, n_b, good = pair.encode(units)
    # both sides of a unit have the same bytes, so the units can follow one another
    starts_a, starts_b = _starts(n_a), _starts(n_b)
    at_a, at_b = common_ends(np.cumsum(pair.length_a[ids_a]), np.cumsum(pair.length_b[ids_b]), starts_a, starts_b)
    cut_a, cut_b = np.concatenate([[0], at_a + 1]), np.concatenate([[0], at_b + 1])
    unit_of = np.searchsorted(starts_a, at_a, side="right") - 1
    (unit, code), (far_unit, far_code, far_times) = linked(ids_a, ids_b, cut_a, cut_b, unit_of)
    codes, local = np.unique(np.concatenate([code, far_code]), return_inverse=True)
    local, far_local = local[:len(code)], local[len(code):]
    edges = np.arange(len(good) + 1)
    first, far_first, group = (np.searchsorted(x, edges) for x in (unit, far_unit, unit_of))
    names_a, names_b = ([names[i] for i in x.tolist()] for names, x in ((pair.text_a, ids_a), (pair.text_b, ids_b)))
    groups = [a + "|" + b for a, b in zip([names_a[i] for i in cut_a[:-1].tolist()],
                                          [names_b[i] for i in cut_b[:-1].tolist()], strict=True)]
    for g in np.flatnonzero((np.diff(cut_a) > 1) | (np.diff(cut_b) > 1)).tolist():
        groups[g] = ",".join(names_a[cut_a[g]:cut_a[g + 1]]) + "|" + ",".join(names_b[cut_b[g]:cut_b[g + 1]])
    gr = group.tolist()
    shown = [";".join(groups[gr[u]:gr[u + 1]]) for u in range(len(good))]
    del names_a, names_b, groups, unit, code, units
    # documents: sequences of units, of which all are given back
    size = np.diff(doc_starts)
    doc = np.repeat(np.arange(len(texts)), size)
    fine = (size > 0) & (np.bincount(doc, weights=~good[seq], minlength=len(texts)) == 0)
    said = [shown[u] for u in seq.tolist()]
    sha = [hashlib.sha256(";".join(said[lo:hi]).encode()).hexdigest() if f else ""
           for f, lo, hi in zip(fine.tolist(), doc_starts[:-1].tolist(), doc_starts[1:].tolist(), strict=True)]
    del said, shown
    seq, doc = seq[fine[doc]], doc[fine[doc]]
    numbers = {c: np.bincount(doc, weights=n[seq], minlength=len(ids)).astype(np.int64)
               for c, n in (("n_a", n_a), ("n_b", n_b), ("n_groups", np.diff(group)))}
    width, n = max(1, len(codes)), np.diff(first)[seq]
    key = np.repeat(doc * width, n) + local[_runs(first[seq], n)]
    key.sort()
    new = np.flatnonzero(np.diff(key, prepend=-1))
    key, times = key[new], np.diff(np.append(new, len(key)))
    n = np.diff(far_first)[seq]
    if n.any():
        at = _runs(far_first[seq], n)
        key, where = np.unique(np.concatenate([key, np.repeat(doc * width, n) + far_local[at]]), return_inverse=True)
        more, times = np.concatenate([times, far_times[at]]), np.zeros(len(key), np.int64)
        np.add.at(times, where, more)
    of, local = key // width, (key % width).astype(np.int32)
    numbers["n_links"] = np.zeros(len(ids), np.int64)
    np.add.at(numbers["n_links"], of, times)
    bounds = pa.array(np.searchsorted(of, np.arange(len(ids) + 1)).astype(np.int32))
    table = pa.table({"doc_id": pa.array(ids, pa.int64()), **numbers, "groups_sha256": pa.array(sha, pa.string()),
                      "pairs": pa.ListArray.from_arrays(bounds, pa.array(local)),
                      "times": pa.ListArray.from_arrays(bounds, pa.array(times))})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table)
    return {"chunk": name, "codes": codes, "docs": np.bincount(local, minlength=len(codes)).astype(np.int64),
            "packed": sink.getvalue().to_pybytes()}


def align(docs: DataFrame, folder: str = TOKENIZERS, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``(chunk, codes, docs, packed)``, one row per chunk of documents."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext
        part, n, pair = TaskContext.get().partitionId(), 0, None
        ids, texts, size = [], [], 0

        def flush() -> pd.DataFrame:
            return pd.DataFrame([_chunk(pair, ids, texts, f"{part}-{n}")])

        for batch in batches:
            pair = pair or Pair(folder)
            for i, t in zip(batch["doc_id"], batch["text"], strict=True):
                ids.append(None if pd.isna(i) else int(i))
                texts.append(t)
                size += len(t or "") + 64
                if size >= chunk_bytes:
                    yield flush()
                    n, ids, texts, size = n + 1, [], [], 0
        if ids:
            yield flush()

    # ids as text: a long column with nulls would come as floats
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    return rows.mapInPandas(run, "chunk string, codes array<long>, docs array<long>, packed binary")


def pair_counts(aligned: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(chunk, at, code)`` of every chunk's pairs, and ``(code, docs, best)`` of every pair."""
    listed = aligned.select("chunk", F.posexplode(F.arrays_zip("codes", "docs")).alias("at", "p"))
    counts = materialize(listed.groupBy(F.col("p.codes").alias("code")).agg(F.sum("p.docs").alias("docs")), "pairs")
    a = F.shiftright("code", SHIFT).alias("a")
    most = counts.groupBy(a).agg(F.max("docs").alias("most")).withColumnRenamed("a", "of")
    best = counts.withColumn("a", a).join(most, F.col("a") == F.col("of"))
    return (listed.select("chunk", "at", F.col("p.codes").alias("code")),
            best.select("code", "docs", (F.col("docs") == F.col("most")).alias("best")))


_RESULT = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
           "groups_sha256 string")


def alignments(docs: DataFrame, folder: str = TOKENIZERS, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per document: tokens, groups, links, links at their A id's highest count, sum of the counts."""
    aligned = materialize(align(docs, folder, chunk_bytes), "aligned")
    listed, counts = pair_counts(aligned)
    counted = listed.join(counts, "code").select(
        "chunk", "at", (F.col("docs") * 2 + F.col("best").cast("long")).alias("value"))
    back = counted.groupBy("chunk").agg(F.array_sort(F.collect_list(F.struct("at", "value")))["value"].alias("values"))
    rows = aligned.select("chunk", "packed").join(back, "chunk", "left").select("packed", "values")

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for packed, values in zip(batch["packed"], batch["values"], strict=True):
                with pa.ipc.open_stream(packed) as stream:
                    t = stream.read_all()
                v = np.zeros(0, np.int64) if values is None else np.asarray(values, np.int64)
                pairs = t["pairs"].combine_chunks()
                own = v[pairs.flatten().to_numpy()]
                times = t["times"].combine_chunks().flatten().to_numpy()
                doc = np.repeat(np.arange(len(t)), pairs.value_lengths().to_numpy())
                out = {"n_best": np.zeros(len(t), np.int64), "count_sum": np.zeros(len(t), np.int64)}
                np.add.at(out["n_best"], doc, times * (own & 1))
                np.add.at(out["count_sum"], doc, times * (own >> 1))
                frame = t.drop_columns(["pairs", "times", "doc_id"]).to_pandas().assign(
                    **out, doc_id=t["doc_id"].to_pandas(types_mapper=lambda _: pd.Int64Dtype()))
                yield frame[[c.split()[0] for c in _RESULT.split(", ")]]

    return rows.mapInPandas(unpack, _RESULT)
