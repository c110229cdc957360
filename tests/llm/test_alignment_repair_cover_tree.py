"""Operators 11 to 13 against brute force, on edge rows and on the given tables."""
import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from twinlens.llm import conversation_repair as repair_
from twinlens.llm import embedding_cover_tree as cover
from twinlens.llm import queries
from twinlens.llm import token_alignment as align_

SF = "/root/testdata/sf0.001"


# ------------------------------------------------------------ alignment

def brute_alignment(rows):
    """By sets of ends and all pairs of tokens in a group, text by text."""
    pair, per, seen = align_.Pair(), [], Counter()
    for doc_id, text in rows:
        a = pair.a.encode(" " + text, add_special_tokens=False).ids if text else []
        b = pair.b.encode(text) if text else []
        whole = (" " + text).encode() if text else b""
        if not a or any(b"".join(names[i] for i in ids) != whole
                        for names, ids in ((pair.bytes_a, a), (pair.bytes_b, b))):
            per.append((doc_id, None))
            continue
        ends_a, ends_b = (np.cumsum([len(n[i]) for i in ids]).tolist() for n, ids in ((pair.bytes_a, a), (pair.bytes_b, b)))
        i = j = 0
        groups = []
        for end in sorted(set(ends_a) & set(ends_b)):
            x, y = ends_a.index(end) + 1, ends_b.index(end) + 1
            groups.append((a[i:x], b[j:y]))
            i, j = x, y
        links = Counter((x, y) for ga, gb in groups for x in ga for y in gb)
        per.append((doc_id, (len(a), len(b), groups, links)))
        seen.update(links.keys())
    best = defaultdict(int)
    for (x, _), n in seen.items():
        best[x] = max(best[x], n)
    out = []
    for doc_id, v in per:
        if v is None:
            out.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = v
        said = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((doc_id, n_a, n_b, len(groups), sum(links.values()),
                    sum(n for k, n in links.items() if seen[k] == best[k[0]]),
                    sum(n * seen[k] for k, n in links.items()), hashlib.sha256(said.encode()).hexdigest()))
    return sorted(out, key=repr)


TEXTS = [None, "", " ", "a", "plain words, twice words", "plain words, twice words", "two  spaces\tand\n\nlines \n end ",
         "<|endoftext|> and <s> </s> <unk> <0x41>", "Ünïcödé çà et là — 你好世界 😀😀", "a▁b literal", " nbsp x",
         "x" * 3000, "qj7" * 700, "😀" * 400, "don't we'll it's 3rd 12345 67,890.12", "\r\nmixed\r\n", "é combining"]


@pytest.mark.parametrize("chunk", [1, 300, 1 << 22])
def test_alignment_equals_brute_force_on_edge_texts(spark, chunk):
    rows = [(i if i != 4 else None, t) for i, t in enumerate(TEXTS)] + [(1, "a"), (1, "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {c: F.lit(1) for c in ("chunk", "codes", "docs", "at", "a.b")})
    got = sorted((tuple(r) for r in align_.alignments(docs, chunk_bytes=chunk).collect()), key=repr)
    assert got == brute_alignment(rows)


def test_alignment_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    got = sorted((tuple(r) for r in queries.op11_token_alignment(spark, SF).collect()), key=repr)
    assert got == brute_alignment([tuple(r) for r in docs.collect()])


def test_alignment_of_texts_with_white_space_at_their_ends_and_nuls(spark):
    texts = ["x", "  ", "ends in a space ", " begins with one", "a\t", "the  ", "\u3000", "  the", "line\n", "\nline", "\xa0",
             "\x00", "\x00b", "a\x00b c", "a\x00d c", "a c", "\x1c", "y \x00", " ▁ ", "z"]
    rows = list(enumerate(texts * 2))
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = sorted((tuple(r) for r in align_.alignments(docs).collect()), key=repr)
    assert got == brute_alignment(rows)


def test_alignment_of_an_empty_table(spark):
    assert align_.alignments(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_large_groups_are_counted_by_ids(monkeypatch):
    pair = align_.Pair()
    text = "😀🤣" * 40 + "ab"
    rows = align_._chunk(pair, [1, 2], [text, text + " " + text], "x")
    monkeypatch.setattr(align_, "SPELLED", 1)
    other = align_._chunk(pair, [1, 2], [text, text + " " + text], "x")
    assert rows["codes"].tolist() == other["codes"].tolist() and rows["packed"] == other["packed"]


def test_gallop_finds_the_first_place():
    rng = np.random.default_rng(1)
    for _ in range(50):
        long = np.unique(rng.integers(0, 500, rng.integers(1, 200)))
        short = np.unique(rng.integers(0, long[-1] + 1, 40))
        guess = rng.integers(-5, len(long) + 5, len(short))
        assert align_.gallop(short, long, guess).tolist() == np.searchsorted(long, short).tolist()


# --------------------------------------------------------------- repair

def brute_edits(rows):
    """Cheapest audit by whole strings: suffixes from the end, all edits, ties by comparing the strings."""
    takes = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
    after = None
    for i in range(len(rows), -1, -1):
        best = {q: [] for q in range(4)}
        for q in range(4):
            if i == len(rows):
                best[q] += [(0, "")] if q in (0, 3) else []
                continue
            dead, cut, initial = rows[i]
            best[q].append((after[q][0] + 3, "D" + after[q][1]))
            for role, then in takes[q].items():
                if not dead and initial == role:
                    best[q].append((after[then][0] + cut, "K" + after[then][1]))
                if not dead and role != "s":
                    best[q].append((after[then][0] + cut + 2, "R" + after[then][1]))
        for _ in range(4):
            for q in range(4):
                for role, then in takes[q].items():
                    if role != "s" and best[then]:
                        cost, audit = min(best[then])
                        best[q].append((cost + 2, "I" + audit))
        after = {q: min(b) for q, b in best.items()}
    return after[0]


def brute_repair(table):
    conversations, out = defaultdict(list), []
    for conv, turn, role, text in table:
        conversations[conv].append((turn, role, text))
    for conv, given in conversations.items():
        rows = []
        for turn, role, text in given:
            name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
            fault = zlib.crc32(name.encode()) % 20
            role, text = (" " if x is None else x for x in (role, text))
            if fault == 0:
                continue
            text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
            rows += [(turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
        rows.sort(key=lambda v: (v[0] is not None, v[0] or 0, v[1].encode(), v[2].encode()))
        turns = [t for t, _, _ in rows if t is not None]
        counts, seen, coded = Counter(), set(), []
        for _, role, text in rows:
            bare = text.strip(" \t\n\x0b\x0c\r")
            fault = ("blank" if not bare else "duplicate" if (role, text) in seen
                     else "truncated" if bare[-1] not in ".!?" else "")
            counts[fault] += 1
            seen.add((role, text))
            coded.append((fault in ("blank", "duplicate"), int(fault == "truncated"), role[:1]))
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        cost, audit = brute_edits(coded)
        lines, left, last = [], iter(rows), ""
        for edit in audit:
            _, role, text = ("", "", "") if edit == "I" else next(left)
            if edit == "D":
                continue
            if edit != "K":
                role = "assistant" if last == "u" else "user"
            last = role[0]
            lines.append(f"{role}:{text}")
        out.append((conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, counts["blank"],
                    counts["duplicate"], counts["truncated"], illegal, cost, audit,
                    hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)


def _edge_conversations():
    rng = np.random.default_rng(3)
    roles = ["system", "user", "assistant", "tool", "", None, "User"]
    texts = ["Fine.", "cut off", "", None, " \t\n", "Why?", "Fine.", "é!", "end. "]
    rows = [(c if c else None, int(t) if t < 9 else None, roles[rng.integers(7) if rng.random() < 0.3 else 1 + t % 2],
             texts[rng.integers(9)]) for c in range(40) for t in rng.integers(0, 10, rng.integers(1, 12))]
    hot = [(99, int(t), ["user", "assistant"][int(rng.random() < 0.5)], f"line {rng.integers(80)}" + "." * int(rng.random() < 0.7))
           for t in range(900)]
    return rows + hot + rows[:5]


@pytest.mark.parametrize("partitions", [1, 60])
def test_repair_equals_brute_force_on_edge_conversations(spark, partitions):
    rows = _edge_conversations()
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns(
        {c: F.lit(1) for c in ("k", "at", "piece", "fault", "a.b")})
    kept = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        got = sorted((tuple(r) for r in repair_.report(frame).collect()), key=repr)
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert got == brute_repair(rows)


def test_repair_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()]
    assert sorted((tuple(r) for r in queries.op12_conversation_repair(spark, SF).collect()), key=repr) == brute_repair(rows)


def test_repair_of_an_empty_table(spark):
    frame = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert repair_.report(frame).count() == 0


@pytest.mark.parametrize("codes", ["", "s", "u", "a", "ua", "sua", "xx", "UA", "aau", "ossu", "uuuaaa", "SUAx" * 5])
def test_agenda_equals_all_edits(codes):
    rows = [(c == "x", int(c.isupper()), c.lower() if c != "o" else "t") for c in codes]
    assert repair_.repair(codes)[:2] == brute_edits(rows)


# ----------------------------------------------------------- cover tree

def brute_links(rows, cosine=cover.COSINE):
    vectors = []
    for _, v, label in rows:
        x = None if v is None or any(c is None for c in v) else np.array(v, np.float64)
        vectors.append(None if label is None or x is None or not len(x) or not np.isfinite(x).all() or not x.any() else x)
    link = np.zeros((len(rows), len(rows)), bool)
    for i, x in enumerate(vectors):
        for j, y in enumerate(vectors):
            if i != j and x is not None and y is not None and rows[i][2] == rows[j][2] and len(x) == len(y):
                x_, y_ = x / np.abs(x).max(), y / np.abs(y).max()
                link[i, j] = (x_ @ y_) / np.sqrt((x_ @ x_) * (y_ @ y_)) >= cosine
    out = []
    for i in range(len(rows)):
        seen, todo = {i}, [i]
        while todo:
            new = set(np.flatnonzero(link[todo.pop()]).tolist()) - seen
            seen |= new
            todo += new
        ids = [rows[k][0] for k in seen if rows[k][0] is not None]
        least = min(ids) if ids else None
        out.append((rows[i][0], int(link[i].sum()), least, rows[i][0] is not None and rows[i][0] == least))
    return sorted(out, key=repr)


def _edge_vectors():
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=6).tolist(), int(i % 3)) for i in range(150)]
    centre = rng.normal(size=6)
    rows += [(200 + i, (centre + rng.normal(size=6) * s).tolist(), 1) for s in (0.0, 0.02, 0.08, 0.2) for i in range(60)]
    nan, inf = float("nan"), float("inf")
    odd = [None, [], [0.0] * 6, [nan] + [1.0] * 5, [inf] + [1.0] * 5, [None] + [1.0] * 5, [1.0, 2.0], [2.0, 4.0],
           [1e300] * 6, [1e-300] * 6, [1.0] * 6]
    rows += [(900 + i, v, 1) for i, v in enumerate(odd)] + [(950, [1.0] * 6, None), (None, [1.0] * 6, 1), (None, [-1.0] * 6, 1)]
    return rows + rows[:3] + [(7, [9.0, 1.0, 0.0, 0.0, 0.0, 0.0], 2)]


@pytest.mark.parametrize("part_rows", [20, 2048])
def test_cover_tree_equals_brute_force_on_edge_vectors(spark, part_rows):
    rows = _edge_vectors()
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumns(
        {c: F.lit(1) for c in ("row", "cell", "part", "node", "a.b")})
    got = sorted((tuple(r) for r in cover.near_duplicates(frame, part_rows=part_rows).collect()), key=repr)
    assert got == brute_links(rows)


def test_cover_tree_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert sorted((tuple(r) for r in queries.op13_embedding_cover_tree(spark, SF).collect()), key=repr) == brute_links(rows)


def test_cover_tree_of_an_empty_table(spark):
    frame = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert cover.near_duplicates(frame).count() == 0


def test_tree_levels_halve_and_radii_cover():
    rng = np.random.default_rng(2)
    tree = cover.CoverTree(np.vstack([rng.normal(size=(80, 5)), np.ones((40, 5)) + rng.normal(size=(40, 5)) * 0.01]))
    for node, kids in enumerate(tree.children):
        d = np.linalg.norm(tree.unit[tree.members[node]] - tree.unit[tree.centre[node]], axis=1)
        assert d.max() == pytest.approx(tree.radius[node])
        if len(kids):
            assert sorted(tree.below(kids)) == sorted(tree.members[node])
            assert tree.centre[kids[0]] == tree.centre[node] and max(tree.radii[kids]) < tree.radius[node]
