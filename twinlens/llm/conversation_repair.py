"""Conversation structure repair by Knuth's lightest derivations (operator 12).

A conversation's rows, by turn, become a sequence of roles of the form
``(s?(ua)+)?`` by the cheapest edits. An item ``[i, q]`` says that what follows
row ``i`` can be repaired from grammar state ``q`` on; axioms are the accepted
ends, an edit of row ``i - 1`` or an insertion deduces an item from another, and
the goal is the first row in the start state. The agenda pops the lightest item
by ``(cost, rows consumed, edit)``. Edits cost nothing or more, only those that
consume a row are free, and an item's edits differ in their letters (each leads
to one state only), so every deduction is superior in that order: what is popped is
final, ties are the ASCII-least by construction, and no audit is ever compared
as a string.

How it runs: rows are range-partitioned and sorted by conversation and turn, so
that a conversation of any length is cut by partition bounds. One that lies
inside a partition is repaired there. Those at a partition's two ends
(at most two a partition) may go on elsewhere: each piece gives the lightest
cost between every pair of states (an agenda for each exit state), a
conversation's pieces (no more than there are partitions) are put together
backwards from these small tables, and every piece is then repaired on its own from
its entry state to exits of known cost. Repeats are found by an aggregate on the
text's digest. The digest of the repaired text is sequential by its nature: it
is streamed over the pieces in order, which are never gathered.

Defined cases: equal turns are put in order of role and text (nulls count as
one space), a null turn comes first; a null conv_id is a conversation of its
own; roles that start with none of s, u, a (also empty ones) can't be kept; a
conversation without rows after the damage has zeros, an empty audit and the empty
text's hash; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinlens.session import materialize

#: Contract values: what an edit costs, what an undeleted truncated row adds, faults by the damage's remainder.
KEEP, INSERT, REROLE, DELETE, TRUNCATED = 0, 2, 2, 3, 1
FAULTS = 20
DROP, BLANK, UNSTOP, REPEAT, USER = range(5)
#: Initials that may follow one another.
LEGAL = ("su", "ua", "au")

#: Grammar states: nothing yet, after s, after u, after a; what each takes next, and those that may end.
START, SYSTEM, ASKED, ANSWERED = range(4)
NEXT = [{"s": SYSTEM, "u": ASKED}, {"u": ASKED}, {"a": ANSWERED}, {"u": ASKED}]
#: The user or assistant that a state needs, for rows given another role and for inserted ones.
NEED = ["u", "u", "a", "u"]
ACCEPT = (START, ANSWERED)
ROLE = {"u": "user", "a": "assistant"}
_NEVER = 1 << 60


def _edits(code: str, q: int) -> Iterator[tuple[str, int, int]]:
    """``(letter, cost, next state)`` of a row's edits; code: x blank or repeated, else the initial (truncated: capital)."""
    yield "D", DELETE, q
    if code == "x":
        return
    more = TRUNCATED if code.isupper() else 0
    if code.lower() in NEXT[q]:
        yield "K", KEEP + more, NEXT[q][code.lower()]
    yield "R", REROLE + more, NEXT[q][NEED[q]]


@lru_cache(maxsize=None)
def _deductions(code: str) -> list[list[tuple[str, int, int]]]:
    """By state that an edit of such a row leads to: ``(letter, cost, state before)``."""
    out: list[list[tuple[str, int, int]]] = [[] for _ in NEXT]
    for q in range(len(NEXT)):
        for letter, cost, then in _edits(code, q):
            out[then].append((letter, cost, q))
    return out


_INSERTED: list[list[int]] = [[q for q in range(len(NEXT)) if NEXT[q][NEED[q]] == then] for then in range(len(NEXT))]


def agenda(codes: str, exits: dict[int, int], entry: int | None) -> dict[tuple[int, int], tuple[int, str]]:
    """Final items ``(row, state): (cost, edit)`` for the exit states' costs; ends when ``[0, entry]`` is final.

    Without an entry it ends when nothing is left. The edit of an exit is empty.
    """
    n, final = len(codes), {}
    todo = [(cost, 0, "", q) for q, cost in exits.items() if cost < _NEVER]
    heapq.heapify(todo)
    while todo:
        cost, consumed, edit, q = heapq.heappop(todo)
        i = n - consumed
        if (i, q) in final:
            continue
        final[i, q] = cost, edit
        if i == 0 and q == entry:
            break
        for before in _INSERTED[q]:
            if (i, before) not in final:
                heapq.heappush(todo, (cost + INSERT, consumed, "I", before))
        if i:
            for letter, more, before in _deductions(codes[i - 1])[q]:
                if (i - 1, before) not in final:
                    heapq.heappush(todo, (cost + more, consumed + 1, letter, before))
    return final


def derivation(codes: str, final: dict[tuple[int, int], tuple[int, str]], entry: int) -> tuple[str, str, int]:
    """``(audit, roles, exit state)`` of the item ``[0, entry]``; roles: of each edit k, -, or the role it gives."""
    audit, roles, i, q = [], [], 0, entry
    while edit := final[i, q][1]:
        audit.append(edit)
        if edit == "D":
            roles.append("-")
            i += 1
            continue
        role = codes[i].lower() if edit == "K" else NEED[q]
        roles.append("k" if edit == "K" else role)
        q = NEXT[q][role]
        i += edit != "I"
    return "".join(audit), "".join(roles), q


@lru_cache(maxsize=1 << 16)
def _repair_short(codes: str) -> tuple[int, str, str]:
    final = agenda(codes, dict.fromkeys(ACCEPT, 0), START)
    return final[0, START][0], *derivation(codes, final, START)[:2]


def repair(codes: str) -> tuple[int, str, str]:
    """``(cost, audit, roles given)`` of a whole conversation."""
    return _repair_short(codes) if len(codes) <= 64 else _repair_short.__wrapped__(codes)


def repaired_lines(audit: str, roles: str, rows: list[tuple[str, str]]) -> list[str]:
    """``role:text`` of what the edits leave; rows: ``(role, text)``."""
    out, own = [], iter(rows)
    for edit, given in zip(audit, roles, strict=True):
        role, text = ("", "") if edit == "I" else next(own)
        if edit != "D":
            out.append(f"{role if given == 'k' else ROLE[given]}:{text}")
    return out


def _spaced(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(" "))


def _name() -> Column:
    """A conversation's name: its id after a colon, '' for the null one."""
    return F.coalesce(F.concat(F.lit(":"), F.col("conv_id").cast("string")), F.lit(""))


def damaged(conversations: DataFrame) -> DataFrame:
    """``(k, turn, role, text)`` after the damage; ``k`` names the conversation."""
    fault = F.crc32(F.concat(_spaced("conv_id"), F.lit(":"), _spaced("turn")).cast("binary")) % FAULTS
    text = F.when(fault == BLANK, "").when(fault == UNSTOP, F.regexp_replace(_spaced("text"), "[.!?]", "")).otherwise(
        _spaced("text"))
    role = F.when(fault == USER, "user").otherwise(_spaced("role"))
    return (conversations.withColumn("fault", fault).where(F.col("fault") != DROP)
            .select(_name().alias("k"), "turn", role.alias("role"), text.alias("text"),
                    F.when(F.col("fault") == REPEAT, 2).otherwise(1).alias("times"))
            .withColumn("copy", F.explode(F.sequence(F.lit(1), "times"))).drop("times"))


def coded(rows: DataFrame) -> DataFrame:
    """``rows``, written out and numbered, with ``code`` and ``fault`` (b, d, t or empty) of each."""
    said = F.sha2(F.concat(F.char_length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"), 256)
    at = materialize(rows.withColumn("said", said).withColumn("at", F.monotonically_increasing_id()), "damaged")
    place = F.struct("turn", "at")  # equal rows of one turn are interchangeable
    first = materialize(at.groupBy(F.col("k").alias("of"), F.col("said").alias("what")).agg(
        F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "repeats")
    words = F.rtrim(F.col("text"), F.lit(" \t\n\x0b\x0c\r"))
    blank = words == ""
    again = F.col("first").isNotNull() & (place > F.col("first"))
    cut = ~F.substring(words, -1, 1).isin(".", "!", "?")
    fault = F.when(blank, "b").when(again, "d").when(cut, "t").otherwise("")
    initial = F.substring("role", 1, 1)
    code = F.when(F.col("fault").isin("b", "d"), "x").when(initial.isin("s", "u", "a"), initial).otherwise("o")
    out = at.join(first, (F.col("k") == F.col("of")) & (F.col("said") == F.col("what")), "left").withColumn(
        "fault", fault)
    return out.select("k", "turn", "role", "text", "at", "fault",
                      F.when(F.col("fault") == "t", F.upper(code)).otherwise(code).alias("code"))


_REPAIRED = ("k string, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
             "repaired_sha256 string")
_PIECE = "piece int, seq long, code string, fault string, role string, text string"


def _counts(faults: list[str]) -> dict[str, int]:
    return {"blank": faults.count("b"), "duplicate": faults.count("d"), "truncated": faults.count("t")}


def _illegal(initials: list[str]) -> int:
    return sum(a + b not in LEGAL for a, b in pairwise(initials))


def _whole(k: str, rows: list[tuple[str, str, str, str]]) -> dict:
    """The result of a conversation from its rows ``(code, fault, role, text)``."""
    cost, audit, roles = repair("".join(r[0] for r in rows))
    lines = repaired_lines(audit, roles, [(r[2], r[3]) for r in rows])
    return {"k": k, **_counts([r[1] for r in rows]), "illegal": _illegal([r[2][:1] for r in rows]), "cost": cost,
            "audit": audit, "repaired_sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest()}


def _frame(rows: list[dict], schema: str) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")], dtype=object)
    # whole numbers with gaps stay whole
    return out.astype({c.split()[0]: "Int64" for c in schema.split(", ") if c.split()[1] in ("long", "int")})


def _in_partitions(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Results of the conversations inside the partition; the rows of its first and its last one as they are."""
    from pyspark import TaskContext
    piece, schema = TaskContext.get().partitionId(), f"{_REPAIRED}, {_PIECE}"
    key, rows, first = None, [], True

    def edge() -> pd.DataFrame:
        return _frame([{"k": key, "piece": piece, "seq": i, "code": code, "fault": fault, "role": role, "text": text}
                       for i, (code, fault, role, text) in enumerate(rows)], schema)

    for batch in batches:
        done = []
        for k, *row in zip(*(batch[c].tolist() for c in ("k", "code", "fault", "role", "text")), strict=True):
            if k != key:
                if rows and first:
                    yield edge()
                    first = False
                elif rows:
                    done.append(_whole(key, rows))
                key, rows = k, []
            rows.append(tuple(row))
        if done:
            yield _frame(done, schema)
    if rows:
        yield edge()


def _costs(codes: str) -> list[int]:
    """Lightest cost from each state before the rows to each state behind them, entry by entry."""
    by_exit = [agenda(codes, {q: 0}, None) for q in range(len(NEXT))]
    return [by_exit[q].get((0, p), (_NEVER, ""))[0] for p in range(len(NEXT)) for q in range(len(NEXT))]


def repaired(rows: DataFrame) -> DataFrame:
    """The results (``_REPAIRED``) of ``coded`` rows, one for each conversation that has any."""
    ordered = rows.repartitionByRange("k", "turn", "role", "text", "at").sortWithinPartitions(
        "k", "turn", "role", "text", "at").select("k", "code", "fault", "role", "text")
    done = materialize(ordered.mapInPandas(_in_partitions, f"{_REPAIRED}, {_PIECE}"), "repaired")
    names = [c.split()[0] for c in _REPAIRED.split(", ")]
    pieces = done.where("piece is not null").select("k", *[c.split()[0] for c in _PIECE.split(", ")])

    def tables(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("seq")
        initials = group["initial"].tolist()
        return pd.DataFrame([{"k": key[0], "piece": key[1], "costs": _costs("".join(group["code"])),
                              **_counts(group["fault"].tolist()), "illegal": _illegal(initials),
                              "first": initials[0], "last": initials[-1]}])

    def joined(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        """Exit costs and entry state of every piece, and the totals."""
        group = group.sort_values("piece").reset_index(drop=True)
        n, then = len(NEXT), [0 if q in ACCEPT else _NEVER for q in range(len(NEXT))]
        exits = []
        for costs in reversed(group["costs"].tolist()):
            exits.append(then)
            then = [min(_NEVER, *(int(costs[p * n + q]) + then[q] for q in range(n))) for p in range(n)]
        totals = {c: int(group[c].sum()) for c in ("blank", "duplicate", "truncated", "illegal")}
        totals["illegal"] += sum(a + b not in LEGAL for a, b in zip(group["last"], group["first"][1:], strict=False))
        return pd.DataFrame([{"k": key[0], "piece": p, "exits": e, **totals, "cost": then[START]}
                             for p, e in zip(group["piece"].tolist(), reversed(exits), strict=True)])

    narrow = pieces.select("k", "piece", "seq", "code", "fault", F.substring("role", 1, 1).alias("initial"))
    costs = narrow.groupBy("k", "piece").applyInPandas(
        tables, "k string, piece int, costs array<long>, blank long, duplicate long, truncated long, illegal long, "
                "first string, last string")
    known = materialize(costs.groupBy("k").applyInPandas(
        joined, "k string, piece int, exits array<long>, blank long, duplicate long, truncated long, illegal long, "
                "cost long"), "piece-costs")

    def mend(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        """A piece's edits and repaired lines from each state it may be entered in."""
        left = left.sort_values("seq")
        codes, exits = "".join(left["code"]), {q: int(c) for q, c in enumerate(right["exits"].iloc[0])}
        final = agenda(codes, exits, None)
        rows, out = list(zip(left["role"], left["text"], strict=True)), []
        for p in range(len(NEXT)):
            audit, roles, then = derivation(codes, final, p)
            lines = repaired_lines(audit, roles, rows)
            out.append({"k": key[0], "piece": key[1], "entry": p, "then": then, "audit": audit, "n": len(lines),
                        "lines": "\n".join(lines)})
        return pd.DataFrame(out)

    ends = known.select("k", "piece", "exits").groupBy("k", "piece")
    mended = materialize(pieces.groupBy("k", "piece").cogroup(ends).applyInPandas(
        mend, "k string, piece int, entry int, then int, audit string, n long, lines string"), "mended")

    def streamed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, state, at, audit, digest, some = None, START, START, [], None, False

        def result() -> dict:
            return {"k": key, "audit": "".join(audit), "repaired_sha256": digest.hexdigest()}

        for batch in batches:
            out = []
            for k, entry, then, part, n, lines in zip(*(batch[c].tolist() for c in (
                    "k", "entry", "then", "audit", "n", "lines")), strict=True):
                if k != key:
                    if key is not None:
                        out.append(result())
                    key, state, audit, digest, some = k, START, [], hashlib.sha256(), False
                if entry == 0:  # a piece comes once for each state; the one it is entered in counts
                    at = state
                if entry != at:
                    continue
                audit.append(part)
                if n:
                    digest.update((b"\n" if some else b"") + lines.encode())
                    some = True
                state = then
            if out:
                yield pd.DataFrame(out)
        if key is not None:
            yield pd.DataFrame([result()])

    whole = mended.repartition("k").sortWithinPartitions("k", "piece", "entry").mapInPandas(
        streamed, "k string, audit string, repaired_sha256 string")
    totals = known.select("k", "blank", "duplicate", "truncated", "illegal", "cost").distinct()
    return done.where("piece is null").select(*names).union(whole.join(totals, "k").select(*names))


def report(conversations: DataFrame) -> DataFrame:
    """Damage and repair of every conversation, one row for each conv_id."""
    rows = damaged(conversations)
    turns = rows.groupBy(F.col("k").alias("of")).agg(
        (F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn")).cast("long").alias("gaps"))
    ids = conversations.select("conv_id").distinct().withColumn("k", _name())
    out = ids.join(repaired(coded(rows)), "k", "left").join(turns, F.col("k") == F.col("of"), "left")
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in
            ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select("conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
