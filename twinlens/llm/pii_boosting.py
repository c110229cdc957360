"""Personal data by candidate gradient boosting (operator 9), DataFrame functions only.

1. Base rules find emails, IP addresses, card and phone numbers, with exact
   positions in code points.
2. High-recall generators propose further spans (number groups, spelled-out
   addresses), which may overlap the base ones.
3. Boosted trees score every proposal from its format and context. They learn
   from made findings of the formats the base rules don't know (``FORMATS``:
   spelled-out addresses, national phone and identity numbers) beside made
   look-alikes (dates, amounts, versions, serial numbers), and from the corpus:
   proposals at a base finding are positives, others negatives unless they
   have one of those formats, which the corpus can't label. Half of the sample
   is made; the corpus half is bounded (``SAMPLE`` in all, by class, the least by
   hash; only small feature vectors reach the driver). The trees become one
   column expression.
4. The held-out half calibrates their scores (a logistic curve of the margin). A
   proposal is redacted from a calibrated probability of ``MIN_PROBABILITY`` on,
   or from where the held-out half keeps a precision of ``MIN_PRECISION``, whichever is more.

Base findings always stay; the trees only add spans.

Defined cases: null and empty texts have no span; equal rows get equal
results; a corpus without proposals is scored by what the made findings teach;
an empty table gives an empty result; other columns, whatever their names, are
ignored or, in ``redact``, kept.
"""

from __future__ import annotations

import json
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinlens.llm.common import bounded_sample, let, match_spans, packed, whole_text
from twinlens.session import materialize

#: Kinds and their patterns, in the contract's order. Each starts
#: where the previous match ended or where its first character can't have been
#: preceded by one of its run, and repeats possessively: the leftmost matches
#: stay the same, long runs take linear time.
KINDS = ["email", "ip", "card", "phone"]
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?:\G|(?<![0-9]))[0-9](?:[\x20-][0-9]|[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
IP_PARTS = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})(?:\.|$)){4}$"
#: Generators of proposals.
GENERATORS = {
    "number": r"(?<![0-9A-Za-z])[+(]?[0-9](?:[\x20().-]{0,2}[0-9]){6,}+(?![0-9A-Za-z])",
    "digits": r"(?<![0-9A-Za-z])[0-9]{7,19}+(?![0-9A-Za-z])",
    "address": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(?:@|\x20?[(\[]at[)\]]\x20?)"
               r"[A-Za-z0-9-]++(?:(?:\.|\x20?[(\[]dot[)\]]\x20?)[A-Za-z0-9-]++)++",
}
#: Formats that are personal data without a base rule, as proposals look.
FORMATS = (r"^[A-Za-z0-9._%+-]+(?:@|\x20?[(\[]at[)\]]\x20?).*[(\[](?:at|dot)[)\]]|[(\[]at[)\]]"
           r"|^\(?[0-9]{3}\)?[\x20.-]{1,2}[0-9]{3}[\x20.-][0-9]{4}$|^0[0-9]{2,4}[\x20-][0-9]{3,4}[\x20-][0-9]{3,4}$"
           r"|^[0-9]{3}-[0-9]{2}-[0-9]{4}$")
CONTEXT = 24
HINTS = {
    "talk": r"(?i)(?:phone|call|tel|fax|mobile|contact)",
    "mail": r"(?i)(?:mail|write|contact)",
    "money": r"(?i)(?:card|visa|account|iban|credit|pay)",
    "person": r"(?i)(?:ssn|social|passport|born|name)",
}
#: Parameters of the trees.
SAMPLE = 8000
ROUNDS = 24
RATE = 0.3
MADE = 4000
MIN_PRECISION = 0.95
MIN_PROBABILITY = 0.9
#: How often a redacted text is searched again.
AGAIN = 2
_SPANS = "array<struct<kind:string,start:int,end:int,m:string>>"


def _luhn(digits: Column) -> Column:
    """True if the digits' Luhn sum ends in 0."""
    ds = F.transform(F.split(F.reverse(digits), ""), lambda c: F.coalesce(c.try_cast("int"), F.lit(0)))
    total = F.aggregate(F.transform(ds, lambda d, i: F.when(i % 2 == 0, d).otherwise(
        F.when(d > 4, d * 2 - 9).otherwise(d * 2))), F.lit(0), lambda s, x: s + x)
    return total % 10 == 0


def _valid(kind: str, m: Column) -> Column:
    digits = F.regexp_replace(m, "[^0-9]", "")
    n = F.length(digits)
    return {"email": F.lit(True), "ip": m.rlike(IP_PARTS),
            "card": F.when(n.between(13, 19), _luhn(digits)).otherwise(False),
            "phone": n.between(9, 15)}[kind]


def _none() -> Column:
    return F.array().cast(_SPANS)


def base_spans(text: Column) -> Column:
    """All base findings, by kind as listed and then by start."""
    has = {"email": F.contains(text, F.lit("@")), "phone": F.contains(text, F.lit("+")),
           "ip": text.rlike(r"[0-9]\.[0-9]"), "card": text.rlike(r"[0-9](?:[\x20-]?[0-9]){12}")}
    return F.concat(*[_found(text, k, PATTERNS[k], has[k], lambda x, k=k: _valid(k, x["m"])) for k in KINDS])


def _found(text: Column, kind: str, pattern: str, possible: Column, valid=None) -> Column:
    """The pattern's matches as spans of a kind; ``valid(x)`` decides which of them stay."""
    spans = match_spans(text, pattern)
    if valid is not None:
        spans = F.filter(spans, lambda x: valid(x))
    spans = F.transform(spans, lambda x: F.struct(F.lit(kind).alias("kind"), x["start"].alias("start"),
                                                  x["end"].alias("end"), x["m"].alias("m")))
    return F.when(possible, spans.cast(_SPANS)).otherwise(_none())


def proposals(text: Column) -> Column:
    """Spans of the generators, which may overlap others."""
    has = {"number": text.rlike(r"[0-9](?:[\x20().-]{0,2}[0-9]){6}"), "digits": text.rlike("[0-9]{7}"),
           "address": F.contains(text, F.lit("@")) | text.rlike(r"[(\[]at[)\]]")}
    return F.concat(*[_found(text, name, pattern, has[name]) for name, pattern in GENERATORS.items()])


FEATURES = ["address", "length", "digits", "separators", "dots", "plus", "brackets", "letters", "groups",
            "longest_group", "first_group", "last_group", "luhn", "ip_form", "before_space", "after_space",
            "after_mark", *[f"hint_{h}" for h in HINTS]]


def features(x: Column, text: Column) -> Column:
    """Small integers describing a proposal's format and context, in the order of FEATURES."""
    m = x["m"]

    def left(pattern: str) -> Column:
        return F.length(F.regexp_replace(m, pattern, ""))

    digits = F.regexp_replace(m, "[^0-9]", "")
    before = F.substring(text, F.greatest(x["start"] - CONTEXT + 1, F.lit(1)), F.least(x["start"], F.lit(CONTEXT)))
    after = F.substring(text, x["end"] + 1, F.lit(1))
    groups = F.regexp_extract_all(m, F.lit("[0-9]+"), F.lit(0))
    flags = [before.rlike(h) for h in HINTS.values()]
    return F.array(*[c.cast("int") for c in [
        x["kind"] == "address", F.length(m), F.length(digits), left(r"[^\x20-]"), left(r"[^.]"), left("[^+]"),
        left("[^()]"), left("[^A-Za-z]"), F.size(groups),
        F.coalesce(F.array_max(F.transform(groups, lambda g: F.length(g))), F.lit(0)),
        F.coalesce(F.length(F.get(groups, F.lit(0))), F.lit(0)),
        F.coalesce(F.length(F.get(groups, F.size(groups) - 1)), F.lit(0)),
        F.when(F.length(digits).between(13, 19), _luhn(digits)).otherwise(False), m.rlike(IP_PARTS),
        before.rlike(r"(?:^|[\s>(])$"), (after == "") | after.rlike(r"\s"), after.rlike(r"[.,;:!?]"), *flags]])


def _scored(docs: DataFrame, *keep: str) -> DataFrame:
    """Adds ``_base`` and ``_more``: base findings, and proposals with features and label."""
    df = docs.select(*keep, whole_text("text").alias("_t")).withColumn(
        "_base", base_spans(F.col("_t")))
    more = F.transform(proposals(F.col("_t")), lambda p: F.struct(
        p.alias("span"), features(p, F.col("_t")).alias("f"),
        F.exists("_base", lambda b: (b["start"] < p["end"]) & (b["end"] > p["start"])).alias("hit")))
    return df.withColumn("_more", more)


class Trees:
    """Boosted trees of depth two for the logistic loss, and the score above which spans are taken."""

    def __init__(self, x: np.ndarray, y: np.ndarray, rounds: int = ROUNDS):
        fit, held = np.arange(len(y)) % 2 == 0, np.arange(len(y)) % 2 == 1
        self.trees: list[tuple] = []
        self.start = float(np.log((y[fit].sum() + 1) / ((1 - y[fit]).sum() + 1)))
        margin = np.full(len(y), self.start)
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-margin))
            g, h = (y - p) * fit, p * (1 - p) * fit
            root = self._split(x, g, h, np.ones(len(y), bool))
            if root is None:
                break
            f, t = root
            tree = [root]
            for side in (x[:, f] <= t, x[:, f] > t):
                cut = self._split(x, g, h, side)
                parts = [side] if cut is None else [side & (x[:, cut[0]] <= cut[1]), side & (x[:, cut[0]] > cut[1])]
                leaves = [float(RATE * g[s].sum() / (h[s].sum() + 1.0)) for s in parts]
                for s, v in zip(parts, leaves, strict=True):
                    margin[s] += v
                tree.append((cut, leaves))
            self.trees.append(tuple(tree))
        self.slope, self.offset = self._calibrated(margin[held], y[held])
        # the lowest margin that keeps the precision among held-out proposals at or above it
        order = np.argsort(-margin[held], kind="stable")
        m, hit = margin[held][order], y[held][order]
        good = np.cumsum(hit) / np.arange(1, len(hit) + 1) >= MIN_PRECISION
        last = np.append(m[1:] != m[:-1], True) if len(m) else np.zeros(0, bool)
        ok = np.flatnonzero(good & last)
        sure = (np.log(MIN_PROBABILITY / (1 - MIN_PROBABILITY)) - self.offset) / self.slope
        self.threshold = max(float(sure), float(m[ok[-1]])) if len(ok) and self.slope > 0 else float("inf")

    @staticmethod
    def _calibrated(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
        """Slope and offset of the log-odds of a held-out positive as a line in the margin (Newton steps)."""
        a, b = 1.0, 0.0
        # targets a little inside 0 and 1 keep the line finite where the classes are apart
        t = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
            w = p * (1 - p) + 1e-9
            g = np.array([((p - t) * margin).sum(), (p - t).sum()])
            mixed = (w * margin).sum()
            h = np.array([[(w * margin * margin).sum() + 1e-6, mixed], [mixed, w.sum() + 1e-6]])
            step = np.linalg.solve(h, g)
            a, b = a - step[0], b - step[1]
            if np.abs(step).max() < 1e-9:
                break
        return (float(a), float(b)) if np.isfinite(a) and np.isfinite(b) else (1.0, 0.0)

    @staticmethod
    def _split(x, g, h, rows):
        best = (1e-6, None)
        for f in range(x.shape[1]):
            for t in np.unique(x[rows, f])[:-1]:
                a = rows & (x[:, f] <= t)
                b = rows & (x[:, f] > t)
                gain = (g[a].sum() ** 2 / (h[a].sum() + 1) + g[b].sum() ** 2 / (h[b].sum() + 1)
                        - g[rows].sum() ** 2 / (h[rows].sum() + 1))
                if gain > best[0]:
                    best = (gain, (f, float(t)))
        return best[1]

    def margin(self, f: Column) -> Column:
        """The trees as a column over a proposal's features."""
        def leaf(cut, leaves) -> Column:
            if cut is None:
                return F.lit(leaves[0])
            return F.when(F.get(f, F.lit(cut[0])) <= cut[1], leaves[0]).otherwise(leaves[1])

        parts = [F.when(F.get(f, F.lit(root[0])) <= root[1], leaf(*low)).otherwise(leaf(*high))
                 for root, low, high in self.trees]
        return reduce(lambda a, b: a + b, parts, F.lit(self.start))


def made_findings(n: int = MADE, seed: int = 11) -> list[tuple[str, int, int, bool]]:
    """``(text, start, end, personal)``: as many findings of FORMATS as look-alikes, in and out of telling contexts."""
    rng = np.random.default_rng(seed)
    some = lambda *x: x[rng.integers(len(x))]
    num = lambda k: "".join(map(str, rng.integers(0, 10, k)))
    word = lambda: "".join(some(*"bcdfglmnprst") + some(*"aeiou") for _ in range(rng.integers(1, 4)))

    def address() -> str:
        at, dot = some((" [at] ", " [dot] "), ("(at)", "(dot)"), ("[at]", "."), (" (at) ", " (dot) "), ("@", " [dot] "))
        return word() + some("", ".", "_") + word() + at + word() + dot + some("org", "com", "net", "de", "info")

    personal = [address,
                lambda: some(f"({num(3)}) {num(3)}-{num(4)}", f"{num(3)}-{num(3)}-{num(4)}",
                             f"{num(3)}.{num(3)}.{num(4)}", f"{num(3)} {num(3)} {num(4)}"),
                lambda: some(f"0{num(3)} {num(3)} {num(4)}", f"0{num(2)} {num(4)} {num(4)}",
                             f"0{num(4)}-{num(3)}-{num(3)}"),
                lambda: f"{num(3)}-{num(2)}-{num(4)}"]
    other = [lambda: some(f"20{num(2)}-{num(2)}-{num(2)}", f"{num(2)}.{num(2)}.20{num(2)} {num(2)}",
                          f"20{num(2)} - 20{num(2)}"),
             lambda: some(f"{num(2)} {num(3)} {num(3)}", f"{num(1)} {num(3)} {num(3)} {num(3)}",
                          f"{num(3)}.{num(3)}.{num(3)}"),
             lambda: num(rng.integers(7, 20)), lambda: num(16), lambda: f"17{num(8)}",
             lambda: some(f"{num(2)}.{num(1)}.{num(2)}.{num(4)}", f"978-{num(1)}-{num(2)}-{num(6)}-{num(1)}",
                          f"{num(4)}-{num(4)}-{num(3)}", f"{num(3)}-{num(3)}-{num(3)}-{num(3)}")]
    tell = {0: ("write to", "mail", "contact"), 1: ("call", "phone", "tel", "fax"), 2: ("call", "tel.", "mobile"),
            3: ("ssn", "social security", "passport", "born")}
    plain = ("in", "the", "see", "number", "order", "on", "version", "item", "about", "total")
    out = []
    for i in range(n):
        good = i % 2 == 0
        k = int(rng.integers(len(personal if good else other)))
        value = (personal if good else other)[k]()
        lead = some(*tell[k]) if good and rng.random() < 0.6 else some(*plain)
        before = " ".join(word() for _ in range(rng.integers(0, 8))) + " " + lead + some(" ", ": ", " ")
        out.append((before + value + some("", ".", ", ") + " " + word(), len(before), len(before) + len(value), good))
    return out


def train(docs: DataFrame, sample: int = SAMPLE, made: int = MADE) -> Trees | None:
    """Trees from made findings and a bounded sample of the corpus' proposals, labelled as the module says."""
    rows = json.dumps([{"text": t, "a": a, "b": b, "good": good} for t, a, b, good in made_findings(made)])
    given = docs.sparkSession.range(1).select(F.explode(F.from_json(
        F.lit(rows), "array<struct<text:string,a:int,b:int,good:boolean>>")).alias("r")).select("r.*").repartition(8)
    own = _scored(given, "a", "b", "good").select("a", "b", "good", F.explode("_more").alias("p")).where("not p.hit")
    at = (F.col("p.span.start") < F.col("b")) & (F.col("p.span.end") > F.col("a"))
    known = [(r.f, float(r.y)) for r in own.select("p.f", (at & F.col("good")).alias("y")).collect()]
    found = _scored(docs, "doc_id").where(F.size("_more") > 0).select("doc_id", F.explode("_more").alias("p"))
    found = materialize(found.where(F.col("p.hit") | ~F.col("p.span.m").rlike(FORMATS))
                        .select("p.f", "p.hit", F.xxhash64("doc_id", "p.span").alias("h")), "proposals")
    for hit in (True, False):
        share = bounded_sample(found.where(F.col("hit") == hit), (sample - made) // 2, "h", "f").collect()
        known += [(r.f, float(hit)) for r in share]
    order = np.random.default_rng(5).permutation(len(known))
    x, y = np.array([known[i][0] for i in order]), np.array([known[i][1] for i in order])
    return Trees(x, y) if len(y) >= 20 and 0 < y.sum() < len(y) else None


def find(docs: DataFrame, *keep: str, trees: Trees | None) -> DataFrame:
    """The columns named in ``keep`` with ``base`` and ``spans`` (base and added ones, by kind and start)."""
    df = _scored(docs, *keep)
    none = _none()
    if trees is None:
        added = none
    else:
        chosen = F.filter("_more", lambda p: ~p["hit"] & (trees.margin(p["f"]) >= trees.threshold))
        added = F.coalesce(F.transform(chosen, lambda p: p["span"]).cast(_SPANS), none)
    order = {k: i for i, k in enumerate([*KINDS, *GENERATORS])}
    rank = F.create_map(*[F.lit(v) for kv in order.items() for v in kv])

    def by_kind(spans: Column) -> Column:
        keyed = F.transform(spans, lambda s: F.struct(rank[s["kind"]].alias("k"), s["start"].alias("a"), s.alias("s")))
        return F.transform(F.array_sort(keyed), lambda s: s["s"])

    spans = F.when(F.size(added) == 0, F.col("_base")).otherwise(by_kind(F.concat("_base", added)))
    return df.select(*keep, "_t", F.col("_base").alias("base"), spans.alias("spans"))


def joined(spans: Column) -> Column:
    """``kind:start:end`` of all spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def report(docs: DataFrame) -> DataFrame:
    """Per document the base counts, the base digest and all spans."""
    found = find(docs, "doc_id", trees=train(docs))

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(k) for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"))


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span, overlapping ones merged, replaced by ``<kind>`` of its first one."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    empty = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        fresh = F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]),
                         F.lit("<"), s["kind"], F.lit(">"))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"),
                        F.when(s["start"] >= acc["at"], fresh).otherwise(acc["out"]).alias("out"))

    def finish(acc: Column) -> Column:
        return F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.char_length(text)))

    return F.when(F.size(spans) == 0, text).otherwise(F.aggregate(ordered, empty, step, finish))


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data replaced in ``text``; null texts stay null, other columns as they are.

    What a replaced neighbour had hidden from the base rules (digits that ran
    on into the next number, say) is looked for again in the outcome.
    """
    rows = docs.select("doc_id", "text", packed(docs).alias("row"))
    found = find(rows, "row", trees=train(docs)).withColumn("_out", redacted(F.col("_t"), F.col("spans")))
    for _ in range(AGAIN):
        found = found.withColumn("_again", F.when(F.size("spans") > 0, base_spans(F.col("_out"))).otherwise(_none()))
        found = found.withColumn("_out", redacted(F.col("_out"), F.col("_again")))
    text = F.when(F.col("row")["text"].isNotNull(), F.col("_out")).alias("text")
    return found.select(*[text if c == "text" else F.col("row")[c].alias(c) for c in docs.columns])
