"""Secret scan with a character convolutional network in numpy (operator 6).

1. One pass over all whole texts finds the base patterns' secrets and every
   further candidate: runs of key characters of ``MIN_TOKEN`` or more, their
   parts of that length between ``/``, ``=`` and ``-``, and values of
   ``MIN_VALUE`` characters or more after any ``name:`` or ``name=``. What a
   base finding covers is cut out of them. A candidate carries overlapping
   windows over its whole length, with the characters before and behind it.
2. A small network (two convolutions over one-hot characters, largest
   activation over positions, one output) is trained on labelled findings: a
   bounded sample of the corpus' candidates (half of it base findings, which
   are positive; the others are negative, save those in a known format of keys
   or after the name of a secret, which are left out) and as many made from
   stated formats of keys and of harmless tokens, set in the sample's contexts.
3. A candidate's output is the largest of its windows'. Outputs are calibrated
   by a logistic fit on held-out findings. The threshold is the highest that
   keeps ``MIN_RECALL`` of the held-out positives; the precision it has there
   is kept beside it (``Network.precision``).
4. Candidates above it are added to the base findings, which always stay. Of a
   run and its parts, the run is added if the parts above the threshold cover
   half of it or there are none, else the parts are; what overlaps is one span.

Texts are read once; the later steps run over the candidates alone. What is
broadcast is the network (some thousand numbers).

Defined cases: null and empty texts have no finding; equal rows get equal
results; without candidates the network learns from the made findings only;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinlens.llm.common import bounded_sample
from twinlens.session import materialize

#: Contract values: kinds in order and their patterns.
KINDS = ["assign", "access", "hex"]
_ASSIGN = re.compile(r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
#: Candidates: the least length of runs and their parts, and of values after a name.
MIN_TOKEN, MIN_VALUE = 16, 6
_RUN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{%d,}" % MIN_TOKEN, re.A)
_PART = re.compile(r"[A-Za-z0-9+_]{%d,}" % MIN_TOKEN, re.A)
_VALUE = re.compile(r"(?<=[A-Za-z0-9_\"'\x20])[:=]\x20*[\"']?([A-Za-z0-9+_][A-Za-z0-9+/_.=-]{%d,})" % (MIN_VALUE - 1), re.A)
_ALNUM = re.compile("[A-Za-z0-9]")
#: Candidates that are no sure negatives: known beginnings of keys, mixed tokens, names of secrets before them.
_KNOWN = re.compile(r"(?:gh[opsu]_|github_pat_|glpat-|sk-|xox[abp]-|eyJ|AIza|AKIA|npm_|hf_)")
_NAMES = ("pass", "pwd", "secret", "token", "key", "auth", "cred", "bearer")
#: Parameters of the network and of its training.
BEFORE, WIDTH, STRIDE, AFTER = 24, 72, 24, 12
CHANNELS, TAPS = 16, 5
SAMPLE, SAMPLE_WINDOWS = 3000, 4
EPOCHS, BATCH, RATE = 5, 64, 0.004
MIN_RECALL = 0.95
SEED = 3
_SPAN = "struct<kind:string,start:int,end:int,windows:array<string>,base:boolean,run:boolean>"

#: Character classes of the one-hot coding are single ASCII letters, digits and marks.
ALPHABET = " abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-.:\"'"
_CODE = np.zeros(256, np.int64)
for _i, _c in enumerate(ALPHABET):
    _CODE[ord(_c)] = _i + 1
SYMBOLS = len(ALPHABET) + 2


def base_findings(text: str) -> list[tuple[str, int, int]]:
    """Base secrets by start, then kind as listed."""
    out = []
    if ":" in text or "=" in text:
        out += [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    out += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text)]
    out += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def windows(text: str, start: int, end: int) -> list[str]:
    """Overlapping windows over a candidate's whole length, the first and last with what lies around it."""
    out = []
    for at in range(start, max(start + 1, end + AFTER - (WIDTH - BEFORE) + STRIDE), STRIDE):
        out.append(text[max(0, at - BEFORE):at].rjust(BEFORE) + text[at:at + WIDTH - BEFORE])
    return out


def _uncovered(start: int, end: int, base: list[tuple[str, int, int]]) -> list[tuple[int, int]]:
    """The pieces of a range that no base finding covers; ``base`` is in the order of its starts."""
    out = []
    for _, s, e in base:
        if e > start and s < end:
            if s > start:
                out.append((start, s))
            start = max(start, e)
    return out + [(start, end)] if start < end else out


def candidates(text: str | None) -> list[tuple[str, int, int, list[str], bool, bool]]:
    """Base findings and further candidates: kind, start, end, windows, base, and if it is a run with cuts inside."""
    text = text or ""
    base = base_findings(text)
    parts, runs = set(), set()
    near = 0  # base findings before it end ahead of the current run
    for m in _RUN.finditer(text):
        while near < len(base) and base[near][2] <= m.start():
            near += 1
        upto = near
        while upto < len(base) and base[upto][1] < m.end():
            upto += 1
        for a, b in _uncovered(*m.span(), base[near:upto]):
            own = {p.span() for p in _PART.finditer(text, a, b)}
            parts |= own
            if b - a >= MIN_TOKEN and (a, b) not in own:
                runs.add((a, b))
    if ":" in text or "=" in text:
        near = 0
        for m in _VALUE.finditer(text):
            while near < len(base) and base[near][2] <= m.start(1):
                near += 1
            upto = near
            while upto < len(base) and base[upto][1] < m.end(1):
                upto += 1
            parts |= {(a, b) for a, b in _uncovered(*m.span(1), base[near:upto]) if b - a >= MIN_VALUE}
    out = [(k, a, b, windows(text, a, b), True, False) for k, a, b in base]
    for a, b in sorted(parts | runs):
        if _ALNUM.search(text, a, b):
            out.append(("cnn", a, b, windows(text, a, b), False, (a, b) not in parts))
    return out


def settled_spans(spans: list[tuple[int, int, bool]]) -> list[tuple[int, int]]:
    """Spans to add from accepted ``(start, end, run)``: runs give way to parts that cover less than half of them."""
    def merged(some: list[tuple[int, int]]) -> list[tuple[int, int]]:
        out: list[tuple[int, int]] = []
        for a, b in sorted(some):
            if out and a < out[-1][1]:
                out[-1] = (out[-1][0], max(b, out[-1][1]))
            else:
                out.append((a, b))
        return out

    parts = merged([(a, b) for a, b, run in spans if not run])
    starts, ends = np.array([a for a, _ in parts], np.int64), np.array([b for _, b in parts], np.int64)
    whole = []
    for a, b, run in spans:
        if run:
            lo, hi = np.searchsorted(ends, a, "right"), np.searchsorted(starts, b, "left")
            covered = int((np.minimum(ends[lo:hi], b) - np.maximum(starts[lo:hi], a)).sum())
            if covered == 0 or 2 * covered >= b - a:
                whole.append((a, b))
    return merged(parts + whole)


def coded(some: list[str]) -> np.ndarray:
    """Character numbers, one row of WIDTH per window."""
    out = np.zeros((len(some), WIDTH), np.int64)
    for i, w in enumerate(some):
        codes = np.frombuffer(w[:WIDTH].encode("utf-32-le", "surrogatepass"), np.uint32)
        out[i, :len(codes)] = np.where(codes < 256, _CODE[np.minimum(codes, 255)], SYMBOLS - 1)
    return out


class Network:
    """Two convolutions, the largest activation over positions, one output."""

    def __init__(self, seed: int = SEED):
        rng = np.random.default_rng(seed)
        # the first convolution over one-hot characters is a sum of looked-up rows
        self.w = [rng.normal(0, 0.15, (TAPS, SYMBOLS, CHANNELS)), np.zeros(CHANNELS),
                  rng.normal(0, (TAPS * CHANNELS) ** -0.5, (TAPS * CHANNELS, CHANNELS)), np.zeros(CHANNELS),
                  rng.normal(0, 0.25, CHANNELS), np.zeros(1)]
        self.calibration = (1.0, 0.0)
        self.threshold, self.precision = 0.5, None

    def forward(self, x: np.ndarray):
        w1, b1, w2, b2, w3, b3 = self.w
        n = WIDTH - TAPS + 1
        z1 = b1 + sum(w1[t][x[:, t:t + n]] for t in range(TAPS))
        a1 = np.maximum(z1, 0)
        m = n - TAPS + 1
        cols = np.concatenate([a1[:, t:t + m] for t in range(TAPS)], axis=2)
        z2 = cols @ w2 + b2
        top = z2.argmax(1)
        best = np.take_along_axis(z2, top[:, None], 1)[:, 0]
        a2 = np.maximum(best, 0)
        return a2 @ w3 + b3[0], (x, z1, cols, top, best, a2)

    def gradients(self, y: np.ndarray, out: np.ndarray, kept) -> list[np.ndarray]:
        """Of the mean logistic loss, in the order of the weights."""
        x, z1, cols, top, best, a2 = kept
        w1, _, w2, _, w3, _ = self.w
        n = WIDTH - TAPS + 1
        d = (1 / (1 + np.exp(-np.clip(out, -30, 30))) - y) / len(y)
        d_best = (d[:, None] * w3) * (best > 0)
        rows = np.arange(len(y))[:, None]
        picked = cols[rows, top]  # of each channel, the columns at its position
        g2 = np.einsum("rck,rc->kc", picked, d_best)
        d_cols = np.zeros_like(cols)
        np.add.at(d_cols, (rows, top), d_best[:, :, None] * w2.T[None])
        d1 = np.zeros_like(z1)
        m = n - TAPS + 1
        for t in range(TAPS):
            d1[:, t:t + m] += d_cols[:, :, t * CHANNELS:(t + 1) * CHANNELS]
        d1 *= z1 > 0
        g1 = np.zeros_like(w1)
        for t in range(TAPS):
            np.add.at(g1[t], x[:, t:t + n], d1)
        return [g1, d1.sum((0, 1)), g2, d_best.sum(0), a2.T @ d, np.array([d.sum()])]

    def fit(self, x: np.ndarray, y: np.ndarray, finding: np.ndarray | None = None) -> Network:
        """Adam steps on the windows of four fifths of the findings; calibration and threshold on the rest.

        ``finding`` numbers the finding of each window (default: one window each).
        """
        finding = np.arange(len(y)) if finding is None else finding
        rng = np.random.default_rng(SEED)
        count = int(finding.max()) + 1
        held_out = np.zeros(count, bool)
        held_out[rng.permutation(count)[:count // 5]] = True
        held, own = np.flatnonzero(held_out[finding]), np.flatnonzero(~held_out[finding])
        first, second = [np.zeros_like(w) for w in self.w], [np.zeros_like(w) for w in self.w]
        step = 0
        for _ in range(EPOCHS):
            own = rng.permutation(own)
            for i in range(0, len(own), BATCH):
                part = own[i:i + BATCH]
                out, kept = self.forward(x[part])
                step += 1
                for j, g in enumerate(self.gradients(y[part], out, kept)):
                    first[j] = 0.9 * first[j] + 0.1 * g
                    second[j] = 0.999 * second[j] + 0.001 * g * g
                    self.w[j] = self.w[j] - RATE * (first[j] / (1 - 0.9 ** step)) / (
                        np.sqrt(second[j] / (1 - 0.999 ** step)) + 1e-8)
        out, truth = np.full(count, -np.inf), np.zeros(count)
        np.maximum.at(out, finding[held], self.outputs(x[held]))
        truth[finding] = y
        out, truth = out[held_out], truth[held_out]
        best = (np.inf, (1.0, 0.0))
        for a in np.geomspace(0.2, 5, 25):
            for b in np.linspace(-2, 2, 17):
                m = a * out + b
                best = min(best, (float(np.mean(np.logaddexp(0, m) - truth * m)), (float(a), float(b))))
        self.calibration = best[1]
        scores = self.calibrated(out)
        good = np.sort(scores[truth == 1])
        if len(good):
            self.threshold = float(good[int((1 - MIN_RECALL) * len(good))])
            self.precision = float(truth[scores >= self.threshold].mean())
        return self

    def outputs(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([np.zeros(0), *[self.forward(x[i:i + 1024])[0] for i in range(0, len(x), 1024)]])

    def calibrated(self, out: np.ndarray) -> np.ndarray:
        a, b = self.calibration
        return 1 / (1 + np.exp(-np.clip(a * out + b, -30, 30)))

    def score(self, x: np.ndarray) -> np.ndarray:
        return self.calibrated(self.outputs(x))

    def score_candidates(self, found: list[list[str]]) -> np.ndarray:
        """The largest score of each candidate's windows; windows are coded a bounded number at a time."""
        flat = [w for ws in found for w in ws]
        if not flat:
            return np.zeros(0)
        s = np.concatenate([self.score(coded(flat[i:i + 8192])) for i in range(0, len(flat), 8192)])
        return np.maximum.reduceat(s, np.cumsum([0] + [len(ws) for ws in found[:-1]]))


def made_candidates(contexts: list[str], n: int, seed: int = SEED) -> tuple[list[list[str]], list[int]]:
    """Windows of ``n`` labelled candidates: keys of stated formats and harmless tokens, set in the given contexts."""
    rng = np.random.default_rng(seed)
    lower, digits = "abcdefghijklmnopqrstuvwxyz", "0123456789"
    upper = lower.upper()
    mixed = lower + upper + digits

    def some(chars: str, least: int, most: int = 0) -> str:
        k = int(rng.integers(least, most + 1)) if most else least
        return "".join(chars[i] for i in rng.integers(0, len(chars), k))

    def pick(choices: list):
        return choices[rng.integers(0, len(choices))]

    def syllables(k: int) -> str:
        return "".join(pick(["on", "er", "tion", "the", "an", "re", "pa", "ciu", "sch", "ver", "ment", "li", "que", "ing"])
                       for _ in range(k))

    def path() -> str:
        return "/".join(syllables(2) for _ in range(int(rng.integers(1, 5)))) + "/"

    # each gives (what stands before it, the token, what stands behind it)
    leads = ["", "", "", "key = \"", "Authorization: Bearer ", "export K=", "id ", "use "]
    keys = [lambda: "ghp_" + some(mixed, 36), lambda: "sk-" + some(mixed, 40), lambda: some(lower + upper, 20, 44),
            lambda: "xoxb-" + some(digits, 11) + "-" + some(mixed, 24), lambda: "eyJ" + some(mixed + "_", 30, 90),
            lambda: some("0123456789abcdef", 40), lambda: "AKIA" + some(upper + digits, 16),
            lambda: some(mixed + "+/", 40), lambda: "AIza" + some(mixed + "_", 35), lambda: some(mixed, 18, 64)]
    names = ["pwd", "auth_key", "passphrase", "client_key", "private_key", "credential", "db_pass", "access_key", "auth"]
    words = [lambda: syllables(2) + some(digits, 1, 4), lambda: syllables(2) + some("!_.", 1) .replace("!", "_") + some(digits, 2),
             lambda: some(mixed, 8, 24), lambda: some(lower + upper, 8, 24)]
    secret = [lambda: (pick(leads), pick(keys)(), ""), lambda: (pick(leads), pick(keys)(), ""),
              lambda: ("https://" + syllables(2) + ".org/" + path(), pick(keys)(), pick(["", "/" + syllables(2)])),
              lambda: (pick(names) + pick(["=", ": ", " = ", ":"]) + pick(["", "", "\"", "'"]), pick(words)(), "")]
    labels_of = ["color", "name", "lang", "title", "size", "href", "note", "see", "page", "width", "type", "author", "und", "date"]
    tokens = [lambda: syllables(6) + some(digits, 2), lambda: syllables(7), lambda: syllables(6).capitalize(),
              lambda: "-".join(syllables(3) for _ in range(3)) + "-" + some(digits, 4), lambda: some(digits, 16, 24),
              lambda: some(digits, 4) + "-" + some(digits, 2) + "-" + some(digits, 2) + "T" + some(digits, 6) + "Z",
              lambda: path() + some(digits, 3), lambda: path() + path() + syllables(3),
              lambda: syllables(4).upper() + "_" + syllables(3).upper() + "_" + some(digits, 2),
              lambda: "_".join(syllables(3) for _ in range(3)), lambda: "page" + some(digits, 14),
              lambda: "=" * int(rng.integers(16, 30)) + some(digits, 1) + "a"]
    plain = [lambda: ("", pick(tokens)(), ""), lambda: (pick(["", "id ", "see "]), pick(tokens)(), ""),
             lambda: ("https://" + syllables(2) + ".org/" + path(), pick(tokens)(), pick(["", "/" + syllables(2)])),
             lambda: (pick(labels_of) + pick(["=", ": ", " = ", ":"]) + pick(["", "", "\"", "'"]),
                      pick([lambda: syllables(3), lambda: some(digits, 6, 8), lambda: syllables(2) + "-" + syllables(2),
                            lambda: syllables(2) + some(digits, 1, 2)])(), "")]
    found, labels = [], []
    for i in range(n):
        label = i % 2
        lead, token, tail = pick(secret if label else plain)()
        around = pick(contexts) if contexts else " " * WIDTH
        head = around[:BEFORE] + pick([" ", "\n"]) + lead
        found.append(windows(head + token + tail + " " + around[-BEFORE:], len(head), len(head) + len(token)))
        labels.append(label)
    return found, labels


def made_findings(contexts: list[str], n: int, seed: int = SEED) -> tuple[list[str], list[int]]:
    """The first window of each made candidate, and its label."""
    found, labels = made_candidates(contexts, n, seed)
    return [ws[0] for ws in found], labels


def scanned(docs: DataFrame) -> DataFrame:
    """``(doc_id, found)``: base findings and candidates of every document."""
    @F.pandas_udf(f"array<{_SPAN}>")
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([[dict(zip(("kind", "start", "end", "windows", "base", "run"), c, strict=True))
                              for c in candidates(t)] for t in texts], dtype=object)

    return docs.select("doc_id", scan.asNondeterministic()(F.col("text")).alias("found"))


def _doubtful(window: str) -> bool:
    """True of a first window whose candidate may be a key that no base pattern knows."""
    before, token = window[:BEFORE].lower(), window[BEFORE:]
    token = re.match(r"[A-Za-z0-9+/_.=-]*", token)[0]
    mixed = len(token) >= MIN_TOKEN and all(re.search(c, token) for c in ("[a-z]", "[A-Z]", "[0-9]"))
    return mixed or bool(_KNOWN.search(token)) or any(n in before for n in _NAMES)


def train(found: DataFrame, sample: int = SAMPLE) -> Network:
    """A network from a bounded sample of the corpus' candidates and as many made findings.

    ``sample`` candidates at most, half of them base findings, and of each at
    most its first ``SAMPLE_WINDOWS`` windows come to the driver.
    """
    own = materialize(found.select(F.explode("found").alias("c")).select(
        F.slice("c.windows", 1, SAMPLE_WINDOWS).alias("windows"), "c.base").distinct(), "secret-windows")
    rows = [r for base in (True, False)
            for r in bounded_sample(own.where(F.col("base") == base), sample // 2, "windows").collect()
            if base or not _doubtful(r.windows[0])]
    contexts = [r.windows[0] for r in rows]
    more, truth = made_candidates(contexts, max(3000, len(rows)))
    every, labels = [r.windows for r in rows] + more, [int(r.base) for r in rows] + truth
    finding = np.repeat(np.arange(len(every)), [len(ws) for ws in every])
    return Network().fit(coded([w for ws in every for w in ws]), np.array(labels, float)[finding], finding)


def find(docs: DataFrame) -> DataFrame:
    """``(doc_id, found)`` with the findings that stay: base ones and candidates above the threshold."""
    found = materialize(scanned(docs), "secret-candidates")
    network = docs.sparkSession.sparkContext.broadcast(train(found))
    few = "array<struct<kind:string,start:int,end:int,base:boolean>>"

    @F.pandas_udf("array<struct<start:int,end:int>>")
    def above(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in batches:
            net = network.value
            out = []
            for cs in b:
                ok = net.score_candidates([list(c["windows"]) for c in cs]) >= net.threshold
                spans = settled_spans([(c["start"], c["end"], c["run"]) for c, k in zip(cs, ok, strict=True) if k])
                out.append([{"start": s, "end": e} for s, e in spans])
            yield pd.Series(out, dtype=object)

    base = F.transform(F.filter("found", lambda c: c["base"]), lambda c: F.struct(
        c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end"), c["base"].alias("base"))).cast(few)
    others = F.filter("found", lambda c: ~c["base"])
    rest = found.where(F.size(others) == 0).select("doc_id", base.alias("found"))
    some = found.where(F.size(others) > 0).select("doc_id", base.alias("kept"), above.asNondeterministic()(others).alias("more"))
    added = F.transform("more", lambda s: F.struct(F.lit("cnn").alias("kind"), s["start"].alias("start"),
                                                   s["end"].alias("end"), F.lit(False).alias("base"))).cast(few)
    return rest.union(some.select("doc_id", F.concat("kept", added).alias("found")))


def joined(spans: Column) -> Column:
    """``kind:start:end`` of spans, ordered by start, then kind as listed, comma-joined."""
    order = F.create_map(*[F.lit(v) for i, k in enumerate([*KINDS, "cnn"]) for v in (k, i)])
    keyed = F.array_sort(F.transform(spans, lambda s: F.struct(
        s["start"].alias("a"), order[s["kind"]].alias("k"), s["end"].alias("e"), s["kind"].alias("n"))))
    return F.array_join(F.transform(keyed, lambda s: F.concat_ws(":", s["n"], s["a"], s["e"])), ",")


def report(docs: DataFrame) -> DataFrame:
    """Per document the base counts, the base digest and all spans."""
    def count(kind: str) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("found", lambda s: s["base"])
    return find(docs).select("doc_id", *[count(k) for k in KINDS], F.sha2(joined(base), 256).alias("base_sha256"),
                             joined(F.col("found")).alias("spans"))
