"""Secret scans: fixed patterns, and a character convolutional network over further candidates in their context."""

from __future__ import annotations

import itertools
import math
import re
from bisect import bisect_right
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnstone.llm.arrow import annotate, pieces, raw, release
from turnstone.operators.ordinals import free_name
from turnstone.session import materialize, ship

#: Fixed patterns, in the order in which kinds are listed; a match shorter than the least length is dropped.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_LEAST = 6
_WORDS = ("passw", "secret", "token", "api")

#: What the network judges besides the patterns' matches: words of eight and more characters with a digit, and what
#: follows a key word outside the fixed list.
LEARNED = "learned"
_RUN = re.compile(r"[A-Za-z0-9+/_.@-]{8,}={0,2}")
_DIGIT = re.compile(r"[0-9]")
_KEYS = ("pwd", "passphrase", "credential", "authorization", "bearer", "private_key", "private key", "access_key", "access key")
_KEYED = re.compile(rf"""(?:{"|".join(_KEYS)})s?(?:["']?\x20*[:=]\x20*["']?|\x20+)([A-Za-z0-9+/_.=-]{{6,}})""", re.A | re.I)
_BEFORE_KEYED = re.compile(rf"""(?:{"|".join(_KEYS)}|password|passwd|secret|token|api_?key|key)s?["']?\x20*[:=\x20]\x20*["']?$""", re.A | re.I)
_EDGES = ".-"

#: Characters of a candidate that the network reads at once, of the context before and after it, and the network's sizes.
#: A longer candidate is read in overlapping windows, STRIDE characters apart.
INSIDE, BEFORE, AFTER = 48, 32, 16
STRIDE = INSIDE // 2
WIDTH, CHANNELS, FILTERS = 5, 12, 24
#: Findings of the corpus that a shard trains on in one round, the most rounds and shards of one round that are planned first, and
#: how many findings made from fixed shapes the network begins with; each shard goes over a quarter of those again.
SHARD, ROUNDS, SHARDS = 8192, 8, 256
MADE, MADE_LONG = 4_000, 2_000
RECALL = 0.98
SEED = 11

SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("score", T.DoubleType())])
FIELDS = [T.StructField("base", T.ArrayType(SPAN)), T.StructField("found", T.ArrayType(SPAN))]


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns' matches, by start, then kind as listed. Offsets are code points."""
    spans = []
    lower = text.lower()
    if any(w in lower for w in _WORDS):
        spans += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        spans += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    spans += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))


def candidates(text: str) -> list[tuple[int, int]]:
    found = set()
    for m in _RUN.finditer(text):
        if _DIGIT.search(m[0]):
            word = m[0].rstrip(_EDGES)
            a = m.start() + len(word) - len(word := word.lstrip(_EDGES))
            if len(word) >= 8:
                found.add((a, a + len(word)))
    lower = text.lower()
    if any(w in lower for w in _KEYS):
        found |= {m.span(1) for m in _KEYED.finditer(text)}
    return sorted(found)


def is_keyed(text: str, start: int) -> bool:
    """Whether a key word stands right before a candidate: such candidates have a threshold of their own."""
    return bool(_BEFORE_KEYED.search(text[max(0, start - BEFORE) : start]))


def uncovered(found: list[tuple[int, int]], spans: list[tuple[int, int, str]]) -> list[tuple[int, int]]:
    """The candidates that no span (by start) holds wholly."""
    starts = [s for s, _, _ in spans]
    reach = list(itertools.accumulate((e for _, e, _ in spans), max))
    return [(a, b) for a, b in found if not (k := bisect_right(starts, a)) or reach[k - 1] < b]


# --- the network ---------------------------------------------------------------------------------------------

#: Character classes: one each for printable ASCII, one for line ends, one for the rest, and padding is 0.
_SYMBOLS = 98
LENGTH = BEFORE + INSIDE + AFTER


def _symbol(c: str) -> int:
    return ord(c) - 30 if " " <= c <= "~" else 1 if c in "\r\n\t" else _SYMBOLS - 1


def window(text: str, start: int, end: int) -> list[int]:
    """The candidate and what surrounds it as symbols: context before, its first characters, context after."""
    return _window(text, start, end, start)


def windows(text: str, start: int, end: int) -> Iterator[list[int]]:
    """All windows of a candidate, which hold each of its characters, with the context of the whole candidate."""
    last = max(start, end - INSIDE)
    for at in range(start, last, STRIDE):
        yield _window(text, start, end, at)
    yield _window(text, start, end, last)


def _window(text: str, start: int, end: int, at: int) -> list[int]:
    parts = ((text[max(0, start - BEFORE) : start], BEFORE, True), (text[at : min(end, at + INSIDE)], INSIDE, False), (text[end : end + AFTER], AFTER, False))
    out: list[int] = []
    for piece, size, right in parts:
        codes = [_symbol(c) for c in piece]
        pad = [0] * (size - len(codes))
        out += pad + codes if right else codes + pad
    return out


@dataclass
class Network:
    """Embedding, one convolution (its filters see where in the window they are: context or candidate), max and mean
    pooling of each part, and a logistic output, calibrated on held-out findings."""

    embed: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    out_bias: float
    slope: float = 1.0
    shift: float = 0.0
    threshold: float = 0.5
    keyed_threshold: float = 0.5
    #: Held-out recall and precision of the candidates without and with a key word before them.
    measured: tuple = ()

    def least(self, keyed: bool) -> float:
        return self.keyed_threshold if keyed else self.threshold

    def logits(self, codes: np.ndarray) -> np.ndarray:
        return self._forward(codes)[0]

    def _forward(self, codes: np.ndarray):
        x = self.embed[codes]
        cols = np.lib.stride_tricks.sliding_window_view(x, WIDTH, axis=1).transpose(0, 1, 3, 2).reshape(len(codes), LENGTH - WIDTH + 1, -1)
        z = np.maximum(cols @ self.filters + self.bias, 0)
        parts = ((0, BEFORE), (BEFORE, BEFORE + INSIDE - WIDTH + 1), (BEFORE + INSIDE - WIDTH + 1, z.shape[1]))
        tops = [z[:, a:b].argmax(1) + a for a, b in parts]
        pooled = np.concatenate([np.take_along_axis(z, t[:, None], 1)[:, 0] for t in tops] + [z[:, parts[1][0] : parts[1][1]].mean(1)], 1)
        return pooled @ self.out + self.out_bias, (cols, z, tops, parts, pooled)

    def scores(self, codes: np.ndarray) -> np.ndarray:
        """Calibrated probabilities."""
        out = np.zeros(len(codes))
        for i in range(0, len(codes), 512):
            out[i : i + 512] = 1 / (1 + np.exp(-(self.slope * self.logits(codes[i : i + 512]) + self.shift)))
        return out

    def judge(self, findings: Iterator[tuple[str, int, int]]) -> list[float]:
        """For each (text, start, end) the score of its highest window; windows are made and read some at a time."""
        tops: list[float] = []
        for some in _batched(((i, w) for i, f in enumerate(findings) for w in windows(*f)), 4096):
            scores = self.scores(np.array([w for _, w in some], np.uint8))
            for (i, _), score in zip(some, scores.tolist(), strict=True):
                if i == len(tops):
                    tops.append(score)
                else:
                    tops[i] = max(tops[i], score)
        return tops


def _batched(items: Iterator, size: int) -> Iterator[list]:
    while some := list(itertools.islice(items, size)):
        yield some


def _rows(first: np.ndarray, findings: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The findings' windows, and where each finding's start among them."""
    sizes = first[findings + 1] - first[findings]
    begins = np.cumsum(sizes) - sizes
    return np.arange(sizes.sum()) + np.repeat(first[findings] - begins, sizes), begins


def _top(net: Network, codes: np.ndarray, first: np.ndarray, findings: np.ndarray) -> np.ndarray:
    """Of each finding the window with the highest logit."""
    if len(codes) == len(first) - 1:
        return findings
    out = first[findings]
    many = first[findings + 1] - out > 1
    if many.any():
        rows, begins = _rows(first, findings[many])
        logits = np.concatenate([net.logits(codes[rows[i : i + 512]]) for i in range(0, len(rows), 512)])
        ends = [*begins[1:], len(rows)]
        out[many] = [rows[a + int(logits[a:b].argmax())] for a, b in zip(begins, ends, strict=True)]
    return out


def _descend(net: Network, codes: np.ndarray, labels: np.ndarray, bounds: np.ndarray, fit: np.ndarray, epochs: int, rng: np.random.Generator) -> None:
    """Change net by Adam over the findings in fit."""
    names = ("embed", "filters", "bias", "out")
    first = {k: np.zeros_like(getattr(net, k)) for k in names} | {"out_bias": 0.0}
    second = {k: np.zeros_like(getattr(net, k)) for k in names} | {"out_bias": 0.0}
    weight = np.where(labels == 1, 0.5 / max(1, labels.sum()), 0.5 / max(1, (1 - labels).sum())) * len(labels)
    step = 0
    for _ in range(epochs):
        for batch in np.array_split(rng.permutation(fit), max(1, len(fit) // 64)):
            x, y = codes[_top(net, codes, bounds, batch)], labels[batch]
            logits, (cols, z, tops, parts, pooled) = net._forward(x)
            error = (1 / (1 + np.exp(-logits)) - y) * weight[batch] / len(batch)
            grads = {"out": pooled.T @ error, "out_bias": error.sum()}
            back = np.outer(error, net.out).reshape(len(batch), 4, FILTERS)
            dz = np.zeros_like(z)
            for p, t in enumerate(tops):
                np.put_along_axis(dz, t[:, None], np.take_along_axis(dz, t[:, None], 1) + back[:, p][:, None], 1)
            a, b = parts[1]
            dz[:, a:b] += back[:, 3][:, None] / (b - a)
            dz *= z > 0
            grads["bias"] = dz.sum((0, 1))
            grads["filters"] = np.tensordot(cols, dz, ((0, 1), (0, 1)))
            dcols = (dz @ net.filters.T).reshape(len(batch), z.shape[1], WIDTH, CHANNELS)
            dx = np.zeros((len(batch), LENGTH, CHANNELS))
            for k in range(WIDTH):
                dx[:, k : k + z.shape[1]] += dcols[:, :, k]
            grads["embed"] = np.zeros_like(net.embed)
            np.add.at(grads["embed"], x, dx)
            step += 1
            for k, g in grads.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                move = 0.005 * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
                setattr(net, k, getattr(net, k) - move)


def train(codes: np.ndarray, labels: np.ndarray, epochs: int = 6, seed: int = SEED, recall: float = RECALL, owners: np.ndarray | None = None, keyed: np.ndarray | None = None) -> Network:
    """Fit by Adam on four fifths of the findings; on the rest, fit the calibration (Platt's two parameters) and
    take the highest thresholds that still find `recall` of the secrets there, one for findings that are keyed (after a
    key word) and one for the others.

    owners: the finding of each row of codes, in order, where findings have several windows; as in `judge`, the highest
    window counts. Without it each row is a finding.
    """
    bounds = np.arange(len(labels) + 1) if owners is None else np.searchsorted(owners, np.arange(len(labels) + 1))
    rng = np.random.default_rng(seed)
    net = Network(
        rng.normal(0, 0.3, (_SYMBOLS, CHANNELS)), rng.normal(0, 0.15, (WIDTH * CHANNELS, FILTERS)), np.zeros(FILTERS), rng.normal(0, 0.1, 4 * FILTERS), 0.0
    )
    order = rng.permutation(len(labels))
    held, fit = order[: len(order) // 5], order[len(order) // 5 :]
    _descend(net, codes, labels, bounds, fit, epochs, rng)
    top = codes[_top(net, codes, bounds, held)]
    logits, y = net.logits(top), labels[held]
    for _ in range(200):
        p = 1 / (1 + np.exp(-(net.slope * logits + net.shift)))
        net.slope -= 0.05 * float(np.mean((p - y) * logits))
        net.shift -= 0.05 * float(np.mean(p - y))
    scores = net.scores(top)
    after = np.zeros(len(held), bool) if keyed is None else np.asarray(keyed, bool)[held]
    measured = []
    for name, mine in (("threshold", ~after), ("keyed_threshold", after)):
        good = np.sort(scores[mine & (y == 1)])
        least = float(good[int((1 - recall) * len(good))]) if len(good) else net.threshold if name != "threshold" else 1.0
        setattr(net, name, least)
        taken = mine & (scores >= least)
        measured.append((float((scores[mine & (y == 1)] >= least).mean()) if len(good) else 0.0, float(y[taken].mean()) if taken.any() else 0.0))
    net.measured = tuple(measured)
    return net


_FINDING = pa.schema([("excerpt", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("label", pa.int32())])

# --- over documents ------------------------------------------------------------------------------------------

#: Shapes of tokens that are no secrets, and of keys, that fixed findings are made from besides the corpus's own.
_HARMLESS = (
    "https/www/example/com/page{d}/index{d}", "chapter{d}_section{d}_paragraph", "version-{d}-release-candidate-{d}",
    "report_{d}_final_version_{d}", "IMG_{d}_{d}_thumbnail", "page={d}/section={d}/table", "item-{d}-of-{d}-in-series",
    "north-region-{d}-south-region-{d}", "ISBN-{d}-{d}-{d}-paperback", "the/quick/brown/fox{d}/jumps",
    "first.last{d}@mail{d}.example.com", "192.168.{d}.{d}", "20{d}-01-{d}T10:{d}:00", "555-{d}-{d}", "{d}{d}{d}{d}{d}", "localhost:{d}", "v{d}.{d}.{d}-beta", "www.site{d}.example.org",
)
_CONTEXT_BAD = ("see ", "in file ", "the page ", "figure ", "read more at ", "chapter ", " ", "of the ")
_CONTEXT_GOOD = ("key: ", "secret=", 'token = "', "Authorization: Bearer ", "export KEY=", "credential ", "pwd: ", " ", "uses ", "private_key=")


def made_findings(n: int, seed: int = SEED) -> list[tuple[str, int, int, int]]:
    """n labelled findings (text, start, end, label) from fixed shapes, half of them secrets."""
    rng = np.random.default_rng(seed)
    alphabets = ["0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", "abcdefghijklmnopqrstuvwxyz0123456789"]
    prefixes = ["", "", "sk-", "ghp_", "xoxb-", "AIza", "pk_live_"]
    out = []
    for i in range(n):
        if i % 2:
            letters = alphabets[rng.integers(len(alphabets))]
            token = prefixes[rng.integers(len(prefixes))] + "".join(letters[j] for j in rng.integers(0, len(letters), rng.integers(14, 48)))
            before = _CONTEXT_GOOD[rng.integers(len(_CONTEXT_GOOD))]
        else:
            token = re.sub(r"\{d\}", lambda _: str(rng.integers(1, 2000)), _HARMLESS[rng.integers(len(_HARMLESS))])
            before = _CONTEXT_BAD[rng.integers(len(_CONTEXT_BAD))]
        out.append((f"{before}{token} ", len(before), len(before) + len(token), i % 2))
    return out


#: What long tokens are put together from, besides the shapes above.
_PARTS = ("services", "production", "eu-west-1", "us-east-2", "accounts", "v1", "v2", "hooks", "api", "internal", "static", "assets", "images", "users", "build", "release", "archive", "data")


def long_findings(n: int, seed: int = SEED) -> list[tuple[str, int, int, int]]:
    """n labelled findings of tokens that may be long: paths, half of them with a key at some place, which are secrets."""
    rng = np.random.default_rng(seed + 1)
    keys = [text[a:b] for text, a, b, label in made_findings(n, seed + 1) if label]
    shape = lambda: re.sub(r"\{d\}", lambda _: str(rng.integers(1, 2000)), _HARMLESS[rng.integers(len(_HARMLESS))].replace("=", "-"))
    out = []
    for i in range(n):
        parts = [shape() if rng.random() < 0.2 else _PARTS[rng.integers(len(_PARTS))] for _ in range(rng.integers(3, 16))]
        if i % 2:
            parts.insert(len(parts) if rng.random() < 0.5 else int(rng.integers(len(parts) + 1)), keys[i // 2])
        token = "/".join(parts)
        contexts = _CONTEXT_BAD if rng.random() < 0.5 else _CONTEXT_GOOD
        before = contexts[rng.integers(len(contexts))]
        out.append((f"{before}{token} ", len(before), len(before) + len(token), i % 2))
    return out


def train_whole(findings: list[tuple[str, int, int, int]], **options) -> Network:
    """The network trained on all windows of labelled findings (text, start, end, label)."""
    codes, owners = _coded(findings)
    keyed = np.array([is_keyed(t, a) for t, a, _, _ in findings])
    return train(codes, np.array([y for *_, y in findings]), owners=owners, keyed=keyed, **options)


def _coded(findings: list[tuple[str, int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """All windows of the findings, and each one's finding."""
    made = [[np.array(w, np.uint8) for w in windows(t, a, b)] for t, a, b, _ in findings]
    return np.array([w for ws in made for w in ws]), np.repeat(np.arange(len(made)), [len(w) for w in made])


def labelled_findings(texts: list[str]) -> list[tuple[str, int, int, int]]:
    """Findings of the texts: the patterns' matches are secrets, also where another text stands before them; plain long
    words, up to four a text, are not, nor are all words with digits that no pattern knows (addresses, numbers), the harder ones."""
    out = []
    before = ""
    for text in texts:
        spans = base_spans(text)
        for a, b, kind in spans:
            if kind == "assign":
                a = b - len(ASSIGN.match(text, a)[2])
            out.append((text[max(0, a - BEFORE) : b + AFTER], min(a, BEFORE), min(a, BEFORE) + b - a, 1))
            out.append((f"{before} {text[a : b + AFTER]}", len(before) + 1, len(before) + 1 + b - a, 1))
        words = [m.span() for m in re.finditer(r"[^\s]{12,}", text)]
        hard = [(a, b) for a, b in candidates(text) if not is_keyed(text, a)]
        for a, b in uncovered(words[:: max(1, len(words) // 4)][:4] + hard, spans):
            if not any(s < b and a < e for s, e, _ in spans):
                out.append((text[max(0, a - BEFORE) : b + AFTER], min(a, BEFORE), min(a, BEFORE) + b - a, 0))
        before = text[:BEFORE]
    return out


_PARAMETERS = ("embed", "filters", "bias", "out", "out_bias")
#: Logits are counted in steps of a thousandth, from which calibration and thresholds are read.
_STEP, _FAR = 1000, 30_000


def _train_shard(net: Network, shard: int, findings: list[tuple[str, int, int, int]], epochs: int) -> list[float]:
    """The network's parameters after the findings of a shard, with some made ones among them."""
    mine = replace(net, **{k: np.array(getattr(net, k)) for k in _PARAMETERS[:-1]})
    every = findings + made_findings(MADE // 4, SEED + 1) + long_findings(MADE_LONG // 4, SEED + 1)
    codes, owners = _coded(every)
    bounds = np.searchsorted(owners, np.arange(len(every) + 1))
    _descend(mine, codes, np.array([y for *_, y in every]), bounds, np.arange(len(every)), epochs, np.random.default_rng([SEED, shard]))
    return np.concatenate([np.ravel(getattr(mine, k)) for k in _PARAMETERS]).tolist()


def _averaged(net: Network, rows: list[tuple[int, list[float]]]) -> Network:
    """net with the mean of the shards' parameters, each weighed by its findings."""
    flat = np.average([r[1] for r in rows], axis=0, weights=[r[0] for r in rows])
    at, parts = 0, {}
    for k in _PARAMETERS:
        shape = np.shape(getattr(net, k))
        size = int(np.prod(shape))
        parts[k] = flat[at : at + size].reshape(shape) if shape else float(flat[at])
        at += size
    return replace(net, **parts)


def _steps(net: Network, findings: list[tuple[str, int, int, int]]) -> list[int]:
    """Each finding's highest logit, in steps."""
    codes, owners = _coded(findings)
    logits = np.concatenate([net.logits(codes[i : i + 512]) for i in range(0, len(codes), 512)])
    top = np.maximum.reduceat(logits, np.searchsorted(owners, np.arange(len(findings))))
    return np.clip(np.floor(top * _STEP), -_FAR, _FAR).astype(int).tolist()


def _calibrate(net: Network, counted: list[tuple[int, int, bool, float]], recall: float = RECALL) -> Network:
    """net with Platt's parameters and thresholds from (logit in steps, label, keyed, how many)."""
    net = replace(net, slope=1.0, shift=0.0)
    step, y, after, n = (np.array(c) for c in zip(*sorted(counted), strict=True))
    logits, after = step / _STEP, after.astype(bool)
    for _ in range(200):
        p = 1 / (1 + np.exp(-(net.slope * logits + net.shift)))
        net.slope -= 0.05 * float(np.average((p - y) * logits, weights=n))
        net.shift -= 0.05 * float(np.average(p - y, weights=n))
    measured = []
    for name, mine in (("threshold", ~after), ("keyed_threshold", after)):
        good = mine & (y == 1)
        below = np.cumsum(n[good])  # logits rise
        if not len(below):
            setattr(net, name, 0.5 if name == "threshold" else 1.0)
            measured.append((0.0, 0.0))
            continue
        least = logits[good][np.searchsorted(below, (1 - recall) * below[-1], "right")]
        setattr(net, name, float(1 / (1 + np.exp(-(net.slope * least + net.shift)))))
        taken = mine & (logits >= least)
        measured.append((float(n[taken & good].sum() / below[-1]), float(n[taken & good].sum() / n[taken].sum())))
    net.measured = tuple(measured)
    return net


def fit(docs: DataFrame, text: str = "text") -> Network:
    """The network, trained on every distinct labelled finding of all documents, after a beginning on made ones.

    Findings are dealt by a hash: a fifth is held out, the rest goes to shards that train side by side from the same
    parameters, whose mean the next round begins with. Shards keep their size; their number, then that of rounds, grows with the
    corpus. Calibration and thresholds come from counts of all held-out findings' logits, with made ones at half as much again."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = raw(batch.column(0))
            for begin, end in pieces(texts):
                rows = labelled_findings([t.decode() for t in texts[begin:end] if t])
                yield pa.RecordBatch.from_pylist([dict(zip(_FINDING.names, r, strict=True)) for r in rows], _FINDING)
            release()

    ship(docs.sparkSession)
    kind = "excerpt string, start int, end int, label int"
    hashed = F.xxhash64("excerpt", "start", "end", "label")
    found = docs.where(F.col(text).isNotNull()).select(F.col(text)).mapInArrow(gather, kind).distinct().withColumn("key", hashed)
    table = materialize(found.withColumn("held", F.pmod("key", F.lit(5)) == 0), "findings")
    counts = {r["held"]: r["count"] for r in table.groupBy("held").count().collect()}
    net = train_whole(made_findings(MADE) + long_findings(MADE_LONG))
    if n := counts.get(False, 0):
        rounds = max(1, min(ROUNDS, n // SHARD), -(-n // (SHARDS * SHARD)))
        shards = -(-n // (rounds * SHARD))
        epochs = max(1, min(6, 50_000 // n))
        dealt = F.pmod(F.xxhash64("key"), F.lit(rounds * shards))
        for k in range(rounds):
            before = net

            def learn(key: tuple, mine: pa.Table) -> pa.Table:
                rows = sorted(zip(*(mine.column(c).to_pylist() for c in _FINDING.names), strict=True))
                return pa.table({"shard": pa.array([key[0].as_py()], pa.int64()), "n": pa.array([len(rows)], pa.int64()), "state": pa.array([_train_shard(before, key[0].as_py(), rows, epochs)])})

            chosen = table.where("NOT held").withColumn("shard", dealt).where(F.col("shard") % rounds == k)
            done = chosen.select("shard", *_FINDING.names).groupBy("shard").applyInArrow(learn, "shard long, n long, state array<double>")
            net = _averaged(net, [(r.n, r.state) for r in sorted(done.collect())])
    own = made_findings(MADE // 4, SEED + 2) + long_findings(MADE_LONG // 4, SEED + 2)
    weight = max(1.0, 1.5 * counts.get(True, 0) / len(own))
    last = net

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(zip(*(c.to_pylist() for c in batch.columns), strict=True))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(_steps(last, rows), pa.int32()), batch.column(3), pa.array([is_keyed(t, a) for t, a, *_ in rows])], ["step", "label", "keyed"])

    judged = table.where("held").select(*_FINDING.names).mapInArrow(judge, "step int, label int, keyed boolean").groupBy("step", "label", "keyed").count()
    counted = [(r.step, r.label, r.keyed, float(r["count"])) for r in judged.collect()]
    counted += [(step, y, is_keyed(t, a), weight) for step, (t, a, _, y) in zip(_steps(net, own), own, strict=True)]
    return _calibrate(net, counted)


def scanner(net: Network) -> Callable[[list[bytes | None]], list[list]]:
    """A function from texts to their base spans and all spans."""

    def scan(texts: list[bytes | None]) -> list[list]:
        base, extra, owners, decoded = [], [], [], []
        for i, raw_text in enumerate(texts):
            text = raw_text.decode() if raw_text else ""
            spans = base_spans(text)
            decoded.append(text)
            base.append(spans)
            extra.append([])
            owners += [(i, a, b, False) for a, b, _ in spans]
            owners += [(i, a, b, True) for a, b in uncovered(candidates(text), spans)]
        scores = net.judge((decoded[i], a, b) for i, a, b, _ in owners)
        judged: list[dict[tuple[int, int], float]] = [{} for _ in texts]
        for (i, a, b, new), score in zip(owners, scores, strict=True):
            judged[i][a, b] = score
            if new and score >= net.least(is_keyed(decoded[i], a)):
                extra[i].append((a, b, LEARNED))
        kinds = (*KINDS, LEARNED)
        row = lambda i, spans: [{"kind": k, "start": a, "end": b, "score": judged[i][a, b]} for a, b, k in spans]
        every = [sorted(x + y, key=lambda s: (s[0], kinds.index(s[2]))) for x, y in zip(base, extra, strict=True)]
        return [[row(i, s) for i, s in enumerate(base)], [row(i, s) for i, s in enumerate(every)]]

    return scan


def scan_secrets(docs: DataFrame, net: Network | None = None, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """docs with base (the fixed patterns' spans) and found (those and the network's), each kind, start, end, score.

    Every candidate is judged with its context, the patterns' own matches too, which stay whatever their score;
    other candidates, unless a match covers them wholly, become spans of kind 'learned' from the network's threshold on. Offsets are code points of
    the whole text, ends exclusive. Map side only; the network has a fixed size.

    A null text is empty; texts of any length are scanned whole; repeated rows give repeated spans; an empty table
    gives no rows, with a network of made findings only; columns named like a result are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(net or fit(docs, text))
    return annotate(docs, text, lambda: scanner(shared.value), FIELDS, keep)


def listed(spans: str):
    """Spans as kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def report(docs: DataFrame, net: Network | None = None) -> DataFrame:
    """One row a document: doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    found = scan_secrets(docs.select("doc_id", "text"), net, keep=["doc_id"])
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *map(count, KINDS), F.sha2(listed("base").cast("binary"), 256).alias("base_sha256"), listed("found").alias("spans"))


MASK = "[secret]"


def _masker(net: Network) -> Callable[[list[bytes | None]], list[list]]:
    scan = scanner(net)

    def mask(texts: list[bytes | None]) -> list[list]:
        out = []
        for raw_text, spans in zip(texts, scan(texts)[1], strict=True):
            if spans:
                text, parts, at = raw_text.decode(), [], 0
                for s in spans:
                    if s["end"] > at:
                        if s["start"] >= at:
                            parts += [text[at : s["start"]], MASK]
                        at = s["end"]
                out.append("".join([*parts, text[at:]]))
            else:
                out.append(raw_text.decode() if raw_text is not None else None)
        return [out]

    return mask


def mask_secrets(docs: DataFrame, net: Network | None = None) -> DataFrame:
    """docs with every secret in text replaced by MASK, and n_chars, where there is one, set to the new length."""
    shared = docs.sparkSession.sparkContext.broadcast(net or fit(docs))
    plain = free_name(docs, "plain")
    masked = annotate(docs.withColumn(plain, F.col("text")), plain, lambda: _masker(shared.value), [T.StructField("text", T.StringType())], keep=[c for c in docs.columns if c != "text"])
    if "n_chars" in docs.columns:
        masked = masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return masked.select(*[F.col(f"`{c}`") for c in docs.columns])
