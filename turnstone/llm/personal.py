"""Personal data: fixed patterns, and spans found by labelers whose reliability is estimated without labels."""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnstone.llm.arrow import annotate
from turnstone.operators.ordinals import free_name
from turnstone.session import materialize

#: Fixed kinds, in the order in which they are listed, then those of spans that only the method finds.
KINDS = ("email", "ip", "card", "phone")
FOUND_KINDS = ("found_email", "found_phone", "found_number", "found_name")
EVERY_KIND = KINDS + FOUND_KINDS

# Fixed patterns. A local part is looked for backwards from its at sign, and digits begin where no digit stands before them:
# the same matches as from the left, in time linear in the text.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"[0-9](?<![0-9]{2})[0-9]*+(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_NO_DIGITS = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    doubled = [int(d) for d in digits[-1::-2]], [2 * int(d) for d in digits[-2::-2]]
    return (sum(doubled[0]) + sum(d - 9 if d > 9 else d for d in doubled[1])) % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns' matches by kind as listed, then start. Offsets are code points."""
    spans = []
    done = at = 0
    while (at := text.find("@", at)) >= 0:
        if (found := _DOMAIN.match(text, at)) is not None:
            begin = at
            while begin > done and text[begin - 1] in _LOCAL:
                begin -= 1
            if begin < at:
                spans.append((begin, found.end(), "email"))
                done = found.end()
        at += 1
    if _DIGIT.search(text) is None:
        return spans
    spans += [(*m.span(), "ip") for m in _IP.finditer(text) if all(len(p := part.lstrip("0")) <= 3 and int(p or 0) <= 255 for part in m[0].split("."))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() <= 37 and 16 <= len(digits := _NO_DIGITS.sub("", m[0])) <= 19 and luhn(digits):
            spans.append((*m.span(), "card"))
    if "+" in text:
        spans += [(*m.span(), "phone") for m in _PHONE.finditer(text) if 8 <= len(_NO_DIGITS.sub("", m[0])) <= 15]
    return spans


# --- candidates besides the fixed patterns -------------------------------------------------------------------

_AT, _DOT = r"\x20?[\[({<]\x20?at\x20?[\])}>]\x20?|\x20at\x20", r"\x20?[\[({<]\x20?dot\x20?[\])}>]\x20?|\x20dot\x20|\."
_SPELLED = re.compile(rf"(?:{_AT})([A-Za-z0-9-]{{1,63}}(?:(?:{_DOT})[A-Za-z0-9-]{{1,63}}){{1,4}})", re.A | re.I)
_ANY_AT = re.compile(r"[\x20\[({<](?:(?<=\x20)at\x20[A-Za-z0-9-]+(?:\.[A-Za-z0-9]|\x20dot\x20)|\x20?at\x20?[\])}>])", re.A | re.I)
# each begins with a class of characters, which the search skips to
_BARE_PHONE = re.compile(r"[0-9(](?<![0-9.+(-].)(?:(?<=\()[0-9]{2,5}\)\x20?|(?<=[0-9])[0-9]{1,4}[\x20./-])(?:[0-9]{2,4}[\x20.-]){1,4}[0-9]{2,4}(?![0-9.-]*[0-9])")
_IBAN = r"[A-Z][0-9]{2}(?:\x20?[0-9A-Z]{4}){3,7}(?:\x20?[0-9A-Z]{1,3})?"
_LONG_NUMBER = re.compile(rf"[0-9A-Z](?<![0-9A-Za-z-].)(?:(?<=[A-Z]){_IBAN}|(?<=[0-9])(?:[0-9]{{2}}-[0-9]{{2}}-[0-9]{{4}}|[0-9]{{3}}(?:[\x20-]?[0-9]{{4}}){{3}}|[0-9]{{3}}[\x20-]?[0-9]{{6}}[\x20-]?[0-9]{{5}}))(?![0-9A-Za-z-])")
_TITLED = r"(?:(?<=M)(?:rs?|s|me)|(?<=D)r|(?<=P)rof|(?<=H)err|(?<=F)rau|(?<=S)ra?)\.?\x20((?:[A-Z][a-z]{1,20}[\x20-]){0,2}[A-Z][a-z]{1,20})"
_NAME = re.compile(rf"[A-Z](?<![A-Za-z].)(?:{_TITLED}|[a-z]{{1,20}}\x20[A-Z][a-z]{{2,20}}(?![A-Za-z]))")

#: What is looked at before and after a span.
BEFORE, AFTER = 40, 24

# Gazetteers, small lists of what is usual.
MAIL_HOSTS = ("gmail", "yahoo", "hotmail", "outlook", "icloud", "proton", "mail", "gmx", "web", "aol", "live", "example")
ENDINGS = ("com", "org", "net", "edu", "gov", "io", "de", "fr", "es", "uk", "eu", "it", "nl", "ch", "at", "us", "ca", "info")
GIVEN_NAMES = frozenset(
    "james john robert michael william david richard joseph thomas charles mary patricia jennifer linda elizabeth barbara susan jessica sarah karen anna maria laura julia peter paul martin stefan klaus hans "
    "jean pierre marie claire sophie luc carlos jose luis juan carmen pablo ana lucia emma noah oliver sophia isabella".split()
)
COUNTRIES = ("AD", "AT", "BE", "CH", "CZ", "DE", "DK", "ES", "FI", "FR", "GB", "IE", "IT", "LU", "NL", "NO", "PL", "PT", "SE")

# Context labelers: words before or after a span, for it and against it.
_CUES = {
    "found_email": re.compile(r"(?:e-?mail|mail|contact|reach|write|address|correo|courriel|kontakt)[^.!?]{0,25}$", re.A | re.I),
    "found_phone": re.compile(r"(?:phone|telefon|tel[eé]fono|t[eé]l[eé]phone|tel|call|fax|mobile|cell|handy|dial|ring|whatsapp)[^.!?]{0,20}$", re.I),
    "found_number": re.compile(r"(?:card|visa|mastercard|amex|iban|account|konto|cuenta|compte|ssn|social\x20security|passport|credit|debit)[^.!?]{0,20}$", re.A | re.I),
    "found_name": re.compile(r"(?:name\x20is|i\x20am|named|signed|dear|sincerely|regards|contact|attn|my\x20name|hei[sß]e|llamo|appelle|von|patient|customer)[:,]?\x20(?:Mr|Mrs|Ms|Dr)?\.?\x20?$", re.A | re.I),
}
_AGAINST = {
    "found_email": re.compile(r"(?:meet|look|arrive|stay|good|stop|pointed|is|was|be)$", re.A | re.I),
    "found_phone": re.compile(r"(?:isbn|issn|version|v\.|ver\.|part|order|invoice|page|pages|pp\.|section|chapter|room|no\.|nr\.|ref|score|date|range|between|from|figure|table|\$|€|£|=)[\x20:#]*$", re.A | re.I),
    "found_number": re.compile(r"(?:isbn|issn|version|part|order|invoice|serial|sku|model|tracking|doi|page|pages|ref|hash|checksum|id|=)[\x20:#]*$", re.A | re.I),
    "found_name": re.compile(r"(?:the|in|of|at|near|from|to|new|north|south|east|west|by\x20the|a|an|street|city)\x20$", re.A | re.I),
}
_AFTERWARDS = {
    "found_email": re.compile(r"^[\x20,;:)]*(?:for|or|if|with|to|any)\b", re.A | re.I),
    "found_phone": re.compile(r"^[\x20,;:)]*(?:ext|extension|or|mobile|any\x20time|and\x20ask|for)\b", re.A | re.I),
    "found_number": re.compile(r"^[\x20,;:)]*(?:exp|expires|cvv|cvc|valid|bic|swift)\b", re.A | re.I),
    "found_name": re.compile(r"^[\x20,]*(?:born|lives|aged|wrote|called|said|phd|md|esq)\b", re.A | re.I),
}
_DATE_LIKE = re.compile(r"^\(?(?:19|20)[0-9]{2}[\x20./-][0-9]{1,2}[\x20./-][0-9]{1,2}\b|^[0-9]{1,2}[\x20./-][0-9]{1,2}[\x20./-](?:19|20)?[0-9]{2}$")
_PLACES = re.compile(r"(?:Street|Road|Avenue|River|Lake|Island|University|County|City|Park|Hall|Company|Times|States|Kingdom|Church|School|Press|Church|Museum|Bridge|Monday|Tuesday|January|February|March|April|June|July|August)$")

#: Labelers, by name: each votes 1 (personal), -1 (not) or 0 for each candidate.
LABELERS = ("form", "check", "lookalike", "gazetteer", "cue", "against", "after")


def _iban(text: str) -> bool:
    plain = text.replace(" ", "")
    moved = plain[4:] + plain[:4]
    return moved.isalnum() and int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def votes(kind: str, span: str, before: str, after: str) -> tuple[int, ...]:
    """What each of LABELERS says of a span, from its characters and those around it."""
    plain = kind if kind in FOUND_KINDS else {"email": "found_email", "phone": "found_phone", "card": "found_number", "ip": "found_number"}[kind]
    digits = _NO_DIGITS.sub("", span)
    form = check = look = known = 0
    if plain == "found_email":
        parts = re.split(rf"(?:{_DOT})", re.split(rf"@|{_AT}", span, maxsplit=1, flags=re.I)[-1], flags=re.I)
        form = 1 if re.search(r"@|[\[({<]", span) else 0
        check = 1 if parts[-1].lower() in ENDINGS else -1
        look = -1 if re.search(r"\x20at\x20", span) and "." in span and not re.search(r"dot", span, re.I) else 0
        known = 1 if any(p.lower().rstrip("0123456789") in MAIL_HOSTS for p in parts[:-1]) else 0
    elif plain == "found_phone":
        form = 1 if re.match(r"^(?:\+[0-9]|\([0-9]{3}\)\x20?[0-9]{3}-[0-9]{4}$|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}$|0[0-9]{1,4}[\x20/-])", span) else 0
        check = 1 if 9 <= len(digits) <= 13 else -1
        look = -1 if _DATE_LIKE.match(span) or re.match(r"^[0-9]{1,3}(?:\x20[0-9]{3})+$", span) or re.match(r"^97[89]", digits) else 0
        known = 1 if "555" in digits or digits[:2] in ("00", "01", "06", "07") else 0
    elif kind == "ip":
        parts = span.split(".")
        form, check = 1, 1 if all(p == str(int(p)) for p in parts) else -1
        known = -1 if int(parts[0]) in (0, 127, 255) else 0
    elif plain == "found_number":
        iban = bool(re.match(r"^[A-Z]{2}[0-9]{2}", span))
        social = bool(re.match(r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$", span))
        form = 1 if iban or social or re.match(r"^[0-9]{4}([\x20-])[0-9]{4}\1[0-9]{4}\1[0-9]{4}$", span) else 0
        check = (1 if _iban(span) else -1) if iban else (-1 if span[:3] in ("000", "666") or span[0] == "9" else 1) if social else 1 if luhn(digits) else -1
        look = -1 if len(set(digits)) < 3 or re.match(r"^97[89]", digits) and len(digits) == 13 else 0
        known = (1 if span[:2] in COUNTRIES else -1) if iban else 1 if not social and digits[:1] in ("3", "4", "5") else 0
    else:
        names = [w.lower() for w in re.split(r"[\x20-]", span)]
        form = 1 if re.search(r"(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Mme|Sr|Sra)\.?\x20$", before) else 0
        check = 0 if form else -1 if _PLACES.search(span) else 0
        look = -1 if not before.strip() or re.search(r"[.!?]\x20*$", before) and not form else 0
        known = 1 if names[0] in GIVEN_NAMES else -1
    context = 1 if _CUES[plain].search(before) else 0
    against = -1 if _AGAINST[plain].search(before) else 0
    later = 1 if _AFTERWARDS[plain].search(after) else 0
    return form, check, look, known, context, against, later


def candidates(text: str, base: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """(start, end, kind) of spans that the fixed patterns don't overlap, by kind, then start; the kinds don't overlap either."""
    starts: list[int] = []  # of stretches that are taken, which don't overlap
    ends: list[int] = []
    for a, b, _ in sorted(base):
        if ends and a < ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)

    def add(a: int, b: int, kind: str) -> None:
        k = bisect_left(starts, b)
        if not k or ends[k - 1] <= a:
            starts.insert(k, a)
            ends.insert(k, b)
            out.append((a, b, kind))

    out: list[tuple[int, int, str]] = []
    if _ANY_AT.search(text):
        for m in _SPELLED.finditer(text):
            begin = m.start()
            while begin > max(0, m.start() - 64) and text[begin - 1] in _LOCAL:
                begin -= 1
            if begin < m.start() and re.search(r"[\[({<.]|\x20dot\x20", m[0]):
                add(begin, m.end(), "found_email")
    if _DIGIT.search(text) is not None:
        for m in _LONG_NUMBER.finditer(text):
            add(*m.span(), "found_number")
        for m in _BARE_PHONE.finditer(text):
            add(*m.span(), "found_phone")
    for m in _NAME.finditer(text):
        a, b = m.span(1 if m[1] else 0)
        first = text[a:b].split(" ")[0].lower()
        if m[1] or first in GIVEN_NAMES:
            add(a, b, "found_name")
    return sorted(out, key=lambda s: (EVERY_KIND.index(s[2]), s[0]))


# --- reliabilities and the span classifier -------------------------------------------------------------------

#: Weights of the final classifier; its sample of spans for each kind and pattern of votes, and made ones; the least
#: probability of a span that no fixed pattern has.
WIDTH = 1024
SAMPLE_SPANS = 24
MADE_SPANS = 1600
LEAST = 0.6
#: What the votes of a family of kinds weigh in the estimate, all together, beside what is believed of labelers before.
VOTE_WEIGHT = 1000.0
_BELIEF = 40.0
_FAMILY = {"email": "email", "found_email": "email", "phone": "phone", "found_phone": "phone", "card": "number", "ip": "address", "found_number": "number", "found_name": "name"}
_SIGNS = {-1: "-", 0: "0", 1: "+"}
_WORD = re.compile(r"[^\W\d_]+")


def features(kind: str, span: str, before: str, after: str, cast: tuple[int, ...]) -> list[int]:
    """Places among WIDTH weights: the kind, its votes, the span's shape and the words around it."""
    shape = re.sub(r"[a-z]+", "a", re.sub(r"[A-Z]+", "A", re.sub(r"[0-9]", "0", span[:40])))
    digits = _NO_DIGITS.sub("", span)
    names = [f"k:{kind}", f"s:{kind}:{shape}", f"d:{kind}:{len(digits)}", f"c:{kind}:{re.sub('0+', '0', shape)}"]
    names += [f"v:{_FAMILY[kind]}:{name}:{v}" for name, v in zip(LABELERS, cast, strict=True) if v]
    names += [f"b:{_FAMILY[kind]}:{w.lower()}" for w in _WORD.findall(before)[-3:]] + [f"a:{_FAMILY[kind]}:{w.lower()}" for w in _WORD.findall(after)[:2]]
    return sorted({zlib.crc32(n.encode()) % WIDTH for n in names})


@dataclass
class Model:
    """weights of the classifier, bias first; reliabilities[family][labeler]: the share of its votes that are right."""

    weights: list[float]
    reliabilities: dict[str, dict[str, float]]

    def probability(self, places: Sequence[int]) -> float:
        return float(1 / (1 + np.exp(-(self.weights[0] + sum(self.weights[1 + p] for p in places)))))


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Expectation-maximisation over distinct patterns of votes (rows of -1, 0, 1) and how often each is cast.

    Labelers vote independently given the truth, each with its own chances of a vote for, against, or none. Counts are taken
    as shares of VOTE_WEIGHT, so an estimate depends on the mixture of votes and not on the size of the corpus; the belief
    that labelers are right more often than not keeps the two truths apart. The chance that each pattern is personal, and
    the chances (truth, labeler, vote)."""
    share = counts / max(1, counts.sum()) * VOTE_WEIGHT
    cast = np.stack([patterns == v for v in (-1, 0, 1)], 2).astype(float)
    belief = np.array([[0.35, 0.5, 0.15], [0.1, 0.5, 0.4]])[:, None, :] * _BELIEF
    chances = np.repeat(belief / _BELIEF, patterns.shape[1], 1)
    prior = 0.5
    for _ in range(rounds):
        logs = np.einsum("plv,tlv->tp", cast, np.log(chances)) + np.log([[1 - prior], [prior]])
        personal = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -500, 500)))
        truth = np.stack((1 - personal, personal)) * share
        chances = np.einsum("tp,plv->tlv", truth, cast) + belief
        chances /= chances.sum(2, keepdims=True)
        prior = (truth[1].sum() + _BELIEF / 2) / (share.sum() + _BELIEF)
    return personal, chances


def train(rows: list[list[int]], labels: np.ndarray, rounds: int = 300) -> list[float]:
    """Logistic regression on soft labels, bias first."""
    x = np.zeros((len(rows), WIDTH + 1))
    x[:, 0] = 1
    for i, places in enumerate(rows):
        x[i, [1 + p for p in places]] = 1
    w, first, second = (np.zeros(WIDTH + 1) for _ in range(3))
    for step in range(1, rounds + 1):
        grad = x.T @ (1 / (1 + np.exp(-(x @ w))) - labels) / max(1, len(rows)) + 2e-4 * w
        first, second = 0.9 * first + 0.1 * grad, 0.999 * second + 0.001 * grad * grad
        w = w - 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return w.tolist()


_MADE = (
    ("write to {n}.{n} [at] {h} [dot] com for details", "mail me: {n} (at) {h} (dot) org, if", "reach {n}{d} at {h} dot net with", "we meet at noon.then we go", "they arrive at gate{d}.The flight", "stay at {h}.All rooms"),
    ("call ({d}{d}{d}) {d}{d}{d}-{d}{d}{d}{d} or", "phone: {d}{d}{d}-{d}{d}{d}-{d}{d}{d}{d} ext", "Telefon 0{d}{d}/{d}{d}{d}{d} {d}{d}{d}{d}, mobile", "tel. 06 {d}{d} {d}{d} {d}{d} {d}{d}", "order {d}{d}{d}{d}-{d}{d}{d}-{d}{d}{d} was", "on 20{d}{d}-0{d}-1{d} the", "isbn 978-{d}-{d}{d}{d}-{d}{d}{d}{d}{d}-{d} paper", "range {d}{d}{d} {d}{d}{d} {d}{d}{d} people"),
    ("ssn {d}{d}{d}-{d}{d}-{d}{d}{d}{d} valid", "my card 4{d}{d}{d}-{d}{d}{d}{d}-{d}{d}{d}{d}-{d}{d}{d}{d} exp", "tracking {d}{d}{d}{d}{d}{d}{d}{d}{d}{d}{d}{d}{d}{d}{d}{d} was", "iban DE{d}{d} {d}{d}{d}{d} {d}{d}{d}{d} {d}{d}{d}{d} {d}{d}{d}{d} {d}{d}", "serial {d}{d}{d}{d} {d}{d}{d}{d} {d}{d}{d}{d} {d}{d}{d}{d} of"),
    ("said Mr. {N} {C} wrote", "my name is {N} {C}, aged", "Dear Mrs {C} and", "regards {N} {C}", "the Mary {C} Church in", "in Saint John River the", "at Paul Street of"),
)


def made_texts(n: int = MADE_SPANS, seed: int = 3) -> list[str]:
    """Texts with spans of usual forms, personal or not; nothing says which, the labelers vote on them as on others."""
    rng = np.random.default_rng(seed)
    names, endings = sorted(GIVEN_NAMES), ("son", "berg", "ero", "field", "ova", "etti")
    pick = lambda of: of[rng.integers(len(of))]
    fill = {"d": lambda: str(rng.integers(10)), "n": lambda: pick(names), "N": lambda: pick(names).title(), "h": lambda: pick(MAIL_HOSTS), "C": lambda: pick(names).title() + pick(endings)}
    shapes = [s for some in _MADE for s in some]
    return ["so " + re.sub(r"\{(\w)\}", lambda m: fill[m[1]](), shapes[i % len(shapes)]) for i in range(n)]


def spans_of(text: str) -> list[tuple[int, int, str, str, list[int]]]:
    """(start, end, kind, votes, features) of all candidates, those of the fixed patterns first."""
    base = base_spans(text)
    out = []
    for a, b, kind in [*base, *candidates(text, base)]:
        around = text[max(0, a - BEFORE) : a], text[b : b + AFTER]
        cast = votes(kind, text[a:b], *around)
        out.append((a, b, kind, "".join(map(_SIGNS.__getitem__, cast)), features(kind, text[a:b], *around, cast)))
    return out


SPAN = T.StructType(
    [T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("votes", T.StringType()), T.StructField("features", T.ArrayType(T.IntegerType()))]
)


def _scanner() -> Callable[[list[bytes | None]], list[list]]:
    names = SPAN.fieldNames()

    def scan(texts: list[bytes | None]) -> list[list]:
        found = [spans_of(t.decode()) if t else [] for t in texts]
        return [[[dict(zip(names, (kind, a, b, cast, places), strict=True)) for a, b, kind, cast, places in some] for some in found]]

    return scan


def candidate_spans(docs: DataFrame, text: str = "text", keep: Sequence[str] | None = None, name: str = "candidates") -> DataFrame:
    """docs' columns (or those in keep) with `name`: all candidates of each whole text, with votes and features. Map side only."""
    return annotate(docs, text, _scanner, [T.StructField(name, T.ArrayType(SPAN))], keep)


def fit(found: DataFrame, name: str = "candidates") -> Model:
    """The reliabilities and the classifier of a corpus, from its candidate spans.

    The votes of all candidates are counted, by kind and pattern (at most 3 ** 7 patterns for each of 8 kinds), and estimated by family of kinds.
    The classifier is trained on the estimates for at most SAMPLE_SPANS spans of each kind and pattern, those of least hash, and on MADE_SPANS
    made texts, which weigh nothing in the reliabilities."""
    flat = found.select(F.explode(name).alias("c")).select("c.kind", "c.votes", "c.features")
    least = Window.partitionBy("kind", "votes").orderBy("hash", "features")
    cast = flat.groupBy("kind", "votes").count().collect()
    sample = flat.select("kind", "votes", "features", F.xxhash64("kind", "votes", "features").alias("hash")).distinct().withColumn("row", F.row_number().over(least)).where(F.col("row") <= SAMPLE_SPANS)
    rows = [(r.kind, r.votes, r.features) for r in sample.orderBy("kind", "votes", "row").collect()]
    rows += [(kind, given, places) for t in made_texts() for _, _, kind, given, places in spans_of(t)]
    value = {sign: v for v, sign in _SIGNS.items()}
    chance: dict[tuple[str, str], float] = {}
    reliabilities = {}
    for family in sorted(set(_FAMILY.values())):
        seen: dict[str, int] = {given: 0 for kind, given, _ in rows if _FAMILY[kind] == family}
        for r in cast:
            if _FAMILY[r.kind] == family:
                seen[r.votes] = seen.get(r.votes, 0) + r["count"]
        given = sorted(seen)
        matrix = np.array([[value[s] for s in g] for g in given]).reshape(len(given), len(LABELERS))
        personal, chances = estimate(matrix, np.array([seen[g] for g in given], float))
        chance |= {(family, g): float(p) for g, p in zip(given, personal, strict=True)}
        right, wrong = chances[1, :, 2] + chances[0, :, 0], chances[0, :, 2] + chances[1, :, 0]
        reliabilities[family] = dict(zip(LABELERS, (right / (right + wrong)).round(4).tolist(), strict=True))
    labels = np.array([chance[_FAMILY[kind], g] for kind, g, _ in rows])
    return Model(train([list(places) for *_, places in rows], labels), reliabilities)


def fit_texts(docs: DataFrame, text: str = "text") -> Model:
    return fit(materialize(candidate_spans(docs.select(F.col(f"`{text}`").alias("text")), keep=[]), "candidates"))


def judged(found: DataFrame, model: Model, name: str = "candidates", into: str = "spans") -> DataFrame:
    """found with `into` for `name`: spans (kind, start, end, score) of the fixed patterns, and the others whose score is LEAST or more."""
    weights = F.array(*[F.lit(w) for w in model.weights])
    logit = lambda s: F.aggregate(s["features"], F.lit(model.weights[0]), lambda total, p: total + F.get(weights, p + 1))
    scored = F.transform(name, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), (1 / (1 + F.exp(-logit(s)))).alias("score")))
    kept = F.filter(scored, lambda s: s["kind"].isin(*KINDS) | (s["score"] >= LEAST))
    return found.select(*[F.col(f"`{c}`") for c in found.columns if c not in {name, into}], kept.alias(into))


def find_personal(docs: DataFrame, model: Model | None = None, text: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """docs' columns (or those in keep) with spans: kind, start, end (code points of the whole text, end exclusive) and score, by kind
    as listed, then start. The fixed patterns' spans stay whatever their score.

    Without a model one is fitted on docs (see fit). A null or empty text has no spans; texts of any length are read
    whole, in time linear in them; repeated rows have equal spans; an empty table gives no rows, with a model of made texts only; a
    column named spans is replaced."""
    name = free_name(docs, "candidates")
    return judged(candidate_spans(docs, text, keep, name), model or fit_texts(docs, text), name)


def _masker() -> Callable[..., list[list]]:
    def mask(texts: list[bytes | None], spans: list[list[dict]]) -> list[list]:
        out = []
        for one, some in zip(texts, spans, strict=True):
            text, parts, at = (one or b"").decode(), [], 0
            for s in sorted(some, key=lambda s: (s["start"], -s["end"])):
                if s["start"] >= at:
                    parts += [text[at : s["start"]], f"[{s['kind'].removeprefix('found_')}]"]
                at = max(at, s["end"])
            out.append(None if one is None else "".join([*parts, text[at:]]))
        return [out]

    return mask


def mask_personal(docs: DataFrame, model: Model | None = None, text: str = "text") -> DataFrame:
    """docs with every span of `text` replaced by its kind in brackets; spans that overlap become the first's."""
    plain, spans, name = (free_name(docs, stem) for stem in ("plain", "found", "candidates"))
    model = model or fit_texts(docs, text)
    found = judged(candidate_spans(docs.withColumn(plain, F.col(f"`{text}`")), plain, None, name), model, name, spans)
    masked = annotate(found, plain, _masker, [T.StructField(text, T.StringType())], [c for c in docs.columns if c != text], [spans])
    return masked.select(*[F.col(f"`{c}`") for c in docs.columns])


def listed(spans: str):
    """Spans as kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def report(docs: DataFrame) -> DataFrame:
    """One row a document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans. Texts are read once."""
    found = materialize(candidate_spans(docs.select("doc_id", "text"), keep=["doc_id"]), "candidates")
    spans = judged(found, fit(found)).withColumn("base", F.filter("spans", lambda s: s["kind"].isin(*KINDS)))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return spans.select("doc_id", *map(count, KINDS), F.sha2(listed("base").cast("binary"), 256).alias("base_sha256"), listed("spans").alias("spans"))
