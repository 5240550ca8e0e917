"""Source divergence, importance resampling and personal data against brute force, with odd rows and empty tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from turnstone.llm import divergence, personal, resampling

DOCS = "doc_id long, text string, lang string, source string"


def corpus(seed=4, n=160):
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in ("ka", "Lo", "mí", "ter", "ß") for b in ("n", "x", "é", "st", "Q")] + ["日本", "a b", "x1y", "it's"]
    rows = []
    for i in range(n):
        lang = rng.choice(["en", "de", None, "xx"])
        source = rng.choice(["s0", "s0", "s0", "s1", "é", None, "Z"])
        mine = words[: 20 + hash((lang, source, 1)) % 9] if source != "Z" else words[5:12]
        rows.append((i, " ".join(rng.choices(mine, k=rng.randrange(0, 40))), lang, source))
    rows += [(n, None, "en", "only nulls"), (n + 1, "", "lonely", "s0"), (n + 2, "rare rare rare", "lonely", "s1"), (n + 3, "ter " * 5000, "en", "s0"), (3, rows[3][1], rows[3][2], rows[3][3])]
    return rows


def brute_audit(rows, least):
    rows = [(t or "", a or "", b or "") for _, t, a, b in rows]
    low = lambda t: t.translate({c: c + 32 for c in range(65, 91)})
    terms = [re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low(t)) for t, _, _ in rows]
    docs, whole, count = Counter(), Counter(), defaultdict(Counter)
    for (_, lang, source), found in zip(rows, terms, strict=True):
        count[lang, source].update(found)
        docs.update((lang, t) for t in set(found))
        whole.update((lang, t) for t in found)
    out = []
    for lang in {a for _, a, _ in rows}:
        kept = sorted(t for (a, t), k in docs.items() if a == lang and k >= least)
        v = len(kept)
        price = lambda c: {t: 1 + (10**9 * (c[t] + 5)) // (sum(c[x] for x in kept) + 5 * v) for t in kept}
        q = price({t: whole[lang, t] for t in kept})
        groups = {b: price(count[lang, b]) for a, b in count if a == lang}
        for source, p in groups.items():
            pairs = [(sum(abs(p[t] - o[t]) for t in kept), item) for item, o in groups.items() if item != source]
            over = [(p[t] - q[t], t) for t in kept if count[lang, source][t] and p[t] > q[t]]
            for part, found, limit in (("pair", pairs, None), ("term", over, 50)):
                found = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:limit]
                out += [(lang, source, part, item, value, k) for k, (value, item) in enumerate(found, 1)]
    return sorted(out)


@pytest.mark.parametrize("block", [300_000, 7])
def test_divergence(spark, monkeypatch, block):
    monkeypatch.setattr(divergence, "BLOCK_POSTINGS", block)
    rows = corpus()
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], DOCS + ", term int, `rank` string").repartition(5)
    found = divergence.audit(docs, least_docs=9)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"] and found.schema["rank"].dataType.simpleString() == "int"
    got = sorted(tuple(r) for r in found.collect())
    expected = brute_audit(rows, 9)
    assert got == expected and {r[2] for r in got} == {"pair", "term"} and any(r[4] == 0 for r in got)


def test_divergence_edges(spark):
    none = spark.createDataFrame([], DOCS)
    assert divergence.report(none).count() == 0
    rows = [(0, "a b", "en", "s0"), (1, None, "en", "s1")]
    assert sorted(tuple(r) for r in divergence.report(spark.createDataFrame(rows, DOCS)).collect()) == brute_audit(rows, 30)
    wide = spark.createDataFrame([(0, 4 * 10**15, 6 * 10**15, 3)], "i int, c long, total long, v long")
    got = wide.select(divergence.share("c", "total", "v").alias("p")).first().p
    assert got == 1 + 10**9 * (4 * 10**15 + 5) // (6 * 10**15 + 15)


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))


def brute_resample(rows, target, order, buckets, percent, least):
    grams = lambda text: [" ".join(w[i : i + n]) for w in [words_of(text)] for n in range(1, order + 1) for i in range(len(w) - n + 1)]
    bucket = lambda g: zlib.crc32(g.encode()) % buckets
    s, t = (Counter(bucket(g) for x in texts for g in grams(x)) for texts in ([r[1] for r in rows], target))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in range(buckets)]
    out = []
    for key, text in ((r[0], r[1]) for r in rows):
        h = int(hashlib.sha256(f"2024:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        found = grams(text)
        weight = sum(gain[bucket(g)] for g in found)
        out.append([key, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words_of(text))])
    long_enough = sorted((r for r in out if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    for r in out:
        r.append(None)
    for k, r in enumerate(long_enough[: len(long_enough) * percent // 100], 1):
        r[5] = k
    return sorted(map(str, out))


@pytest.mark.parametrize(("order", "buckets"), [(1, 10_000), (3, 53)])
def test_resampling(spark, order, buckets):
    rows = [(i, t) for i, t, _, _ in corpus(seed=9)] + [(None, "null key " * 15), (None, "null key " * 15), (7, "Other Text, same key! " * 8)]
    rows += [(1000 + i, "same words for all of them " * 5) for i in range(40)]
    target = ["ter mín ßx " * 9, None, "it's 日本", "Null KEY"]
    docs = spark.createDataFrame([(*r, "a", 2) for r in rows], "doc_id long, text string, weight string, `row` int").repartition(3)
    wanted = spark.createDataFrame([(0, t) for t in target], "item_id int, text string")
    found = resampling.draw(resampling.weigh(docs, wanted, order=order, buckets=buckets), percent=30, least_words=10)
    assert {"text", "row"} <= set(found.columns) and found.schema["weight"].dataType.simpleString() == "bigint"
    got = sorted(str([r.doc_id, r.n_features, r.weight, r.score, r.n_words, r["rank"]]) for r in found.collect())
    assert got == brute_resample(rows, target, order, buckets, 30, 10)


def test_resampling_edges(spark):
    none, some = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([(0, "w " * 30), (1, None)], "doc_id long, text string")
    assert resampling.report(none, some).count() == 0
    found = resampling.report(some, none)
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"] and {f.dataType.simpleString() for f in found.schema} == {"bigint"}
    assert {r.doc_id: r.n_features for r in found.collect()} == {0: 30, 1: 0}
    drawn = resampling.resample(some, some, percent=100)
    assert [(r.doc_id, r["rank"]) for r in drawn.collect()] == [(0, 1)]
    assert resampling.Features(2)([b"", None])[0].tolist() == [0, 0]


#: The fixed patterns as they are stated, without thought for time.
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute_base(text):
    def good(kind, found):
        digits = [int(c) for c in found if c.isdigit()]
        if kind == "ip":
            return all(int(p) <= 255 for p in found.split("."))
        if kind == "card":
            sums = [d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(digits))]
            return 16 <= len(digits) <= 19 and sum(sums) % 10 == 0
        return kind == "email" or 8 <= len(digits) <= 15

    return [(*m.span(), kind) for kind, pattern in PLAIN.items() for m in re.finditer(pattern, text) if good(kind, m[0])]


def personal_texts():
    rng = random.Random(2)
    parts = ["a@b.c", "@", ".", "x_y", "-", "1", "12", "255", "256", ".", " ", "+", "(", ")", "+49 (30) 1234-567", "4111 1111 1111 1111", "4111-1111-1111-1112", "10.0.0.1", "é", "\U0001f600", "00", "%", "\n", "user@host.example.org", "0" * 20]
    return ["".join(rng.choices(parts, k=rng.randrange(1, 25))) for _ in range(3000)] + ["", "a@b.c.d@e.f", "1.2.3.4.5.6.7.8", "+1" + "2" * 14, "." .join(["0" * 6000] * 4)]


def test_personal_patterns():
    for text in personal_texts():
        if len(text) < 5000:
            assert personal.base_spans(text) == brute_base(text), text
    assert personal.base_spans(".".join(["0" * 6000] * 4))[0][2] == "ip"


def test_personal_is_linear():
    import time

    began = time.time()
    for piece in ("a", "1", "1.", "+1", "1 ", "a@", "@a", "a.b@", "A", "Mr ", "Anna ", " at a", "(at)", "DE12 ", "(12) "):
        personal.spans_of(piece * 60_000)
    assert time.time() - began < 60


def test_personal(spark):
    texts = [t for t in personal_texts() if len(t) < 5000][:400] + [None, "", "mail hein.19@mail5.example.com now", "mail hein.19@mail5.example.com now", "plain words " * 20_000 + "x@y.zz"]
    rows = [(i, t, "mine", 1) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string, n_email int").repartition(3)
    found = {r.doc_id: r for r in personal.report(docs).collect()}
    assert len(found) == len(texts)
    for i, text, *_ in rows:
        base = brute_base(text or "")
        written = ",".join(f"{k}:{a}:{b}" for a, b, k in base)
        r = found[i]
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == kind for *_, k in base) for kind in personal.KINDS)
        assert r.base_sha256 == hashlib.sha256(written.encode()).hexdigest()
        assert ",".join(x for x in r.spans.split(",") if not x.startswith("found_")) == written
    assert personal.report(docs.where("false")).count() == 0
    masked = personal.mask_personal(docs, personal.fit_texts(docs))
    assert masked.columns == docs.columns
    got = {r.doc_id: r for r in masked.collect()}
    n = len(texts)
    assert got[n - 3].text == "mail [email] now" and got[n - 5].text is None and got[n - 1].text.endswith("[email]") and got[0].spans == "mine"


#: Forms that no made text has, and whether they are personal.
OUTSIDE = [
    ("You may e-mail {n} AT {h} DOT com or", True), ("kontakt: {n}.{n}<at>{h}.de, gerne", True), ("Contact {n}{d}{d} [at] {h} [dot] io for", True),
    ("He was at work.Later he", False), ("look at figure.The rest", False),
    ("please ring ({d}{d}{d}) {d}{d}{d}-{d}{d}{d}{d} any time", True), ("Mobile: 07{d}{d}{d} {d}{d}{d} {d}{d}{d} or", True), ("fax {d}{d}{d}.{d}{d}{d}.{d}{d}{d}{d} and", True),
    ("printed 19{d}{d}-1{d}-0{d} in", False), ("from pages {d}{d}{d}-{d}{d}{d}-{d}{d}{d} of", False), ("ISBN 978 {d} {d}{d}{d} {d}{d}{d}{d}{d} {d} hardcover", False), ("a sum of {d}{d}{d} {d}{d}{d} {d}{d}{d} francs", False),
    ("social security {d}{d}{d}-{d}{d}-{d}{d}{d}{d} on", None), ("part no. {d}{d}{d}{d}-{d}{d}{d}{d}-{d}{d}{d}{d}-{d}{d}{d}{d} in stock", False),
    ("signed {N} {C}, born", True), ("Herr {N} {C} called", True), ("near Saint Paul Cathedral in", False), ("the Carlos Bridge of", False),
]


def test_personal_outside(spark):
    """Held-out forms: precision and recall of spans that no fixed pattern has."""
    model = personal.fit(spark.createDataFrame([], "candidates array<struct<kind:string,start:int,end:int,votes:string,features:array<int>>>"))
    rng = np.random.default_rng(17)
    fill = {"d": lambda: str(rng.integers(10)), "n": lambda: rng.choice(["zoe", "kim", "ravi"]), "N": lambda: rng.choice(["Emma", "Noah", "Pablo"]), "h": lambda: rng.choice(["gmail", "proton", "firma"]), "C": lambda: rng.choice(["Okafor", "Lindqvist", "Tanaka"])}
    hits, wrong, total = 0, 0, 0
    for shape, is_personal in OUTSIDE:
        for _ in range(40):
            text = "Well, " + re.sub(r"\{(\w)\}", lambda m: str(fill[m[1]]()), shape)
            taken = any(k.startswith("found_") and model.probability(places) >= personal.LEAST for _, _, k, _, places in personal.spans_of(text))
            if is_personal is not None:
                hits += taken and is_personal
                wrong += taken and not is_personal
                total += is_personal
    recall, precision = hits / total, hits / max(1, hits + wrong)
    print(f"recall {recall:.3f} precision {precision:.3f}")
    assert recall >= 0.85 and precision >= 0.9


def test_estimate_recovers_reliabilities():
    """Votes drawn from known chances: the estimate finds who is right, and the truth of most patterns."""
    rng = np.random.default_rng(1)
    truth = rng.random(20_000) < 0.3
    right = np.array([0.95, 0.85, 0.75, 0.9, 0.6])
    says = np.where(rng.random((20_000, 5)) < right, truth[:, None], ~truth[:, None]) * 2 - 1
    says[rng.random(says.shape) < 0.3] = 0
    patterns, back, counts = np.unique(says, axis=0, return_inverse=True, return_counts=True)
    personal_chance, chances = personal.estimate(patterns, counts.astype(float))
    assert ((personal_chance[back.reshape(-1)] > 0.5) == truth).mean() > 0.9
    share = (chances[1, :, 2] + chances[0, :, 0]) / (chances[:, :, [0, 2]].sum((0, 2)))
    assert share.argmin() == 4 and share[0] > share[2] > share[4]
