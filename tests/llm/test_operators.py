"""Each operator against brute force on small inputs with nulls, empty texts, repeated rows and empty tables."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from turnstone.llm import arrow, chat, decontamination, embedding_dedup, hashing, jaccard, langid, mixing, secrets, sketch, substring_dedup, token_counts, warc
from turnstone.llm.components import components
from turnstone.llm.queries import tokenizer_path

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def make_texts(seed=0, n=60):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    base = [[rng.choice(words) for _ in range(rng.randrange(1, 90))] for _ in range(n)]
    for k in range(0, n, 4):
        base[k] = list(base[k // 2])
        if base[k] and k % 8:
            base[k][len(base[k]) // 2] = "Changed"
    return [" ".join(b) for b in base] + ["", None, "Solo", "x " * 50, "x " * 50]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en" if i % 2 else "de", f"s{i % 5}", 0) for i, t in enumerate(make_texts())]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def test_substring_dedup(docs, empty):
    seen, expected = set(), {}
    for i, t in enumerate(make_texts()):
        w = (t or "").split()
        gone = set()
        for a in range(len(w) - 19):
            key = tuple(w[a : a + 20])
            if key in seen:
                gone.update(range(a, a + 20))
            seen.add(key)
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        expected[i] = (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.report(docs).collect()}
    assert got == expected
    assert substring_dedup.report(empty).count() == 0
    clash = substring_dedup.remove_repeats(docs.withColumn("n_words", F.lit("x")).withColumn("more", F.lit(1)))
    assert clash.schema["n_words"].dataType.simpleString() == "bigint" and "more" in clash.columns


def brute_removed(rows, size=20):
    """(key, text) rows in order -> words that stay, by the rule word for word; rows of one key and text share places."""
    first = {}
    for key, t in rows:
        w = (t or "").split()
        for a in range(len(w) - size + 1):
            first.setdefault(tuple(w[a : a + size]), (key, a))
    out = []
    for key, t in rows:
        w = (t or "").split()
        gone = {i for a in range(len(w) - size + 1) if first[tuple(w[a : a + size])] != (key, a) for i in range(a, a + size)}
        out.append(" ".join(x for i, x in enumerate(w) if i not in gone))
    return out


def test_substring_dedup_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "CHUNK_BYTES", 4000)  # many chunks
    monkeypatch.setattr(sketch, "SHARD_CELLS", 64)  # a narrow sketch: many false repeats
    rng = random.Random(8)
    passage = " ".join(f"p{i}" for i in range(45))
    rows = [(i, " ".join(f"u{rng.randrange(3000)}" for _ in range(60)) + " " + passage + f" end{i}") for i in range(120)]
    rows += [(200, "ha " * 70), (201, "ha " * 70), (202, None), (203, ""), (204, " ".join(f"v{k % 977}" for k in range(60_000)))]
    rows += [(205, passage), (205, passage)]
    nulls = [(None, "only once " * 3), (None, passage + " tail")]
    table = spark.createDataFrame([(k, t, "own", 1, "x") for k, t in rows + nulls], "doc_id long, text string, n_words string, __id int, __text string")
    found = substring_dedup.remove_repeats(table)
    assert found.columns == ["doc_id", "text", "__id", "__text", "n_words", "n_removed", "kept_text"]
    expected = sorted(zip([str(k) for k, _ in nulls + rows], brute_removed([(-1 - i, t) for i, (_, t) in enumerate(nulls)] + rows), strict=True))
    assert sorted((str(r.doc_id), r.kept_text) for r in found.collect()) == expected


@pytest.mark.parametrize("shard", [64, 1 << 20])
def test_sketch_never_too_low(monkeypatch, shard):
    monkeypatch.setattr(sketch, "SHARD_CELLS", shard)
    hashes = lambda texts: hashing.word_hashes(hashing.split_words(texts))
    texts = [t.encode() for t in make_texts() if t]
    values, counts = np.unique(hashes(texts), return_counts=True)
    for rows in (1, 2):
        layout = sketch.Layout(sum(map(len, texts)), 4000, 0.5, 3, rows, (2, 33))
        chunks = [hashes(texts[k :: layout.chunks]) for k in range(layout.chunks)]
        asked = pa.concat_tables([sketch._question(layout, k, h) for k, h in enumerate(chunks)])
        told = []
        for row, shard_no in set(zip(asked["row"].to_pylist(), asked["shard"].to_pylist(), strict=True)):
            told.append(sketch._answer(layout, asked.filter((pc.field("row") == row) & (pc.field("shard") == shard_no))))
        told = pa.concat_tables(told)
        wrong = 0
        for k, mine in enumerate(chunks):
            masks = sketch.at_least(layout, mine, told.filter(pc.field("chunk") == k))
            exact = counts[np.searchsorted(values, mine)]
            for least, mask in zip((2, 33), masks, strict=True):
                assert mask[exact >= least].all()
            wrong += int(masks[1][exact == 1].sum())
        assert shard == 64 or wrong < 0.1 * (counts == 1).sum()


def test_jaccard(docs, empty):
    sets = []
    for t in make_texts():
        w = (t or "").lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    up = list(range(len(sets)))
    for a in range(len(sets)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = up[a], up[b]
                up = [min(x, y) if u in (x, y) else u for u in up]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.join_similar(docs).collect()}
    assert got == {i: (len(s), up[i]) for i, s in enumerate(sets)}
    assert jaccard.join_similar(empty).count() == 0
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns and kept.count() == len({c for _, c in got.values()})


def test_jaccard_index():
    """Similar sets share a key whatever is taken for repeated or frequent; unlike sets with a common part have none."""
    rng = np.random.default_rng(4)
    for n in (5, 40, 63, 64, 70, 130, 300, 900):
        for _ in range(12):
            base = rng.integers(0, 2**64, n, dtype=np.uint64)
            cut = int(n * rng.uniform(0, 0.11))
            other = np.concatenate((base[cut:], rng.integers(0, 2**64, cut, dtype=np.uint64)))
            every = np.unique(np.concatenate((base, other)))
            repeated = dict(zip(every.tolist(), (np.isin(every, base) & np.isin(every, other)) | (rng.random(len(every)) < 0.3), strict=True))
            frequent = {t: r and rng.random() < rng.choice([0.1, 0.9, 1.0]) for t, r in repeated.items()}
            keys = []
            for tokens in (np.unique(base), np.unique(other)):
                flags = [np.array([d[t] for t in tokens.tolist()], bool) for d in (repeated, frequent)]
                keys.append(jaccard.signatures(tokens, *flags))
            if jaccard.similar(np.unique(base), np.unique(other)):
                assert len(np.intersect1d(*keys)), n
    passage = rng.integers(0, 2**64, 60, dtype=np.uint64)
    tokens = np.unique(np.concatenate((passage, rng.integers(0, 2**64, 60, dtype=np.uint64))))
    common = np.isin(tokens, passage)
    assert not len(jaccard.signatures(tokens, common, common))


def test_jaccard_odd_rows(spark, monkeypatch):
    """Null and repeated ids, rows that repeat, long texts, clashing columns, and a large family of near copies."""
    monkeypatch.setattr(jaccard, "CHUNK_BYTES", 4000)  # many chunks
    monkeypatch.setattr(sketch, "SHARD_CELLS", 64)  # a narrow sketch: many tokens taken for repeated and frequent
    rng = random.Random(3)
    base = [f"b{i}" for i in range(150)]

    def near(k):
        words = list(base)
        for _ in range(k):
            words[rng.randrange(150)] = f"z{rng.randrange(10**6)}"
        return " ".join(words)

    rows = [(i, near(rng.choice([2, 4, 6]))) for i in range(700)]
    rows += [(800, "long " + " ".join(str(k) for k in range(40_000))), (801, "LONG " + " ".join(str(k) for k in range(40_000))), (None, rows[0][1]), (802, rows[1][1]), (802, rows[1][1]), (803, None)]
    table = spark.createDataFrame([(*r, 1, "k", "f") for r in rows], "doc_id long, text string, component_id int, keys string, family string")
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in ((t or "").lower().split() for _, t in rows)]
    up = {d: d for d, _ in rows if d is not None}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, (d, _) in enumerate(rows):
        for b in range(a):
            e = rows[b][0]
            if d is not None and e is not None and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = root(d), root(e)
                up[max(x, y)] = min(x, y)
    got = [(r.doc_id, r.component_id) for r in jaccard.join_similar(table).collect()]
    assert sorted(got, key=str) == sorted(((d, root(d) if d is not None else None) for d, _ in rows), key=str)


def test_language_posteriors_by_enumeration():
    import itertools

    rng = np.random.default_rng(7)
    for n in (1, 2, 5, 7):
        e, t = rng.normal(size=(n, 3)), rng.normal(size=(3, 3))
        expected = np.zeros((n, 3))
        for path in itertools.product(range(3), repeat=n):
            weight = np.exp(sum(e[i, k] for i, k in enumerate(path)) + sum(t[a, b] for a, b in itertools.pairwise(path)))
            for i, k in enumerate(path):
                expected[i, k] += weight
        expected /= expected.sum(1, keepdims=True)
        found = langid.posteriors(e, np.array([0, n]), t, 2)
        free = langid.posteriors(e, np.array([0, n]), t - t.max(), 32)
        assert np.allclose(found, free)
        if n > 1:  # the start is a uniform message through the transitions; by enumeration with that start
            start = np.exp(t).sum(0)
            expected = np.zeros((n, 3))
            for path in itertools.product(range(3), repeat=n):
                weight = start[path[0]] * np.exp(sum(e[i, k] for i, k in enumerate(path)) + sum(t[a, b] for a, b in itertools.pairwise(path)))
                for i, k in enumerate(path):
                    expected[i, k] += weight
            assert np.allclose(found, expected / expected.sum(1, keepdims=True))


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(0, i) for i in range(300, 340)] + [(i, i + 1) for i in range(400, 440)]
    up = list(range(500))
    for a, b in edges:
        x, y = up[a], up[b]
        up = [min(x, y) if u in (x, y) else u for u in up]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: up[n] for a, b in edges if a != b for n in (a, b)}


def test_decontamination(spark, docs, empty):
    texts = make_texts()
    bench = spark.createDataFrame([(0, texts[1]), (1, "solo"), (2, None), (3, ""), (4, "no such words at all in any of these documents here")], "item_id long, text string")
    words = [decontamination.normal((t or "").encode()).split() for t in texts]
    windows = {0: {tuple(words[1][i : i + 10]) for i in range(max(1, len(words[1]) - 9))}, 1: {(b"solo",)}}
    expected = {}
    for d, w in enumerate(words):
        hit, items = set(), set()
        for item, keys in windows.items():
            for key in keys:
                for i in range(len(w) - len(key) + 1):
                    if tuple(w[i : i + len(key)]) == key:
                        hit.update(range(i, i + len(key)))
                        items.add(str(item))
        expected[d] = (len(w), len(hit), len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest())
    spans = []
    for limit in (400_000, 7):
        got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256) for r in decontamination.report(docs, bench, max_windows=limit).collect()}
        assert got == expected
        found = decontamination.scan_benchmark(docs.withColumn("row", F.lit(1)).withColumn("hit_words", F.lit("own")), bench, max_windows=limit)
        spans.append(sorted((r.doc_id, r.row, [tuple(x) for x in r.hit_spans]) for r in found.collect()))
    assert spans[0] == spans[1] and any(s for _, _, s in spans[0])
    assert decontamination.report(empty, bench).count() == 0
    assert decontamination.decontaminate(docs, bench).columns == docs.columns
    span = decontamination.scan_benchmark(spark.createDataFrame([(1, "é  SOLO!")], "doc_id long, text string"), bench).first().hit_spans
    assert [(s.start, s.end) for s in span] == [(3, 7)]


def test_token_counts(spark, empty):
    texts = make_texts() + ["  two  spaces\n\nnew ", "a\tb\r\n é ﬁ Ａ", "<s>hi</s> <0x0A>", "▁ ▁a", "\n", " ", "日本語 \x00 🙂"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model = token_counts.model(tokenizer_path())
    got = {r.doc_id: (r.n_bytes, r.n_tokens) for r in token_counts.count_tokens(rows, tokenizer_path(), keep=["doc_id"]).collect()}
    assert got == {i: (len((t or "").encode()), len(model.encode(t or ""))) for i, t in enumerate(texts)}
    assert token_counts.count_tokens(empty, tokenizer_path()).count() == 0


def test_chat(spark, tmp_path):
    rows = [(1, 0, "user", "a"), (2, 0, "user", "a"), (2, 1, "assistant", "b"), (3, 0, "user", "a"), (3, 1, "assistant", "b"), (4, 0, "user", "c"), (4, 0, "user", "c"), (None, 0, "user", "z"), (5, None, None, None)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r.n_turns for r in chat.collapse_and_render(table).collect()}
    assert got == {2: 2, 4: 2, 5: 1}
    assert chat.collapse_and_render(table.limit(0)).count() == 0


def test_chat_against_sql(spark, tmp_path):
    import duckdb

    rng = random.Random(6)
    rows = [(6, i, "user", str(i)) for i in range(1300)] + [(7, i, "user", str(i)) for i in range(900)]  # a long one and its snapshot
    rows += [(8, 3, rng.choice("uv"), rng.choice("xyz")) for _ in range(700)] + [(9, None, None, "long " * 200_000)]  # one turn number
    for c in range(20, 120):
        rows += [(c, i // 2, rng.choice(["user", None]), rng.choice(["p", "q"])) for i in range(rng.randrange(1, 5))]
    rows += rows[-6:]
    table = spark.createDataFrame([(*r, 1, "own") for r in rows], "conv_id long, turn long, role string, text string, k int, chat string")
    table.write.parquet(str(tmp_path / "c"))
    expected = duckdb.sql(chat.ORACLE_SQL.replace("FROM conversations", f"FROM '{tmp_path}/c/*.parquet'")).fetchall()
    got = [tuple(r) for r in chat.collapse_and_render(table).select("conv_id", "n_turns", "chat").collect()]
    assert sorted(got) == sorted(expected) and {6, 8, 9} <= {r[0] for r in got} and 7 not in {r[0] for r in got}


def test_embeddings(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(40, 16))
    vectors = [*base, *(base[:20] + rng.normal(size=(20, 16)) * 0.05), *base[:5], *(base[:20] + rng.normal(size=(20, 16)) * 0.2)]
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(np.float32(vectors))]
    rows += [(100, None), (101, [0.0] * 16), (102, [float("nan")] * 16), (103, [1.0, 2.0]), (104, [2.0, 4.0])]
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.link_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), tile=16).collect()}
    unit = np.float32(vectors).astype(float)
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    near = (unit @ unit.T >= 0.95) & ~np.eye(len(unit), dtype=bool)
    up = list(range(len(unit)))
    for a, b in zip(*np.nonzero(near), strict=True):
        x, y = up[a], up[b]
        up = [min(x, y) if u in (x, y) else u for u in up]
    expected = {i: (int(near[i].sum()), up[i]) for i in range(len(unit))} | {100: (0, 100), 101: (0, 101), 102: (0, 102), 103: (1, 103), 104: (1, 103)}
    assert got == expected


def test_language(spark, empty):
    rng = np.random.default_rng(0)
    tables = {"de": ["der", "und", "schön", "nicht", "eine", "zeitung"], "en": ["the", "and", "thing", "with", "other", "where"]}
    rows = [(i, " ".join(rng.choice(tables[k], 40)), k, "s", 0) for i, k in enumerate(["de", "en"] * 60)]
    rows += [(500, None, None, "s", 0), (501, "123 !!", "en", "s", 0)]
    table = spark.createDataFrame(rows, DOCS)
    got = {r.doc_id: r for r in langid.report(table).collect()}
    assert all(got[i].lang_pred == k for i, _, k, _, _ in rows[:-2]) and got[500].lang_pred == got[501].lang_pred == "und"
    assert all(0 <= r.score <= 1 for r in got.values())
    mixed = spark.createDataFrame([(1, "der und nicht eine the and with other thing where")], "doc_id long, text string")
    words = langid.identify(mixed, langid.fit(table)).first().lang_words
    assert words == {"de": 4, "en": 6}
    assert langid.report(empty).count() == 0
    e, t, b = rng.normal(size=(70, 3)), rng.normal(size=(3, 3)), np.array([0, 0, 1, 70])
    assert np.allclose(langid.posteriors(e, b, t, 4), langid.posteriors(e, b, t, 100))


def test_language_sample_of_copies(spark):
    few = [" ".join(f"xx{i}y{k}" for k in range(40)) for i in range(3)]
    hashed = spark.createDataFrame([(t,) for t in few], "text string").select(F.pmod(F.xxhash64("text"), F.lit(1_000_000))).collect()
    copies = 20 * 1_000_000 // min(r[0] for r in hashed) + 20
    rows = [(4 * i + 3, few[i % 3], "xx", "s", 0) for i in range(copies)]
    rows += [(10**6 + i, " ".join(f"zz{i}q{k}" for k in range(40)), "zz", "s", 0) for i in range(50)]
    rows += [(2 * 10**6 + i, f"kurz{i}", "ku", "s", 0) for i in range(20)] + [(3 * 10**6 + i, " \n", "blank", "s", 0) for i in range(20)]
    sequences, labels = langid.sample_sequences(spark.createDataFrame(rows, DOCS), documents=5)
    assert labels == ["ku", "xx", "zz"] and {labels[k] for _, gold in sequences for k in gold} == {"ku", "xx", "zz"}
    assert {b" ".join(t).decode() for t, g in sequences if g == [1] * 32} <= {" ".join(t.split()[:32]) for t in few}
    assert len(sequences) == 5 + 3 + 5


def test_mixed_languages_are_kept(spark):
    rng = np.random.default_rng(0)
    tables = {"de": ["der", "und", "schön", "nicht", "eine", "zeitung"], "en": ["the", "and", "thing", "with", "other", "where"], "fi": ["joka", "hän", "että", "kaikki", "mutta", "silloin"]}
    rows = [(i, " ".join(rng.choice(tables[k], 40)), k, "s", 0) for i, k in enumerate(["de", "en", "fi"] * 60)]
    mixed = " ".join(w for k in tables for w in rng.choice(tables[k], 20))
    table = spark.createDataFrame([*rows, (500, mixed, None, "s", 0), (501, "12 34", None, "s", 0)], DOCS)
    got = langid.identify(table).where("doc_id = 500").first()
    assert got.score < 0.5 and got.certainty > 0.8
    kept = langid.keep_identified(table.withColumn("certainty", F.lit("own")))
    assert kept.columns == [*table.columns, "certainty"] and {r.doc_id for r in kept.collect()} == {*range(180), 500}


def test_secrets(spark, empty):
    key = "AKIA" + "ABCDEFGH12345678"
    texts = [f'x token = "0123456789abcdef0123456789" {key} y', "Password: abc", "é api-key: none, API_KEY=abcdef", None, "", "plain words only"]
    assert [(a, b, k) for a, b, k in secrets.base_spans(texts[0])] == [(2, 37, "assign"), (11, 37, "hex"), (39, 59, "access")]
    assert secrets.base_spans(texts[1]) == [] and secrets.base_spans(texts[2]) == [(17, 31, "assign")]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = secrets.made_findings(400)
    net = secrets.train(np.array([secrets.window(*f[:3]) for f in found]), np.array([f[3] for f in found]), epochs=4)
    held = secrets.made_findings(200, seed=99)
    scores = net.scores(np.array([secrets.window(*f[:3]) for f in held]))
    labels = np.array([f[3] for f in held])
    assert (scores[labels == 1] >= net.threshold).mean() > 0.9 and (scores[labels == 0] < net.threshold).mean() > 0.9
    masked = {r.doc_id: r.text for r in secrets.mask_secrets(table, net).collect()}
    assert masked[0] == "x [secret]\" [secret] y" and masked[5] == texts[5] and masked[3] is None
    assert secrets.scan_secrets(empty, net).count() == 0


def test_secrets_report_against_brute_force(spark):
    """Base spans by walking the text character by character."""
    rng = random.Random(12)
    parts = ["password", "Passwd=", "SECRET", "token", "api_key", "apikey", ": ", "= ", '"', "'", " ", "abc", "AKIA", "ABCDEFGHIJKLMNOP", "X9", "0123456789abcdef", "deadbeef01", "é", "+/_.=-", "\n"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(0, 30))) for _ in range(400)] + [None, "", "token=" * 3000, "ab12" * 60_000]

    def run(text, at, letters):
        end = at
        while end < len(text) and text[end] in letters:
            end += 1
        return end

    upper, digits = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    value = set(upper + upper.lower() + digits + "+/_.=-")

    def assign(text, at):
        for word in ("password", "passwd", "secret", "token", "api_key", "apikey"):
            if text[at : at + len(word)].lower() == word:
                k = at + len(word)
                k += text[k : k + 1] in ('"', "'") and k < len(text)
                k = run(text, k, " ")
                if text[k : k + 1] not in (":", "=") or k >= len(text):
                    continue
                k = run(text, k + 1, " ")
                k += k < len(text) and text[k] in "\"'"
                end = run(text, k, value)
                if end > k:
                    return end, end - k >= 6
        return None

    def spans(text):
        out = []
        at = 0
        while at < len(text):
            m = assign(text, at)
            if m:
                out += [(at, 0, "assign", m[0])] if m[1] else []
                at = m[0]
            else:
                at += 1
        for order, kind, head, letters, least in ((1, "access", "AKIA", set(upper + digits), 20), (2, "hex", "", set(digits + "abcdef"), 24)):
            at = 0
            while at < len(text):
                end = run(text, at + len(head), letters) if text.startswith(head, at) else at
                if end > at + len(head):
                    out += [(at, order, kind, end)] if end - at >= least else []
                    at = end
                else:
                    at += 1
        return [(k, a, e) for a, _, k, e in sorted(out)]

    net = secrets.train_whole(secrets.made_findings(40), epochs=1)
    net.threshold = net.keyed_threshold = 2.0
    rows = spark.createDataFrame([(i, t, "own") for i, t in enumerate(texts)] * 2, "doc_id long, text string, found string")
    got = [(r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256, r.spans) for r in secrets.report(rows, net).collect()]
    expected = []
    for i, t in enumerate(texts):
        found = spans(t or "")
        listed = ",".join(f"{k}:{a}:{e}" for k, a, e in found)
        counts = [sum(k == x for k, _, _ in found) for x in ("assign", "access", "hex")]
        expected += [(i, *counts, hashlib.sha256(listed.encode()).hexdigest(), listed)] * 2
    assert sorted(got) == sorted(expected)


def test_secrets_beyond_the_patterns():
    """The network adds keys that no pattern knows, and leaves addresses and numbers alone."""
    net = secrets.train_whole(secrets.made_findings(3000) + secrets.long_findings(1000))
    assert all(recall > 0.9 and precision > 0.8 for recall, precision in net.measured)
    good = ["pwd: x9Kf2LmQ7bTz4RvW8n", "uses sk-9aB3dE7gH1jK5mN8pQ2s here", "private_key=Zx81kQpL0vB7nM4tR6yU"]
    bad = ["mail first.last34@mail7.example.com now", "from 161.17.88.162 on", "call 555-7713 or 20241-1180-22", "report_12_final_version_3"]
    found = secrets.scanner(net)([t.encode() for t in good + bad])[1]
    assert [len(f) for f in found] == [1, 1, 1, 0, 0, 0, 0]


def test_secrets_in_long_tokens():
    token = "services/production/eu-west-1/accounts/v2/hooks/users/" + "Zq3" * 30
    read = list(secrets.windows(f"see {token}", 4, 4 + len(token)))
    inside = [w[secrets.BEFORE : secrets.BEFORE + secrets.INSIDE] for w in read]
    assert inside[0] == secrets.window(f"see {token}", 4, 4 + len(token))[secrets.BEFORE : secrets.BEFORE + secrets.INSIDE]
    at = [*range(0, len(token) - secrets.INSIDE, secrets.STRIDE), len(token) - secrets.INSIDE]
    assert inside == [[secrets._symbol(c) for c in token[k : k + secrets.INSIDE]] for k in at]
    net = secrets.train_whole(secrets.made_findings(800) + secrets.long_findings(800), epochs=6)
    held = secrets.long_findings(300, seed=99) + secrets.made_findings(200, seed=99)
    scores, labels = np.array(net.judge(f[:3] for f in held)), np.array([f[3] for f in held])
    assert (scores[labels == 1] >= net.threshold).mean() > 0.9 and (scores[labels == 0] < net.threshold).mean() > 0.9
    path = "services/production/eu-west-1/accounts/v2/hooks/"
    found = secrets.scanner(net)([f"see {path}x9Kf2LmQ7bTz4RvW8nYc3HdJ6sGp1AeU5oXi now".encode(), f"see {path}users/images/v1/static/assets now".encode()])[1]
    assert [[s["kind"] for s in spans] for spans in found] == [["learned"], []]


def test_secrets_around_a_pattern(spark):
    net = secrets.train_whole(secrets.made_findings(40), epochs=1)
    net.threshold = 0.0
    token = "Ab9_" + "0123456789abcdef01234567" + "_Zq8LmQ7bTz4RvW8nYc3"
    found = secrets.scanner(net)([f"x {token} end".encode(), b'token = "0123456789abcdef0123456789"'])[1]
    assert [[(s["kind"], s["start"], s["end"]) for s in spans] for spans in found] == [[("learned", 2, 2 + len(token)), ("hex", 6, 30)], [("assign", 0, 35), ("hex", 9, 35)]]
    masked = secrets.mask_secrets(spark.createDataFrame([(1, f"x {token} end")], "doc_id long, text string"), net).first()
    assert masked.text == "x [secret] end"


def test_mixing(docs, empty):
    rows = mixing.mix(docs, budget=500).collect()
    assert sum(r.n_taken for r in rows) <= 500 and sum(r.n_taken for r in rows) > 480
    assert all(r.n_taken <= r.n_copies * r.n_tokens for r in rows)
    full = mixing.mix(docs, budget=10**9).collect()
    assert {r.n_copies for r in full if r.n_tokens} == {mixing.MAX_EPOCHS}
    assert mixing.mix(empty).count() == 0
    assert mixing.mix_documents(docs).columns == [*docs.columns, "n_copies"]


def test_mixing_with_clashing_columns(docs):
    names = ["epochs", "rest", "cut_key", "cut_start", "at_cut", "in_last_epoch", "name", "own", "domain", "n_copies", "__lang", "__key"]
    clash = docs.withColumn("doc_id", F.when(F.col("doc_id") % 7 != 0, F.col("doc_id"))).withColumns({c: F.lit("own") for c in names})
    for budget in (500, 10**9):
        found = mixing.mix_documents(clash, budget=budget)
        assert found.columns == [c for c in clash.columns if c != "n_copies"] + ["n_copies"]
        rows = found.collect()
        assert rows and all(r.rest == r.name == r.own == r["__lang"] == "own" for r in rows)
        assert sorted(map(str, (r.doc_id for r in rows))) == sorted(map(str, (r.doc_id for r in mixing.mix(clash, budget=budget).collect())))


def test_mixing_by_shuffle(docs, monkeypatch):
    small = sorted(map(tuple, mixing.mix(docs, budget=700).collect()))
    monkeypatch.setattr(mixing, "BROADCAST_LEAVES", 0)
    assert sorted(map(tuple, mixing.mix(docs, budget=700).collect())) == small


def test_warc_unclosed_marks():
    import re
    import time

    hidden = re.compile(r"<!--.*?-->|<script\b.*?</script[^>]*>|<style\b.*?</style[^>]*>|<head\b.*?</head[^>]*>", re.S | re.I | re.A)
    parts = ["<!--", "-->", "<script>", "</script>", "</script", "<SCRIPT x", "<style>", "</style>", "<head", "</head>", "<header>", ">", "<", "a", "<a href=x>", "<a ", "href", "<title>", "</title>", "<title x", "é"]
    rng = random.Random(2)
    for _ in range(3000):
        page = "".join(rng.choices(parts, k=rng.randrange(14)))
        assert warc._without_hidden(page) == hidden.sub("", page)
        title = re.search(r"<title[^>]*>(.*?)</title", page, re.S | re.I | re.A)
        assert warc.title_of(page) == (title[1].strip() if title else "")
        assert warc.count_links(page) == len(re.findall(r"<a\s[^>]*href", page, re.I | re.A))
        text = re.sub(r"<[^>]*>", "", warc._BREAK.sub("\n", hidden.sub("", page)))
        assert warc.plain_text(page) == re.sub(" ?\n[ \n]*", "\n", text).strip(" \n")
    began = time.time()
    for mark in ("<!--", "<script ", "<title ", "<a ", "<", "</script", "<p "):
        warc._facts([mark.encode() * 400_000])
    assert time.time() - began < 30


def test_warc(spark):
    page = '<html><head><title>T &amp; t</title></head><body><!-- x --><p>one<b>two</b></p><script>no()</script><a href="/x">l&eacute;</a></body></html>'
    table = spark.createDataFrame([(1, "http://a/", page), (2, None, None)], "page_id long, url string, html string")
    rows = {(r.page_id, r.record_type): r for r in warc.derive(table).collect()}
    assert rows[1, "conversion"].block == "onetwo\nlé" and rows[2, "conversion"].block == ""
    meta, text = rows[1, "metadata"], rows[1, "conversion"]
    assert meta.refers_to == text.refers_to == meta.concurrent_to and text.concurrent_to is None
    assert f"WARC-Concurrent-To: {meta.refers_to}\r\n" in meta.headers and "Concurrent" not in text.headers and "\r\n\r\n" not in text.headers[:-4]
    import base64

    digest = base64.b32encode(hashlib.sha1(text.block.encode()).digest()).decode()
    assert text.block_digest == f"sha1:{digest}" and f"Content-Length: {len(text.block.encode())}" in text.headers
    assert warc.derive(table.limit(0)).count() == 0


def test_pieces():
    texts = [b"a" * 10, None, b"b" * 30, b""]
    assert list(arrow.pieces(texts, 20)) == [(0, 3), (3, 4)]


def test_token_table_of_copies(spark):
    """A text with very many copies neither fills the sample nor is kept out of it."""
    rows = [(i, "one text that many share") for i in range(3000)] + [(i, f"text{i} by itself") for i in range(3000, 6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    table = token_counts.frequent_lengths(docs, tokenizer_path(), entries=50, sample=600)
    assert {" many", " by", " itself"} <= set(table) and len(table) == 50
    assert token_counts.frequent_lengths(docs.where("false"), tokenizer_path()) == {}


def test_names_of_results_as_own_columns(spark):
    """Own columns named like results, or like what hides them, come back as they were."""
    rows = [(1, "plain words of one text here now", 0.5, "own", "mine", "theirs", 3), (2, 'token = "0123456789abcdef0123456789abcdef"', 1.5, "other", "x", "y", 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double, `own_score` string, `plain` string, __text string, n_hit int").withColumn("lang", F.lit("en"))
    masked = {r.doc_id: r for r in secrets.mask_secrets(docs).collect()}
    assert masked[1] == docs.where("doc_id = 1").first() and "[secret]" in masked[2].text and masked[2]["__text"] == "y" and masked[2].plain == "x"
    kept = langid.keep_identified(docs.withColumn("Certainty", F.lit("c")))
    assert kept.columns == [*docs.columns, "Certainty"] and all(r.score == 0.5 and r.own_score == "own" for r in kept.where("doc_id = 1").collect())
    bench = spark.createDataFrame([(7, "nothing of it")], "item_id long, text string")
    clean = decontamination.decontaminate(docs, bench)
    assert clean.columns == docs.columns and sorted(map(tuple, clean.collect())) == sorted(map(tuple, docs.collect()))


def test_groups_that_lie_in_others(spark):
    """Documents of three passages out of twenty: many keys, but rows of few groups a document, whatever their number."""
    for n in (200, 800):
        rng = random.Random(n)
        rows = []
        for doc in range(n):
            for passage in rng.sample(range(20), 3):
                rows += [(1000 * passage + k, doc) for k in range(60) if rng.random() < 0.9 or k < 3]
        table = spark.createDataFrame(rows, "key long, doc_id long")
        left = [tuple(r) for r in jaccard.maximal_groups(table).collect()]
        assert len(left) < 10 * n < len(rows) / 10
        groups = lambda some: [set(d for k, d in some if k == key) for key in {k for k, _ in some}]
        pairs = lambda some: {(a, b) for g in groups(some) for a in g for b in g if a < b}
        if n == 200:
            assert pairs(left) == pairs(rows)


def test_passages_shared_by_many(spark):
    """Long shared passages, in groups of more and of fewer than 128 documents: all links are found, with few texts sent."""
    rng = random.Random(6)
    passages = [" ".join(f"p{k}x{i}" for i in range(100)) for k in range(12)]
    rows = []
    for doc in range(600):
        chosen = sorted(rng.sample(range(12), 3))
        own = " ".join(f"o{doc}y{i}" for i in range(rng.choice([0, 3, 10, 200])))
        rows.append((doc, " ".join([*(passages[k] for k in chosen), own])))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.component_id for r in jaccard.join_similar(docs).collect()}
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for _, t in rows for w in [t.split()]]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if min(len(sets[i]), len(sets[j])) * 100 >= 80 * max(len(sets[i]), len(sets[j])) and 100 * (both := len(sets[i] & sets[j])) >= 80 * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((root(i), root(j)))
                up[b] = a
    assert got == {i: root(i) for i in range(len(rows))}


def test_layout_at_any_size():
    """What a chunk sends to a shard stays worth its row, and rows grow with the corpus, up to tens of terabytes."""
    for chunk, cells, each, rows in ((substring_dedup.CHUNK_BYTES, substring_dedup.CELLS_PER_BYTE, substring_dedup.CELLS_PER_ANCHOR, 2), (jaccard.CHUNK_BYTES, jaccard.CELLS_PER_BYTE, jaccard.CELLS_PER_TOKEN, 1)):
        for total in (30e9, 1e12, 10e12):
            layout = sketch.Layout(int(total), chunk, cells, each, rows, (2,))
            shards = -(-layout.width // layout.shard)
            hashes = total * cells / each
            payloads = layout.chunks * shards
            assert hashes / payloads > 100, (total, hashes / payloads)
            assert layout.shard < 1 << 29 and total / layout.chunks < 100e6
    assert sketch.Layout(10**9, 1 << 20, 0.08, 4, 2, (2,)).shard == sketch.SHARD_CELLS


def test_secrets_fit_takes_every_finding(spark, monkeypatch):
    """All distinct findings are trained on or held out, over several rounds and shards."""
    texts = [f'see file{i}x{i * 7919}abc and host{i}.example.org then token = "{hashlib.md5(str(i).encode()).hexdigest()}"' for i in range(300)]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").coalesce(1)
    seen, trained = [], []
    calibrate, averaged = secrets._calibrate, secrets._averaged
    monkeypatch.setattr(secrets, "MADE", 400)
    monkeypatch.setattr(secrets, "MADE_LONG", 200)
    monkeypatch.setattr(secrets, "SHARD", 200)
    monkeypatch.setattr(secrets, "_calibrate", lambda net, counted: seen.append(counted) or calibrate(net, counted))
    monkeypatch.setattr(secrets, "_averaged", lambda net, states: trained.append([n for n, _ in states]) or averaged(net, states))
    net = secrets.fit(rows)
    every = len(set(secrets.labelled_findings(texts)))
    own = sum(n for *_, n in seen[0][:-150])
    assert sum(map(sum, trained)) + own == every > 1000 and len(trained) > 1 and len(trained[0]) >= 1
    assert all(recall >= 0.9 for recall, _ in net.measured)
