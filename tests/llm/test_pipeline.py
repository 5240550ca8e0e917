"""The pipeline's stages on a small corpus: what each removes, and that clean documents stay."""

import random

import corpus_pipeline as pipeline


def corpus():
    rng = random.Random(5)
    vocabulary = {"en": ["the", "and", "thing", "with", "other", "where", "house"], "de": ["der", "und", "schön", "nicht", "eine", "zeitung", "haus"]}
    syllables = ["ka", "lo", "mi", "ter", "un", "sa"]
    word = lambda lang: rng.choice(vocabulary[lang]) if rng.random() < 0.6 else rng.choice(vocabulary[lang])[:3] + "".join(rng.choices(syllables, k=3))
    rows = []
    for i in range(60):
        lang = "en" if i % 2 else "de"
        rows.append([i, " ".join(word(lang) for _ in range(120)), lang, f"src{i % 4}", 0])
    rows.append([60, rows[3][1], "en", "src0", 0])
    rows.append([61, rows[4][1] + " noch", "de", "src1", 0])
    item = " ".join(f"quiz{k}" for k in range(12))
    rows.append([62, f"{rows[5][1][:200]} {item}", "en", "src2", 0])
    rows[7][1] += ' token = "0123456789abcdef0123456789abcdef"'
    rows.append([63, "12 34 !!", None, "src3", 0])
    rows.append([64, None, None, None, None])
    return rows, item


def test_stages(spark, tmp_path):
    rows, item = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    held, gone = docs, []
    for name, stage in pipeline.STAGES:
        before = {r.doc_id for r in held.select("doc_id").collect()}
        held = stage(spark, held, str(tmp_path))
        held.write.parquet(str(tmp_path / name))
        held = spark.read.parquet(str(tmp_path / name))
        gone.append(before - {r.doc_id for r in held.select("doc_id").collect()})
        if name != pipeline.STAGES[-1][0]:
            assert held.columns == docs.columns
        if name == "secret_scan":
            assert "[secret]" in held.where("doc_id = 7").first().text
    assert gone[0] == {63, 64} and gone[1] == {60, 61} and gone[2] == {62} and gone[3] == set()
    assert held.columns == [*docs.columns, "n_copies"] and held.count() > 0
    assert pipeline.run(spark, str(tmp_path)).count() == held.count()
