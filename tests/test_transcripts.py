"""Goldens for each documented rule, and a brute-force check of the speaker join."""

import json
import random
import re
import time
import weakref

import pytest
from pyspark.sql import functions as F

from turnstone.functions import audio, edits, text
from turnstone.operators import fusion, lines, model_output, publish, render, scoring, stats, worklist
from turnstone.sources import files, listing

WORD = "interview_id long, idx int, start double, end double, text string"
TURN = "interview_id long, turn_ix int, start double, end double, speaker string"


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


def test_units_and_joins(spark):
    cases = {"hello (world)": ["hello(", "world)"], "a - ,b c": ["a-,", "b", "c"], "他说你好。abc": ["他", "说", "你", "好。", "abc"], "  ": [], "-- a": ["--", "a"]}
    for given, expected in cases.items():
        assert one(spark, text.split_words(F.lit(given))) == expected
    joins = [(["a", "(b", ")"], "a (b)"), (["ok", "你"], "ok你"), (["a", ",", "b"], "a, b"), (["x", '"y"'], 'x "y"')]
    for given, expected in joins:
        assert one(spark, text.join_words(F.array(*map(F.lit, given)))) == expected


def test_names_and_stamps(spark):
    assert one(spark, text.stamp(F.lit(3661.5))) == "01:01:01.500"
    assert one(spark, text.stamp(F.lit(-1.0), ",")) == "00:00:00,000"
    assert one(spark, text.stem(F.lit("a/iv_1.2"))) == "iv_1"
    assert one(spark, text.folder_name(F.lit("02_00113-a"))) == "02_00113"
    assert one(spark, text.slug(F.lit("Ä b/c"))) == "Ä_b_c"
    assert one(spark, text.escape(F.lit("<a&b>"))) == "&lt;a&amp;b&gt;"
    labels = {"speaker_0": "S01", "1": "S02", "spk2_ch3": "S04", "anna": "anna"}
    for given, expected in labels.items():
        assert one(spark, model_output.speaker_label(F.lit(given))) == expected


def sweep(words, turns, gap=1.0):
    """The rules of the speaker join, word by word over all turns."""
    order = sorted(range(len(turns)), key=lambda i: (turns[i][0], turns[i][1]))
    out = []
    for ws, we in words:
        overlaps = [(min(we, turns[i][1]) - max(ws, turns[i][0]), -r) for r, i in enumerate(order)]
        best = max((o for o in overlaps if o[0] > 0), default=None)
        if best:
            out.append(order[-best[1]])
            continue
        cursor = next((r for r, i in enumerate(order) if turns[i][1] >= ws), len(order))
        near = [(max(0.0, turns[order[r]][0] - we, ws - turns[order[r]][1]), r) for r in range(max(0, cursor - 1), min(len(order), cursor + 2))]
        found = min(near, default=None)
        out.append(order[found[1]] if found and found[0] <= gap else None)
    return out


@pytest.mark.parametrize(("seconds", "pairs"), [(1800.0, 1 << 20), (3.0, 1 << 20), (0.7, 2)])
def test_speaker_join_against_sweep(spark, monkeypatch, seconds, pairs):
    """Also in slices so short that most turns are in many of them, and with few pairs at once."""
    monkeypatch.setattr(fusion, "SLICE_SECONDS", seconds)
    monkeypatch.setattr(fusion, "PAIRS", pairs)
    rng = random.Random(3)
    word_rows, turn_rows, expected = [], [], {}
    cases = [([(10.5, 10.8)], [(0, 10), (2, 3)]), ([(1, 1)], [(0, 5)]), ([(1, 3)], [(0, 2), (2, 4)]), ([(2, 3)], [(0, 1)]), ([(1, 2)], [])]
    for _ in range(60):
        starts = sorted(rng.randrange(200) / 4 for _ in range(8))
        words = [(s, s + rng.choice([0, 0.25, 0.5, 2])) for s in starts]
        spans = [rng.randrange(200) / 4 for _ in range(rng.randrange(6))]
        cases.append((words, [(s, s + rng.choice([0, 0.5, 3, 70])) for s in spans]))
    for k, (words, turns) in enumerate(cases):
        word_rows += [(k, i, float(a), float(b), "w") for i, (a, b) in enumerate(words)]
        turn_rows += [(k, i, float(a), float(b), f"S{i}") for i, (a, b) in enumerate(turns)]
        expected |= {(k, i): t for i, t in enumerate(sweep(words, turns))}
    found = fusion.assign_speakers(spark.createDataFrame(word_rows, WORD), spark.createDataFrame(turn_rows, TURN))
    assert {(r.interview_id, r.idx): r.turn_ix for r in found.collect()} == expected
    assert [expected[k, 0] for k in range(5)] == [None, 0, 0, 0, None]


def test_speaker_sweep():
    import numpy as np

    rng = random.Random(12)
    for pairs in (2, 1 << 20):
        fusion_pairs, fusion.PAIRS = fusion.PAIRS, pairs
        for _ in range(300):
            words = sorted((rng.randrange(80) / 4, rng.choice([0, 0.25, 1, 5])) for _ in range(rng.randrange(12)))
            spans = sorted((a, a + rng.choice([-1, 0, 0.5, 3, 30])) for a in (rng.randrange(80) / 4 for _ in range(rng.randrange(9))))
            ws, we = (np.array([f(w) for w in words], float) for f in (lambda w: w[0], lambda w: w[0] + w[1]))
            ts, te = (np.array([s[k] for s in spans], float) for k in (0, 1))
            turn, overlap = fusion.sweep(ws, we, ts, te, np.arange(len(ts)), 1.0)
            expected = sweep(list(zip(ws.tolist(), we.tolist(), strict=True)), spans)
            assert [None if t < 0 else t for t in turn.tolist()] == expected
        fusion.PAIRS = fusion_pairs


def test_missing_times(spark):
    """Words and turns without times meet nothing; own columns of any name stay."""
    words = spark.createDataFrame([(1, 0, 0.0, 1.0, "a", "s"), (1, 1, None, None, "b", "t"), (2, 0, 0.0, 1.0, "c", "u")], WORD + ", slice string")
    turns = spark.createDataFrame([(1, 0, None, 5.0, "S01"), (1, 1, 0.5, 9.0, "S02"), (3, 0, 0.0, 1.0, "S03")], TURN)
    found = fusion.assign_speakers(words, turns)
    assert found.columns == [*words.columns, "turn_ix", "speaker", "overlap", "by_proximity"]
    assert sorted((r.interview_id, r.idx, r.slice, r.turn_ix, r.overlap, r.by_proximity) for r in found.collect()) == [(1, 0, "s", 1, 0.5, False), (1, 1, "t", None, None, False), (2, 0, "u", None, None, False)]


def test_segments_and_stats(spark):
    words = spark.createDataFrame([(1, 0, 0.0, 1.0, "a"), (1, 1, 1.0, 2.0, "b"), (1, 2, 9.0, 9.5, "c"), (1, 3, 9.5, 9.6, "d")], WORD)
    turns = spark.createDataFrame([(1, 0, 0.0, 1.0, "S01"), (1, 1, 1.0, 2.0, "S01"), (2, 0, 0.0, 1.0, "S02")], TURN)
    marked = fusion.mark_segments(fusion.assign_speakers(words, turns))
    parts = [(r.segment_index, r.text, r.speaker) for r in fusion.segments(marked).orderBy("segment_index").collect()]
    assert parts == [(0, "a", "S01"), (1, "b", "S01"), (2, "c d", None)]
    got = {r.interview_id: r for r in fusion.fusion_stats(marked, turns).collect()}
    assert (got[1].words_total, got[1].words_assigned, got[1].speakers) == (4, 2, ["S01"])
    assert (got[2].turns_total, got[2].turns_without_words, got[2].speakers) == (1, 0, [])


def starts_of(starts, ends, texts, limits):
    flat = [False] * len(texts)
    return lines.line_starts(starts, ends, [len(t) for t in texts], flat, [t[-1:] in text.SENTENCE_ENDERS for t in texts], limits)[0]


def test_lines(spark):
    limits = lines.LineLimits()
    w = [("x" * 41, 0.0, 1.0), ("y", 1.0, 1.5), ("z", 1.5, 1.6)]
    assert starts_of(*zip(*[(a, b, t) for t, a, b in w], strict=True), limits) == [0, 1]
    assert starts_of((0.0, 1.75), (1.0, 2.0), ("a", "b"), limits) == [0]
    assert starts_of((0.0, 1.875), (1.0, 2.0), ("a", "b"), limits) == [0, 1]
    assert starts_of((0.0, 1.0), (1.0, 2.0), ("abcdefghijkl.", "b"), limits) == [0, 1]
    assert lines.merge_slivers((0.0, 1.0), (1.0, 1.2), (2, 1), (False, False), limits) == [0]
    assert lines.merge_slivers((0.0, 1.0), (0.2, 2.0), (2, 1), (False, False), limits) == [0, 1]
    segments = spark.createDataFrame([(1, 0, 0.0, 5.0, "bare text", "S01")], "interview_id long, segment_index int, start double, end double, text string, speaker string")
    none = spark.createDataFrame([], WORD + ", segment_index int")
    got = lines.build_lines(none, segments).collect()
    assert [(r.text, r.start, r.end) for r in got] == [("bare text", 0.0, 5.0)]


def lines_in_turn(words, limits, merge=True):
    """The rules word by word over a whole segment, then line by line: (first word, one past the last, end)."""
    import unicodedata

    def tight(left, right):
        closing = not right or unicodedata.category(right[0])[0] == "P" and right[0] not in "([{\"'"
        return closing or "\u4e00" <= right[:1] <= "\u9fff" or "\u4e00" <= left[-1:] <= "\u9fff"

    out, chars = [], 0
    for k, (a, b, t) in enumerate(words):
        if out:
            _, end, before = words[k - 1]
            fresh = a - end > limits.max_gap or b - words[out[-1]][0] > limits.max_duration or before[-1:] in text.SENTENCE_ENDERS and chars >= limits.min_chars_for_sentence_break or chars + 1 + len(t) > limits.max_chars
        if not out or fresh:
            out.append(k)
            chars = len(t)
        else:
            chars += len(t) + (not tight(words[k - 1][2], t))
    joined = []
    for first, stop in zip(out, [*out[1:], len(words)], strict=True):
        size = len(words[first][2]) + sum(len(t) + (not tight(p, t)) for (_, _, p), (_, _, t) in zip(words[first:stop], words[first + 1 : stop], strict=False))
        end = words[stop - 1][1]
        if merge and joined:
            begin, _, last, held = joined[-1]
            if max(0.0, end - words[first][0]) < limits.min_duration and held + size + 1 <= limits.max_chars and end - words[begin][0] <= limits.max_duration:
                joined[-1] = (begin, stop, max(last, end), held + size + (not tight(words[first - 1][2], words[first][2])))
                continue
        joined.append((first, stop, end, size))
    return [(first, stop, end) for first, stop, end, _ in joined]


@pytest.mark.parametrize("merge", [True, False])
def test_lines_in_stretches(spark, merge):
    """Packed by stretches and folded over them, against one pass over each segment; one segment is very long."""
    rng = random.Random(21)
    rows, expected = [], {}
    limits = lines.LineLimits()
    for k in range(40):
        at, words = 0.0, []
        for _ in range(20_000 if k == 0 else rng.randrange(1, 60)):
            at += rng.choice([0, 0, 0, 0.05, 0.5, 0.75, 0.875, 2])
            long = rng.choice([0, 0.03125, 0.25, 0.5, 3])
            words.append((at, at + long, rng.choice(["a", "bb", "word", "longer-word", "end.", ",", "(so", "中", "文。", "!", "x" * 30, "it's"])))
            at += long * rng.choice([1, 1, 0.5])
        rows += [(k // 3, k % 3, 7 * i, a, b, t, f"S{k}") for i, (a, b, t) in enumerate(words)]
        expected[k // 3, k % 3] = [(words[a][0], end, [7 * i for i in range(a, b)]) for a, b, end in lines_in_turn(words, limits, merge)]
    table = spark.createDataFrame(rows, "interview_id long, segment_index int, idx int, start double, end double, text string, speaker string").repartition(5)
    packed = lines.pack_lines(table, limits, merge)
    got = {}
    for r in packed.orderBy("interview_id", "segment_index", "line_in_segment").collect():
        mine = got.setdefault((r.interview_id, r.segment_index), [])
        assert r.line_in_segment == len(mine) and r.speaker == f"S{3 * r.interview_id + r.segment_index}"
        mine.append((r.start, r.end, [w.idx for w in r.words]))
    assert got == expected
    assert re.search(r"hashpartitioning\(interview_id#\w+, segment_index#\w+, stretch#", packed._jdf.queryExecution().toString())


def test_live_packer():
    """Words in any order and cut, with restarts in between, give the lines of the whole."""
    from turnstone.streaming.live_lines import LinePacker

    rng = random.Random(31)
    limits = lines.LineLimits()
    for _ in range(200):
        at, words = 0.0, []
        for _ in range(rng.randrange(1, 80)):
            at += rng.choice([0, 0, 0.05, 0.5, 0.875, 2])
            long = rng.choice([0, 0.03125, 0.25, 0.5, 3])
            words.append((at, at + long, rng.choice(["a", "word", "end.", ",", "(so", "中", "文。", "x" * 30])))
            at += long
        cuts = sorted({0, len(words), *(rng.randrange(len(words)) for _ in range(rng.randrange(3)))})
        expected, rows = [], []
        for segment, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            expected += [(segment, words[a + i][0], end, list(range(a + i, a + j)), f"S{segment}") for i, j, end in lines_in_turn(words[a:b], limits)]
            shuts = [t[0] in ",中文" for _, _, t in words[a:b]]
            rows += [[a + i, x, y, t, segment, f"S{segment}", len(t), shuts[i], t[-1] in "中文", t[-1] in ".。"] for i, (x, y, t) in enumerate(words[a:b])]
        rows = [rows[i] for i in sorted(range(len(rows)), key=lambda i: i + rng.random() * rng.choice([0, 5]))]
        held, got = None, []
        while rows:
            n = rng.randrange(1, 9)
            packer = LinePacker(limits, held)
            got += packer.add(rows[:n] + rows[: rng.randrange(2)])
            rows, held = rows[n:], packer.held()
        got += LinePacker(limits, held).end()
        assert [(g["segment_index"], g["start"], g["end"], [w["idx"] for w in g["words"]], g["speaker"]) for g in got] == expected
        assert [g["line_ix"] for g in got] == list(range(len(got)))


def test_live_lines(spark, tmp_path):
    """A stream in several batches, with a restart: the same lines as of all words together; the idle timer gives the rest."""
    from turnstone.streaming.live_lines import live_lines

    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    rng = random.Random(8)
    rows = []
    for k in range(3):
        at = 0.0
        for i in range(50):
            at += rng.choice([0.05, 0.5, 0.875, 2])
            rows.append((k, i // 17, i, at, at + 0.1, rng.choice(["a", "word", "end.", ",", "中"]), f"S{i // 17}"))
            at += 0.1
    schema = "interview_id long, segment_index int, idx int, start double, end double, text string, speaker string"
    given = tmp_path / "given"

    def run(name, idle=None):
        stream = spark.readStream.schema(schema).parquet(str(given))
        writer = live_lines(stream, idle_seconds=idle).writeStream.option("checkpointLocation", str(tmp_path / f"check-{name}")).format("parquet").option("path", str(tmp_path / name))
        if idle is None:
            query = writer.trigger(availableNow=True).start()
            assert query.awaitTermination(120)
        else:
            query = writer.start()
            ends = time.time() + 120
            while time.time() < ends and query.isActive and not ((tmp_path / name / "_spark_metadata").exists() and spark.read.schema(made.schema).parquet(str(tmp_path / name)).where("interview_id = 2").count() == count):
                time.sleep(1)
            query.stop()

    rng.shuffle(rows)
    for part in (rows[:70], rows[70:]):
        spark.createDataFrame(part, schema).write.mode("append").parquet(str(given))
        run("out")
    ends = [(k, None, None, None, None, None, None) for k in (0, 1)]
    spark.createDataFrame(ends, schema).write.mode("append").parquet(str(given))
    run("out")
    columns = ["interview_id", "line_ix", "segment_index", "start", "end", "text", "speaker"]
    whole = lines.build_lines(spark.createDataFrame(rows, schema)).where("interview_id < 2").select(*columns)
    made = spark.read.parquet(str(tmp_path / "out")).select(*columns)
    assert sorted(map(tuple, made.where("interview_id < 2").collect())) == sorted(map(tuple, whole.collect()))
    count = lines.build_lines(spark.createDataFrame(rows, schema)).where("interview_id = 2").count()
    assert 0 < made.where("interview_id = 2").count() < count
    run("idle", 3.0)
    assert spark.read.parquet(str(tmp_path / "idle")).where("interview_id = 2").count() == count


def test_bands(spark):
    rows = [(1, float(v)) for v in (0.1, 0.2, 0.3, 0.4)] + [(2, None)]
    got = {r.interview_id: (r.good, r.neutral, r.bad) for r in stats.score_bands(spark.createDataFrame(rows, "interview_id long, confidence double")).collect()}
    assert got == {1: (0.4, 0.3, 0.2), 2: (0.9, 0.7, 0.5)}


def test_merge_and_limits(spark):
    kind = "ord int, name string, url string"
    old = spark.createDataFrame([(0, "a", "a"), (1, "b", "b")], kind)
    new = spark.createDataFrame([(0, "b", "b1"), (1, "c", "c1"), (2, "c", "c2")], kind)
    got = publish.merge_index(old, new).orderBy("is_new", "ord").collect()
    assert [r.url for r in got] == ["a", "b1", "c1", "c2"]
    counts = publish.merge_counts(old, new).first()
    assert (counts.new, counts.updated, counts.total) == (2, 1, 4)
    items = spark.createDataFrame([(i, str(i)) for i in range(6)], "ord int, id string")
    done = spark.createDataFrame([("0",), ("1",)], "id string")
    assert worklist.pending(items, done, 2, limit_first=True).count() == 0
    assert [r.id for r in worklist.pending(items, done, 2).orderBy("ord").collect()] == ["2", "3"]


def whole_table(a, b):
    """The operations by the whole table of distances: back from its end, a diagonal step first, then a deletion."""
    table = [list(range(len(b) + 1))]
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(table[-1][j - 1] + (x != y), table[-1][j] + 1, row[-1] + 1))
        table.append(row)
    i, j, back = len(a), len(b), []
    while i or j:
        differs = int(i > 0 and j > 0 and a[i - 1] != b[j - 1])
        if i and j and table[i][j] == table[i - 1][j - 1] + differs:
            i, j = i - 1, j - 1
            back.append(("substitution" if differs else "match", i, j))
        elif i and table[i][j] == table[i - 1][j] + 1:
            i -= 1
            back.append(("deletion", i, None))
        else:
            j -= 1
            back.append(("insertion", None, j))
    return back[::-1], table[-1][-1]


def random_pair(rng):
    letters = "abcd"[: rng.randrange(1, 5)] if rng.random() < 0.7 else [f"w{k}" for k in range(30)]
    a = [rng.choice(letters) for _ in range(rng.randrange(40))]
    if rng.random() < 0.5:
        return a, [rng.choice(letters) for _ in range(rng.randrange(40))]
    b = []
    for x in a:
        kind = rng.random()
        b += [] if kind < 0.1 else [rng.choice(letters)] if kind < 0.2 else [rng.choice(letters), x] if kind < 0.3 else [x]
    return a, b


def test_edits(monkeypatch):
    assert [k for k, _, _ in edits.alignment("abc", "axc")] == ["match", "substitution", "match"]
    assert [k for k, _, _ in edits.alignment("ab", "b")] == ["deletion", "match"]
    rng = random.Random(11)
    for n in range(2500):
        a, b = random_pair(rng)
        expected, distance = whole_table(a, b)
        monkeypatch.setattr(edits, "MASK_BYTES", 0 if n % 3 == 0 else 1 << 26)  # places put together for each column
        for reach, held in ((None, 1 << 26), (1, 1 << 26), (3, 1)):  # a band that is doubled; columns made again
            kinds, rows, columns = edits.align(a, b, reach, held)
            own = [(edits.KINDS[k], None if i < 0 else i, None if j < 0 else j) for k, i, j in zip(kinds.tolist(), rows.tolist(), columns.tolist(), strict=True)]
            assert own == expected, (a, b, reach, held)
        numbers = {t: k for k, t in enumerate({*a, *b})}
        assert edits.banded_distance([numbers[t] for t in a], [numbers[t] for t in b], 1) == distance


def test_error_rates(spark):
    words = spark.createDataFrame([(1, 0, "Hello,", 0.5), (1, 1, "wurld", 0.25), (1, 2, "-", None)], "interview_id long, idx int, text string, confidence double")
    refs = spark.createDataFrame([(1, "hello world again")], "interview_id long, reference_text string")
    got = scoring.error_rates(words, refs).first()
    assert (got.hits, got.substitutions, got.deletions, got.insertions, got.wer) == (1, 1, 1, 0, 0.6667)
    assert (got.mean_confidence_correct, got.mean_confidence_incorrect) == (0.5, 0.25)


def test_large_alignments(spark):
    rng = random.Random(4)
    said = [f"w{rng.randrange(500)}" for _ in range(5500)]
    heard = [w for i, w in enumerate(said) if i % 50]
    words = spark.createDataFrame([(1, i, w, 0.5) for i, w in enumerate(heard)], "interview_id long, idx int, text string, confidence double")
    got = scoring.error_rates(words, spark.createDataFrame([(1, " ".join(said))], "interview_id long, reference_text string")).collect()
    assert [(r.reference_words, r.hypothesis_words, r.hits, r.substitutions, r.deletions, r.insertions) for r in got] == [(5500, 5390, 5390, 0, 110, 0)]
    assert (got[0].wer, got[0].mean_confidence_correct) == (0.02, 0.5)


def test_audio_round_trip():
    import numpy as np

    tone = np.sin(np.arange(1600) / 10).astype(np.float32)
    back, rate = audio.decode(audio.encode(tone))
    assert rate == 16000 and abs(audio.to_mono(back) - tone).max() < 1e-4
    assert len(audio.resample(tone, 16000, 8000)) == 800


def test_sources(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for name in ("b.MP3", "a.wav", "a.prepared.wav", "note.txt"):
        (tmp_path / "in" / name).write_bytes(b"x")
    found = [r.path.rpartition("/")[2] for r in listing.find_recordings(spark, str(tmp_path / "in")).orderBy("ord").collect()]
    assert found == ["a.wav", "b.MP3"]
    (tmp_path / "c.json").write_text('{"entries": [{"name": "n", "audio": "u"}]}')
    assert [r.name for r in listing.read_entries(spark, str(tmp_path / "c.json")).collect()] == ["n"]
    assert listing.read_entries(spark, str(tmp_path / "none.json")).count() == 0
    rows = spark.createDataFrame([("x", "{}", "WEBVTT\n")], "name string, json string, vtt string")
    written = files.write_files(rows, str(tmp_path / "out"), {"json": ("json", ".json"), "vtt": ("vtts", ".vtt")}).collect()
    assert written[0].files == 2 and (tmp_path / "out/vtts/x.vtt").read_text() == "WEBVTT\n"
    assert [r.id for r in listing.completed(spark, str(tmp_path / "out/json")).collect()] == ["x"]


def test_without_training_operators(tmp_path):
    """A copy without the operators' folder and the pipeline imports, and registers everything else."""
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    import __spark_entry__

    root = Path(__spark_entry__.__file__).parent
    shutil.copytree(root / "turnstone", tmp_path / "turnstone", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; print(*sorted(e.queries()), '|', *sorted(e.oracle_sql()))"
    told = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={"PATH": "/usr/bin:/bin"}, capture_output=True, text=True, check=True).stdout
    names = told.split("|")[0].split()
    assert "fused_recordings" in names and not [n for n in names if n.startswith("op") or n == "pipeline"]


def test_raw_turns(spark):
    shapes = ['{"start": 0, "end": 1, "speaker": 1}', '{"begin": 0, "end_time": 1, "label": 1.0}', '{"start": 0, "end": 1, "label": true}', '{"start": 0, "end": 1, "speaker": 1.5}', '[0, 1, 2.0]', '["0", "1", "spk2_ch3"]', "0 1 speaker_0", "0.0,1.0,3", '{"start": 0, "end": 1, "speaker": "1.0"}', "none", '{"start": 0}']
    raw = spark.createDataFrame([(1, i, r) for i, r in enumerate(shapes)], "interview_id long, ord int, raw string")
    got = model_output.diarized_turns(model_output.parse_raw_turns(raw)).orderBy("turn_ix").collect()
    assert [r.speaker for r in got] == ["S02", "S02", "True", "1.5", "S03", "S04", "S01", "S04", "S01"]  # ties keep their order
    assert sorted(r.warning for r in model_output.unread_turns(raw).collect()) == ["unrecognised diarization segment: none", 'unrecognised diarization segment: {"start": 0}']


def test_suffixes(spark, tmp_path):
    for suffix in (".mp3", ".wav", ".m4a", ".flac", ".ogg", ".mp4", ".mkv", ".mov", ".aac", ".webm"):
        (tmp_path / f"x{suffix}").write_bytes(b"x")
    found = [r.path.rpartition(".")[2] for r in listing.find_recordings(spark, str(tmp_path)).collect()]
    assert sorted(found) == sorted(["mp3", "wav", "m4a", "flac", "ogg", "mp4", "mkv", "mov"])


def test_text_distance():
    rng = random.Random(9)
    for _ in range(500):
        a, b = ("".join(rng.choices("abc", k=rng.randrange(12))) for _ in range(2))
        assert edits.text_distance(a, b) == whole_table(a, b)[1]
    a = "".join(rng.choices("abcdefgh ", k=30_000))
    b = "".join(c for i, c in enumerate(a) if i % 500)  # sixty letters are left out
    assert edits.text_distance(a, b) == edits.text_distance(b, a) == 60


def test_words_over_many_slices(spark, monkeypatch):
    """Words and turns that reach over several slices, beside short ones."""
    monkeypatch.setattr(fusion, "SLICE_SECONDS", 30.0)
    rng = random.Random(5)
    words = sorted((rng.randrange(0, 400) / 2, rng.choice([0.5, 20, 70, 95])) for _ in range(60))
    spans = [(a, a + rng.choice([1, 40, 130])) for a in (rng.randrange(0, 400) / 2 for _ in range(25))]
    rows = spark.createDataFrame([(1, i, a, a + n, "w") for i, (a, n) in enumerate(words)], WORD)
    turns = spark.createDataFrame([(1, i, float(a), float(b), f"S{i}") for i, (a, b) in enumerate(spans)], TURN)
    found = {r.idx: r.turn_ix for r in fusion.assign_speakers(rows, turns).collect()}
    assert found == dict(enumerate(sweep([(a, a + n) for a, n in words], spans)))


def test_run_status_and_streams(spark, tmp_path, capsys):
    from turnstone import cli
    from turnstone.streaming import incremental

    words = spark.createDataFrame([(1, 0, 0.0, 1.0, "a", 0.5, "measured"), (2, 0, 0.0, 1.0, "b", None, "measured")], WORD + ", confidence double, source string")
    words.write.parquet(str(tmp_path / "words"))
    spark.createDataFrame([(1, 0, 0.0, 1.0, "S01")], TURN).write.parquet(str(tmp_path / "turns"))
    out = str(tmp_path / "out")
    for expected in ("2 files", "2 files", "0 files"):
        cli.main(["run", "--words", str(tmp_path / "words"), "--turns", str(tmp_path / "turns"), "--out", out, "--max-files", "1"])
        assert expected in capsys.readouterr().out
    assert '"speaker": "S01"' in (tmp_path / "out/json/1.json").read_text()
    cli.main(["status", "--out", out])
    assert "2 finished" in capsys.readouterr().out

    spark.createDataFrame([("a",), ("b",)], "id string").write.parquet(str(tmp_path / "items"))
    done = tmp_path / "done"
    spark.createDataFrame([("a",)], "id string").write.parquet(str(done))
    query = incremental.process_new_items(spark.readStream.schema("id string").parquet(str(tmp_path / "items")), lambda: spark.read.parquet(str(done)), lambda rows: rows.write.mode("append").parquet(str(done)), str(tmp_path / "check"))
    query.awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(str(done)).collect()) == ["a", "b"]


def test_folder_source(spark, tmp_path):
    from turnstone.session import ship
    from turnstone.sources.folders import FolderSource

    (tmp_path / "f1").mkdir()
    (tmp_path / "f1" / "x.MP3").write_bytes(b"")
    (tmp_path / "f1" / "x.txt").write_bytes(b"")
    ship(spark)
    spark.dataSource.register(FolderSource)
    read = lambda **o: [(r.folder, r.name) for r in spark.read.format("audio_folders").options(root=str(tmp_path), **o).load().collect()]
    assert read() == [("f1", "x.MP3")] and read(folders="none,f1") == [("f1", "x.MP3")]


def test_json_by_pieces(spark):
    """A record's segments are read one after another, never held together; texts are those of json.dumps over the whole."""

    class Segment(dict):
        __hash__ = object.__hash__

    alive = weakref.WeakSet()

    def read(n):
        for k in range(n):
            words = [{"idx": 2 * k + i, "text": f'w"{i}\n', "start": k / 7, "end": k + 0.12345, "confidence": [None, 0.12345][i], "source": "measured", "speaker": "S"} for i in (0, 1)]
            made = Segment(segment_index=k, start=k / 7, end=k + 1.0, text=f"é {k}", speaker=None, words=words)
            alive.add(made)
            assert len(alive) <= 2
            yield made
            del made

    line = {"line_ix": 0, "segment_index": 3, "start": 0.0, "end": 1.0, "text": "x", "speaker": None, "idx": [6, 7]}
    record = render.full_document({"audio_path": "p", "duration": 9.87654, "segments": read(50), "lines": iter([line])})
    again = json.loads(record)
    assert record == json.dumps(again, indent=2, ensure_ascii=False) and again["text"].startswith("é 0 é 1 ")
    assert len(again["segments"]) == 50 and again["segments"][9]["confidence"] == again["lines"][0]["confidence"] == 0.1235
    made = render.document(read(50), "en", {"more": []})
    assert made == json.dumps(json.loads(made), indent=2, ensure_ascii=False) and render.document([], "en") == json.dumps({"segments": [], "language": "en"}, indent=2)
    kind = "interview_id long, segments array<struct<segment_index:int,start:double,end:double,text:string,speaker:string,words:array<struct<idx:int,text:string,start:double,end:double,confidence:double,source:string,speaker:string>>>>"
    rows = [(i, [dict(s) for s in read(i)] + [{"segment_index": 99, "start": 0.0, "end": 0.5, "text": "bare", "speaker": "S", "words": None}]) for i in range(30)]
    nested = spark.createDataFrame(rows, kind).coalesce(1)
    assert {r.interview_id: r.json for r in render.to_json(nested).collect()} == {i: render.document(s, "en") for i, s in rows}
    assert render.to_json(nested.where("false")).count() == 0


def test_lines_for_width_without_words_in_lines(spark):
    """Lines may come without their words; only recordings with a line that is too long are packed anew."""
    rows = [(1, k, k / 2, k / 2 + 0.4, "abcde") for k in range(12)] + [(2, 0, 0.0, 0.4, "short")]
    words = spark.createDataFrame([(*r, 0) for r in rows], f"{WORD}, segment_index int")
    own = lines.build_lines(words).drop("words").withColumn("text", F.when(F.col("interview_id") == 2, "kept").otherwise(F.col("text")))
    made = lines.lines_for_width(own, words, None, 20)
    assert made.columns == own.columns
    got = sorted((r.interview_id, r.line_ix, r.text) for r in made.collect())
    assert got == [(1, k, "abcde abcde abcde") for k in range(4)] + [(2, 0, "kept")]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("rows", [1, 3, 1000])
def test_speaker_join_over_batches(spark, rows):
    """A slice's turns and words over many small batches, or many slices in one; no group goes to Python by itself."""
    rng = random.Random(rows)
    word_rows, turn_rows, expected = [], [], {}
    for k in range(12):
        words = sorted((rng.randrange(0, 80 if k % 3 else 16_000) / 2, rng.choice([0, 0.5, 9])) for _ in range(rng.randrange(30)))
        spans = [(a, a + rng.choice([1, 4, 30])) for a in (rng.randrange(0, 80 if k % 2 else 16_000) / 2 for _ in range(rng.randrange(12)))]
        word_rows += [(k, i, a, a + n, "w") for i, (a, n) in enumerate(words)]
        turn_rows += [(k, i, float(a), float(b), f"S{i}") for i, (a, b) in enumerate(spans)]
        expected |= {(k, i): t for i, t in enumerate(sweep([(a, a + n) for a, n in words], spans))}
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    try:
        found = fusion.assign_speakers(spark.createDataFrame(word_rows, WORD), spark.createDataFrame(turn_rows, TURN))
        got = found.collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert {(r.interview_id, r.idx): r.turn_ix for r in got} == expected
    assert all(r.speaker == (None if r.turn_ix is None else f"S{r.turn_ix}") for r in got)
    assert "CoGroups" not in plan_of(found)


def test_speaker_join_keeps_words_of_partitioned_tables(spark):
    """Words that are partitioned by recording, as turns are, in a session that lets unions keep that partitioning."""
    from turnstone.operators.words import clamp_words

    words = spark.range(4000).selectExpr("id % 200 interview_id", "cast(id div 200 as int) idx", "cast(id div 200 as double) start", "(id div 200) + 0.5D end", "'w' text")
    turns = spark.range(200).selectExpr("id interview_id", "0 turn_ix", "0D start", "99D end", "'S01' speaker")
    for kept in ("true", "false"):
        before = spark.conf.get("spark.sql.unionOutputPartitioning")
        spark.conf.set("spark.sql.unionOutputPartitioning", kept)
        try:
            found = fusion.mark_segments(fusion.assign_speakers(clamp_words(words), turns))
            assert found.where("turn_ix = 0 AND overlap = 0.5").count() == 4000 and found.count() == 4000
        finally:
            spark.conf.set("spark.sql.unionOutputPartitioning", before)


def test_shuffles_of_words_and_cues(spark):
    """Turns are dealt before they become words; lines are dealt by recording once after they are folded."""
    from turnstone.plans import fixtures

    talk = spark.createDataFrame([(1, 0, "user", "a b"), (1, 1, "assistant", "c d")], "conv_id long, turn int, role string, text string")
    plan = plan_of(fixtures.timed_words(talk))
    assert plan.count("Exchange") == 1 and plan.index("Generate") < plan.index("Exchange")
    words = spark.createDataFrame([(1, 0, 0.0, 1.0, "a", 0)], WORD + ", segment_index int")
    made = render.to_vtt(render.cues(lines.number_cues(lines.build_lines(words))))
    assert plan_of(made).count("Exchange") == 4  # words, stretches, lines, folded lines
    assert made.first().vtt == "WEBVTT\n\n00:00:00.000 --> 00:00:01.000\na\n"


def test_highlighted_groups_once(spark):
    """Cues with words, without, and with the words of one line unknown; lines are read and grouped once."""
    kind = "interview_id long, line_ix int, segment_index int, start double, end double, text string, speaker string, words array<struct<idx:int,start:double,end:double,text:string>>, cue_ix int"
    rows = [
        (1, 0, 0, 0.0, 1.0, "a <b", "S01", [(0, 0.0, 0.5, "a"), (1, 0.5, 1.0, "<b")], 0),
        (1, 1, 0, 1.0, 2.0, "c", "S01", [(2, 1.0, 2.0, "c")], 0),
        (1, 2, 1, 3.0, 4.0, "x & y", None, [], 1),
        (1, 3, 1, 4.0, 5.0, "z", None, [], 1),
        (1, 4, 2, 6.0, 7.0, "p", "S02", [(3, 6.0, 7.0, "p")], 2),
        (1, 5, 2, 7.0, 360_000.0005, "q", "S02", None, 2),
    ]
    made = render.highlighted(spark.createDataFrame(rows, kind))
    got = [(r.cue_ix, r.word_ix, r.start, r.end, r.body) for r in made.orderBy("cue_ix", "word_ix").collect()]
    assert got == [
        (0, 0, 0.0, 0.5, "<v S01><u>a</u> &lt;b c"),
        (0, 1, 0.5, 1.0, "<v S01>a <u>&lt;b</u> c"),
        (0, 2, 1.0, 2.0, "<v S01>a &lt;b <u>c</u>"),
        (1, 0, 3.0, 5.0, "x &amp; y\nz"),
        (2, 0, 6.0, 360_000.0005, "<v S02>p\nq"),
    ]
    plan = plan_of(render.to_vtt(made))
    assert plan.count("Exchange") <= 2 and "Join" not in plan and "Union" not in plan
    assert render.to_vtt(made).first().vtt.endswith("00:00:06.000 --> 100:00:00.000\n<v S02>p\nq\n")
