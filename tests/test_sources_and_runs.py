"""Lists, sources, fetching, decoding, the command line and its limits."""

import json
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from turnstone import cli
from turnstone.functions import audio
from turnstone.operators import model_output, render
from turnstone.operators.ordinals import number_rows
from turnstone.session import seconds_left, timed
from turnstone.sources import files, listing, lists
from turnstone.streaming import incremental


def test_index_keeps_what_it_does_not_know(spark, tmp_path):
    path = tmp_path / "index.json"
    old = [{"name": "b", "z": {"k": [1, None]}, "a": "ü"}, {"name": "c", "url": "c0"}, {"x": 1}]
    path.write_text(json.dumps(old))
    new = spark.createDataFrame([(0, "c", "c1", None), (1, "d", "d1", "v"), (2, None, "n", None)], "ord int, name string, url string, vtt string")
    assert lists.publish_index(new, str(path)) == {"new": 2, "updated": 1, "total": 5}
    expected = [old[0], {"name": "c", "url": "c1"}, {"x": 1}, {"name": "d", "url": "d1", "vtt": "v"}, {"url": "n"}]
    assert json.loads(path.read_text()) == expected
    assert list(json.loads(path.read_text())[0]) == ["name", "z", "a"]
    assert lists.publish_index(new.limit(0), str(path))["total"] == 5
    path.write_text("not json")
    assert lists.publish_index(new.where("ord = 1"), str(path)) == {"new": 1, "updated": 0, "total": 1}
    assert [p.name for p in tmp_path.iterdir()] == ["index.json"]


def test_lists_are_read_as_written(spark, tmp_path):
    entries = spark.createDataFrame([(1, "b", "u2"), (0, 'a"\n', "u1")], "ord int, name string, audio string")
    assert lists.write_work_list(entries, str(tmp_path / "work.json")) == 2
    assert [(r.name, r.audio) for r in listing.read_entries(spark, str(tmp_path / "work.json")).orderBy("ord").collect()] == [('a"\n', "u1"), ("b", "u2")]
    lists.write_names(spark.createDataFrame([("y",), ('x"',)], "id string"), str(tmp_path / "in" / "done.json"))
    assert json.loads((tmp_path / "in" / "done.json").read_text()) == ['x"', "y"]
    assert sorted(r.id for r in listing.skip_list(spark, str(tmp_path / "in" / "done.json")).collect()) == ['x"', "y"]
    assert listing.skip_list(spark, str(tmp_path / "none.json")).count() == 0
    assert lists.write_names(spark.createDataFrame([], "id string"), str(tmp_path / "no.json")) == 0
    assert json.loads((tmp_path / "no.json").read_text()) == []
    assert sorted(r.name for r in listing.published_names(spark, str(tmp_path / "work.json")).collect()) == ['a"\n', "b"]
    assert listing.count_files(spark, str(tmp_path), (".json",)).first().files == 3
    assert listing.count_files(spark, str(tmp_path), (".JSON",)).first().files == 0


def test_order_and_exclusion(spark, tmp_path):
    """Paths go by their parts; exclusion is of a folder, not of a text; a suffix is read as it is written."""
    names = ["a/x.wav", "a-b/x.wav", "data/one.mp3", "b/a/z.flac", "b/a2/z.FLAC", "b/note.txt", "c/k.prepared.wav", "c/K.PREPARED.WAV", "c d/é.ogg"]
    for name in names:
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(b"x")
    found = lambda exclude: [(r.ord, r.path.split(f"{tmp_path}/")[1]) for r in listing.find_recordings(spark, str(tmp_path), exclude).orderBy("ord").collect()]
    every = sorted((n for n in names if not n.endswith((".txt", ".prepared.wav"))), key=lambda n: n.split("/"))
    assert every[0] == "a/x.wav" and every[1] == "a-b/x.wav"
    assert found(None) == list(enumerate(every))
    for exclude in (f"{tmp_path}/a", f"{tmp_path}/b/../a/", f"file://{tmp_path}/a"):
        assert found(exclude) == list(enumerate(n for n in every if not n.startswith("a/")))
    assert found("a") == list(enumerate(every))


def test_places_in_order(spark):
    rows = spark.range(5000).selectExpr("pmod(xxhash64(id), 300) AS k", "id", "1 AS Inside", "2 AS place")
    placed = number_rows(rows, F.desc("k"), "id", first=1, parts=7)
    assert placed.columns == ["k", "id", "Inside", "place"]
    got = [(r.k, r.id) for r in sorted(placed.collect(), key=lambda r: r.place)]
    assert got == sorted(got, key=lambda r: (-r[0], r[1])) and sorted(r.place for r in placed.collect()) == list(range(1, 5001))
    assert number_rows(rows.where("id < 0"), "id").count() == 0


def test_published_together(spark, tmp_path):
    """A task that fails leaves no file; a commit that is cut short is finished; parts are joined in order."""
    from turnstone.sources import publishing

    root = tmp_path / "out"
    rows = spark.createDataFrame([(i, f"text {i}", None if i % 2 else "vtt") for i in range(20)], "name long, json string, vtt string").repartition(5)
    kinds = {"json": ("json", ".json"), "vtt": ("vtts", ".vtt")}
    bad = rows.withColumn("json", F.when(F.col("name") == 7, F.raise_error(F.lit("no more"))).otherwise(F.col("json")))
    with pytest.raises(Exception, match="no more"):
        publishing.publish_files(bad, str(root), kinds)
    assert not [p for p in root.rglob("*") if not p.relative_to(root).parts[0].startswith(".staged-")]
    time.sleep(2)  # tasks that were still running
    publishing.forget(str(root), 0)
    publishing.publish_files(rows, str(root), kinds)
    assert sorted(p.name for p in (root / "json").iterdir()) == sorted(f"{i}.json" for i in range(20))
    assert (root / "vtts/4.vtt").read_text() == "vtt" and len(list((root / "vtts").iterdir())) == 10 and not list(root.glob(".staged-*"))
    with pytest.raises(Exception, match="no path inside"):
        publishing.publish(spark.createDataFrame([("../x", "y")], "path string, content string"), str(root))
    assert not list(root.glob(".staged-*")) and not (tmp_path / "x").exists()
    # a driver that is lost after the decision: the rest is moved later
    cut = root / ".staged-abc" / "task"
    cut.mkdir(parents=True)
    (cut / "late.txt").write_text("late")
    (root / ".staged-abc/other").mkdir()
    (root / ".staged-abc/other/failed.txt").write_text("attempt that failed")
    (root / ".staged-abc/commit.json").write_text('["task"]')
    assert publishing.finish_commits(str(root)) == 1 and publishing.finish_commits(str(root)) == 0
    assert (root / "late.txt").read_text() == "late" and not (root / "failed.txt").exists()
    many = spark.range(3000).selectExpr("3000 - id AS ord", "to_json(named_struct('n', 3000 - id)) AS entry").repartition(6)
    assert lists.write_array(many, str(tmp_path / "all.json"), "ord") == 3000
    assert [e["n"] for e in json.loads((tmp_path / "all.json").read_text())] == list(range(1, 3001))
    assert lists.write_array(many.limit(0), str(tmp_path / "none.json"), "ord") == 0 and (tmp_path / "none.json").read_text() == "[]"
    assert not list(tmp_path.glob(".*"))


def test_sheet(spark, tmp_path):
    (tmp_path / "s.csv").write_text("as,b\n02_00113-a,1\n,2\n02_00113-b,3\n")
    assert [r.folder for r in listing.sheet_folders(spark, str(tmp_path / "s.csv")).orderBy("ord").collect()] == ["02_00113", "nan"]
    assert listing.sheet_folders(spark, str(tmp_path / "s.csv"), "none").count() == 0


def test_sources_of_items(spark, tmp_path):
    assert [listing.resolve_source(*a) for a in (("local", True), ("auto", True), (None, False), ("", True))] == ["local", "json", "smb", "json"]
    (tmp_path / "f").mkdir()
    (tmp_path / "f" / "a b.wav").write_bytes(b"x")
    (tmp_path / "w.json").write_text('[{"name": "n 1", "audio": "http://h/x.mp3"}, {"name": "no"}]')
    item = lambda *a: [(r.id, r.kind) for r in listing.work_items(spark, *a).collect()]
    assert item("local", str(tmp_path / "f")) == [("a b", "local")]
    assert item("json", str(tmp_path / "w.json")) == [("n_1", "url")]
    assert item("smb", str(tmp_path)) == [("a_b", "smb")]
    with pytest.raises(ValueError, match="unknown source"):
        listing.work_items(spark, "ftp", "x")


def test_fetching(spark, tmp_path):
    (tmp_path / "big").write_bytes(b"x" * 2000)
    (tmp_path / "small").write_bytes(b"x" * 1000)
    rows = [(k, "url", None, f"file://{tmp_path}/{k}", f"{k}.mp3") for k in ("big", "small", "none")]
    rows += [("l", None, str(tmp_path / "big"), None, None), ("m", "local", "/none/x", None, None), ("u", "ftp", None, None, None)]
    items = spark.createDataFrame(rows, "id string, kind string, path string, url string, filename string")
    got = {r.id: r for r in files.fetch_items(items, str(tmp_path / "to"), least_bytes=files.EMPTY_BYTES).collect()}
    assert got["big"].local_path == str(tmp_path / "to" / "big.mp3") and got["l"].local_path == str(tmp_path / "big")
    errors = {k: (r.error or "").partition(":")[0] for k, r in got.items()}
    assert errors == {"big": "", "small": "ValueError", "none": "URLError", "l": "", "m": "FileNotFoundError", "u": "ValueError"}
    assert [p.name for p in (tmp_path / "to").iterdir()] == ["big.mp3"]


def test_playlists(spark, tmp_path):
    """Variants, ranges, templates and what is missing, from files."""
    from turnstone.sources import playlists

    web = tmp_path / "web"
    (web / "low").mkdir(parents=True)
    (web / "master.m3u8").write_text('#EXTM3U\n#EXT-X-MEDIA:TYPE=AUDIO,GROUP-ID="a",NAME="x, y",URI="other.m3u8"\n#EXT-X-MEDIA:TYPE=AUDIO,GROUP-ID="a",DEFAULT=YES,URI="low/a.m3u8"\n#EXT-X-STREAM-INF:BANDWIDTH=9,AUDIO="a",RESOLUTION=1x1\nvideo.m3u8\n')
    (web / "low/a.m3u8").write_text("#EXTM3U\r\n#EXT-X-MAP:URI=\"../all.bin\",BYTERANGE=\"2@0\"\r\n#EXTINF:4,\r\n#EXT-X-BYTERANGE:3@4\r\n../all.bin\r\n#EXTINF:4,\r\n#EXT-X-BYTERANGE:2\r\n../all.bin\r\n#EXTINF:1,\r\nlast.ts?x=1\r\n#EXT-X-ENDLIST\r\n".replace("?x=1", ""))
    (web / "all.bin").write_bytes(b"0123456789")
    (web / "low/last.ts").write_bytes(b"END")
    (web / "plain.m3u8").write_text("#EXTM3U\n#EXT-X-STREAM-INF:BANDWIDTH=900,CODECS=\"avc1.4d,mp4a.40\"\nv.m3u8\n#EXT-X-STREAM-INF:BANDWIDTH=5,CODECS=\"mp4a.40.2\"\nlow/a.m3u8\n#EXT-X-STREAM-INF:BANDWIDTH=2,CODECS=\"mp4a.40.2\"\nx.m3u8\n")
    (web / "gone.m3u8").write_text("#EXTM3U\n#EXTINF:1,\nall.bin\n#EXTINF:1,\nnone.ts\n")
    (web / "locked.m3u8").write_text('#EXTM3U\n#EXT-X-KEY:METHOD=AES-128,URI="k"\nall.bin\n')
    (web / "loop.m3u8").write_text("#EXTM3U\n#EXT-X-STREAM-INF:BANDWIDTH=1\nloop.m3u8\n")
    (web / "short.m3u8").write_text("#EXTM3U\n#EXT-X-BYTERANGE:20@5\nall.bin\n")
    (web / "a.mpd").write_text(
        '<MPD xmlns="urn:mpeg:dash:schema:mpd:2011" mediaPresentationDuration="PT0M5S"><Period><AdaptationSet contentType="video"><Representation id="v" bandwidth="99"><BaseURL>all.bin</BaseURL></Representation></AdaptationSet>'
        '<AdaptationSet mimeType="audio/mp4"><SegmentTemplate initialization="$RepresentationID$-i.m" media="$RepresentationID$-$Number%03d$.m" duration="20" timescale="10" startNumber="7"/>'
        '<Representation id="q" bandwidth="1"/><Representation id="r" bandwidth="2"/></AdaptationSet></Period></MPD>'
    )
    for name, content in (("r-i.m", b"I"), ("r-007.m", b"a"), ("r-008.m", b"b"), ("r-009.m", b"c")):
        (web / name).write_bytes(content)
    (web / "t.mpd").write_text('<MPD><Period><AdaptationSet contentType="audio"><Representation id="r"><SegmentTemplate media="t-$Time$.m"><SegmentTimeline><S t="5" d="3" r="1"/><S d="9"/></SegmentTimeline></SegmentTemplate></Representation></AdaptationSet></Period></MPD>')
    (web / "l.mpd").write_text('<MPD><Period><AdaptationSet contentType="audio"><Representation><SegmentList><Initialization sourceURL="all.bin" range="0-1"/><SegmentURL media="all.bin" mediaRange="7-9"/></SegmentList></Representation></AdaptationSet></Period></MPD>')
    url = lambda name: (web / name).as_uri()
    assert [p.url.rpartition("/")[2] for p in playlists.resolve(url("t.mpd"))] == ["t-5.m", "t-8.m", "t-11.m"]
    wanted = {"master.m3u8": b"0145678END", "plain.m3u8": b"0145678END", "a.mpd": b"Iabc", "l.mpd": b"01789", "all.bin": b"0123456789", "gone.m3u8": "URLError", "locked.m3u8": "ValueError", "loop.m3u8": "ValueError", "short.m3u8": "ValueError", "absent.m3u8": "URLError"}
    items = spark.createDataFrame([(name, "url", None, url(name), f"{name}.mp4") for name in wanted], "id string, kind string, path string, url string, filename string")
    for made, to in ((playlists.fetch_playlists(items, str(tmp_path / "one")), tmp_path / "one"), (files.fetch_items(items, str(tmp_path / "two")), tmp_path / "two")):
        got = {r.id: r for r in made.collect()}
        for name, expected in wanted.items():
            if isinstance(expected, bytes):
                assert got[name].error is None and (to / f"{name}.mp4").read_bytes() == expected, name
            else:
                assert got[name].local_path is None and got[name].error.startswith(expected), (name, got[name])
        assert sorted(p.name for p in to.iterdir() if not p.name.startswith(".") and not p.name.endswith(".part")) == sorted(f"{n}.mp4" for n, e in wanted.items() if isinstance(e, bytes))


def test_resampling_keeps_tones():
    for rate, to in ((48_000, 16_000), (44_100, 16_000), (11_025, 16_000), (8_000, 16_000), (16_000, 48_000)):
        low, at = min(rate, to) / 2, np.arange(rate) / rate
        for share in (0.02, 0.5, 0.89):
            made = audio.resample(np.sin(2 * np.pi * share * low * at).astype(np.float32), rate, to)
            assert len(made) == to
            inside = slice(to // 4, 3 * to // 4)
            angle = 2 * np.pi * share * low * np.arange(to)[inside] / to
            waves = np.stack((np.sin(angle), np.cos(angle)), 1)
            parts, *_ = np.linalg.lstsq(waves, made[inside].astype(float), rcond=None)
            assert abs(20 * np.log10(np.hypot(*parts))) < 0.1 and abs(parts[1]) < 1e-3  # neither louder nor later
            assert 20 * np.log10(np.abs(made[inside] - waves @ parts).max()) < -60
        for share in (1.1, 1.4) if to < rate else ():
            made = audio.resample(np.sin(2 * np.pi * share * low * at).astype(np.float32), rate, to)
            assert 20 * np.log10(np.abs(made[to // 4 : 3 * to // 4]).max()) < -60
    assert abs(audio.resample(np.ones(4410, np.float32), 44_100)[400:1200] - 1).max() < 1e-6 and len(audio.resample(np.zeros(0), 8000)) == 0


def test_folders_as_a_stream(spark, tmp_path):
    """Each file once, over restarts; a folder that can't be read yet is looked at again."""
    from turnstone.session import ship
    from turnstone.sources.folders import FolderSource

    ship(spark)
    spark.dataSource.register(FolderSource)
    share = tmp_path / "share"
    for name in ("a/1.wav", "a/note.txt", "b/2.MP3"):
        (share / name).parent.mkdir(parents=True, exist_ok=True)
        (share / name).write_bytes(b"x")

    def run():
        stream = spark.readStream.format("audio_folders").options(root=str(share), folders="a,b,late", ledger=str(tmp_path / "ledger")).load()
        query = stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "check")).start()
        try:
            query.processAllAvailable()
        finally:
            query.stop()
        return sorted((r.folder, r.name, r.remote_path) for r in spark.read.parquet(str(tmp_path / "out")).collect())

    row = lambda folder, name: (folder, name, f"{share}/{folder}/{name}")
    assert run() == [row("a", "1.wav"), row("b", "2.MP3")]
    (share / "late").mkdir()
    (share / "late/3.ogg").write_bytes(b"x")
    (share / "a/0.wav").write_bytes(b"x")
    expected = [row("a", "0.wav"), row("a", "1.wav"), row("b", "2.MP3"), row("late", "3.ogg")]
    assert run() == expected and run() == expected
    with pytest.raises(Exception, match="ledger"):
        spark.readStream.format("audio_folders").options(root=str(share)).load().writeStream.format("noop").option("checkpointLocation", str(tmp_path / "no")).start().processAllAvailable()


def test_decoders_in_turn(spark):
    tone = np.full(1600, 0.25, np.float32)

    def odd(data):
        if not data.startswith(b"ODD"):
            raise ValueError("not odd")
        return np.stack((tone, tone * 3), 1), 16_000

    def missing(data):
        raise ImportError("no codec")

    rows = spark.createDataFrame([(0, bytearray(audio.encode(tone))), (1, bytearray(b"ODD")), (2, bytearray(b"junk"))], "k int, content binary")
    decoders = [("missing", missing), ("odd", odd)]
    got = {r.k: r for r in rows.select("k", audio.read_audio("content", decoders).alias("r"), audio.prepare_audio(F.col("content"), None, lambda s, rate: s / 2, decoders).alias("p")).collect()}
    assert got[0].r.error is None and abs(got[1].r.samples[0] - 0.5) < 1e-6
    assert got[2].r.error.startswith("could not decode: missing: not installed (no codec); odd: ValueError: not odd; wave: ")
    assert abs(audio.decode(got[1].p)[0].max() - 0.75) < 1e-3 and got[2].p is None  # halved, then boosted three times


def test_decoding_in_a_table(spark):
    tone = (np.sin(np.arange(1600) / 10) / 2).astype(np.float32)
    rows = spark.createDataFrame([(0, bytearray(audio.encode(tone))), (1, bytearray(b"junk" * 20)), (2, None)], "k int, content binary")
    got = {r.k: r for r in rows.select("k", audio.read_audio("content").alias("r"), audio.load_audio(F.col("content")).alias("s"), audio.prepare_audio(F.col("content"), 3.0).alias("p")).collect()}
    assert abs(np.array(got[0].s) - tone).max() < 1e-4 and got[0].r.error is None and len(got[0].r.samples) == 1600
    loud, rate = audio.decode(got[0].p)
    assert rate == audio.RATE and abs(np.abs(loud).max() - 1) < 1e-3
    assert got[1].s is None and got[1].p is None and got[1].r.error.startswith("could not decode: wave: Error")
    assert got[2].r.error is None and got[2].s is None


def test_one_item_fails_by_itself(spark):
    def start():
        def model(item):
            if item["id"] == "bad":
                raise RuntimeError("no such thing")
            if item["id"] == "gpu":
                raise RuntimeError("CUDA error: illegal memory access")
            return [] if item["id"] == "none" else [{"text": "a", "start": 0.0, "end": 1.0, "confidence": 0.5}]

        return model

    items = spark.createDataFrame([(i,) for i in ("ok", "bad", "none", "gpu", "later")], "id string").coalesce(1)
    got = {r.id: (r.outcome, r.message, len(r.words)) for r in model_output.transcribe(items, start).collect()}
    assert got["ok"] == ("ok", None, 1) and got["none"] == ("failed", "no speech recognised", 0)
    assert got["bad"] == ("failed", "RuntimeError: no such thing", 0) and got["gpu"][0] == "fatal" and got["later"][0] == "skipped"
    words = spark.createDataFrame([(1, "S01", 0, 0)], "idx int, speaker string, turn_ix int, segment_index int")
    cleared = model_output.clear_attribution(words).first()
    assert (cleared.speaker, cleared.turn_ix, cleared.segment_index) == (None, None, -1)


def test_whole_record():
    word = {"idx": 0, "text": "hi", "start": 0.12345, "end": 1.0, "confidence": float("nan"), "source": "measured", "speaker": None}
    line = {"line_ix": 0, "start": 0.0, "end": 1.0, "speaker": None, "segment_index": 0, "text": "hi", "idx": [0]}
    segment = {"segment_index": 0, "start": 0.0, "end": 1.0, "speaker": None, "text": "hi", "words": [word]}
    made = json.loads(render.full_document({"segments": [segment], "lines": [line], "audio_path": "p", "duration": None}))
    assert (made["text"], made["duration"], made["audio_path"]) == ("hi", None, "p")
    assert made["segments"][0]["words"] == [{"word": "hi", "start": 0.123, "end": 1.0, "confidence": None, "source": "measured", "speaker": None, "segment_index": 0}]
    assert made["lines"][0]["confidence"] is None


def test_times():
    seconds = {}
    for _ in range(2):
        with pytest.raises(KeyError), timed(seconds, "a"):
            time.sleep(0.01)
            raise KeyError
    assert seconds["a"] >= 0.02
    assert seconds_left(0) == float("inf") and 299 < seconds_left(15) <= 300 and seconds_left(15, time.monotonic() - 400) < 0


def test_stream_is_stopped_in_time(spark, tmp_path):
    spark.createDataFrame([("a", 0.5, "S01", 1), ("b", 1.0, "S01", 2)], "id string, confidence double, speaker string, s int").write.parquet(str(tmp_path / "items"))
    stream = spark.readStream.schema("id string, confidence double, speaker string, s int").parquet(str(tmp_path / "items"))
    seen = []
    none = lambda: spark.createDataFrame([], "id string")
    query = incremental.process_new_items(stream, none, lambda rows: seen.append(rows.count()), str(tmp_path / "c1"), available_now=False)
    query.processAllAvailable()
    assert not incremental.run_until(query, 1) and not query.isActive and seen == [2]
    query = incremental.process_new_items(stream, none, lambda rows: seen.append(rows.count()), str(tmp_path / "c2"))
    assert incremental.run_until(query) and seen == [2, 2]
    timed_rows = spark.read.parquet(str(tmp_path / "items")).withColumn("ts", F.timestamp_seconds("s"))
    talk = incremental.rolling_talk(timed_rows).first()
    assert (talk.n_words, talk.mean_confidence) == (2, 0.75)


def test_run_options(spark, tmp_path, capsys):
    words = [(k, 0, 0.0, 1.0, "a", 0.5, "measured") for k in range(1, 6)]
    spark.createDataFrame(words, "interview_id long, idx int, start double, end double, text string, confidence double, source string").write.parquet(str(tmp_path / "words"))
    spark.createDataFrame([(1, 0, 0.0, 1.0, "S01")], "interview_id long, turn_ix int, start double, end double, speaker string").write.parquet(str(tmp_path / "turns"))
    spark.createDataFrame([("1", "failed")], "id string, outcome string").write.parquet(str(tmp_path / "failed"))
    spark.createDataFrame([("1", "fatal")], "id string, outcome string").write.parquet(str(tmp_path / "fatal"))
    (tmp_path / "work.json").write_text('[{"name": "4", "audio": "u"}, {"name": "2", "audio": "u"}, {"name": "9", "audio": "u"}]')
    out = tmp_path / "out"

    def run(*more):
        code = cli.main(["run", "--words", str(tmp_path / "words"), "--turns", str(tmp_path / "turns"), "--out", str(out), *more])
        told = capsys.readouterr().out.strip().splitlines()
        return code, told[0], json.loads(told[1])

    code, told, report = run("--source", "auto", "--config-json", str(tmp_path / "work.json"), "--max-files", "1", "--outcomes", str(tmp_path / "failed"))
    assert (code, told, report["left"], report["failed"]) == (0, "2 files", 0, 0) and (out / "json" / "4.json").exists()
    assert run("--deadline-minutes", "5")[1:] and not (out / "json" / "1.json").exists()
    code, told, report = run("--deadline-minutes", "60", "--batch-files", "3", "--outcomes", str(tmp_path / "fatal"))
    assert (code, told, report["left"]) == (1, "8 files", 0) and set(report["seconds"]) == {"list", "write"}
    assert sorted(p.name for p in (out / "vtts").iterdir()) == [f"{k}.vtt" for k in range(1, 6)]
