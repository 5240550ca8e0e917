"""The registered queries over the driver's tables, each with the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from turnstone.functions import audio, text
from turnstone.operators import fusion, lines, model_output, publish, render, scoring, stats, worklist
from turnstone.operators import words as word_ops
from turnstone.plans import fixtures, recording
from turnstone.session import materialize
from turnstone.streaming import incremental

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(function: Query) -> Query:
        _QUERIES[function.__name__] = function
        if sql:
            _SQL[function.__name__] = sql
        return function

    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.timed_words(_table(spark, sf_dir, "conversations"))


def _recorded(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Words and turns, stored, as a user has them."""
    words = materialize(_words(spark, sf_dir), "words")
    return words, materialize(fixtures.speaker_turns(words), "turns")


def _marked(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    words, turns = _recorded(spark, sf_dir)
    return fusion.mark_segments(fusion.assign_speakers(words, turns)), turns


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.build_lines(_marked(spark, sf_dir)[0])


def _sql(body: str, depth: str = "fused") -> str:
    parts = [fixtures.WORDS_SQL]
    if depth != "words":
        parts.append(fixtures.TURNS_SQL)
    if depth in ("fused", "lines"):
        parts.append(fixtures.FUSE_SQL)
    if depth == "lines":
        parts.append(fixtures.LINES_SQL)
    return fixtures.with_sql(*parts, body=body)


# --- fusion ----------------------------------------------------------------------------------------------------


@query(_sql("SELECT * FROM words", "words"))
def timed_words(spark, sf_dir):
    return _words(spark, sf_dir)


@query(_sql("SELECT * FROM turns", "turns"))
def speaker_turns(spark, sf_dir):
    return fixtures.speaker_turns(_words(spark, sf_dir))


@query(_sql("SELECT interview_id, idx, turn_ix, speaker, round(overlap, 6) AS overlap, by_proximity FROM fused"))
def speaker_assignment(spark, sf_dir):
    marked, _ = _marked(spark, sf_dir)
    return marked.select("interview_id", "idx", "turn_ix", "speaker", F.round("overlap", 6).alias("overlap"), "by_proximity")


@query(_sql('SELECT interview_id, segment_index, "start", "end", text, speaker, n_words FROM segs'))
def segments(spark, sf_dir):
    marked, _ = _marked(spark, sf_dir)
    return fusion.segments(marked)


FUSION_STATS_SQL = _sql("""
SELECT w.interview_id, n AS words_total, n_in AS words_assigned, n - n_in AS words_unassigned, n_near AS words_assigned_by_proximity,
  coalesce(t, 0) AS turns_total, coalesce(t, 0) - used AS turns_without_words, round(n_in / n, 4) AS assigned_fraction,
  coalesce(round(share, 4), 0) AS mean_overlap_fraction, coalesce(names, '') AS speakers
FROM (SELECT interview_id, count(*) AS n, count(turn_ix) AS n_in, count(*) FILTER (by_proximity) AS n_near, count(DISTINCT turn_ix) AS used,
    avg(CASE WHEN turn_ix IS NOT NULL THEN least(1.0, overlap / greatest("end" - "start", 1e-6)) END) AS share FROM fused GROUP BY interview_id) w
  LEFT JOIN (SELECT interview_id, count(*) AS t, string_agg(DISTINCT speaker, ',' ORDER BY speaker) AS names FROM turns GROUP BY interview_id) u USING (interview_id)""")


@query(FUSION_STATS_SQL)
def fusion_stats(spark, sf_dir):
    marked, turns = _marked(spark, sf_dir)
    return fusion.fusion_stats(marked, turns).withColumn("speakers", F.array_join("speakers", ","))


@query(
    _sql(
        """, moved AS (SELECT *, "start" - (idx % 7) * 0.3 AS s, "end" - (idx % 5) * 0.4 AS e, max("end") OVER (PARTITION BY interview_id) * 0.9 AS lim FROM words),
clamped AS (SELECT *, least(greatest(0.0, max(s) OVER (PARTITION BY interview_id ORDER BY idx ROWS UNBOUNDED PRECEDING)), lim) AS cs FROM moved)
SELECT interview_id, idx, round(cs, 6) AS "start", round(least(greatest(e, cs), lim), 6) AS "end" FROM clamped""",
        "words",
    )
)
def clamped_words(spark, sf_dir):
    words = _words(spark, sf_dir)
    limits = words.groupBy("interview_id").agg((F.max("end") * 0.9).alias("duration"))
    moved = words.withColumn("start", F.col("start") - (F.col("idx") % 7) * 0.3).withColumn("end", F.col("end") - (F.col("idx") % 5) * 0.4)
    found = word_ops.clamp_words(moved, limits)
    return found.select("interview_id", "idx", F.round("start", 6).alias("start"), F.round("end", 6).alias("end"))


@query(_sql("""SELECT interview_id, string_agg(text, ' ' ORDER BY segment_index) AS text FROM segs GROUP BY interview_id"""))
def transcript_text(spark, sf_dir):
    marked, _ = _marked(spark, sf_dir)
    return word_ops.transcript_text(fusion.segments(marked))


@query(_sql("""SELECT interview_id, CAST(row_number() OVER (PARTITION BY interview_id ORDER BY segment_index) - 1 AS INTEGER) AS turn_ix, "start", "end", speaker
FROM segs WHERE speaker IS NOT NULL AND "end" > "start" """))
def turns_from_segments(spark, sf_dir):
    marked, _ = _marked(spark, sf_dir)
    return word_ops.turns_from_segments(fusion.segments(marked))


# --- lines, cues, renderers ----------------------------------------------------------------------------------------


@query(_sql("SELECT * FROM lines", "lines"))
def lines_packed(spark, sf_dir):
    return _lines(spark, sf_dir).drop("words")


#: At this width some recordings keep their lines and most are packed anew.
NARROW = 40


@query(_sql(f''', narrow AS (WITH RECURSIVE {fixtures.LINES_SQL.replace("42", str(NARROW))} SELECT * FROM lines),
fit AS (SELECT interview_id FROM lines GROUP BY interview_id HAVING bool_and(length(text) <= {NARROW}))
SELECT interview_id, line_ix, segment_index, "start", "end", text, speaker FROM lines WHERE interview_id IN (FROM fit)
UNION ALL SELECT interview_id, line_ix, segment_index, "start", "end", text, speaker FROM narrow WHERE interview_id NOT IN (FROM fit)''', "lines"))
def lines_reused_at_width(spark, sf_dir):
    marked = materialize(_marked(spark, sf_dir)[0], "marked")
    return lines.lines_for_width(materialize(lines.build_lines(marked).drop("words"), "lines"), marked, None, NARROW)


ESC_SQL = "replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


def _stamp_sql(value: str, decimal: str = ".") -> str:
    ms = f"CAST(round_even(greatest({value}, 0) * 1000, 0) AS BIGINT)"
    return f"printf('%02d:%02d:%02d{decimal}%03d', {ms} // 3600000, {ms} // 60000 % 60, {ms} // 1000 % 60, {ms} % 1000)"


CUES_SQL = f"""cues AS (SELECT interview_id, cue_ix, min(segment_index) AS segment_index, min_by("start", line_ix) AS "start", max_by("end", line_ix) AS "end", min_by(speaker, line_ix) AS speaker,
  CASE WHEN any_value(speaker) IS NULL THEN '' ELSE '<v ' || any_value(speaker) || '>' END || string_agg({ESC_SQL}, chr(10) ORDER BY line_ix) AS body
  FROM cued GROUP BY interview_id, cue_ix)"""


@query(_sql(f", {CUES_SQL} SELECT * FROM cues", "lines"))
def cues(spark, sf_dir):
    return render.cues(lines.number_cues(_lines(spark, sf_dir)))


@query(
    _sql(
        f""", {CUES_SQL} SELECT interview_id, 'WEBVTT' || chr(10) || chr(10) || string_agg({_stamp_sql('"start"')} || ' --> ' || {_stamp_sql('"end"')} || chr(10) || body || chr(10), chr(10) ORDER BY cue_ix) AS vtt
FROM cues GROUP BY interview_id""",
        "lines",
    )
)
def webvtt(spark, sf_dir):
    return render.to_vtt(render.cues(lines.number_cues(_lines(spark, sf_dir))))


@query(
    _sql(
        f""", {CUES_SQL} SELECT interview_id, string_agg((cue_ix + 1) || chr(10) || {_stamp_sql('"start"', ",")} || ' --> ' || {_stamp_sql('"end"', ",")} || chr(10) || body || chr(10), chr(10) ORDER BY cue_ix) AS srt
FROM cues GROUP BY interview_id""",
        "lines",
    )
)
def subrip(spark, sf_dir):
    return render.to_srt(render.cues(lines.number_cues(_lines(spark, sf_dir))))


HIGHLIGHT_SQL = f"""
, placed AS (SELECT l.interview_id, c.cue_ix, l.idx, l."start", l."end", {ESC_SQL.replace("text", "l.text")} AS word, c.speaker FROM lined l
  JOIN (SELECT interview_id, segment_index, line_ix, cue_ix, speaker, row_number() OVER (PARTITION BY interview_id, segment_index ORDER BY line_ix) - 1 AS dest FROM cued) c
  ON c.interview_id = l.interview_id AND c.segment_index = l.segment_index AND c.dest = l.dest),
single AS (SELECT a.interview_id, a.cue_ix, a.idx, any_value(a."start") AS "start", any_value(a."end") AS "end", CASE WHEN any_value(a.speaker) IS NULL THEN '' ELSE '<v ' || any_value(a.speaker) || '>' END
  || string_agg(CASE WHEN a.idx = b.idx THEN '<u>' || b.word || '</u>' ELSE b.word END, ' ' ORDER BY b.idx) AS body
  FROM placed a JOIN placed b USING (interview_id, cue_ix) GROUP BY a.interview_id, a.cue_ix, a.idx)
SELECT interview_id, 'WEBVTT' || chr(10) || chr(10) || string_agg({_stamp_sql('"start"')} || ' --> ' || {_stamp_sql('"end"')} || chr(10) || body || chr(10), chr(10) ORDER BY cue_ix, idx) AS vtt
FROM single GROUP BY interview_id"""


@query(_sql(HIGHLIGHT_SQL, "lines"))
def webvtt_highlighted(spark, sf_dir):
    return render.to_vtt(render.highlighted(lines.number_cues(_lines(spark, sf_dir))))


@query()
def transcript_json(spark, sf_dir):
    marked, _ = _marked(spark, sf_dir)
    return render.to_json(render.nested_segments(marked, fusion.segments(marked)))


_JSON_WORD = "struct<word:string,start:double,end:double,score:double,speaker:string,source:string>"
_JSON_SEGMENT = f"struct<start:double,end:double,text:string,speaker:string,words:array<{_JSON_WORD}>>"


@query(_sql("""SELECT m.interview_id, 'en' AS "language", m.segment_index, round(s."start", 3) AS segment_start, round(s."end", 3) AS segment_end, s.text AS segment_text, s.speaker AS segment_speaker,
  row_number() OVER (PARTITION BY m.interview_id, m.segment_index ORDER BY m.idx) - 1 AS place, m.text AS word, round(m."start", 3) AS "start", round(m."end", 3) AS "end", m.confidence AS score, m.speaker, m.source
FROM marked m JOIN segs s USING (interview_id, segment_index)"""))
def transcript_json_words(spark, sf_dir):
    """Every word as a reader of the JSON finds it."""
    read = transcript_json(spark, sf_dir).select("interview_id", F.from_json("json", f"struct<language:string,segments:array<{_JSON_SEGMENT}>>").alias("d"))
    placed = read.select("interview_id", "d.language", F.posexplode("d.segments").alias("segment_index", "s"))
    own = [F.col(f"s.{c}").alias(f"segment_{c}") for c in ("start", "end", "text", "speaker")]
    return placed.select("interview_id", "language", "segment_index", *own, F.posexplode("s.words").alias("place", "w")).select("*", "w.*").drop("w")


@query()
def transcript_records(spark, sf_dir):
    words, turns = _recorded(spark, sf_dir)
    made = recording.fuse(words, turns)
    facts = words.groupBy("interview_id").agg(F.max("end").alias("duration")).withColumn("audio_path", F.concat(F.lit("/audio/iv_"), "interview_id", F.lit(".mp3")))
    return render.to_full_json(render.nested_segments(made.words, made.segments), made.lines, facts)


_RECORD_LINE = "struct<index:int,start:double,end:double,speaker:string,segment_index:int,text:string>"


@query(_sql(""", facts AS (SELECT interview_id, max("end") AS duration FROM words GROUP BY interview_id)
SELECT interview_id, '/audio/iv_' || interview_id || '.mp3' AS audio_path, round(duration, 3) AS duration, line_ix AS index, round(l."start", 3) AS "start", round(l."end", 3) AS "end", l.speaker, segment_index, l.text, n_words AS segment_words
FROM lines l JOIN facts USING (interview_id) JOIN (SELECT interview_id, segment_index, n_words FROM segs) USING (interview_id, segment_index)""", "lines"))
def transcript_record_lines(spark, sf_dir):
    """Every line as a reader of the whole records finds it, with the number of its segment's words."""
    kind = f"struct<audio_path:string,duration:double,segments:array<struct<words:array<struct<word:string>>>>,lines:array<{_RECORD_LINE}>>"
    read = transcript_records(spark, sf_dir).select("interview_id", F.from_json("json", kind).alias("d"))
    flat = read.select("interview_id", "d.audio_path", "d.duration", "d.segments", F.inline("d.lines"))
    return flat.withColumn("segment_words", F.size(F.get("segments", F.col("segment_index"))["words"]).cast("long")).drop("segments")


@query(
    f"""SELECT event_id, {_stamp_sql("value")} AS dot, {_stamp_sql("value * 100", ",")} AS comma FROM events"""
)
def stamps(spark, sf_dir):
    events = _table(spark, sf_dir, "events")
    return events.select("event_id", text.stamp(F.col("value")).alias("dot"), text.stamp(F.col("value") * 100, ",").alias("comma"))


@query(f"SELECT page_id, md5({ESC_SQL.replace('text', 'html')}) AS escaped FROM pages")
def escaped_pages(spark, sf_dir):
    return _table(spark, sf_dir, "pages").select("page_id", F.md5(text.escape(F.col("html")).cast("binary")).alias("escaped"))


# --- statistics -----------------------------------------------------------------------------------------------------


@query(_sql("SELECT interview_id, segment_index, round(CAST(sum(CAST(round(confidence * 1000) AS BIGINT)) AS DOUBLE) / count(confidence) / 1000, 12) AS mean_confidence FROM marked GROUP BY ALL"))
def segment_confidence(spark, sf_dir):
    marked, _ = _marked(spark, sf_dir)
    exact = marked.withColumn("confidence", F.round(F.col("confidence") * 1000).cast("long"))
    return stats.mean_confidence(exact, "interview_id", "segment_index", scale=1000, digits=12)


@query(
    _sql(
        """, sorted AS (SELECT interview_id, list_sort(list(round(confidence, 4)) FILTER (confidence IS NOT NULL)) AS l FROM words GROUP BY interview_id)
SELECT interview_id, coalesce(round(l[least(CAST(floor(len(l) * 0.75) AS BIGINT), len(l) - 1) + 1], 3), 0.9) AS good,
  coalesce(round(l[least(CAST(floor(len(l) * 0.5) AS BIGINT), len(l) - 1) + 1], 3), 0.7) AS neutral,
  coalesce(round(l[least(CAST(floor(len(l) * 0.25) AS BIGINT), len(l) - 1) + 1], 3), 0.5) AS bad FROM sorted""",
        "words",
    )
)
def score_bands(spark, sf_dir):
    return stats.score_bands(_words(spark, sf_dir))


@query(
    _sql(
        """, per AS (SELECT interview_id, segment_index, count(*) AS w, count(*) FILTER (source = 'measured') AS m FROM marked GROUP BY ALL)
SELECT interview_id, count(*) AS total_segments, count(*) FILTER (m > 0) AS successful_alignments, count(*) FILTER (m = 0) AS failed_alignments,
  round(count(*) FILTER (m > 0) / count(*) * 100, 1) AS success_rate, CAST(sum(w) AS BIGINT) AS total_words, CAST(sum(m) AS BIGINT) AS words_with_measured_timings FROM per GROUP BY interview_id"""
    )
)
def alignment_stats(spark, sf_dir):
    marked, _ = _marked(spark, sf_dir)
    return stats.alignment_stats(marked, fusion.segments(marked))


@query(
    _sql(
        """, late AS (SELECT interview_id, idx, "start" + (interview_id % 5) * 10 AS s, "end" + (interview_id % 5) * 10 AS e FROM words),
ends AS (SELECT interview_id, round(min_by(s, idx), 2) AS a, round(max_by(e, idx), 2) AS b, max(e) + 1 AS d FROM late GROUP BY interview_id)
SELECT interview_id, round(d, 2) AS audio_seconds, a AS first_word_at, b AS last_word_at,
  CASE WHEN a > 30 THEN 'no words in the first ' || CAST(round_even(a, 0) AS BIGINT) || 's of ' || CAST(round_even(d, 0) AS BIGINT) || 's' END AS warning FROM ends""",
        "words",
    )
)
def run_summary(spark, sf_dir):
    shift = (F.col("interview_id") % 5) * 10
    words = _words(spark, sf_dir).withColumn("start", F.col("start") + shift).withColumn("end", F.col("end") + shift)
    interviews = words.groupBy("interview_id").agg((F.max("end") + 1).alias("duration"))
    return stats.run_summary(words, interviews).select("interview_id", "audio_seconds", "first_word_at", "last_word_at", "warning")


@query(
    _sql(
        """SELECT interview_id, s.n AS segments, l.n AS lines, w.n AS words FROM (SELECT interview_id, count(*) AS n FROM segs GROUP BY interview_id) s
JOIN (SELECT interview_id, count(*) AS n FROM lines GROUP BY interview_id) l USING (interview_id) JOIN (SELECT interview_id, count(*) AS n FROM words GROUP BY interview_id) w USING (interview_id)""",
        "lines",
    )
)
def transcript_counts(spark, sf_dir):
    marked, _ = _marked(spark, sf_dir)
    parts = fusion.segments(marked)
    return stats.transcript_counts(marked, parts, lines.build_lines(marked, parts))


@query(_sql('SELECT interview_id, speaker, round(sum("end" - "start"), 3) AS seconds FROM segs GROUP BY ALL'))
def talk_time(spark, sf_dir):
    marked, _ = _marked(spark, sf_dir)
    return stats.talk_time(fusion.segments(marked)).withColumn("seconds", F.round("seconds", 3))


@query(_sql("SELECT interview_id, idx, text, confidence FROM words WHERE confidence < 0.6", "words"))
def low_scores(spark, sf_dir):
    return stats.low_scores(_words(spark, sf_dir)).select("interview_id", "idx", "text", "confidence")


@query("SELECT CASE o_orderstatus WHEN 'F' THEN 'processed' WHEN 'O' THEN 'skipped' ELSE 'failed' END AS outcome, count(*) AS items FROM orders GROUP BY 1")
def outcome_totals(spark, sf_dir):
    outcome = F.when(F.col("o_orderstatus") == "F", "processed").when(F.col("o_orderstatus") == "O", "skipped").otherwise("failed")
    return stats.outcome_totals(_table(spark, sf_dir, "orders").select(outcome.alias("outcome")))


# --- text -----------------------------------------------------------------------------------------------------------

_CJK_SQL = r"\x{3040}-\x{30FF}\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{F900}-\x{FAFF}\x{AC00}-\x{D7AF}\x{20000}-\x{2FA1F}"
UNITS_SQL = f"""regexp_extract_all(replace(regexp_replace(regexp_replace(trim(regexp_replace(text, '\\s+', ' ', 'g')), ' (\\pP+)', chr(1) || '\\1' || chr(2), 'g'), chr(2) || '?' || chr(1), '', 'g'), chr(2), ' '),
  '[{_CJK_SQL}]\\pP*|[^ {_CJK_SQL}]+')"""


@query(f"SELECT conv_id, turn, CAST(len(u) AS INTEGER) AS n_units, array_to_string(u, '|') AS units FROM (SELECT conv_id, turn, {UNITS_SQL} AS u FROM conversations)")
def text_units(spark, sf_dir):
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", text.split_words(F.col("text")).alias("u"))
    return rows.select("conv_id", "turn", F.size("u").alias("n_units"), F.array_join("u", "|").alias("units"))


@query(
    """SELECT w, trim(replace(lower(regexp_replace(w, '[^\\PP'']', '', 'g')), 'ß', 'ss'), '''') AS scored, right(w, 1) IN ('.', '!', '?', '…', ';') AS stops
FROM (SELECT DISTINCT unnest(string_split_regex(text, '[ \\n]+')) AS w FROM conversations) WHERE w <> ''"""
)
def normalized_words(spark, sf_dir):
    words = _table(spark, sf_dir, "conversations").select(F.explode(F.split("text", "[ \n]+")).alias("w")).where("w <> ''").distinct()
    return words.select("w", text.normalize_for_scoring("w").alias("scored"), text.ends_sentence(F.col("w")).alias("stops"))


@query("SELECT w, regexp_replace(replace(lower(w), 'ß', 'ss'), '[^\\pL\\pN'']', '', 'g') AS aligned FROM (SELECT DISTINCT unnest(string_split_regex(text, '[ \\n]+')) AS w FROM conversations) WHERE w <> ''")
def alignment_words(spark, sf_dir):
    words = _table(spark, sf_dir, "conversations").select(F.explode(F.split("text", "[ \n]+")).alias("w")).where("w <> ''").distinct()
    return words.select("w", text.normalize_for_alignment("w").alias("aligned"))


@query(
    """WITH u AS (SELECT page_id, url, CASE page_id % 4 WHEN 0 THEN url || '/talk_' || page_id || '.mp4/index.m3u8' WHEN 1 THEN url || '/a.b-' || page_id || '.wav' WHEN 2 THEN url || '.mpd' ELSE url END AS media FROM pages)
SELECT page_id, substr(regexp_replace(url, '[^\\pL\\pN\\-_.]', '_', 'g'), 1, 180) AS slug,
  CASE WHEN regexp_extract(media, '/([^/]+\\.(?:mp4|mp3|m4a|wav))(?:/|$)', 1) <> '' THEN regexp_extract(media, '/([^/]+\\.(?:mp4|mp3|m4a|wav))(?:/|$)', 1) ELSE 'page_' || page_id || '_x.mp4' END AS file,
  CASE WHEN regexp_extract(media, '/([^/]+\\.mp4)/index\\.m3u8', 1) <> '' THEN regexp_extract(media, '/([^/]+\\.mp4)/index\\.m3u8', 1) ELSE 'page ' || page_id || '/x.mp4' END AS stream_file,
  media LIKE '%.m3u8' OR media LIKE '%.mpd' OR media LIKE '%/index.m3u8%' AS stream,
  CASE WHEN regexp_extract(page_id || '_' || page_id * 7 || '-a', '^([0-9]+_[0-9]+)', 1) <> '' THEN regexp_extract(page_id || '_' || page_id * 7 || '-a', '^([0-9]+_[0-9]+)', 1) END AS folder,
  'iv_' || page_id AS stem, 'https://files.example.org/json/' || page_id || '.json' AS published, 'job ' || page_id || ' of main' AS filled FROM u"""
)
def names_from_urls(spark, sf_dir):
    kind = F.col("page_id") % 4
    media = F.when(kind == 0, F.concat("url", F.lit("/talk_"), "page_id", F.lit(".mp4/index.m3u8")))
    media = media.when(kind == 1, F.concat("url", F.lit("/a.b-"), "page_id", F.lit(".wav"))).when(kind == 2, F.concat("url", F.lit(".mpd"))).otherwise(F.col("url"))
    name = F.concat(F.lit("page "), "page_id", F.lit("/x"))
    number = F.col("page_id").cast("string")
    return _table(spark, sf_dir, "pages").withColumn("media", media).select(
        "page_id",
        text.slug(F.col("url")).alias("slug"),
        text.filename_from_url(F.col("media"), name).alias("file"),
        text.stream_filename(F.col("media"), name).alias("stream_file"),
        text.is_stream(F.col("media")).alias("stream"),
        text.folder_name(F.concat("page_id", F.lit("_"), F.col("page_id") * 7, F.lit("-a"))).alias("folder"),
        text.stem(F.concat(F.lit("/data/iv_"), "page_id", F.lit(".2"))).alias("stem"),
        text.published_url("https://files.example.org/", "json", number, ".json").alias("published"),
        text.fill_template(F.lit("job {ID} of {BRANCH}"), {"ID": number, "BRANCH": "main"}).alias("filled"),
    )


# --- work lists -------------------------------------------------------------------------------------------------------

ENTRIES_SQL = """entries AS (SELECT c_custkey AS ord, CASE WHEN c_custkey % 5 = 0 THEN '' ELSE c_name END AS name, CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE 'id ' || c_custkey END AS id,
  CASE WHEN c_custkey % 3 = 0 THEN '' ELSE 'https://m.example.org/' || c_custkey || '/t.mp3' END AS audio, CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE 'https://n.example.org/' || c_custkey END AS audio_url FROM customer)"""


def _entries(spark, sf_dir):
    key = F.col("c_custkey")
    return _table(spark, sf_dir, "customer").select(
        key.alias("ord"),
        F.when(key % 5 == 0, "").otherwise(F.col("c_name")).alias("name"),
        F.when(key % 10 != 0, F.concat(F.lit("id "), key)).alias("id"),
        F.when(key % 3 == 0, "").otherwise(F.concat(F.lit("https://m.example.org/"), key, F.lit("/t.mp3"))).alias("audio"),
        F.when(key % 6 != 0, F.concat(F.lit("https://n.example.org/"), key)).alias("audio_url"),
    )


@query(
    f"""WITH {ENTRIES_SQL}, named AS (SELECT ord, coalesce(nullif(audio, ''), nullif(audio_url, '')) AS url, coalesce(nullif(name, ''), nullif(id, '')) AS name FROM entries)
SELECT ord, regexp_replace(name, '[^\\pL\\pN\\-_.]', '_', 'g') AS id, 'url' AS kind, url, name, CASE WHEN url LIKE '%/t.mp3' THEN 't.mp3' ELSE regexp_replace(name, '[^\\pL\\pN\\-_.]', '_', 'g') || '.mp4' END AS filename
FROM named WHERE url IS NOT NULL AND name IS NOT NULL"""
)
def items_from_entries(spark, sf_dir):
    return worklist.items_from_entries(_entries(spark, sf_dir))


@query("SELECT page_id AS ord, regexp_replace(regexp_extract(url || '.wav', '([^/]*)/*$', 1), '(.)\\.[^.]*$', '\\1') AS id, 'local' AS kind, url || '.wav' AS path, false AS temporary FROM pages")
def items_from_paths(spark, sf_dir):
    paths = _table(spark, sf_dir, "pages").select(F.col("page_id").alias("ord"), F.concat("url", F.lit(".wav")).alias("path"))
    return worklist.items_from_paths(paths).withColumn("temporary", worklist.is_temporary(F.col("kind")))


@query("SELECT folder, min(o_orderkey) AS ord FROM (SELECT o_orderkey, o_custkey % 97 || '_' || o_custkey % 7 AS folder FROM orders) GROUP BY folder ORDER BY ord LIMIT 50")
def distinct_folders(spark, sf_dir):
    value = F.concat((F.col("o_custkey") % 97).cast("string"), F.lit("_"), F.col("o_custkey") % 7, F.when(F.col("o_orderkey") % 2 == 0, "-a").otherwise(" "))
    return worklist.distinct_folders(_table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("ord"), value.alias("value")), 50)


@query("SELECT o_custkey % 997 || '_' || o_custkey % 7 AS folder, min(o_orderkey) AS ord FROM orders GROUP BY folder")
def distinct_folders_all(spark, sf_dir):
    value = F.concat((F.col("o_custkey") % 997).cast("string"), F.lit("_"), F.col("o_custkey") % 7, F.when(F.col("o_orderkey") % 2 == 0, "-a").otherwise(" "))
    return worklist.distinct_folders(_table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("ord"), value.alias("value")))


DONE_SQL = "done AS (SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS id FROM orders WHERE o_orderstatus = 'F'), items AS (SELECT c_custkey AS ord, CAST(c_custkey AS VARCHAR) AS id FROM customer)"


def _items_and_done(spark, sf_dir):
    items = _table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("ord"), F.col("c_custkey").cast("string").alias("id"))
    return items, _table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").cast("string").alias("id"))


@query(f"WITH {DONE_SQL} SELECT * FROM items WHERE id NOT IN (SELECT id FROM done)")
def pending_items(spark, sf_dir):
    return worklist.pending(*_items_and_done(spark, sf_dir))


@query(f"WITH {DONE_SQL} SELECT * FROM items WHERE id NOT IN (SELECT id FROM done) ORDER BY ord LIMIT 25")
def pending_limited(spark, sf_dir):
    return worklist.pending(*_items_and_done(spark, sf_dir), limit=25)


@query(f"WITH {DONE_SQL} SELECT * FROM (SELECT * FROM items ORDER BY ord LIMIT 25) WHERE id NOT IN (SELECT id FROM done)")
def pending_limit_first(spark, sf_dir):
    return worklist.pending(*_items_and_done(spark, sf_dir), limit=25, limit_first=True)


@query("""SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'RuntimeError: CUDA error: ' || event_type WHEN 1 THEN 'cuDNN error' WHEN 2 THEN 'ValueError: ' || event_type ELSE 'cuda error' END AS message, event_id % 4 < 2 AS fatal FROM events""")
def fatal_messages(spark, sf_dir):
    kind = F.col("event_id") % 4
    message = F.when(kind == 0, F.concat(F.lit("RuntimeError: CUDA error: "), "event_type")).when(kind == 1, "cuDNN error")
    message = message.when(kind == 2, F.concat(F.lit("ValueError: "), "event_type")).otherwise("cuda error")
    rows = _table(spark, sf_dir, "events").select("event_id", message.alias("message"))
    return rows.withColumn("fatal", worklist.is_unrecoverable(F.col("message")))


@query(
    """SELECT ord, name, url, folder, CASE WHEN regexp_extract(url, '/([^/]+\\.mp4)/index\\.m3u8', 1) <> '' THEN regexp_extract(url, '/([^/]+\\.mp4)/index\\.m3u8', 1) ELSE name || '.mp4' END AS filename
FROM (SELECT page_id AS ord, 'p' || page_id AS name, url || CASE WHEN page_id % 2 = 0 THEN '/f' || page_id || '.mp4/index.m3u8' ELSE '' END AS url, 'p' || page_id AS folder FROM pages)"""
)
def valid_downloads(spark, sf_dir):
    suffix = F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("/f"), "page_id", F.lit(".mp4/index.m3u8"))).otherwise("")
    rows = _table(spark, sf_dir, "pages").select(F.col("page_id").alias("ord"), F.concat(F.lit("p"), "page_id").alias("name"), F.concat("url", suffix).alias("audio"))
    return worklist.valid_downloads(rows)


# --- publishing -------------------------------------------------------------------------------------------------------


@query(
    """WITH j AS (SELECT 'c' || c_custkey AS name FROM customer WHERE c_acctbal > 0), v AS (SELECT 'c' || c_custkey AS name FROM customer WHERE c_nationkey < 15)
SELECT c_custkey AS ord, c_name AS name, 'a' || c_custkey AS audio, CASE WHEN j.name IS NULL THEN '' ELSE 'https://r.example.org/json/' || j.name || '.json' END AS url,
  CASE WHEN v.name IS NULL THEN '' ELSE 'https://r.example.org/vtts/' || v.name || '.vtt' END AS vtt
FROM customer LEFT JOIN j ON j.name = 'c' || c_custkey LEFT JOIN v ON v.name = 'c' || c_custkey WHERE j.name IS NOT NULL OR v.name IS NOT NULL"""
)
def linked_entries(spark, sf_dir):
    customer = _table(spark, sf_dir, "customer")
    file = lambda kind, suffix: F.concat(F.lit(f"/out/{kind}/c"), "c_custkey", F.lit(suffix)).alias("path")
    links = publish.file_links(customer.where("c_acctbal > 0").select(file("json", ".json")), customer.where("c_nationkey < 15").select(file("vtts", ".vtt")), "https://r.example.org")
    entries = customer.select(F.col("c_custkey").alias("ord"), F.col("c_name").alias("name"), F.concat(F.lit("c"), "c_custkey").alias("folder"), F.concat(F.lit("a"), "c_custkey").alias("audio"))
    return publish.link_entries(entries, links)


INDEX_SQL = """old AS (SELECT c_custkey AS ord, 'n' || c_custkey AS name, 'old' || c_custkey AS url FROM customer),
new AS (SELECT o_orderkey AS ord, CASE WHEN o_orderkey % 50 = 0 THEN '' ELSE 'n' || o_custkey * 2 END AS name, 'new' || o_orderkey AS url FROM orders),
newest AS (SELECT name, arg_max(url, ord) AS url FROM new WHERE name <> '' GROUP BY name),
merged AS (SELECT old.ord, old.name, coalesce(newest.url, old.url) AS url, false AS is_new FROM old LEFT JOIN newest USING (name)
  UNION ALL SELECT ord, name, url, true FROM new WHERE name NOT IN (SELECT name FROM old))"""


def _indexes(spark, sf_dir):
    old = _table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("ord"), F.concat(F.lit("n"), "c_custkey").alias("name"), F.concat(F.lit("old"), "c_custkey").alias("url"))
    name = F.when(F.col("o_orderkey") % 50 == 0, "").otherwise(F.concat(F.lit("n"), F.col("o_custkey") * 2))
    new = _table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("ord"), name.alias("name"), F.concat(F.lit("new"), "o_orderkey").alias("url"))
    return old, new


@query(f"WITH {INDEX_SQL} SELECT * FROM merged")
def merged_index(spark, sf_dir):
    return publish.merge_index(*_indexes(spark, sf_dir))


@query(f"WITH {INDEX_SQL} SELECT count(*) FILTER (is_new) AS new, (SELECT count(*) FROM new) - count(*) FILTER (is_new) AS updated, count(*) AS total FROM merged")
def merge_counts(spark, sf_dir):
    return publish.merge_counts(*_indexes(spark, sf_dir))


# --- model output -----------------------------------------------------------------------------------------------------


@query(
    """WITH d AS (SELECT event_id AS interview_id, value * 40 AS duration FROM events WHERE value > 0)
SELECT interview_id, CAST(i AS INTEGER) AS chunk_ix, round(i * 465.0, 6) AS chunk_start, round(least(i * 465.0 + 480.0, duration), 6) AS chunk_end
FROM d, LATERAL (SELECT unnest(range(0, CAST(greatest(ceil(duration / 465.0), 1) AS BIGINT))) AS i) s"""
)
def chunk_plan(spark, sf_dir):
    rows = _table(spark, sf_dir, "events").where("value > 0").select(F.col("event_id").alias("interview_id"), (F.col("value") * 40).alias("duration"))
    return model_output.plan_chunks(rows).select("interview_id", "chunk_ix", F.round("chunk_start", 6).alias("chunk_start"), F.round("chunk_end", 6).alias("chunk_end"))


@query("SELECT event_id, CASE WHEN event_id % 2 = 0 AND value * 20 > 480 THEN 'chunk' WHEN event_id % 2 = 1 AND value * 20 > 1200 THEN 'local' ELSE 'full' END AS strategy FROM events")
def long_audio_strategy(spark, sf_dir):
    mode = F.when(F.col("event_id") % 2 == 0, "chunk").otherwise("local")
    return _table(spark, sf_dir, "events").select("event_id", model_output.long_audio_strategy(F.col("value") * 20, mode).alias("strategy"))


@query(_sql('SELECT interview_id, idx, text, round("start", 3) AS "start", round("end", 3) AS "end" FROM words', "words"))
def stitched_chunks(spark, sf_dir):
    """Words cut into overlapping chunks and stitched are the words."""
    words = _words(spark, sf_dir)
    limits = words.groupBy("interview_id").agg(F.max("end").alias("duration"))
    chunks = model_output.plan_chunks(limits, 20.0, 4.0)
    inside = (F.col("start") >= F.col("chunk_start")) & (F.col("start") < F.col("chunk_end"))
    cut = words.join(chunks, "interview_id").where(inside)
    cut = cut.withColumn("start", F.col("start") - F.col("chunk_start")).withColumn("end", F.col("end") - F.col("chunk_start"))
    own = cut.select("interview_id", "chunk_ix", "idx", "text", "start", "end")
    found = model_output.stitch_chunks(own, chunks, 20.0, 4.0)
    return found.select("interview_id", "idx", "text", F.round("start", 3).alias("start"), F.round("end", 3).alias("end"))


@query(
    _sql(
        """, raw AS (SELECT interview_id, idx, CASE WHEN idx % 9 = 0 THEN ' ' ELSE text END AS w, "start", "end", CASE WHEN interview_id % 4 = 0 AND idx = 0 THEN 'none' ELSE CAST(idx % 100 AS VARCHAR) END AS score FROM words),
sound AS (SELECT interview_id FROM raw GROUP BY interview_id HAVING count(*) = count(try_cast(score AS DOUBLE)) AND interview_id % 3 <> 0)
SELECT r.interview_id, CAST(row_number() OVER (PARTITION BY r.interview_id ORDER BY idx) - 1 AS INTEGER) AS idx, trim(w) AS text, "start", "end", CASE WHEN s.interview_id IS NOT NULL THEN try_cast(score AS DOUBLE) END AS confidence, 'measured' AS source
FROM raw r LEFT JOIN sound s USING (interview_id) WHERE trim(w) <> ''""",
        "words",
    )
)
def hypothesis_words(spark, sf_dir):
    return model_output.hypothesis_words(_hypotheses(spark, sf_dir))


def _hypotheses(spark, sf_dir):
    words = _words(spark, sf_dir)
    entry = F.struct(
        "idx",
        F.when(F.col("idx") % 9 == 0, " ").otherwise(F.col("text")).alias("word"),
        *[F.lit(None).cast("string").alias(c) for c in ("segment", "char", "text")],
        "start",
        "end",
    )
    score = F.when((F.col("interview_id") % 4 == 0) & (F.col("idx") == 0), "none").otherwise((F.col("idx") % 100).cast("string"))
    scored = words.withColumn("score", score)
    both = scored.groupBy("interview_id").agg(F.array_sort(F.collect_list(entry)).alias("raw"), word_ops.ordered("idx", "score").alias("scores"))
    extra = F.when(F.col("interview_id") % 3 == 0, F.concat("scores", F.array(F.lit("1")))).otherwise(F.col("scores"))
    return both.withColumn("scores", extra)


@query(
    _sql(
        """, n AS (SELECT interview_id, count(*) AS n FROM words GROUP BY interview_id)
SELECT interview_id, CASE WHEN interview_id % 3 = 0 THEN 'word_confidence length ' || (n + 1) || ' != word count ' || n || '; scores discarded' ELSE 'word_confidence was not numeric; scores discarded' END AS warnings
FROM n WHERE interview_id % 3 = 0 OR interview_id % 4 = 0""",
        "words",
    )
)
def hypothesis_warnings(spark, sf_dir):
    return model_output.hypothesis_warnings(_hypotheses(spark, sf_dir)).withColumn("warnings", F.array_join("warnings", "|"))


@query(
    _sql(
        """, raw AS (SELECT *, CASE turn_ix % 3 WHEN 0 THEN 'speaker_' || (turn_ix % 4) WHEN 1 THEN CAST(turn_ix % 4 AS VARCHAR) ELSE 'spk' || turn_ix || '_ch' || (turn_ix % 4) END AS who FROM turns),
cut AS (SELECT interview_id, least("start", 60.0) AS s, greatest(least("start", 60.0), least("end", 60.0)) AS e, turn_ix % 4 + 1 AS n, turn_ix AS place FROM raw)
SELECT interview_id, CAST(row_number() OVER (PARTITION BY interview_id ORDER BY s, e, place) - 1 AS INTEGER) AS turn_ix, s AS "start", e AS "end", printf('S%02d', n) AS speaker FROM cut""",
        "turns",
    )
)
def diarized_turns(spark, sf_dir):
    turns = fixtures.speaker_turns(_words(spark, sf_dir))
    ix = F.col("turn_ix")
    who = F.when(ix % 3 == 0, F.concat(F.lit("speaker_"), ix % 4)).when(ix % 3 == 1, (ix % 4).cast("string")).otherwise(F.concat(F.lit("spk"), ix, F.lit("_ch"), ix % 4))
    as_text = F.concat_ws(" ", "start", "end", who)
    as_object = F.to_json(F.struct(F.col("start").cast("string").alias("begin"), F.col("end").cast("string").alias("end_time"), who.alias("label")))
    as_array = F.concat(F.lit("["), F.concat_ws(", ", "start", "end", F.concat(F.lit('"'), who, F.lit('"'))), F.lit("]"))
    raw = turns.select("interview_id", ix.alias("ord"), F.when(ix % 5 == 0, as_object).when(ix % 5 == 1, as_array).otherwise(as_text).alias("raw"))
    raw = raw.union(turns.select("interview_id", ix, F.lit("no turn")))
    limits = turns.select("interview_id").distinct().withColumn("duration", F.lit(60.0))
    return model_output.diarized_turns(model_output.parse_raw_turns(raw), limits)


@query(
    _sql(
        """, n AS (SELECT interview_id, count(*) AS t, string_agg(DISTINCT speaker, ',' ORDER BY speaker) AS names FROM turns WHERE interview_id % 3 <> 0 GROUP BY interview_id)
SELECT DISTINCT w.interview_id, coalesce(t, 0) AS turns, coalesce(names, '') AS speakers, round(w.interview_id / 100.0 / 60.0, 5) AS rtf,
  CASE w.interview_id % 3 WHEN 0 THEN 'failed' ELSE NULL END AS status FROM words w LEFT JOIN n USING (interview_id)""",
        "turns",
    )
)
def diarization_meta(spark, sf_dir):
    words = _words(spark, sf_dir)
    turns = fixtures.speaker_turns(words).where("interview_id % 3 <> 0")
    failed = F.col("interview_id") % 3 == 0
    runs = words.select("interview_id").distinct().select("interview_id", (F.col("interview_id") / 100.0).alias("elapsed"), F.lit(60.0).alias("duration"), failed.alias("failed"), F.lit(True).alias("enabled"))
    return model_output.diarization_meta(turns, runs).withColumn("speakers", F.array_join("speakers", ","))


# --- scoring ------------------------------------------------------------------------------------------------------------


def _mean_sql(which: str) -> str:
    """The mean of three-digit confidences to four places, in whole numbers, halves up."""
    total, n = f"CAST(sum(CAST(round(confidence * 1000) AS BIGINT)) FILTER ({which}) AS BIGINT)", f"count(confidence) FILTER ({which})"
    return f"CASE WHEN {n} > 0 THEN ((20 * {total} + {n}) // (2 * {n})) / 10000.0 END"


#: Swapped words match nothing and dropped ones can't come back, so a least-cost alignment has just these operations.
#: DuckDB measures bytes: letters beyond ASCII get upper-case letters, which normalised words don't have.
@query(_sql(f"""
, heard AS (SELECT interview_id, idx, confidence, idx % 11 = 10 AS gone, idx % 11 <> 10 AND idx % 13 = 12 AS swapped,
  translate(trim(replace(lower(regexp_replace(text, '[^\\PP'']', '', 'g')), 'ß', 'ss'), ''''), 'äöüéèêçñóáíú', 'ABCDEFGHIJKL') AS token FROM words),
counted AS (SELECT interview_id, count(*) AS reference_words, count(*) FILTER (NOT gone) AS hypothesis_words, count(*) FILTER (NOT gone AND NOT swapped) AS hits,
  count(*) FILTER (swapped) AS substitutions, count(*) FILTER (gone) AS deletions, CAST(0 AS BIGINT) AS insertions,
  string_agg(token, '' ORDER BY idx) AS ref, string_agg(CASE WHEN swapped THEN 'qqq' ELSE token END, '' ORDER BY idx) FILTER (NOT gone) AS hyp,
  {_mean_sql('NOT gone')} AS mean_confidence, {_mean_sql('NOT gone AND NOT swapped')} AS mean_confidence_correct,
  {_mean_sql('swapped')} AS mean_confidence_incorrect FROM heard GROUP BY interview_id)
SELECT * EXCLUDE (ref, hyp), round((substitutions + deletions) / reference_words, 4) AS wer, round(hits / reference_words, 4) AS word_accuracy,
  round(levenshtein(ref, coalesce(hyp, '')) / greatest(1, length(ref)), 4) AS cer FROM counted""", "words"))
def error_rates(spark, sf_dir):
    words = _words(spark, sf_dir)
    kept = words.where("idx % 11 <> 10").withColumn("text", F.when(F.col("idx") % 13 == 12, "qqq").otherwise(F.col("text")))
    spoken = Window.partitionBy("interview_id").orderBy("idx")
    kept = kept.withColumn("idx", F.row_number().over(spoken) - 1)
    references = words.groupBy("interview_id").agg(F.array_join(word_ops.ordered("idx", "text"), " ").alias("reference_text"))
    return scoring.error_rates(kept, references)


#: The whole table of distances, row by row, then back from its end: a diagonal step first, then a deletion.
@query(
    r"""WITH RECURSIVE t AS (SELECT p_partkey AS interview_id, regexp_extract_all(lower(p_type), '[a-z]') AS x, regexp_extract_all(lower(p_name), '[a-z]') AS y FROM part),
grid AS (SELECT interview_id, x, y, 0 AS i, range(0, len(y) + 1) AS d FROM t
  UNION ALL SELECT interview_id, x, y, i + 1, list_reduce(range(1, len(y) + 1),
    lambda row, j: list_append(row, least(d[j] + CASE WHEN x[i + 1] = y[j] THEN 0 ELSE 1 END, d[j + 1] + 1, row[-1] + 1)), [i + 1]::BIGINT[]) FROM (
    SELECT interview_id, x, y, i, d FROM grid WHERE i < len(x))),
back AS (SELECT interview_id, x, y, len(x) AS i, len(y) AS j, 0 AS steps, '' AS kind FROM t
  UNION ALL SELECT interview_id, x, y, CASE WHEN k = 'insertion' THEN i ELSE i - 1 END, CASE WHEN k = 'deletion' THEN j ELSE j - 1 END, steps + 1, k FROM (
    SELECT b.*, CASE WHEN b.i > 0 AND b.j > 0 AND here.d[b.j + 1] = above.d[b.j] + CASE WHEN b.x[b.i] = b.y[b.j] THEN 0 ELSE 1 END
      THEN CASE WHEN b.x[b.i] = b.y[b.j] THEN 'match' ELSE 'substitution' END
      WHEN b.i > 0 AND here.d[b.j + 1] = above.d[b.j + 1] + 1 THEN 'deletion' ELSE 'insertion' END AS k
    FROM back b JOIN grid here ON here.interview_id = b.interview_id AND here.i = b.i
    LEFT JOIN grid above ON above.interview_id = b.interview_id AND above.i = b.i - 1 WHERE b.i > 0 OR b.j > 0)),
ops AS (SELECT interview_id, steps, kind, CASE WHEN kind <> 'insertion' THEN CAST(i AS INTEGER) END AS ref_index, CASE WHEN kind <> 'deletion' THEN CAST(j AS INTEGER) END AS hyp_index, x, y FROM back WHERE steps > 0)
SELECT interview_id, CAST(row_number() OVER (PARTITION BY interview_id ORDER BY steps DESC) - 1 AS INTEGER) AS place, kind, ref_index, hyp_index, x[ref_index + 1] AS reference, y[hyp_index + 1] AS token FROM ops"""
)
def edit_operations(spark, sf_dir):
    """Letters of part names as words, held against those of part types: short, with ties and repeats, and of every operation."""
    parts = _table(spark, sf_dir, "part").withColumnRenamed("p_partkey", "interview_id")
    letters = lambda c: F.expr(f"regexp_extract_all(lower({c}), '[a-z]', 0)")
    words = parts.select("interview_id", F.posexplode(letters("p_name")).alias("idx", "text"))
    references = parts.select("interview_id", F.array_join(letters("p_type"), " ").alias("reference_text"))
    return scoring.operations(scoring.scored_words(words), references).drop("idx")


# --- sample arrays --------------------------------------------------------------------------------------------------------


@query(
    """WITH b AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE) * 3.0) AS l FROM embeddings),
p AS (SELECT vec_id, l, list_max(list_transform(l, lambda x: abs(x))) AS m FROM b)
SELECT vec_id, round(64 / 16, 4) AS seconds, round(list_sum(CASE WHEN m > 1 THEN list_transform(l, lambda x: x / m) ELSE l END), 5) AS total, round(list_sum(l[9:24]), 5) AS part FROM p"""
)
def sample_arrays(spark, sf_dir):
    samples = F.transform("embedding", lambda x: x.cast("double"))
    rows = _table(spark, sf_dir, "embeddings").select("vec_id", samples.alias("s"))
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda a, x: a + x)
    cut = audio.slice_audio(F.transform("s", lambda x: x * 3.0), F.lit(16), F.lit(0.5), F.lit(1.5))
    return rows.select(
        "vec_id",
        F.round(audio.duration_of(F.col("s"), F.lit(16)), 4).alias("seconds"),
        F.round(total(audio.apply_boost(F.col("s"), 3.0)), 5).alias("total"),
        F.round(total(cut), 5).alias("part"),
    )


# --- event time -------------------------------------------------------------------------------------------------------------


@query(
    """WITH e AS (SELECT user_id, ts, CASE WHEN ts <= lag(ts) OVER w + INTERVAL 1 HOUR THEN 0 ELSE 1 END AS fresh FROM events WHERE ts IS NOT NULL WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM e)
SELECT user_id AS interview_id, min(ts) AS "start", max(ts) + INTERVAL 1 HOUR AS "end", count(*) AS n_words FROM s GROUP BY user_id, k"""
)
def event_islands(spark, sf_dir):
    events = _table(spark, sf_dir, "events").select(F.col("user_id").alias("interview_id"), "ts")
    return incremental.speech_islands(events, "1 hour")


# --- whole plans --------------------------------------------------------------------------------------------------------------


@query(_sql("""SELECT w.interview_id, count(*) AS words, count(turn_ix) AS assigned, count(*) FILTER (by_proximity) AS by_proximity, max(segment_index) + 1 AS segments, coalesce(any_value(u.speakers), '') AS speakers
FROM marked w LEFT JOIN (SELECT interview_id, string_agg(DISTINCT speaker, ',' ORDER BY speaker) AS speakers FROM turns GROUP BY interview_id) u USING (interview_id) GROUP BY w.interview_id"""))
def fused_recordings(spark, sf_dir):
    """The flagship: clamp, speaker join with fallback, segments, statistics."""
    made = recording.fuse(*_recorded(spark, sf_dir))
    counts = made.words.groupBy("interview_id").agg((F.max("segment_index") + 1).alias("segments"))
    return made.stats.join(counts, "interview_id").select(
        "interview_id",
        F.col("words_total").alias("words"),
        F.col("words_assigned").alias("assigned"),
        F.col("words_assigned_by_proximity").alias("by_proximity"),
        "segments",
        F.array_join("speakers", ",").alias("speakers"),
    )


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
