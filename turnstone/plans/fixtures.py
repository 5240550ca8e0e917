"""Timed words and speaker turns derived from plain conversations, the same in every run."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from turnstone.session import spread


def timed_words(conversations: DataFrame) -> DataFrame:
    """Words with times from their lengths: interview_id, idx, turn, role, text, start, end, confidence, source."""
    dealt = spread(conversations.select("conv_id", "turn", "role", "text"), "conv_id")  # turns, before they are many times as many words
    tokens = dealt.select("conv_id", "turn", "role", F.posexplode(F.split("text", "[ \n]+")).alias("pos", "w")).where("w <> ''")
    length = 120 + 40 * F.least(F.length("w"), F.lit(17))
    gap = F.when((F.col("conv_id") * 7 + F.col("turn") * 13 + F.col("pos") * 5) % 11 == 0, 1400).otherwise(40)
    tokens = tokens.withColumn("dur", length.cast("long")).withColumn("gap", gap.cast("long"))
    order = Window.partitionBy("conv_id").orderBy("turn", "pos")
    ends = F.sum(F.col("dur") + F.col("gap")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    placed = tokens.withColumn("idx", (F.row_number().over(order) - 1).cast("int")).withColumn("at", ends)
    score = ((F.col("conv_id") * 31 + F.col("turn") * 17 + F.col("pos") * 7) % 1000) / 1000.0
    return placed.select(
        F.col("conv_id").alias("interview_id"),
        "idx",
        "turn",
        "role",
        F.col("w").alias("text"),
        ((F.col("at") - F.col("dur")) / 1000.0).alias("start"),
        (F.col("at") / 1000.0).alias("end"),
        F.when((F.col("conv_id") + F.col("pos")) % 97 != 0, score).alias("confidence"),
        F.when((F.col("conv_id") + F.col("idx")) % 5 == 0, "interpolated").otherwise("measured").alias("source"),
    )


def speaker_turns(words: DataFrame) -> DataFrame:
    """Turns around each turn's words, with shifted ends: interview_id, turn_ix, start, end, speaker."""
    speaker = F.when(F.col("role") == "user", "S01").when(F.col("role") == "assistant", "S02").otherwise("S03")
    spans = words.groupBy("interview_id", "turn", "role").agg(F.min("start").alias("lo"), F.max("end").alias("hi"))
    start = F.round(F.greatest(F.lit(0.0), F.col("lo") + ((F.col("turn") * 37) % 9 - 4) * 0.3), 3)
    end = F.round(F.col("hi") - ((F.col("turn") * 53) % 7 - 2) * 0.4, 3)
    turns = spans.select("interview_id", F.col("turn").cast("int").alias("turn_ix"), start.alias("start"), end.alias("end"), speaker.alias("speaker"))
    return turns.where(F.col("end") > F.col("start"))


WORDS_SQL = """
toks AS (SELECT conv_id, turn, role, pos - 1 AS pos, w FROM (
  SELECT conv_id, turn, role, unnest(range(1, len(l) + 1)) AS pos, unnest(l) AS w FROM (
    SELECT conv_id, turn, role, string_split_regex(text, '[ \\n]+') AS l FROM conversations)) WHERE w <> ''),
meas AS (SELECT *, 120 + 40 * least(length(w), 17) AS dur, CASE WHEN (conv_id * 7 + turn * 13 + pos * 5) % 11 = 0 THEN 1400 ELSE 40 END AS gap FROM toks),
run AS (SELECT *, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn, pos) - 1 AS INTEGER) AS idx,
  CAST(sum(dur + gap) OVER (PARTITION BY conv_id ORDER BY turn, pos ROWS UNBOUNDED PRECEDING) AS BIGINT) AS pt FROM meas),
words AS (SELECT conv_id AS interview_id, idx, turn, role, w AS text, CAST(pt - dur AS DOUBLE) / 1000.0 AS "start", CAST(pt AS DOUBLE) / 1000.0 AS "end",
  CASE WHEN (conv_id + pos) % 97 <> 0 THEN CAST((conv_id * 31 + turn * 17 + pos * 7) % 1000 AS DOUBLE) / 1000.0 END AS confidence,
  CASE WHEN (conv_id + idx) % 5 = 0 THEN 'interpolated' ELSE 'measured' END AS source FROM run)"""

TURNS_SQL = """
spans AS (SELECT interview_id, turn, role, min("start") AS lo, max("end") AS hi FROM words GROUP BY interview_id, turn, role),
turns AS (SELECT * FROM (SELECT interview_id, CAST(turn AS INTEGER) AS turn_ix,
  round(greatest(0.0, lo + CAST((turn * 37) % 9 - 4 AS DOUBLE) * 0.3), 3) AS "start", round(hi - CAST((turn * 53) % 7 - 2 AS DOUBLE) * 0.4, 3) AS "end",
  CASE role WHEN 'user' THEN 'S01' WHEN 'assistant' THEN 'S02' ELSE 'S03' END AS speaker FROM spans) WHERE "end" > "start")"""

#: The textbook form of the speaker join: all turns of a recording for each word.
FUSE_SQL = """
ranked AS (SELECT *, row_number() OVER (PARTITION BY interview_id ORDER BY "start", "end", turn_ix) - 1 AS rank, count(*) OVER (PARTITION BY interview_id) AS n FROM turns),
pairs AS (SELECT w.interview_id, w.idx, t.rank, t.n, least(w."end", t."end") - greatest(w."start", t."start") AS overlap,
  greatest(0.0, t."start" - w."end", w."start" - t."end") AS away, t."end" >= w."start" AS ahead FROM words w JOIN ranked t USING (interview_id)),
best AS (SELECT interview_id, idx, rank, overlap FROM (SELECT *, row_number() OVER (PARTITION BY interview_id, idx ORDER BY overlap DESC, rank) AS r FROM pairs WHERE overlap > 0) WHERE r = 1),
cur AS (SELECT interview_id, idx, coalesce(min(CASE WHEN ahead THEN rank END), max(n)) AS c FROM pairs GROUP BY interview_id, idx),
near AS (SELECT interview_id, idx, rank FROM (
  SELECT p.*, row_number() OVER (PARTITION BY interview_id, idx ORDER BY away, rank) AS r FROM pairs p JOIN cur USING (interview_id, idx)
  WHERE rank BETWEEN c - 1 AND c + 1 AND (interview_id, idx) NOT IN (SELECT (interview_id, idx) FROM best)) WHERE r = 1 AND away <= 1.0),
fused AS (SELECT w.*, t.turn_ix, t.speaker, CASE WHEN b.rank IS NOT NULL THEN b.overlap WHEN q.rank IS NOT NULL THEN 0.0 END AS overlap, b.rank IS NULL AND q.rank IS NOT NULL AS by_proximity
  FROM words w LEFT JOIN best b USING (interview_id, idx) LEFT JOIN near q USING (interview_id, idx)
  LEFT JOIN ranked t ON t.interview_id = w.interview_id AND t.rank = coalesce(b.rank, q.rank)),
marked AS (SELECT *, CAST(sum(CASE WHEN fresh THEN 1 ELSE 0 END) OVER (PARTITION BY interview_id ORDER BY idx ROWS UNBOUNDED PRECEDING) - 1 AS INTEGER) AS segment_index FROM (
  SELECT *, idx = 0 OR turn_ix IS DISTINCT FROM lag(turn_ix) OVER (PARTITION BY interview_id ORDER BY idx) AS fresh FROM fused)),
glue AS (SELECT *, CASE WHEN regexp_matches(text, '^\\pP') AND text[1] NOT IN ('(', '[', '{', '"', '''') THEN '' ELSE ' ' END AS lead FROM marked),
segs AS (SELECT interview_id, segment_index, min_by("start", idx) AS "start", max_by("end", idx) AS "end",
  substr(string_agg(CASE WHEN r = 1 THEN '#' ELSE lead END || text, '' ORDER BY idx), 2) AS text, min_by(speaker, idx) AS speaker, count(*) AS n_words FROM (
    SELECT *, row_number() OVER (PARTITION BY interview_id, segment_index ORDER BY idx) AS r FROM glue) GROUP BY interview_id, segment_index)"""

#: Lines as a recursion over the words of each segment, then over its lines.
LINES_SQL = """
ord AS (SELECT interview_id, segment_index, idx, "start", "end", text, lead, CASE WHEN lead = '' THEN 0 ELSE 1 END AS sp, length(text) AS len,
  right(text, 1) IN ('.', '!', '?', '…', ';') AS stops, row_number() OVER (PARTITION BY interview_id, segment_index ORDER BY idx) AS r FROM glue),
pack AS (SELECT interview_id, segment_index, r, 0 AS line, "start" AS ls, "end" AS pe, len AS chars, stops FROM ord WHERE r = 1
  UNION ALL SELECT interview_id, segment_index, r, CASE WHEN brk THEN line + 1 ELSE line END, CASE WHEN brk THEN "start" ELSE ls END, "end",
    CASE WHEN brk THEN len ELSE chars + sp + len END, now FROM (
    SELECT o.interview_id, o.segment_index, o.r, p.line, p.ls, o."start", o."end", o.len, o.sp, p.chars, o.stops AS now,
      o."start" - p.pe > 0.8 OR o."end" - p.ls > 7.0 OR p.chars + 1 + o.len > 42 OR (p.stops AND p.chars >= 12) AS brk
    FROM pack p JOIN ord o ON o.interview_id = p.interview_id AND o.segment_index = p.segment_index AND o.r = p.r + 1)),
raw AS (SELECT interview_id, segment_index, line, min("start") AS "start", max_by("end", r) AS "end", max_by(chars, r) AS chars, min_by(sp, r) AS sp
  FROM pack JOIN ord USING (interview_id, segment_index, r) GROUP BY interview_id, segment_index, line),
fold AS (SELECT interview_id, segment_index, line, 0 AS dest, "start" AS ls, chars AS held FROM raw WHERE line = 0
  UNION ALL SELECT interview_id, segment_index, line, CASE WHEN j THEN dest ELSE dest + 1 END, CASE WHEN j THEN ls ELSE "start" END, CASE WHEN j THEN held + sp + chars ELSE chars END FROM (
    SELECT x.interview_id, x.segment_index, x.line, f.dest, f.ls, f.held, x."start", x.chars, x.sp,
      greatest(x."end" - x."start", 0) < 0.25 AND f.held + x.chars + 1 <= 42 AND x."end" - f.ls <= 7.0 AS j
    FROM fold f JOIN raw x ON x.interview_id = f.interview_id AND x.segment_index = f.segment_index AND x.line = f.line + 1)),
lined AS (SELECT o.*, f.dest, x."end" AS line_end, row_number() OVER (PARTITION BY o.interview_id, o.segment_index, f.dest ORDER BY o.idx) AS k
  FROM ord o JOIN pack p USING (interview_id, segment_index, r) JOIN fold f ON f.interview_id = o.interview_id AND f.segment_index = o.segment_index AND f.line = p.line
  JOIN raw x ON x.interview_id = o.interview_id AND x.segment_index = o.segment_index AND x.line = p.line),
lines AS (SELECT interview_id, CAST(row_number() OVER (PARTITION BY interview_id ORDER BY segment_index, dest) - 1 AS INTEGER) AS line_ix, segment_index, "start", "end", text, speaker FROM (
  SELECT l.interview_id, l.segment_index, l.dest, min(l."start") AS "start", max(l.line_end) AS "end", substr(string_agg(CASE WHEN k = 1 THEN '#' ELSE l.lead END || l.text, '' ORDER BY l.idx), 2) AS text,
    any_value(s.speaker) AS speaker FROM lined l JOIN segs s USING (interview_id, segment_index) GROUP BY l.interview_id, l.segment_index, l.dest)),
cued AS (SELECT *, CAST(dense_rank() OVER (PARTITION BY interview_id ORDER BY segment_index, part) - 1 AS INTEGER) AS cue_ix FROM (
  SELECT *, (row_number() OVER (PARTITION BY interview_id, segment_index ORDER BY line_ix) - 1) // 2 AS part FROM lines))"""


def with_sql(*parts: str, body: str) -> str:
    """The parts as common tables before the body; a body that starts with a comma adds its own."""
    return "WITH RECURSIVE " + ",".join(parts) + "\n" + body
