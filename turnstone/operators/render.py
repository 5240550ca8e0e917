"""Renderers: WebVTT, SubRip and JSON, one text a recording."""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnstone.functions.text import escape, stamp
from turnstone.session import ship


def _voice(show_speaker: bool) -> Column:
    named = F.coalesce("speaker", F.lit("")) != ""
    return F.when(named & F.lit(show_speaker), F.concat(F.lit("<v "), F.col("speaker"), F.lit(">"))).otherwise("")


def cues(numbered: DataFrame, show_speaker: bool = True) -> DataFrame:
    """Lines with cue_ix as cues: interview_id, cue_ix, segment_index, start, end, speaker, body."""
    body = F.array_join(_in_order(escape(F.col("text")), "line_ix"), "\n")
    made = numbered.groupBy("interview_id", "cue_ix").agg(
        F.min("segment_index").alias("segment_index"),
        F.min_by("start", "line_ix").alias("start"),
        F.max_by("end", "line_ix").alias("end"),
        F.min_by("speaker", "line_ix").alias("speaker"),
        body.alias("body"),
    )
    return made.withColumn("body", F.concat(_voice(show_speaker), "body"))


def highlighted(numbered: DataFrame, show_speaker: bool = True) -> DataFrame:
    """Cues of one word each: the words of a cue, that one underlined. Lines carry their words; a cue without words
    stays whole. Same columns as cues, and word_ix. Lines are grouped once, and texts escaped once."""
    grouped = numbered.groupBy("interview_id", "cue_ix").agg(
        F.array_sort(F.collect_list(F.struct("line_ix", "start", "end", "speaker", escape(F.col("text")).alias("text"), "words"))).alias("lines"),
        F.min("segment_index").alias("segment_index"),
    )
    made = grouped.select("interview_id", "cue_ix", "segment_index", "lines", F.get("lines", F.lit(0))["speaker"].alias("speaker"), F.flatten(F.col("lines")["words"]).alias("words"))
    made = made.withColumn("texts", F.transform("words", lambda w: escape(w["text"])))
    made = made.select("*", F.posexplode_outer("words").alias("word_ix", "word"))
    at, texts = F.col("word_ix"), F.col("texts")
    rest = F.slice(texts, at + 2, F.greatest(F.size(texts) - at - 1, F.lit(0)))
    marked = F.concat_ws(" ", F.slice(texts, 1, at), F.concat(F.lit("<u>"), F.get(texts, at), F.lit("</u>")), rest)
    bare = at.isNull()
    first, last = F.get("lines", F.lit(0)), F.element_at("lines", -1)
    return made.select(
        "interview_id", "cue_ix", "segment_index",
        F.when(bare, first["start"]).otherwise(F.col("word.start")).alias("start"),
        F.when(bare, last["end"]).otherwise(F.col("word.end")).alias("end"),
        "speaker",
        F.concat(_voice(show_speaker), F.when(bare, F.array_join(F.col("lines")["text"], "\n")).otherwise(marked)).alias("body"),
        F.coalesce(at, F.lit(0)).alias("word_ix"),
    )


def _times(decimal: str = ".") -> Column:
    return F.concat(stamp(F.col("start"), decimal), F.lit(" --> "), stamp(F.col("end"), decimal))


def _in_order(block: Column, *order: str) -> Column:
    return F.array_sort(F.collect_list(F.struct(*order, block.alias("__block"))))["__block"]


def to_vtt(made: DataFrame) -> DataFrame:
    """interview_id and its cues (also highlighted ones) as WebVTT."""
    order = ["cue_ix", *(["word_ix"] if "word_ix" in made.columns else [])]
    block = F.concat(_times(), F.lit("\n"), "body", F.lit("\n"))
    text = F.concat(F.lit("WEBVTT\n\n"), F.array_join(_in_order(block, *order), "\n"))
    return made.groupBy("interview_id").agg(text.alias("vtt"))


def to_srt(made: DataFrame) -> DataFrame:
    """interview_id and its cues as SubRip."""
    block = F.concat((F.col("cue_ix") + 1).cast("string"), F.lit("\n"), _times(","), F.lit("\n"), "body", F.lit("\n"))
    return made.groupBy("interview_id").agg(F.array_join(_in_order(block, "cue_ix"), "\n").alias("srt"))


def nested_segments(words: DataFrame, segments: DataFrame) -> DataFrame:
    """interview_id and segments, an array in order, each with its words in order."""
    have = [c for c in ("text", "start", "end", "confidence", "source", "speaker", "status", "reference", "segment_index") if c in words.columns]
    inner = words.groupBy("interview_id", "segment_index").agg(F.array_sort(F.collect_list(F.struct("idx", *[c for c in have if c != "segment_index"]))).alias("words"))
    both = segments.join(inner, ["interview_id", "segment_index"], "left")
    return both.groupBy("interview_id").agg(F.array_sort(F.collect_list(F.struct("segment_index", "start", "end", "text", "speaker", "words"))).alias("segments"))


def _maybe(value: float | None, digits: int) -> float | None:
    return None if value is None or math.isnan(value) else round(float(value), digits)


def _word_entry(word: dict) -> dict:
    entry = {"word": word["text"], "start": round(word["start"], 3), "end": round(word["end"], 3), "score": _maybe(word.get("confidence"), 4)}
    if word.get("speaker"):
        entry["speaker"] = word["speaker"]
    entry["source"] = word.get("source")
    if word.get("status") is not None:
        entry["status"] = word["status"]
    return entry


def _dumps(value: object, pad: str = "\n") -> str:
    """A value as JSON inside a larger one; pad: a new line and the blanks before the value. No string holds a line's end as it is."""
    return json.dumps(value, indent=2, ensure_ascii=False).replace("\n", pad)


def _listed(parts: list[str]) -> str:
    """A top-level list of values that are texts already, made with pad ENTRY."""
    return "[" + ENTRY + f",{ENTRY}".join(parts) + "\n  ]" if parts else "[]"


ENTRY = "\n    "


def document(segments: Iterable[dict], language: str, extras: dict | None = None) -> str:
    """A recording's JSON. A score is there even if null, a speaker only where there is one, a status only where
    words were scored; times have 3 digits, scores 4, rounded as Python rounds."""
    parts = []
    for s in segments:
        entry = {"start": round(s["start"], 3), "end": round(s["end"], 3), "text": s["text"], "words": [_word_entry(w) for w in s["words"] or [] if w]}
        if s["speaker"]:
            entry["speaker"] = s["speaker"]
        parts.append(_dumps(entry, ENTRY))
    facts = {"language": language} | (extras or {})
    whole = {k: _dumps(v, "\n  ") for k, v in ({"segments": None} | facts).items()}
    if "segments" not in facts:
        whole["segments"] = _listed(parts)
    return "{\n  " + ",\n  ".join([f"{_dumps(k)}: {v}" for k, v in whole.items()]) + "\n}"


def full_document(row: dict) -> str:
    """A recording's whole record as JSON: its text, facts, segments with confidences and words, and lines. Here an
    unknown confidence or speaker is null, and a word's status and reference come together. row: audio_path, duration,
    segments and lines, which are gone through once."""
    known = lambda scores: [x for x in scores if x is not None and not math.isnan(x)]
    mean = lambda scores: _maybe(sum(scores) / len(scores), 4) if scores else None
    span = lambda x: {"start": round(x["start"], 3), "end": round(x["end"], 3)}

    def word(w: dict, segment: int) -> dict:
        entry = {"word": w["text"], **span(w), "confidence": _maybe(w.get("confidence"), 4), "source": w.get("source"), "speaker": w.get("speaker"), "segment_index": segment}
        return entry | ({"status": w["status"], "reference": w.get("reference")} if w.get("status") is not None else {})

    of: dict[int, float | None] = {}
    texts, segments = [], []
    for s in row["segments"]:
        words = s["words"] or []
        of |= {w["idx"]: w.get("confidence") for w in words}
        texts += [s["text"]] if s["text"] else []
        mine = mean(known(w.get("confidence") for w in words))
        entry = {"index": s["segment_index"], **span(s), "speaker": s["speaker"], "text": s["text"], "confidence": mine, "words": [word(w, s["segment_index"]) for w in words]}
        segments.append(_dumps(entry, ENTRY))
    lines = [
        _dumps({"index": x["line_ix"], **span(x), "speaker": x["speaker"], "segment_index": x["segment_index"], "text": x["text"], "confidence": mean(known(of[k] for k in x["idx"]))}, ENTRY)
        for x in row["lines"] or []
    ]
    facts = {"audio_path": row.get("audio_path"), "duration": _maybe(row.get("duration"), 3), "text": " ".join(texts)}
    whole = {k: _dumps(v) for k, v in facts.items()} | {"segments": _listed(segments), "lines": _listed(lines)}
    return "{\n  " + ",\n  ".join([f"{_dumps(k)}: {v}" for k, v in whole.items()]) + "\n}"


#: Texts of recordings leave a worker once they have so many characters together.
SENT_CHARS = 1 << 22


def _items(value: pa.Scalar) -> Iterator[dict | None]:
    """The entries of a list of structs; lists within an entry become Python values only when its turn comes."""
    if not value.is_valid:
        return
    within = lambda column: ([*_items(x)] if x.is_valid else None for x in column)
    deep = lambda kind: pa.types.is_list(kind) and pa.types.is_struct(kind.value_type)
    held = value.values
    whole = lambda c: not c.null_count and pa.types.is_primitive(c.type) or pa.types.is_string(c.type)
    names = [f.name for f in held.type]
    plain = lambda c: c.to_numpy(zero_copy_only=False).tolist() if whole(c) else c.to_pylist()
    columns = [within(c) if deep(c.type) else plain(c) for c in held.flatten()]
    entries = (dict(zip(names, entry, strict=True)) for entry in zip(*columns, strict=True))
    yield from entries if not held.null_count else (e if there else None for e, there in zip(entries, held.is_valid().to_pylist(), strict=True))


def _render(rows: DataFrame, write: Callable[[dict[str, pa.Scalar]], str]) -> DataFrame:
    """interview_id and json, a recording's text from its row. Spark bounds a batch in bytes; of what is in it one
    recording at a time becomes Python values, its words by segments, since those take many times its size."""

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            begin = size = 0
            texts: list[str] = []
            for k in range(batch.num_rows):
                texts.append(write({name: batch.column(i)[k] for i, name in enumerate(batch.schema.names)}))
                size += len(texts[-1])
                if size >= SENT_CHARS or k + 1 == batch.num_rows:
                    ids = batch.column(batch.schema.names.index("interview_id")).slice(begin, len(texts))
                    yield pa.RecordBatch.from_arrays([ids, pa.array(texts, pa.string())], ["interview_id", "json"])
                    begin, size, texts = k + 1, 0, []

    ship(rows.sparkSession)
    return rows.mapInArrow(render, f"interview_id {rows.schema['interview_id'].dataType.simpleString()}, json string")


def to_full_json(nested: DataFrame, lines: DataFrame, interviews: DataFrame) -> DataFrame:
    """interview_id and json of whole records. interviews: interview_id, audio_path, duration; lines carry words."""
    packed = F.struct("line_ix", "segment_index", "start", "end", "text", "speaker", F.transform("words", lambda w: w["idx"]).alias("idx"))
    rows = nested.join(lines.groupBy("interview_id").agg(F.array_sort(F.collect_list(packed)).alias("lines")), "interview_id", "left")
    rows = rows.join(interviews.select("interview_id", "audio_path", "duration"), "interview_id", "left")

    def write(row: dict[str, pa.Scalar]) -> str:
        return full_document({"audio_path": row["audio_path"].as_py(), "duration": row["duration"].as_py(), "segments": _items(row["segments"]), "lines": _items(row["lines"])})

    return _render(rows.select("interview_id", "audio_path", "duration", "segments", "lines"), write)


def to_json(nested: DataFrame, language: str = "en", extras: str | None = None) -> DataFrame:
    """interview_id and json, from segments (see nested_segments); extras: a column with more top-level entries, as
    JSON. Exact null and rounding rules need Python."""

    def write(row: dict[str, pa.Scalar]) -> str:
        more = row[extras].as_py() if extras else None
        return document(_items(row["segments"]), language, json.loads(more) if more else None)

    return _render(nested.select("interview_id", "segments", *([extras] if extras else [])), write)
