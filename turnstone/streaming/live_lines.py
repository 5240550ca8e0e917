"""Lines of words as they arrive: the rules of operators.lines with a state for each recording."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from turnstone.functions.text import ends_sentence, is_cjk, join_words, no_space_between
from turnstone.operators.lines import LineLimits
from turnstone.session import ship

_WORD = ("idx", "start", "end", "text", "segment_index", "speaker", "size", "shuts", "wide", "stops")
_IDX, _START, _END, _TEXT, _SEGMENT, _SPEAKER, _SIZE, _SHUTS, _WIDE, _STOPS = range(len(_WORD))


class LinePacker:
    """A recording's words, one after the other, as lines. What is held is the open line, the closed one before it, which a
    sliver may still join, and words that came before others which they follow; it can be written as JSON."""

    def __init__(self, limits: LineLimits, held: str | None = None):
        self.limits = limits
        self.state = json.loads(held) if held else {"next": 0, "line": 0, "speaker": None, "waiting": [], "open": [], "chars": 0, "before": None, "last": None}

    def held(self) -> str:
        return json.dumps(self.state)

    def add(self, words: list[list]) -> list[dict]:
        """The lines that are finished once these words, in any order, have come."""
        s, out = self.state, []
        waiting = sorted([*s["waiting"], *words])
        taken = 0
        while taken < len(waiting) and waiting[taken][_IDX] <= s["next"]:
            word = waiting[taken]
            taken += 1
            if word[_IDX] == s["next"]:  # one that has come before is not taken again
                out += self._take(word)
                s["next"] += 1
        s["waiting"] = waiting[taken:]
        return out

    def end(self) -> list[dict]:
        """All lines that are left; words that wait for others come in their order."""
        out = []
        for word in self.state["waiting"]:
            out += self._take(word)
            self.state["next"] = word[_IDX] + 1
        self.state["waiting"] = []
        return out + self._finish()

    def _take(self, word: list) -> list[dict]:
        s, out, limits = self.state, [], self.limits
        before = s["before"]
        if before is not None and before[_SEGMENT] != word[_SEGMENT]:
            out, before = self._finish(), None
        if before is None:
            s["speaker"] = word[_SPEAKER]
        tight = bool(word[_SHUTS] or before is not None and before[_WIDE])
        if s["open"]:
            first = s["open"][0]
            slow = word[_START] - before[_END] > limits.max_gap or word[_END] - first[_START] > limits.max_duration
            if slow or (before[_STOPS] and s["chars"] >= limits.min_chars_for_sentence_break) or s["chars"] + 1 + word[_SIZE] > limits.max_chars:
                out += self._close()
        if s["open"]:
            s["chars"] += word[_SIZE] + (not tight)
        else:
            s["chars"], s["tight"] = word[_SIZE], tight
        s["open"].append(word)
        s["before"] = word
        return out

    def _close(self) -> list[dict]:
        """The open line joins the one before it, or that one is finished."""
        s, limits = self.state, self.limits
        words, chars, last = s["open"], s["chars"], s["last"]
        start, end = words[0][_START], words[-1][_END]
        s["open"] = []
        fits = last is not None and last["chars"] + chars + 1 <= limits.max_chars and end - last["start"] <= limits.max_duration
        if fits and max(0.0, end - start) < limits.min_duration:
            last["chars"] += chars + (not s["tight"])
            last["end"] = max(last["end"], end)
            last["words"] += words
            return []
        s["last"] = {"start": start, "end": end, "chars": chars, "words": words}
        return self._number(last)

    def _finish(self) -> list[dict]:
        s = self.state
        out = self._close() if s["open"] else []
        out += self._number(s["last"])
        s["last"] = s["before"] = None
        return out

    def _number(self, line: dict | None) -> list[dict]:
        if line is None:
            return []
        s = self.state
        words = [{"idx": w[_IDX], "start": w[_START], "end": w[_END], "text": w[_TEXT]} for w in line["words"]]
        s["line"] += 1
        return [{"line_ix": s["line"] - 1, "segment_index": line["words"][0][_SEGMENT], "start": line["start"], "end": line["end"], "speaker": s["speaker"], "words": words}]


class _LinesProcessor(StatefulProcessor):
    def __init__(self, limits: LineLimits, idle_seconds: float | None):
        self.limits, self.idle = limits, None if idle_seconds is None else int(idle_seconds * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("lines", "held string")

    def _packer(self) -> LinePacker:
        return LinePacker(self.limits, self.state.get()[0] if self.state.exists() else None)

    def _rows(self, key, lines: list[dict]) -> pd.DataFrame:
        return pd.DataFrame([{"interview_id": key[0], **line} for line in lines], columns=["interview_id", "line_ix", "segment_index", "start", "end", "speaker", "words"])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        packer, words, ended = self._packer(), [], False
        for some in rows:
            ended = ended or bool(some["idx"].isna().any())
            some = some[some["idx"].notna()]
            words += [[int(w[0]), float(w[1]), float(w[2]), w[3], int(w[4]), w[5], int(w[6]), *map(bool, w[7:])] for w in some[list(_WORD)].itertuples(index=False)]
        lines = packer.add(words)
        if ended:
            lines += packer.end()
        if self.idle is not None:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            if not ended:
                self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.idle)
        self.state.update((packer.held(),))
        yield self._rows(key, lines)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        packer = self._packer()
        lines = packer.end()
        self.state.update((packer.held(),))
        yield self._rows(key, lines)

    def close(self) -> None:
        pass


def live_lines(words: DataFrame, limits: LineLimits = LineLimits(), idle_seconds: float | None = None) -> DataFrame:
    """A stream of words (interview_id, segment_index, idx, start, end, text, speaker) as a stream of lines, the same as
    `lines.pack_lines` gives of all words together: interview_id, line_ix, segment_index, start, end, text, speaker, words.

    idx counts a recording's words from 0 without gaps; they may come in any order and in any cut into batches, and one that comes
    again is taken once. A line is given once it can't change any more. The last ones are given when a row without
    idx says that the recording has ended, or, if idle_seconds are given, when none of its words has come for as long; with
    them the stream goes on by itself, so a trigger that takes what there is does not end. State is kept by recording
    (two lines, and words that came too early), in the state store of the session, which must hold several columns
    (RocksDB): a restart from the checkpoint goes on where the stream was."""
    key = words.schema["interview_id"].dataType.simpleString()
    text = F.col("text")
    shuts = (text == "") | F.coalesce(no_space_between(F.lit("a"), text), F.lit(False))
    wide = F.coalesce(is_cjk(F.right(text, F.lit(1))), F.lit(False))
    sent = words.select("interview_id", "idx", "start", "end", "text", "segment_index", "speaker", F.length("text").alias("size"), shuts.alias("shuts"), wide.alias("wide"), ends_sentence(text).alias("stops"))
    ship(words.sparkSession)
    made = sent.groupBy("interview_id").transformWithStateInPandas(
        _LinesProcessor(limits, idle_seconds),
        f"interview_id {key}, line_ix long, segment_index int, start double, end double, speaker string, words array<struct<idx:int,start:double,end:double,text:string>>",
        "append",
        "none" if idle_seconds is None else "processingTime",
    )
    return made.select("interview_id", "line_ix", "segment_index", "start", "end", join_words(F.transform("words", lambda w: w["text"])).alias("text"), "speaker", "words")
