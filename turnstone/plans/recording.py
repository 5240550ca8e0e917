"""From words and turns to everything that is published of a recording."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from turnstone.operators import fusion, lines, render, words as word_ops
from turnstone.session import materialize


@dataclass(frozen=True)
class Recording:
    """The tables of fused recordings."""

    words: DataFrame
    segments: DataFrame
    lines: DataFrame
    stats: DataFrame

    def vtt(self, max_lines: int = 2, highlight: bool = False, show_speaker: bool = True) -> DataFrame:
        numbered = lines.number_cues(self.lines, max_lines)
        made = render.highlighted(numbered, show_speaker) if highlight else render.cues(numbered, show_speaker)
        return render.to_vtt(made)

    def srt(self, max_lines: int = 2) -> DataFrame:
        return render.to_srt(render.cues(lines.number_cues(self.lines, max_lines)))

    def json(self, language: str = "en") -> DataFrame:
        return render.to_json(render.nested_segments(self.words, self.segments), language)


def fuse(words: DataFrame, turns: DataFrame, durations: DataFrame | None = None, limits: lines.LineLimits = lines.LineLimits()) -> Recording:
    """Clamp, assign speakers, segment, pack lines. words: interview_id, idx, text, start, end, confidence, source.

    Words with their speakers are stored once, since all four tables read them; the rest is lazy. Words and turns are read
    twice: give stored tables where they are dear to make."""
    clamped = word_ops.clamp_words(words, durations)
    marked = fusion.mark_segments(materialize(fusion.assign_speakers(clamped, turns), "assigned"))
    return Recording(marked, fusion.segments(marked), lines.build_lines(marked, None, limits), fusion.fusion_stats(marked, turns))
