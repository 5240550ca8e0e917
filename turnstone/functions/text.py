"""Text functions: tokens of mixed scripts, joining, names, stamps. All are expressions of built-in functions, but
for the two that need Unicode normal forms, which Spark lacks."""

from __future__ import annotations

import unicodedata
from collections.abc import Mapping

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Scripts written without spaces (kana, ideographs, Hangul), as ranges of a regular expression.
CJK = r"\x{3040}-\x{30FF}\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{F900}-\x{FAFF}\x{AC00}-\x{D7AF}\x{20000}-\x{2FA1F}"
# Characters that end a sentence.
SENTENCE_ENDERS = (".", "!", "?", "…", "。", "！", "？", "；", ";")
# Audio and video suffixes of a source file's name.
MEDIA_NAME = r"/([^/]+\.(?:mp4|mp3|m4a|wav))(?:/|$)"

#: Characters that no text holds, used between words while they are put together.
_OPEN, _SHUT = "﷐", "﷑"


def is_cjk(char: Column) -> Column:
    return F.rlike(char, F.lit(f"^[{CJK}]"))


def split_words(text: Column) -> Column:
    """Units that can carry a time: blank-separated words; each CJK character alone. Punctuation at the start of a
    later chunk, or after a CJK character, stays with the unit before it."""
    flat = F.trim(F.regexp_replace(text, r"(?U)[\s\x1c-\x1f]+", " "))
    glued = F.regexp_replace(flat, r" (\p{P}+)", f"{_OPEN}$1{_SHUT}")
    glued = F.regexp_replace(F.regexp_replace(glued, f"{_SHUT}?{_OPEN}", ""), _SHUT, " ")
    return F.regexp_extract_all(glued, F.lit(rf"([{CJK}]\p{{P}}*|[^ {CJK}]+)"), F.lit(1))


def no_space_between(left: Column, right: Column) -> Column:
    """Whether a word follows another without a space: next to CJK, or before closing punctuation."""
    closing = F.rlike(right, F.lit(r"^\p{P}")) & ~F.substring(right, 1, 1).isin("(", "[", "{", '"', "'")
    return F.rlike(left, F.lit(f"[{CJK}]$")) | is_cjk(right) | closing


def join_words(words: Column) -> Column:
    """An array of words as running text. Empty and null words are left out."""
    joined = F.array_join(F.filter(words, lambda w: w != ""), _OPEN)
    tight = rf"(?<=[{CJK}]){_OPEN}|{_OPEN}(?=[{CJK}])|{_OPEN}(?=\p{{P}})(?![(\[{{\"'])"
    return F.regexp_replace(F.regexp_replace(joined, tight, ""), _OPEN, " ")


def ends_sentence(word: Column) -> Column:
    return F.coalesce(F.right(word, F.lit(1)).isin(*SENTENCE_ENDERS), F.lit(False))


@F.pandas_udf(T.StringType())
def normalize_for_scoring(words: pd.Series) -> pd.Series:
    """NFKC, without punctuation but inner apostrophes, case folded."""

    def clean(word: str | None) -> str | None:
        if word is None:
            return None
        kept = (c for c in unicodedata.normalize("NFKC", word) if c == "'" or unicodedata.category(c)[0] != "P")
        return "".join(kept).strip("'").casefold()

    known: dict[str | None, str | None] = {w: clean(w) for w in words.unique()}
    return words.map(known)


@F.pandas_udf(T.StringType())
def normalize_for_alignment(words: pd.Series) -> pd.Series:
    """NFKC, case folded, letters, digits and apostrophes only."""

    def clean(word: str | None) -> str | None:
        return None if word is None else "".join(c for c in unicodedata.normalize("NFKC", word).casefold() if c.isalnum() or c == "'")

    return words.map(clean)


def slug(value: Column) -> Column:
    """A name that is safe in a file system, at most 180 characters."""
    return F.substring(F.regexp_replace(value, r"[^\p{L}\p{N}\-_.]", "_"), 1, 180)


def folder_name(value: Column) -> Column:
    """12_345-x and 12_345 name the folder 12_345; other values name themselves."""
    both = F.regexp_extract(value, r"^([0-9]+_[0-9]+)", 1)
    return F.when(both != "", both).otherwise(value)


def filename_from_url(url: Column, name: Column) -> Column:
    """The media file that a URL names, or else one made from the entry's name."""
    found = F.regexp_extract(url, MEDIA_NAME, 1)
    return F.when(found != "", found).otherwise(F.concat(slug(name), F.lit(".mp4")))


def stream_filename(url: Column, name: Column) -> Column:
    """The older rule: only the video of an HLS playlist counts, and the name is taken as it is."""
    found = F.regexp_extract(url, r"/([^/]+\.mp4)/index\.m3u8", 1)
    return F.when(found != "", found).otherwise(F.concat(name, F.lit(".mp4")))


def is_stream(url: Column) -> Column:
    return F.endswith(url, F.lit(".m3u8")) | F.endswith(url, F.lit(".mpd")) | F.contains(url, F.lit("/index.m3u8"))


def escape(text: Column) -> Column:
    """Markup characters as references; & first."""
    for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(raw), F.lit(safe))
    return text


def stamp(seconds: Column, decimal: str = ".") -> Column:
    """HH:MM:SS.mmm, never negative, milliseconds rounded half to even."""
    millis = F.rint(F.greatest(seconds.cast("double"), F.lit(0.0)) * 1000).cast("long")
    part = lambda unit, size: F.lpad((F.floor(millis / unit) % size).cast("string"), 2, "0")
    hours = F.floor(millis / 3_600_000)
    shown = F.when(hours > 99, hours.cast("string")).otherwise(F.lpad(hours.cast("string"), 2, "0"))
    return F.concat(shown, F.lit(":"), part(60_000, 60), F.lit(":"), part(1000, 60), F.lit(decimal), F.lpad((millis % 1000).cast("string"), 3, "0"))


def basename(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)/*$", 1)


def stem(path: Column) -> Column:
    """The last part of a path without its last suffix; ids with a dot lose what follows it, too."""
    return F.regexp_replace(basename(path), r"(?<=.)\.[^.]*$", "")


def published_url(base: str, kind: str, name: Column, suffix: str) -> Column:
    return F.concat(F.lit(f"{base.rstrip('/')}/{kind}/"), name, F.lit(suffix))


def fill_template(template: Column, values: Mapping[str, Column | str]) -> Column:
    """{NAME} placeholders replaced, each by its value."""
    for name, value in values.items():
        template = F.replace(template, F.lit("{" + name + "}"), value if isinstance(value, Column) else F.lit(value))
    return template
