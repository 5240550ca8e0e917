"""Recordings that are given as playlists (HLS, DASH): which pieces they have, and the pieces put together."""

from __future__ import annotations

import math
import os
import re
import shutil
import uuid
import xml.etree.ElementTree as ET
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path
from urllib.parse import urljoin, urlsplit
from urllib.request import Request, urlopen

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstone.session import ship

SECONDS = 600
_ATTRIBUTE = re.compile(r'([A-Z0-9-]+)=("[^"]*"|[^,]*)')
_VIDEO = re.compile(r"avc|hvc|hev|vp0?[89]|av01|mp4v", re.I)
#: Lists that name lists, one in the other, at most.
DEPTH = 4


@dataclass(frozen=True)
class Piece:
    """A piece of a recording: length None is up to its end."""

    url: str
    offset: int = 0
    length: int | None = None


def is_playlist(url: str) -> bool:
    path = urlsplit(url).path
    return path.endswith((".m3u8", ".mpd"))


def open_piece(piece: Piece):
    """A stream of a piece's bytes; the parts of a file and of a server that knows ranges are asked for, others skipped to."""
    whole = piece.offset == 0 and piece.length is None
    headers = {} if whole else {"Range": f"bytes={piece.offset}-" + ("" if piece.length is None else str(piece.offset + piece.length - 1))}
    source = urlopen(Request(piece.url, headers=headers), timeout=SECONDS)  # noqa: S310
    if not whole and getattr(source, "status", None) != 206:
        left = piece.offset
        while left > 0 and (skipped := source.read(min(left, 1 << 20))):
            left -= len(skipped)
    return source


def copy_piece(piece: Piece, out) -> int:
    """Bytes copied; fewer than a range asks for are an error."""
    with open_piece(piece) as source:
        if piece.length is None:
            begin = out.tell()
            shutil.copyfileobj(source, out)
            return out.tell() - begin
        left = piece.length
        while left and (data := source.read(min(left, 1 << 20))):
            out.write(data)
            left -= len(data)
        if left:
            raise ValueError(f"{left} bytes are missing: {piece.url}")
        return piece.length


def _attributes(line: str) -> dict[str, str]:
    return {k: v.strip('"') for k, v in _ATTRIBUTE.findall(line.partition(":")[2])}


def _range(text: str, after: int) -> tuple[int, int]:
    """Offset and length of n[@o]; without an offset it begins after what came before."""
    length, _, offset = text.partition("@")
    return int(offset) if offset else after, int(length)


def hls_variant(lines: list[str], url: str) -> str | None:
    """Of a list of variants the audio: a rendition of its own, the default one first; or else a variant without video, or
    else any, of the highest bandwidth. None: the list is one of pieces."""
    variants, audio = [], []
    for k, line in enumerate(lines):
        if line.startswith("#EXT-X-MEDIA:"):
            found = _attributes(line)
            if found.get("TYPE") == "AUDIO" and found.get("URI"):
                audio.append((found.get("DEFAULT") == "YES", found["URI"]))
        elif line.startswith("#EXT-X-STREAM-INF:"):
            found = _attributes(line)
            uri = next((x for x in lines[k + 1 :] if x and not x.startswith("#")), None)
            if uri:
                plain = "RESOLUTION" not in found and not _VIDEO.search(found.get("CODECS", ""))
                variants.append((plain, int(found.get("BANDWIDTH", 0)), uri))
    if audio:
        return urljoin(url, max(audio, key=lambda a: a[0])[1])
    return urljoin(url, max(variants, key=lambda v: v[:2])[2]) if variants else None


def hls_pieces(lines: list[str], url: str) -> list[Piece]:
    out: list[Piece] = []
    span: str | None = None
    after: dict[str, int] = {}
    for line in lines:
        if line.startswith("#EXT-X-KEY:") and _attributes(line).get("METHOD", "NONE") != "NONE":
            raise ValueError(f"encrypted: {url}")
        if line.startswith("#EXT-X-BYTERANGE:"):
            span = line.partition(":")[2]
        elif line.startswith("#EXT-X-MAP:"):
            found = _attributes(line)
            at = urljoin(url, found["URI"])
            out.append(Piece(at, *_range(found["BYTERANGE"], 0)) if "BYTERANGE" in found else Piece(at))
        elif line and not line.startswith("#"):
            at = urljoin(url, line)
            if span is None:
                out.append(Piece(at))
            else:
                offset, length = _range(span, after.get(at, 0))
                after[at], span = offset + length, None
                out.append(Piece(at, offset, length))
    return out


def _seconds(text: str | None) -> float:
    found = re.fullmatch(r"P(?:(\d+)D)?T?(?:(\d+)H)?(?:(\d+)M)?(?:([\d.]+)S)?", text or "")
    return sum(float(v or 0) * unit for v, unit in zip(found.groups(), (86400, 3600, 60, 1), strict=True)) if found else 0.0


def dash_pieces(text: str, url: str) -> list[Piece]:
    """The pieces of the audio of the highest bandwidth; of a list without audio of its own, of anything."""
    root = ET.fromstring(text)  # noqa: S314
    for node in root.iter():
        node.tag = node.tag.rpartition("}")[2]
    out: list[Piece] = []
    for period in root.iter("Period"):
        sets = []
        for group in period.iter("AdaptationSet"):
            for one in group.iter("Representation"):
                kind = f"{group.get('contentType')} {group.get('mimeType')} {one.get('mimeType')}"
                sets.append(("audio" in kind, int(one.get("bandwidth", 0)), group, one))
        if not sets:
            continue
        _, _, group, one = max(sets, key=lambda s: s[:2])
        base = url
        for node in (root, period, group, one):
            found = node.find("BaseURL")
            base = urljoin(base, (found.text or "").strip()) if found is not None else base
        pick = lambda name, group=group, one=one: next((n for n in (one.find(name), group.find(name)) if n is not None), None)
        length = _seconds(period.get("duration")) or _seconds(root.get("mediaPresentationDuration"))
        out += _template(pick("SegmentTemplate"), one, base, length) or _listed(pick("SegmentList"), base) or [Piece(base)]
    return out


def _span(text: str | None) -> tuple[int, int | None]:
    if not text:
        return 0, None
    first, _, last = text.partition("-")
    return int(first), int(last) - int(first) + 1


def _listed(node: ET.Element | None, base: str) -> list[Piece]:
    if node is None:
        return []
    head = node.find("Initialization")
    first = [] if head is None else [Piece(urljoin(base, head.get("sourceURL", "")), *_span(head.get("range")))]
    return first + [Piece(urljoin(base, s.get("media", "")), *_span(s.get("mediaRange"))) for s in node.iter("SegmentURL")]


def _template(node: ET.Element | None, one: ET.Element, base: str, seconds: float) -> list[Piece]:
    if node is None:
        return []
    known = {"RepresentationID": one.get("id", ""), "Bandwidth": one.get("bandwidth", "")}

    def filled(text: str, **more: int) -> Piece:
        value = lambda m: "$" if not m[1] else format(int((known | more)[m[1]]), m[2][1:]) if m[2] else str((known | more)[m[1]])
        return Piece(urljoin(base, re.sub(r"\$(\w*)(%0\d+d)?\$", value, text)))

    out = [filled(node.get("initialization", ""))] if node.get("initialization") else []
    number, at = int(node.get("startNumber", 1)), 0
    if node.find("SegmentTimeline") is not None:
        for s in node.iter("S"):
            at = int(s.get("t", at))
            for _ in range(int(s.get("r", 0)) + 1):
                out.append(filled(node.get("media", ""), Number=number, Time=at))
                number, at = number + 1, at + int(s.get("d", 0))
        return out
    step = int(node.get("duration", 0)) / int(node.get("timescale", 1))
    count = math.ceil(seconds / step - 1e-9) if step else 0
    return out + [filled(node.get("media", ""), Number=number + k, Time=k * int(node.get("duration", 0))) for k in range(count)]


def resolve(url: str, depth: int = DEPTH) -> list[Piece]:
    """The pieces of a playlist's audio, in order; of any other address the one piece that it is."""
    if not is_playlist(url):
        return [Piece(url)]
    if not depth:
        raise ValueError(f"lists that name lists: {url}")
    with urlopen(url, timeout=SECONDS) as source:  # noqa: S310
        text = source.read().decode("utf-8-sig")
    if urlsplit(url).path.endswith(".mpd"):
        pieces = dash_pieces(text, url)
    else:
        lines = [line.strip() for line in text.splitlines()]
        if not lines or lines[0] != "#EXTM3U":
            raise ValueError(f"no playlist: {url}")
        variant = hls_variant(lines, url)
        pieces = resolve(variant, depth - 1) if variant else hls_pieces(lines, url)
    if not pieces:
        raise ValueError(f"no pieces: {url}")
    return pieces


def download(url: str, target: Path) -> None:
    """All pieces of a playlist in one file, one after the other."""
    with target.open("wb") as out:
        for piece in resolve(url):
            copy_piece(piece, out)


def pieces_of(items: DataFrame) -> DataFrame:
    """Items (id, url) as rows id, place, url, offset, length of their pieces, or id and error."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for name, url in zip(batch["id"], batch["url"], strict=True):
                try:
                    rows += [(name, k, p.url, p.offset, p.length, None) for k, p in enumerate(resolve(url))]
                except Exception as error:  # noqa: BLE001  it is this item's error
                    rows.append((name, None, None, None, None, f"{type(error).__name__}: {error}"))
            frame = pd.DataFrame(rows, columns=["id", "place", "url", "offset", "length", "error"], dtype=object)
            yield frame.astype({"place": "Int64", "offset": "Int64", "length": "Int64"})

    ship(items.sparkSession)
    return items.select("id", "url").mapInPandas(run, "id string, place long, url string, offset long, length long, error string")


def fetch_playlists(items: DataFrame, dest: str) -> DataFrame:
    """Items (id, url, filename) fetched to dest, a folder that all executors see: id, local_path, error.

    Pieces are dealt over tasks, also those of one recording, and written beside the file; once all are there one
    task a recording puts them together, and the file appears when it is whole. A piece that can't be had is its recording's error."""
    run_id = uuid.uuid4().hex

    def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            errors = []
            for row in batch.to_dict("records"):
                error = row["error"]
                if pd.isna(error):
                    target = Path(dest, f".{run_id}", row["folder"], f"{int(row['place']):09d}")
                    target.parent.mkdir(parents=True, exist_ok=True)
                    part = target.with_name(f"{uuid.uuid4().hex}.part")
                    try:
                        with part.open("wb") as out:
                            copy_piece(Piece(row["url"], int(row["offset"]), None if pd.isna(row["length"]) else int(row["length"])), out)
                        os.replace(part, target)
                        error = None
                    except Exception as failure:  # noqa: BLE001
                        part.unlink(missing_ok=True)
                        error = f"{type(failure).__name__}: {failure}"
                errors.append(error)
            yield pd.DataFrame({"id": batch["id"], "error": errors}, dtype=object)

    def join(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            paths = []
            for row in batch.to_dict("records"):
                folder, target = Path(dest, f".{run_id}", row["folder"]), Path(dest, row["filename"])
                if pd.isna(row["error"]):
                    target.parent.mkdir(parents=True, exist_ok=True)
                    part = target.with_name(f".{uuid.uuid4().hex}.part")
                    if folder.exists():  # else an earlier attempt of this task has put it together
                        with part.open("wb") as out:
                            for k in range(int(row["pieces"])):
                                with (folder / f"{k:09d}").open("rb") as held:
                                    shutil.copyfileobj(held, out)
                        os.replace(part, target)
                shutil.rmtree(folder, ignore_errors=True)
                paths.append(str(target) if pd.isna(row["error"]) else None)
            yield pd.DataFrame({"id": batch["id"], "local_path": paths, "error": batch["error"]}, dtype=object)

    named = items.select("id", F.coalesce("filename", "id").alias("filename"))
    dealt = pieces_of(items).withColumn("folder", F.sha2("id", 256)).repartition(F.col("id"), F.col("place"))
    fetched = dealt.mapInPandas(fetch, "id string, error string").groupBy("id").agg(F.count(F.lit(1)).alias("pieces"), F.min("error").alias("error"))
    ready = fetched.join(named.dropDuplicates(["id"]), "id").withColumn("folder", F.sha2("id", 256))
    return ready.mapInPandas(join, "id string, local_path string, error string")
