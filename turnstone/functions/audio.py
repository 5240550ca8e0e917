"""Sample arrays: expressions where arrays allow, and UDFs for decoding, resampling and encoding PCM."""

from __future__ import annotations

import io
import math
import wave
from collections.abc import Callable, Sequence
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

RATE = 16_000
#: The resampler's filter: zero crossings of its sinc on each side, its Kaiser window, and where it passes half, as a share of
#: the lower Nyquist frequency.
CROSSINGS, KAISER, PASS = 28, 7.0, 1.0
#: Output samples that are made together.
STRETCH = 1 << 16
# What a copy is boosted by that has been denoised, and one that has not.
DENOISED_BOOST, PLAIN_BOOST = 3.0, 1.0


def duration_of(samples: Column, rate: Column) -> Column:
    return F.when(rate == 0, F.lit(0.0)).otherwise(F.size(samples) / rate)


def apply_boost(samples: Column, factor: float) -> Column:
    """Samples times factor, divided by their peak only if that passes 1."""
    loud = F.transform(samples, lambda x: x * F.lit(factor))
    peak = F.coalesce(F.array_max(F.transform(loud, F.abs)), F.lit(0.0))
    return F.when(peak > 1, F.transform(loud, lambda x: x / peak)).otherwise(loud)


def slice_audio(samples: Column, rate: Column, start: Column, end: Column, pad: float = 0.0) -> Column:
    """The samples of a span of seconds, padded; empty outside the recording."""
    size = F.size(samples)
    low = F.least(F.greatest(F.bround((start - pad) * rate), F.lit(0)), size).cast("int")
    high = F.least(F.greatest(F.ceil((end + pad) * rate), F.lit(0)), size).cast("int")
    return F.slice(samples, low + 1, F.greatest(high - low, F.lit(0)))


def decode(data: bytes) -> tuple[np.ndarray, int]:
    """PCM WAV of 1, 2 or 4 bytes a sample, as floats in [-1, 1] (frames, channels), and its rate."""
    with wave.open(io.BytesIO(data)) as source:
        width, channels, rate = source.getsampwidth(), source.getnchannels(), source.getframerate()
        raw = source.readframes(source.getnframes())
    if width == 1:
        samples = (np.frombuffer(raw, np.uint8).astype(np.float32) - 128) / 128
    elif width in (2, 4):
        kind = np.dtype(f"<i{width}")
        samples = np.frombuffer(raw, kind).astype(np.float32) / np.iinfo(kind).max
    else:
        raise ValueError(f"{width}-byte samples can't be read")
    return samples.reshape(-1, channels), rate


def to_mono(samples: np.ndarray) -> np.ndarray:
    """The mean over channels, which are the shorter axis."""
    if samples.ndim == 1:
        return samples.astype(np.float32)
    return samples.mean(axis=1 if samples.shape[0] > samples.shape[1] else 0).astype(np.float32)


@lru_cache(maxsize=8)
def filter_bank(up: int, down: int) -> tuple[np.ndarray, int]:
    """The low-pass of a change of rate by up / down as `up` rows, each the taps that one phase of the output sees, last first,
    and how many input samples before its own place a phase reaches back."""
    most = max(up, down)
    half = CROSSINGS * most
    n = np.arange(-half, half + 1)
    taps = PASS / most * np.sinc(PASS * n / most) * np.kaiser(2 * half + 1, KAISER)
    reach = half // up + 1
    bank = np.zeros((up, 2 * reach + 1))
    for phase in range(up):
        places = phase + up * np.arange(-reach, reach + 1)  # of the filter, for the samples around
        inside = np.abs(places) <= half
        bank[phase, inside] = taps[places[inside] + half]
        bank[phase] /= bank[phase].sum()  # each phase keeps a constant as it is
    return np.ascontiguousarray(bank[:, ::-1]), reach


def resample(samples: np.ndarray, rate: int, to: int = RATE) -> np.ndarray:
    """By a rational factor through a polyphase filter bank: a Kaiser-windowed sinc, of which an output sample needs one
    phase only. Silence is taken before and after the samples."""
    if rate == to or not len(samples):
        return samples.astype(np.float32)
    shared = math.gcd(rate, to)
    up, down = to // shared, rate // shared
    bank, reach = filter_bank(up, down)
    size = round(len(samples) * to / rate)
    padded = np.concatenate((np.zeros(reach), samples.astype(np.float64), np.zeros(reach + down // up + 2)))
    around = np.lib.stride_tricks.sliding_window_view(padded, 2 * reach + 1)
    out = np.empty(size, np.float32)
    for begin in range(0, size, STRETCH):
        at = np.arange(begin, min(size, begin + STRETCH)) * down
        out[begin : begin + STRETCH] = np.einsum("ij,ij->i", around[at // up], bank[at % up])
    return out


def encode(samples: np.ndarray, rate: int = RATE) -> bytes:
    """16-bit mono WAV: clipped, scaled, truncated."""
    out = io.BytesIO()
    with wave.open(out, "wb") as sink:
        sink.setnchannels(1)
        sink.setsampwidth(2)
        sink.setframerate(rate)
        sink.writeframes((np.clip(samples, -1, 1) * 32767).astype("<i2").tobytes())
    return out.getvalue()


Decoder = Callable[[bytes], tuple[np.ndarray, int]]


def decode_any(data: bytes, decoders: Sequence[tuple[str, Decoder]]) -> np.ndarray:
    """The samples, mono at RATE, by the first of the named decoders that can read them; or an error that lists every attempt."""
    tried = []
    for name, decoder in decoders:
        try:
            samples, rate = decoder(data)
            return resample(to_mono(samples), rate)
        except ImportError as error:
            tried.append(f"{name}: not installed ({error})")
        except Exception as error:  # noqa: BLE001  the next one is tried
            tried.append(f"{name}: {type(error).__name__}: {error}")
    raise ValueError("could not decode: " + "; ".join(tried))


def _read(content: pd.Series, decoders: Sequence[tuple[str, Decoder]] = ()) -> pd.DataFrame:
    def read(data: bytes | None) -> tuple[np.ndarray | None, str | None]:
        try:
            return (None, None) if data is None else (decode_any(data, [*decoders, ("wave", decode)]), None)
        except ValueError as error:
            return None, str(error)

    return pd.DataFrame([read(data) for data in content], columns=["samples", "error"], dtype=object)


_READ = T.StructType([T.StructField("samples", T.ArrayType(T.FloatType())), T.StructField("error", T.StringType())])


def read_audio(content: Column | str, decoders: Sequence[tuple[str, Decoder]] = ()) -> Column:
    """A recording's samples, mono at RATE, or the error why it can't be read; both null where there is no file.

    decoders: names and functions from a file's bytes to samples (frames, or frames and channels) and their rate,
    which are tried in turn; WAV files are read here, last of all."""

    @F.pandas_udf(_READ)
    def read(data: pd.Series) -> pd.DataFrame:
        return _read(data, decoders)

    return read(content)


def load_audio(content: Column | str, decoders: Sequence[tuple[str, Decoder]] = ()) -> Column:
    """A recording's samples, mono at RATE; null where it can't be read."""
    return read_audio(content, decoders)["samples"]


@F.pandas_udf(T.BinaryType())
def to_wav(samples: pd.Series) -> pd.Series:
    return samples.map(lambda s: None if s is None else encode(np.asarray(s, np.float32)))


def prepare_audio(content: Column, boost: float | None = None, denoise: Callable[[np.ndarray, int], np.ndarray] | None = None, decoders: Sequence[tuple[str, Decoder]] = ()) -> Column:
    """A recording's prepared copy: decoded, denoised, boosted, encoded; null where it can't be read.

    denoise: a function of samples and their rate, for which no library is here; without it samples are as they were. Without a boost
    that is given, denoised copies are boosted by DENOISED_BOOST and others not. Array functions can't take what a UDF
    returns, so all steps are one UDF."""
    factor = boost if boost is not None else PLAIN_BOOST if denoise is None else DENOISED_BOOST

    @F.pandas_udf(T.BinaryType())
    def prepare(data: pd.Series) -> pd.Series:
        def made(samples: np.ndarray | None) -> bytes | None:
            if samples is None:
                return None
            if denoise is not None:
                samples = np.asarray(denoise(samples, RATE), np.float32)
            if factor and factor != 1.0:
                samples = samples * np.float32(factor)
                samples = samples / max(1.0, float(np.abs(samples).max(initial=0.0)))
            return encode(samples)

        return _read(data, decoders)["samples"].map(made)

    return prepare(content)
