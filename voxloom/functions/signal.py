"""Waveform expressions on ``array<float>`` columns. Everything here runs in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from voxloom.constants import (
    MAX_ALIGNMENT_SECONDS,
    MAX_RECOGNITION_SECONDS,
    SAMPLE_RATE,
    TOKENS_PER_100_FRAMES,
)
from voxloom.functions.binding import bind

def _empty() -> Column:
    return F.array().cast("array<float>")


def _f32(x: Column) -> Column:
    return x.cast("float")


def audio_token_length(frames: Column) -> Column:
    """13 tokens per full 100 frames; the rest is halved three times, each time rounded up."""
    frames = frames.cast("bigint")
    rest = F.shiftright(F.pmod(frames, F.lit(100)) + 7, 3)
    return rest + F.floor(frames / 100) * TOKENS_PER_100_FRAMES


def ms_from_token(index: Column, segment_ms: float) -> Column:
    return index * F.lit(float(segment_ms))


def to_mono(channels: Column) -> Column:
    """Mean over channels. Up to 8 rows that are longer than their count are channels, otherwise the rows are frames."""

    def mean(rows: Column) -> Column:
        count, first = F.size(rows), F.get(rows, F.lit(0))
        summed = F.aggregate(
            F.slice(rows, 2, F.greatest(count - 1, F.lit(0))), first,
            lambda acc, ch: F.zip_with(acc, ch, lambda a, b: a + b),
        )
        by_channel = bind(count, lambda n: F.transform(summed, lambda x: _f32(x / n)))
        by_frame = F.transform(
            rows, lambda fr: _f32(F.aggregate(fr, F.lit(0.0).cast("float"), lambda a, b: a + b) / F.size(fr))
        )
        as_channels = (count <= 8) & (F.size(first) > count)
        return F.when(count == 0, _empty()).when(as_channels, by_channel).otherwise(by_frame)

    return bind(channels, mean)


def peak(wav: Column) -> Column:
    return F.coalesce(F.array_max(F.transform(wav, F.abs)), F.lit(0.0).cast("float"))


def clip_unit(x: Column) -> Column:
    one = F.lit(1.0).cast("float")
    return F.greatest(F.least(x, one), -one)


def normalize_range(wav: Column) -> Column:
    """Divide by the peak only where it exceeds 1."""

    def scaled(w: Column) -> Column:
        return bind(
            peak(w), lambda top: F.when(top > 1.0, F.transform(w, lambda x: clip_unit(_f32(x / top)))).otherwise(w)
        )

    return bind(wav, scaled)


def normalize_int_pcm(samples: Column, bits: int, signed: bool = True) -> Column:
    """Integer samples of a declared depth to [-1, 1]; unsigned samples are centred first."""
    half = float(2 ** (bits - 1))
    shift = 0.0 if signed else half
    return F.transform(samples, lambda x: clip_unit(_f32((x.cast("double") - shift) / half)))


def normalize_float_pcm(samples: Column) -> Column:
    """Float samples are scaled only when the peak is clearly above 1."""

    def scaled(top: Column) -> Column:
        loud = F.transform(samples, lambda x: clip_unit(_f32(x / (top + 1e-12))))
        return F.when(top > 1.0 + 1e-6, loud).otherwise(F.transform(samples, lambda x: clip_unit(_f32(x))))

    return bind(peak(samples).cast("double"), scaled)


def stream_pcm16(samples: Column) -> Column:
    """16-bit stream samples divided by 32768."""
    return F.transform(samples, lambda x: _f32(x / F.lit(32768.0)))


def _interpolate(wav: Column, n_out: Column, step: Column) -> Column:
    """``n_out`` samples at the positions i * step, linear between neighbours, the last sample kept at the edge."""

    def sampled(s: Column) -> Column:
        w, last = s["w"], s["last"]

        def sample(i: Column) -> Column:
            def at(x: Column) -> Column:
                low = F.floor(x).cast("int")
                t = x - low
                return _f32(F.get(w, low) * (1 - t) + F.get(w, F.least(low + 1, last)) * t)

            return bind(i * s["step"], at)

        return F.when((s["n"] <= 0) | (s["last"] < 0), _empty()).otherwise(
            F.transform(F.sequence(F.lit(0), F.greatest(s["n"] - 1, F.lit(0))), sample)
        )

    parts = F.struct(
        wav.alias("w"), (F.size(wav) - 1).alias("last"), n_out.cast("int").alias("n"), step.cast("double").alias("step")
    )
    return bind(parts, sampled)


def resample_linear(wav: Column, sr: Column, target: int = SAMPLE_RATE) -> Column:
    """Linear resampling: output length is rounded half up, positions step by the rate ratio, the edge is clamped."""
    n_out = F.floor(F.size(wav) * F.lit(float(target)) / sr + 0.5)
    return F.when(sr == target, wav).otherwise(_interpolate(wav, n_out, sr / F.lit(float(target))))


def resample_even_grid(wav: Column, sr: Column, target: int = SAMPLE_RATE) -> Column:
    """Linear resampling on an even time grid over the same duration; output length is rounded half to even."""
    n_in = F.size(wav)
    n_out = F.bround(n_in.cast("double") / sr * target)
    return F.when(sr == target, wav).otherwise(_interpolate(wav, n_out, n_in / F.greatest(n_out, F.lit(1))))


def normalize_waveform(channels: Column, sr: Column, target: int = SAMPLE_RATE) -> Column:
    """Mono, resampled, in range."""
    return bind(to_mono(channels), lambda mono: normalize_range(resample_linear(mono, sr, target)))


def max_chunk_seconds(with_timestamps: Column) -> Column:
    return F.when(with_timestamps, F.lit(MAX_ALIGNMENT_SECONDS)).otherwise(F.lit(MAX_RECOGNITION_SECONDS))


def slice_span(wav: Column, sr: Column, start: Column, end: Column) -> Column:
    """Samples between two times in seconds, clamped to the signal; null where the span is missing, reversed or empty."""
    first = F.greatest(F.lit(0), (start * sr).cast("int"))
    stop = F.least(F.size(wav), (end * sr).cast("int"))
    # the comparison is not true for null times either, so those give null as well
    return F.when((end > start) & (stop > first), F.slice(wav, first + 1, stop - first))


def to_pcm16(wav: Column) -> Column:
    return F.transform(wav, lambda x: (clip_unit(x) * F.lit(32767.0).cast("float")).cast("smallint"))
