"""Audio inputs: classification, base64 and PCM payloads, WAV headers of bytes and of files."""

from __future__ import annotations

import io

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType, IntegerType, StructField, StructType

from voxloom.functions.text import after_first, trim_py
from voxloom.sources import wavfiles
from voxloom.sources.wavfiles import read_header

BASE64_MIN_CHARS = 256
PCM_BYTES = 4


def classify_audio_input(value: Column) -> Column:
    """``url`` (http or https with a host), ``base64`` (data:audio, or long and without slashes), else ``path``."""
    slashed = value.contains("/") | value.contains("\\")
    return (
        F.when(value.rlike(r"^(?i)https?://[^/?#]"), "url")
        .when(value.startswith("data:audio") | (~slashed & (F.length(value) > BASE64_MIN_CHARS)), "base64")
        .otherwise("path")
    )


def decode_base64_payload(value: Column) -> Column:
    """Bytes of a base64 text, with or without a ``data:...,`` head; null where it does not decode."""
    headed = value.contains(",") & trim_py(value).startswith("data:")
    return F.try_to_binary(F.when(headed, after_first(value, ",")).otherwise(value), F.lit("base64"))


@F.pandas_udf(ArrayType(FloatType()))
def _floats(body: pd.Series) -> pd.Series:
    return body.map(lambda b: None if b is None else np.frombuffer(b, dtype="<f4"))


def decode_pcm_f32(body: Column) -> Column:
    """Little-endian 32-bit floats; null where the length is not a multiple of four."""
    return _floats(F.when(F.octet_length(body) % PCM_BYTES == 0, body))


_HEADER = StructType([StructField("sr", IntegerType()), StructField("channels", IntegerType()), StructField("duration", DoubleType())])


@F.pandas_udf(_HEADER)
def wav_header(body: pd.Series) -> pd.DataFrame:
    """Rate, channels and seconds from a WAV header; an unreadable file has a duration of -1."""

    def read(data):
        header = read_header(io.BytesIO(data or b""), len(data or b""))
        return header.sr, header.channels, header.duration

    rows = pd.DataFrame([read(b) for b in body], columns=["sr", "channels", "duration"], dtype=object)
    return rows.astype({"sr": "Int32", "channels": "Int32", "duration": "float64"})


def list_audio(spark: SparkSession, folder: str, pattern: str = "*.wav") -> DataFrame:
    """(path, length) of every audio file, for a check of missing paths. No file is opened."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true")
    return files.load(folder).select("path", "length")


def scan_audio_manifest(spark: SparkSession, folder: str, pattern: str = "*.wav") -> DataFrame:
    """(path, length, sr, channels, duration, header_bytes) of every audio file of a folder tree, from the headers alone."""
    wavfiles.register(spark)
    return spark.read.format(wavfiles.NAME).option("pattern", pattern).load(folder)


def write_audio_files(df: DataFrame, folder: str) -> None:
    """One file per row of a table (name, content), in a folder of the shared store."""
    wavfiles.register(df.sparkSession)
    df.select("name", "content").write.format(wavfiles.NAME).mode("append").save(folder)


def _little_endian(value: Column, size: int) -> Column:
    text = F.lpad(F.hex(F.pmod(value.cast("bigint"), F.lit(256**size))), 2 * size, "0")
    return F.concat(*[F.substring(text, 2 * i + 1, 2) for i in reversed(range(size))])


def wav_bytes(samples: Column, sr: int) -> Column:
    """16-bit mono WAV file content from an array of integer samples, made by expressions only."""
    size = F.size(samples) * 2
    fields = [
        F.hex(F.lit("RIFF")), _little_endian(size + 36, 4), F.hex(F.lit("WAVEfmt ")), _little_endian(F.lit(16), 4),
        _little_endian(F.lit(1), 2), _little_endian(F.lit(1), 2), _little_endian(F.lit(sr), 4),
        _little_endian(F.lit(sr * 2), 4), _little_endian(F.lit(2), 2), _little_endian(F.lit(16), 2),
        F.hex(F.lit("data")), _little_endian(size, 4), F.array_join(F.transform(samples, lambda x: _little_endian(x, 2)), ""),
    ]
    return F.unhex(F.concat(*fields))
