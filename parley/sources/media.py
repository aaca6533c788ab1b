"""PCM WAV bytes, storage addresses and upload rules as column expressions and small functions."""

from __future__ import annotations

import json
import struct

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

MAX_UPLOAD = 314_572_800


def wav_header(content: Column) -> Column:
    """Channels, rate, bits, frames and whether the bytes are whole PCM; for headers of 44 bytes."""

    def number(at: int, size: int) -> Column:
        return F.conv(F.concat(*(F.hex(F.substring(content, at + i + 1, 1)) for i in reversed(range(size)))), 16, 10).cast("long")

    frames = number(40, 4) / (number(22, 2) * number(34, 2) / 8)
    whole = (F.substring(content, 1, 4) == F.lit(b"RIFF")) & (F.substring(content, 9, 4) == F.lit(b"WAVE")) & (number(20, 2) == 1) & (F.length(content) == number(40, 4) + 44)
    return F.struct(number(22, 2).alias("channels"), number(24, 4).alias("rate"), number(34, 2).alias("bits"), frames.cast("long").alias("frames"), whole.alias("whole"))


def cut(content: Column, start_frame: Column, end_frame: Column) -> Column:
    """Payload bytes of 16-bit mono frames start .. end."""
    return F.substring(content, (start_frame * 2 + 45).cast("int"), ((end_frame - start_frame) * 2).cast("int"))


def half_even_frame(ms: Column, rate: int) -> Column:
    """The frame at a millisecond, halves to even."""
    return F.bround(ms.cast("decimal(20,0)") * rate / 1000, 0).cast("long")


def readings(header: Column, length: Column, expected_ms: Column, rate: int = 16_000) -> Column:
    """Which readers accept a WAV of ``expected_ms``.

    ``strict`` compares the length in milliseconds, halves up; ``exact`` refuses lengths between
    milliseconds; ``chunk`` wants the very number of frames, ``track`` also no byte after them.
    """
    frames = header["frames"]
    pcm = header["whole"] & (header["channels"] == 1) & (header["bits"] == 16) & (header["rate"] == rate) & (frames > 0)
    strict = F.floor((frames * 1000 + rate // 2) / rate) == expected_ms
    exact = (frames * 1000 % rate == 0) & (frames * 1000 == expected_ms * rate)
    chunk = frames == half_even_frame(expected_ms, rate)
    track = (frames * 1000 == expected_ms * rate) & (length == frames * 2 + 44)
    said = {"strict": strict, "exact": exact, "chunk": chunk, "track": track}
    return F.struct(*(F.coalesce(pcm & ok, F.lit(False)).alias(k) for k, ok in said.items()))


def range_of(content: Column, frames: Column, start_ms: Column, end_ms: Column, rate: int) -> Column:
    """Payload bytes between two milliseconds, bounds rounded half to even; null past the end or where nothing is left."""
    a, b = half_even_frame(start_ms, rate), half_even_frame(end_ms, rate)
    return F.when((start_ms >= 0) & (b > a) & (b <= frames), cut(content, a, b))


def raw_keys(raw_id: Column, part_index: Column) -> Column:
    """Storage keys of a recording's audio, its speech segments, and one of its parts."""
    root = F.concat(F.lit("raw_audios/"), raw_id)
    part = F.when(part_index >= 0, F.concat(root, F.lit("/audio_parts/"), part_index.cast("string"), F.lit("/audio.wav")))
    return F.struct(F.concat(root, F.lit("/audio.wav")).alias("audio"), F.concat(root, F.lit("/vad_segments.json")).alias("segments"), part.alias("part"))


def beside(key: Column, *names: Column | str) -> Column:
    """A key in the folder of another key, such as results/transcript.json or speaker-references/references.json."""
    parts = [F.lit(n) if isinstance(n, str) else n for n in names]
    return F.concat_ws("/", F.regexp_replace(key, "/[^/]*$", ""), *parts)


def _dumped(texts: pd.Series, **style) -> pd.Series:
    return texts.map(lambda t: None if t is None else json.dumps(json.loads(t), ensure_ascii=True, **style) + "\n")


@F.pandas_udf(StringType())
def compact_json(document: pd.Series) -> pd.Series:
    """JSON text without spaces, fields as they come, ASCII only, with a line feed at the end."""
    return _dumped(document, separators=(",", ":"))


@F.pandas_udf(StringType())
def pretty_json(document: pd.Series) -> pd.Series:
    """JSON text indented by two, fields as they come, ASCII only, with a line feed at the end."""
    return _dumped(document, indent=2)


@F.pandas_udf(ArrayType(IntegerType()))
def samples_of(payload: pd.Series) -> pd.Series:
    """The 16-bit little-endian samples of payload bytes; an odd byte at the end is left out."""
    return payload.map(lambda raw: None if raw is None else np.frombuffer(raw[: len(raw) // 2 * 2], "<i2").astype(np.int32))


def to_wav(samples: np.ndarray, rate: int) -> bytes:
    """Mono 16-bit PCM behind a header of 44 bytes."""
    raw = np.clip(np.rint(samples), -32768, 32767).astype("<i2").tobytes()
    return b"RIFF" + struct.pack("<I", len(raw) + 36) + b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, 1, rate, rate * 2, 2, 16) + b"data" + struct.pack("<I", len(raw)) + raw


PARSED = StructType([*(StructField(n, LongType()) for n in ("channels", "rate", "bits", "frames", "data_at")), StructField("error", StringType())])


def parse_wav(raw: bytes | None) -> tuple:
    """Channels, rate, bits, frames and the payload's place, found chunk by chunk, or what is wrong.

    Errors: ``riff`` (no RIFF WAVE), ``fmt`` (none before the data, or too short), ``codec`` (no PCM),
    ``width`` (frames of no whole bytes), ``data`` (none, or cut off). Chunks of other kinds are
    passed over with the byte that pads odd ones.
    """
    if raw is None or len(raw) < 12 or raw[:4] != b"RIFF" or raw[8:12] != b"WAVE":
        return (None,) * 5 + ("riff",)
    at, form = 12, None
    while at + 8 <= len(raw):
        name, size = raw[at : at + 4], int.from_bytes(raw[at + 4 : at + 8], "little")
        body = at + 8
        if name == b"fmt ":
            if size < 16 or body + 16 > len(raw):
                return (None,) * 5 + ("fmt",)
            form = struct.unpack("<HHIIHH", raw[body : body + 16])
        elif name == b"data":
            if form is None:
                return (None,) * 5 + ("fmt",)
            codec, channels, rate, _, _, bits = form
            if codec != 1:
                return channels, rate, bits, None, None, "codec"
            step = channels * bits // 8
            if not step or bits % 8:
                return channels, rate, bits, None, None, "width"
            if body + size > len(raw):
                return channels, rate, bits, None, None, "data"
            return channels, rate, bits, size // step, body, None
        at = body + size + size % 2
    return (None,) * 5 + ("data" if form else "fmt",)


@F.pandas_udf(PARSED)
def wav_chunks(content: pd.Series) -> pd.DataFrame:
    """:func:`parse_wav` of each file."""
    names = PARSED.fieldNames()
    return pd.DataFrame([parse_wav(raw) for raw in content], columns=names).astype({n: "Int64" for n in names[:-1]})


def payload_of(content: Column, parsed: Column, start_frame: Column, end_frame: Column) -> Column:
    """Bytes of the frames start .. end of a parsed file; null where it has an error or too few frames."""
    step = (parsed["channels"] * parsed["bits"] / 8).cast("int")
    found = F.substring(content, (parsed["data_at"] + start_frame * step + 1).cast("int"), ((end_frame - start_frame) * step).cast("int"))
    return F.when(parsed["error"].isNull() & (start_frame >= 0) & (end_frame >= start_frame) & (end_frame <= parsed["frames"]), found)


def with_wav(tracks: DataFrame, rate: int = 16_000) -> DataFrame:
    """Sample arrays (scaled to their peak) as WAV bytes in column ``wav``."""

    def encode(batches):
        for pdf in batches:
            scaled = [np.asarray(s, float) / max(1e-9, np.abs(s).max()) * 32767 * 0.9 if len(s) else np.zeros(0) for s in pdf["samples"]]
            yield pd.DataFrame({"track_id": pdf["track_id"], "wav": [to_wav(s, rate) for s in scaled]})

    return tracks.select("track_id", "samples").mapInPandas(encode, "track_id long, wav binary")


def upload_suffix(name: Column) -> Column:
    """The lower-cased alphanumeric suffix of a file name, else ``.upload``."""
    found = F.lower(F.regexp_extract(name, r"\.([A-Za-z0-9]+)$", 1))
    return F.when(F.length(found) > 0, F.concat(F.lit("."), found)).otherwise(".upload")


def valid_upload(length: Column) -> Column:
    return length.between(1, MAX_UPLOAD)


def address(url: Column) -> Column:
    """Scheme, host, path and query of an address, and whether it is canonical."""
    odd = url.rlike(r"[%\\\s?#]") | url.rlike(r"(^|/)\.\.?(/|$)") | url.rlike(r"[^:]//")
    return F.struct(F.parse_url(url, F.lit("PROTOCOL")).alias("scheme"), F.parse_url(url, F.lit("HOST")).alias("host"), F.parse_url(url, F.lit("PATH")).alias("path"), (~odd & url.rlike("^[a-z][a-z0-9]*://[^/]+/.+")).alias("canonical"))
