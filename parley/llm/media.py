"""Media columns: payloads kept in MPEG transport streams (ISO/IEC 13818-1).

``mux`` stores bytes as one private-data elementary stream of one program: a program
association table, a program map table, then access units as PES packets with presentation
timestamps and random-access flags, cut into 188-byte packets. ``demux`` follows the tables
to the stream, checks continuity counters, reassembles the PES packets and returns payload,
timestamps and random-access points.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

PACKET, SYNC = 188, 0x47
PAT_PID, PMT_PID, DATA_PID, PROGRAM = 0, 0x1000, 0x100, 1
#: A program of private data alone has no clock reference: its map names the null PID for it.
NO_PCR = 0x1FFF
PRIVATE_PES, PRIVATE_STREAM = 0x06, 0xBD  # stream type, stream id
#: Payload bytes of an access unit, and ticks of the 90 kHz clock between units.
UNIT, TICKS = 16_384, 3_600
#: Every so many units one is a random-access point.
ACCESS_EVERY = 4
#: The payload is padded with zeros to a positive multiple of this.
ALIGN = 64


def _crc_table() -> list[int]:
    table = []
    for n in range(256):
        c = n << 24
        for _ in range(8):
            c = (c << 1 ^ 0x04C11DB7 if c & 0x80000000 else c << 1) & 0xFFFFFFFF
        table.append(c)
    return table


_CRC = _crc_table()


def crc32_mpeg(data: bytes) -> int:
    """The CRC of table sections; over a section and its CRC it is zero."""
    c = 0xFFFFFFFF
    for b in data:
        c = (c << 8 & 0xFFFFFFFF) ^ _CRC[c >> 24 ^ b]
    return c


def _section(table_id: int, key: int, body: bytes) -> bytes:
    head = bytes([table_id]) + (0xB000 | len(body) + 9).to_bytes(2, "big") + key.to_bytes(2, "big") + b"\xc1\x00\x00"
    return head + body + crc32_mpeg(head + body).to_bytes(4, "big")


def _table_packet(pid: int, section: bytes) -> bytes:
    head = bytes([SYNC, 0x40 | pid >> 8, pid & 0xFF, 0x10, 0])
    return (head + section).ljust(PACKET, b"\xff")


_TABLES = _table_packet(PAT_PID, _section(0, 1, PROGRAM.to_bytes(2, "big") + (0xE000 | PMT_PID).to_bytes(2, "big"))) + _table_packet(
    PMT_PID, _section(2, PROGRAM, (0xE000 | NO_PCR).to_bytes(2, "big") + b"\xf0\x00" + bytes([PRIVATE_PES]) + (0xE000 | DATA_PID).to_bytes(2, "big") + b"\xf0\x00")
)


def _timestamp(pts: int) -> bytes:
    return bytes([0x21 | pts >> 29 & 0x0E]) + (pts >> 14 & 0xFFFE | 1).to_bytes(2, "big") + (pts << 1 & 0xFFFE | 1).to_bytes(2, "big")


def _unit_packets(unit: bytes, pts: int, access: bool, counter: int) -> np.ndarray:
    """The 188-byte packets of one access unit, its last one filled by an adaptation field."""
    pes = b"\x00\x00\x01" + bytes([PRIVATE_STREAM]) + (len(unit) + 8).to_bytes(2, "big") + b"\x84\x80\x05" + _timestamp(pts) + unit
    field = 2 if access else 0  # adaptation field of the first packet
    n = -(-(len(pes) + field) // 184)
    fill = n * 184 - field - len(pes)
    out = np.zeros((n, PACKET), np.uint8)
    out[:, 0], out[:, 1], out[:, 2] = SYNC, DATA_PID >> 8, DATA_PID & 0xFF
    out[:, 3] = 0x10 | (np.arange(n) + counter & 15)
    out[0, 1] |= 0x40
    pad = np.zeros(n, np.int64)
    pad[0] += field
    pad[-1] += fill
    for i in {0, n - 1}:
        if pad[i]:
            out[i, 3] |= 0x20
            out[i, 4] = pad[i] - 1
            if pad[i] > 1:
                out[i, 5] = 0x40 if access and i == 0 else 0
                out[i, 6 : 4 + pad[i]] = 0xFF
    room = np.arange(4, PACKET) >= (4 + pad)[:, None]
    out[:, 4:][room] = np.frombuffer(pes, np.uint8)
    return out


def mux(payload: bytes, unit: int = UNIT, ticks: int = TICKS, access_every: int = ACCESS_EVERY) -> bytes:
    """A transport stream that holds ``payload``; equal payloads give equal bytes."""
    if unit > 65_527:
        raise ValueError("an access unit must fit a PES packet's length field")
    parts, counter = [_TABLES], 0
    for k, at in enumerate(range(0, len(payload), unit)):
        packets = _unit_packets(payload[at : at + unit], k * ticks & (1 << 33) - 1, k % access_every == 0, counter)
        counter += len(packets)
        parts.append(packets.tobytes())
    return b"".join(parts)


@dataclass
class Stream:
    """What ``demux`` reads from a transport stream."""

    payload: bytes
    timestamps: list[int]
    access: list[bool]
    unit_bytes: list[int]
    streams: dict[int, int]  # elementary PID to stream type
    continuity_errors: int
    packets: int
    unit_at: list[int]  # first byte of each unit in the payload


def _sections(packets: np.ndarray, body: np.ndarray) -> bytes:
    """The first complete section that starts in these packets, CRC checked."""
    data, length = b"", None
    for p, at in zip(packets, body):
        raw = p[at:].tobytes()
        if p[1] & 0x40:
            if data:
                break
            raw = raw[1 + raw[0] :]
        elif not data:
            continue
        data += raw
        if length is None and len(data) >= 3:
            length = 3 + (int.from_bytes(data[1:3], "big") & 0xFFF)
        if length is not None and len(data) >= length:
            data = data[:length]
            if crc32_mpeg(data):
                raise ValueError("a table section's CRC is wrong")
            return data
    raise ValueError("a program table is missing or cut off")


def _continuity(p: np.ndarray, has_field: np.ndarray) -> tuple[np.ndarray, int]:
    """Which of one PID's packets with a body to read, and how many breaks their counters show.

    A packet may come twice in a row, whole and alike: the second is left out. A flagged
    discontinuity is no break.
    """
    counters = p[:, 3].astype(np.int16) & 15
    step = np.diff(counters, prepend=(counters[:1] - 1)) & 15
    again = np.zeros(len(p), bool)
    for k in np.flatnonzero(step == 0):
        again[k] = k > 0 and not again[k - 1] and (p[k] == p[k - 1]).all()
    flagged = has_field & (p[:, 4] > 0) & ((p[:, 5] & 0x80) != 0)
    return ~again, int(((step != 1) & ~again & ~flagged).sum())


def demux(stream: bytes, strict: bool = True) -> Stream:
    """Read a transport stream of one program with one elementary stream.

    A ``strict`` reader refuses streams whose continuity counters show lost packets; another one
    counts the breaks and returns the units that it can still put together.
    """
    if not stream or len(stream) % PACKET:
        raise ValueError("not a whole number of packets")
    p = np.frombuffer(stream, np.uint8).reshape(-1, PACKET)
    if (p[:, 0] != SYNC).any():
        raise ValueError("a packet lacks its sync byte")
    pid = (p[:, 1].astype(np.int32) & 0x1F) << 8 | p[:, 2]
    has_field, has_body = (p[:, 3] & 0x20) != 0, (p[:, 3] & 0x10) != 0
    body = np.where(has_body, 4 + np.where(has_field, p[:, 4].astype(np.int64) + 1, 0), PACKET)

    pat = _sections(p[pid == PAT_PID], body[pid == PAT_PID])
    programs = {int.from_bytes(pat[i : i + 2], "big"): int.from_bytes(pat[i + 2 : i + 4], "big") & 0x1FFF for i in range(8, len(pat) - 4, 4)}
    pmt_pid = next(v for k, v in programs.items() if k)
    pmt = _sections(p[pid == pmt_pid], body[pid == pmt_pid])
    streams, i = {}, 12 + (int.from_bytes(pmt[10:12], "big") & 0xFFF)
    while i < len(pmt) - 4:
        streams[int.from_bytes(pmt[i + 1 : i + 3], "big") & 0x1FFF] = pmt[i]
        i += 5 + (int.from_bytes(pmt[i + 3 : i + 5], "big") & 0xFFF)

    errors, read = 0, has_body.copy()
    for k in [PAT_PID, pmt_pid, *streams]:
        at = np.flatnonzero((pid == k) & has_body)
        read[at], breaks = _continuity(p[at], has_field[at])
        errors += breaks
    own = np.flatnonzero((pid == next(iter(streams))) & read)
    errors += len(own) > 0 and not p[own[0], 1] & 0x40  # the first packet left starts no unit
    if errors and strict:
        raise ValueError(f"continuity counters show {errors} breaks: packets are lost")
    q, at = p[own], body[own]
    kept = np.arange(PACKET) >= at[:, None]
    data, sizes = q[kept].tobytes(), PACKET - at
    starts = np.flatnonzero(q[:, 1] & 0x40)
    ends = np.concatenate([[0], np.cumsum(sizes)])
    flags = has_field[own] & (q[:, 4] > 0) & ((q[:, 5] & 0x40) != 0)
    units, stamps, access = [], [], []
    for k, first in enumerate(starts):
        pes = data[ends[first] : ends[starts[k + 1]] if k + 1 < len(starts) else len(data)]
        if pes[:3] != b"\x00\x00\x01":
            raise ValueError("a PES packet lacks its start code")
        length = int.from_bytes(pes[4:6], "big")
        unit = pes[9 + pes[8] : 6 + length if length else len(pes)]
        if length and len(pes) < 6 + length:
            if strict:
                raise ValueError("a PES packet is cut off")
            continue
        if pes[7] & 0x80:
            b = pes[9:14]
            stamps.append((b[0] >> 1 & 7) << 30 | int.from_bytes(b[1:3], "big") >> 1 << 15 | int.from_bytes(b[3:5], "big") >> 1)
        access.append(bool(flags[first]))
        units.append(unit)
    sizes = [len(u) for u in units]
    return Stream(b"".join(units), stamps, access, sizes, streams, errors, len(p), list(accumulate(sizes, initial=0))[:-1])


def aligned(text: bytes) -> bytes:
    """Bytes padded with zeros to a positive multiple of ``ALIGN``."""
    return text + bytes(-len(text) % ALIGN or (ALIGN if not text else 0))


def with_media(docs: DataFrame, text_col: str = "text", media_col: str = "media") -> DataFrame:
    """doc_id, n_bytes and the text's transport stream as a binary column; null counts as empty."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [x or b"" for x in batch.column(1).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array([mux(aligned(t)) for t in texts], pa.binary())],
                names=["doc_id", "n_bytes", media_col],
            )

    return common.map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text_col).alias("text")), f"doc_id long, n_bytes long, {media_col} binary", encode)


FEATURES = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, continuity_errors long, access_points long, first_pts long, last_pts long, points array<struct<pts:bigint,byte:bigint>>"


def media_features(media: DataFrame, media_col: str = "media") -> DataFrame:
    """Features of stored transport streams, computed from the payload that is read back.

    ``points`` holds the timestamp and first payload byte of each random-access point. A stream
    with lost packets is refused.
    """

    def describe(doc_id, n_bytes, raw: bytes) -> tuple:
        s = demux(raw)
        if len(s.payload) != max(ALIGN, -(-n_bytes // ALIGN) * ALIGN):
            raise ValueError(f"document {doc_id}: units are missing at the stream's end")
        used = np.frombuffer(s.payload, np.uint8)
        levels = np.bincount(used >> 5, minlength=8)
        text = f"packets={s.packets};units={len(s.unit_bytes)};access={sum(s.access)};streams={','.join(f'{k:#x}:{v:#x}' for k, v in s.streams.items())};levels={'/'.join(map(str, levels))}"
        return (doc_id, n_bytes, len(s.payload), hashlib.sha256(s.payload).hexdigest(), zlib.crc32(s.payload[-ALIGN:]), len(raw), hashlib.sha256(raw).hexdigest(), text, s.continuity_errors, sum(s.access), s.timestamps[0] if s.timestamps else None, s.timestamps[-1] if s.timestamps else None, [{"pts": t, "byte": at} for t, at, a in zip(s.timestamps, s.unit_at, s.access) if a])

    names = [c.split()[0] for c in FEATURES.split(", ")]
    kinds = {"string": pa.string(), "long": pa.int64(), "array<struct<pts:bigint,byte:bigint>>": pa.list_(pa.struct([("pts", pa.int64()), ("byte", pa.int64())]))}
    types = [kinds[c.split()[1]] for c in FEATURES.split(", ")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [describe(*x) for x in zip(*(batch.column(i).to_pylist() for i in range(3)))]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * len(types), types)], names=names)

    return common.map_arrow(media.select("doc_id", "n_bytes", media_col), FEATURES, read)
