"""Matroska: texts to audio files of 8-bit samples, and files to packet tables.

`parse` reads any Matroska file: variable-length element ids and sizes, segments and clusters of unknown size, SimpleBlocks and BlockGroups, all four lacings (none, Xiph, fixed, EBML), tracks and cues. Every frame becomes a row with its track, timestamp and byte range. `write` makes a file with one PCM track: an info and a tracks element, clusters of laced SimpleBlocks, and cues that point to each cluster.

`packets` and `cues` give these tables for a column of files. Broken input: elements that reach beyond the end are cut there, a file without a segment has no packets, null content has none. Null text counts as empty and equal texts give equal files. Repeated rows are separate; empty tables give empty tables; other columns are not read.
"""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import col, pieces, table, utf8

EBML, SEGMENT, INFO, TRACKS, CLUSTER, CUES = 0x1A45DFA3, 0x18538067, 0x1549A966, 0x1654AE6B, 0x1F43B675, 0x1C53BB6B
SCALE, TIMESTAMP, SIMPLE, GROUP, BLOCK, DURATION = 0x2AD7B1, 0xE7, 0xA3, 0xA0, 0xA1, 0x9B
ENTRY, NUMBER, KIND, CODEC, AUDIO, RATE, CHANNELS, DEPTH, DEFAULT = 0xAE, 0xD7, 0x83, 0x86, 0xE1, 0xB5, 0x9F, 0x6264, 0x23E383
POINT, CUETIME, POSITIONS, CUETRACK, CUECLUSTER = 0xBB, 0xB3, 0xB7, 0xF7, 0xF1
#: Elements at the level of clusters: one of them ends a cluster of unknown size.
TOP = {INFO, TRACKS, CLUSTER, CUES, 0x114D9B74, 0x1941A469, 0x1043A770, 0x1254C367}
UNIT, FRAME, LACE, BLOCKS, HERTZ = 64, 512, 8, 32, 8000


def _id(n: int) -> bytes:
    return n.to_bytes((n.bit_length() + 7) // 8, "big")


def _size(n: int) -> bytes:
    """The shortest size whose bits are not all set, which would mean unknown."""
    width = 1
    while n >= (1 << 7 * width) - 1:
        width += 1
    return (n | 1 << 7 * width).to_bytes(width, "big")


def _element(kind: int, body: bytes) -> bytes:
    return _id(kind) + _size(len(body)) + body


def _uint(kind: int, n: int) -> bytes:
    return _element(kind, n.to_bytes(max(1, (n.bit_length() + 7) // 8), "big"))


def _signed_size(n: int) -> bytes:
    """A difference of sizes in EBML lacing."""
    width = 1
    while not -(1 << 7 * width - 1) < n < 1 << 7 * width - 1:
        width += 1
    return (n + (1 << 7 * width - 1) - 1 | 1 << 7 * width).to_bytes(width, "big")


def _block(track: int, at: int, frames: list[bytes]) -> bytes:
    sizes = [len(f) for f in frames]
    head = _size(track) + struct.pack(">h", at)
    if len(frames) == 1:
        return head + b"\x80" + frames[0]
    if len(set(sizes)) == 1:
        return b"".join((head, b"\x84", bytes([len(frames) - 1]), *frames))
    lace = _size(sizes[0]) + b"".join(_signed_size(b - a) for a, b in zip(sizes, sizes[1:-1]))
    return b"".join((head, b"\x86", bytes([len(frames) - 1]), lace, *frames))


def write(payload: bytes) -> bytes:
    """A Matroska file that holds the payload as samples of one PCM track."""
    frames = [payload[i : i + FRAME] for i in range(0, len(payload), FRAME)]
    audio = _element(RATE, struct.pack(">d", HERTZ)) + _uint(CHANNELS, 1) + _uint(DEPTH, 8)
    step = FRAME * 1000 // HERTZ
    entry = _uint(NUMBER, 1) + _uint(0x73C5, 1) + _uint(KIND, 2) + _uint(DEFAULT, step * 1_000_000) + _element(CODEC, b"A_PCM/INT/LIT") + _element(AUDIO, audio)
    parts = [_element(INFO, _uint(SCALE, 1_000_000) + _element(0x4D80, b"glyphloom") + _element(0x5741, b"glyphloom")), _element(TRACKS, _element(ENTRY, entry))]
    place, cues = sum(map(len, parts)), []
    for i in range(0, len(frames), LACE * BLOCKS):
        start = i * step
        blocks = [_element(SIMPLE, _block(1, (j - i) * step, frames[j : min(j + LACE, i + LACE * BLOCKS)])) for j in range(i, min(i + LACE * BLOCKS, len(frames)), LACE)]
        parts.append(_element(CLUSTER, b"".join((_uint(TIMESTAMP, start), *blocks))))
        cues.append(_element(POINT, _uint(CUETIME, start) + _element(POSITIONS, _uint(CUETRACK, 1) + _uint(CUECLUSTER, place))))
        place += len(parts[-1])
    parts.append(_element(CUES, b"".join(cues)))
    header = _uint(0x4286, 1) + _uint(0x42F7, 1) + _uint(0x42F2, 4) + _uint(0x42F3, 8) + _element(0x4282, b"matroska") + _uint(0x4287, 4) + _uint(0x4285, 2)
    return _element(EBML, header) + _element(SEGMENT, b"".join(parts))


def _vint(data: bytes, at: int, keep: bool = False) -> tuple[int | None, int]:
    """The value (None: unknown size) and the place after it; keep leaves the length marker, as ids have it. Raises IndexError at the end."""
    first = data[at]
    width = 9 - first.bit_length()
    if width > 8 or at + width > len(data):
        raise IndexError
    n = int.from_bytes(data[at : at + width], "big")
    if keep:
        return n, at + width
    n &= (1 << 7 * width) - 1
    return (None if n == (1 << 7 * width) - 1 else n), at + width


def elements(data: bytes, start: int, end: int, unknown=()):
    """(id, start, end) of the bodies between start and end; a body of unknown size ends before the next element with an id in unknown."""
    at = start
    while at < end:
        try:
            kind, after = _vint(data, at, True)
            size, body = _vint(data, after)
        except IndexError:
            return
        if size is None:
            stop = _until(data, body, end, unknown)
        else:
            stop = min(body + size, end)
        yield kind, body, stop
        at = stop


def _until(data: bytes, at: int, end: int, kinds) -> int:
    if not kinds:
        return end
    while at < end:
        try:
            kind, after = _vint(data, at, True)
            size, body = _vint(data, after)
        except IndexError:
            return end
        if kind in kinds or kind == SEGMENT or kind == EBML:
            return at
        if size is None:
            return end
        at = body + size
    return end


def _number(data: bytes, a: int, b: int) -> int:
    return int.from_bytes(data[a:b], "big")


def _lacing(data: bytes, at: int, end: int, kind: int) -> list[tuple[int, int]]:
    """(offset, length) of the frames of a block whose body begins at `at`; kind: 0 none, 1 Xiph, 2 fixed, 3 EBML."""
    if kind == 0:
        return [(at, end - at)]
    n, at, sizes = data[at] + 1, at + 1, []
    if kind == 2:
        sizes = [(end - at) // n] * n
    elif kind == 1:
        for _ in range(n - 1):
            size = 0
            while data[at] == 255:
                size, at = size + 255, at + 1
            sizes.append(size + data[at])
            at += 1
    elif n > 1:
        first, at = _vint(data, at)
        sizes.append(first or 0)
        for _ in range(n - 2):
            width = 9 - data[at].bit_length()
            raw, at = _vint(data, at)
            raw = (1 << 7 * width) - 1 if raw is None else raw
            sizes.append(sizes[-1] + raw - ((1 << 7 * width - 1) - 1))
    if kind != 2:
        sizes.append(end - at - sum(sizes))
    out = []
    for size in sizes:
        size = max(0, min(size, end - at))
        out.append((at, size))
        at += size
    return out


def parse(data: bytes) -> tuple[list[tuple], list[tuple], dict[int, dict]]:
    """Packets (cluster, block, frame, track, timestamp_ns, key, lacing, offset, length), cues (timestamp_ns, track, cluster_offset) and tracks by number.

    Later frames of a lace are spaced by the track's default duration, if it has one.
    """
    packets, cues, tracks, scale = [], [], {}, 1_000_000
    cluster = -1
    for kind, a, b in elements(data, 0, len(data), {EBML, SEGMENT}):
        if kind != SEGMENT:
            continue
        origin = a
        for kind, a, b in elements(data, a, b, TOP):
            if kind == INFO:
                scale = next((_number(data, x, y) for k, x, y in elements(data, a, b) if k == SCALE), scale)
            elif kind == TRACKS:
                for k, x, y in elements(data, a, b):
                    if k == ENTRY:
                        track = {}
                        for k2, x2, y2 in elements(data, x, y):
                            if k2 in (NUMBER, KIND, DEFAULT):
                                track[k2] = _number(data, x2, y2)
                            elif k2 == CODEC:
                                track[k2] = data[x2:y2].decode("latin-1")
                        tracks[track.get(NUMBER, 0)] = track
            elif kind == CUES:
                for k, x, y in elements(data, a, b):
                    if k != POINT:
                        continue
                    time, spots = 0, []
                    for k2, x2, y2 in elements(data, x, y):
                        if k2 == CUETIME:
                            time = _number(data, x2, y2)
                        elif k2 == POSITIONS:
                            spots.append({k3: _number(data, x3, y3) for k3, x3, y3 in elements(data, x2, y2)})
                    cues += [(time * scale, s.get(CUETRACK, 0), origin + s.get(CUECLUSTER, 0)) for s in spots]
            elif kind == CLUSTER:
                cluster, block, base = cluster + 1, -1, 0
                for k, x, y in elements(data, a, b, TOP):
                    if k == TIMESTAMP:
                        base = _number(data, x, y)
                        continue
                    simple, duration = k == SIMPLE, None
                    if k == GROUP:
                        inner = list(elements(data, x, y))
                        duration = next((_number(data, p, q) for k2, p, q in inner if k2 == DURATION), None)
                        refers = any(k2 == 0xFB for k2, _, _ in inner)
                        found = next(((p, q) for k2, p, q in inner if k2 == BLOCK), None)
                        if not found:
                            continue
                        x, y = found
                    elif not simple:
                        continue
                    block += 1
                    try:
                        number, at = _vint(data, x)
                        relative, flags = struct.unpack_from(">hB", data, at)
                        lacing = flags >> 1 & 3
                        frames = _lacing(data, at + 3, y, lacing)
                    except (IndexError, struct.error):
                        continue
                    key = bool(flags & 0x80) if simple else not refers
                    time = (base + relative) * scale
                    step = tracks.get(number, {}).get(DEFAULT) or (duration * scale // len(frames) if duration else 0)
                    packets += [(cluster, block, i, number, time + i * step, key, lacing, at, n) for i, (at, n) in enumerate(frames)]
    return packets, cues, tracks


def read_back(data: bytes, track: int = 1) -> tuple[bytes, list[tuple]]:
    packets = [p for p in parse(data)[0] if p[3] == track]
    return b"".join(data[p[7] : p[7] + p[8]] for p in packets), packets


PACKETS = "cluster long, block long, frame long, track long, timestamp_ns long, is_key boolean, lacing long, offset long, length long"
CUE_ROWS = "timestamp_ns long, track long, cluster_offset long"
#: Rows handed on at a time: a file has many packets.
ROWS = 50_000


def _table(df: DataFrame, key: str, content: str, schema: str, part: int, texts: bool = False) -> DataFrame:
    """(key, ...): the packets (part 0) or cues (1) of each file; key keeps its type. texts: content is text (null: empty), of which the file is made here, one at a time: a step before that makes them would hold batches of files in workers of its own."""
    rows = df.select(col(key).alias("key"), col(content).cast("binary").alias("content"))
    names = [x.split()[0] for x in schema.split(", ")]
    kinds = [pa.bool_() if x.endswith("boolean") else pa.int64() for x in schema.split(", ")]

    def run(parts):
        for batch in pieces(parts, 100):
            keys = batch.column(0)
            for i, file in enumerate(batch.column(1)):
                data = write(pad(file.as_py() or b"")) if texts else file.as_py()
                found = parse(data)[part] if data is not None else []
                for at in range(0, len(found), ROWS):
                    some = found[at : at + ROWS]
                    yield pa.RecordBatch.from_arrays([keys.take(pa.array([i] * len(some), pa.int64())), *(pa.array(c, t) for c, t in zip(zip(*some), kinds))], ["key", *names])

    return rows.mapInArrow(run, f"key {rows.schema['key'].dataType.simpleString()}, {schema}")


def packets(df: DataFrame, key: str, content: str, texts: bool = False) -> DataFrame:
    return _table(df, key, content, PACKETS, 0, texts)


def cues(df: DataFrame, key: str, content: str, texts: bool = False) -> DataFrame:
    return _table(df, key, content, CUE_ROWS, 1, texts)


def files(docs: DataFrame) -> DataFrame:
    """(doc_id, content): each text, padded, as a Matroska file."""

    def run(parts):
        for batch in pieces(parts, 100):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([write(pad(x.as_py())) for x in batch.column(1)], pa.binary())], ["doc_id", "content"])

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), utf8().alias("raw")).mapInArrow(run, "doc_id long, content binary")


def pad(raw: bytes) -> bytes:
    return raw + b"\0" * (-len(raw) % UNIT if raw else UNIT)


def feature(payload: bytes, rows: list[tuple]) -> str:
    """Counts of packets and clusters, duration, mean, energy and crossings of the mid level, in integers."""
    x = np.frombuffer(payload, np.uint8).astype(np.int64)
    up = x >= 128
    return f"packets={len(rows)};clusters={rows[-1][0] + 1 if rows else 0};ms={len(x) * 1000 // HERTZ};sum={int(x.sum())};energy={int((x * x).sum())};crossings={int((up[1:] != up[:-1]).sum())}"


SCHEMA = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def digests(docs: DataFrame) -> DataFrame:
    """Stores each text in a file and tells what the file, as read back, holds."""

    def run(parts):
        for batch in pieces(parts):
            out = []
            for key, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                raw = raw.as_py()
                media = write(pad(raw))
                payload, rows = read_back(media)
                out.append((key, len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-UNIT:]), len(media), hashlib.sha256(media).hexdigest(), feature(payload, rows)))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [()] * 8, kinds)], [x.split()[0] for x in SCHEMA.split(", ")])

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), utf8().alias("raw")).mapInArrow(run, SCHEMA)


def query(spark, sf_dir):
    return digests(table(spark, sf_dir, "documents").select("doc_id", "text"))


def packet_query(spark, sf_dir):
    """The packet table of all documents' files."""
    return packets(table(spark, sf_dir, "documents"), "doc_id", "text", texts=True).select("key", "cluster", "block", "frame", "timestamp_ns", "length")


def cue_query(spark, sf_dir):
    """The cues of all documents' files."""
    return cues(table(spark, sf_dir, "documents"), "doc_id", "text", texts=True).select("key", "timestamp_ns", "track")


_BYTES = f"SELECT doc_id, (greatest(1, (strlen(coalesce(text, '')) + {UNIT - 1}) // {UNIT}) * {UNIT})::BIGINT AS n FROM documents"
_STEP = FRAME * 1000 // HERTZ * 1_000_000
PACKET_SQL = f"""
WITH b AS ({_BYTES}), f AS (SELECT doc_id, n, unnest(range((n + {FRAME - 1}) // {FRAME})) AS i FROM b)
SELECT doc_id AS key, (i // {LACE * BLOCKS})::BIGINT AS cluster, (i % {LACE * BLOCKS} // {LACE})::BIGINT AS block, (i % {LACE})::BIGINT AS frame, (i * {_STEP})::BIGINT AS timestamp_ns, least({FRAME}, n - i * {FRAME})::BIGINT AS length FROM f
"""
CUE_SQL = f"""
WITH b AS ({_BYTES}) SELECT doc_id AS key, (unnest(range((n + {FRAME * LACE * BLOCKS - 1}) // {FRAME * LACE * BLOCKS})) * {LACE * BLOCKS * _STEP})::BIGINT AS timestamp_ns, 1::BIGINT AS track FROM b
"""
