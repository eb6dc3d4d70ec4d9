"""Baseline JPEG columns: parse markers, Huffman-decode scans, and keep dimensions with DC-only luminance thumbnails.

Decoding runs over many restart intervals at once: every interval is a lane of numpy arrays, so a step decodes one
coefficient of each. `pack` stores any bytes losslessly as quantised coefficients, 192 to an MCU of three 8x8 blocks,
with a restart interval of one MCU; `decode` reads any baseline (SOF0, 8-bit, Huffman) image.

Edge cases: null and empty text are one unit of blanks; a null id passes through; equal texts give equal bytes and
features; a file that isn't baseline JPEG, is cut off or damaged raises `ValueError` in `decode` and gives null
features and the reason in `thumbnails`; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import arrow_map
from .textarrays import groups

UNIT = 192
#: What ends entropy-coded bytes: a marker that is no restart.
_NEXT = re.compile(rb"\xff[\x01-\xcf\xd8-\xfe]")
#: Bytes that texts use most come first; they get the smallest coefficients.
_ORDER = bytes(dict.fromkeys(b" etaonihsrdlcumwfgypbvkjxqz.,\n" + bytes(range(256))))
_BYTE_TO_COEF = np.zeros(256, np.int64)
_BYTE_TO_COEF[np.frombuffer(_ORDER, np.uint8)] = (np.arange(256) // 2 + 1) * np.where(np.arange(256) % 2 == 0, 1, -1)
_COEF_TO_BYTE = np.full(2048, -1, np.int64)
_COEF_TO_BYTE[_BYTE_TO_COEF + 1024] = np.arange(256)
#: Code length of each size of coefficient from 1 to 8; the code of all ones stays free, as the format asks.
_LENGTHS = (2, 2, 2, 3, 4, 5, 6, 7)


def _codes(lengths: list[int]) -> list[int]:
    """Canonical codes for lengths in ascending order."""
    out, code, last = [], 0, lengths[0]
    for n in lengths:
        code <<= n - last
        out.append(code)
        code, last = code + 1, n
    return out


_SIZE = np.array([int(abs(c)).bit_length() for c in _BYTE_TO_COEF])
_EXTRA = np.where(_BYTE_TO_COEF > 0, _BYTE_TO_COEF, _BYTE_TO_COEF + (1 << _SIZE) - 1)
_WORD = (np.array(_codes(list(_LENGTHS)))[_SIZE - 1] << _SIZE) | _EXTRA
_BITS = np.array(_LENGTHS)[_SIZE - 1] + _SIZE


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


def _header(units: int, cols: int, rows: int) -> bytes:
    counts = bytes(_LENGTHS.count(n) for n in range(1, 17))
    table = b"".join(_segment(0xC4, bytes([kind]) + counts + bytes(range(1, 9))) for kind in (0x00, 0x10))
    frame = struct.pack(">BHHB", 8, 8 * rows, 8 * cols, 3) + b"".join(bytes([c, 0x11, 0]) for c in (1, 2, 3))
    scan = bytes([3, 1, 0, 2, 0, 3, 0, 0, 63, 0])
    return b"".join([b"\xff\xd8", _segment(0xFE, b"units=%d" % units), _segment(0xDB, b"\0" + b"\1" * 64), _segment(0xC0, frame), table, _segment(0xDD, struct.pack(">H", 1)), _segment(0xDA, scan)])


def _shape(units: int) -> tuple[int, int]:
    cols = max(min(units, 16), -(-units // 8191))
    return cols, -(-units // cols)


def padded(data: bytes) -> bytes:
    return data + b" " * (max(-(-len(data) // UNIT), 1) * UNIT - len(data))


def pack(payloads: list[bytes]) -> list[bytes]:
    """JPEG files that hold the payloads (each a multiple of 192 bytes) as coefficients."""
    units = [len(p) // UNIT for p in payloads]
    shapes = [_shape(n) for n in units]
    cells = [c * r for c, r in shapes]
    b = np.frombuffer(b"".join(p + b" " * UNIT * (n - u) for p, u, n in zip(payloads, units, cells, strict=True)), np.uint8).reshape(-1, UNIT)
    bits = _BITS[b]
    ends = np.cumsum(bits, axis=1)
    size = (ends[:, -1] + 7) >> 3
    first = np.concatenate([[0], np.cumsum(size)])
    at = (ends - bits + 8 * first[:-1, None]).ravel()
    value = _WORD[b.ravel()] << (24 - bits.ravel() - (at & 7))
    total = int(first[-1])
    sums = np.bincount(at >> 3, value.astype(np.float64), total).astype(np.int64)
    raw = sums >> 16
    raw[1:] += (sums[:-1] >> 8) & 255
    raw[2:] += sums[:-2] & 255
    raw[first[1:] - 1] += (1 << (8 * size - ends[:, -1])) - 1
    # a stuffed zero after each 0xFF, and a restart marker before each MCU but an image's first
    image = np.repeat(np.arange(len(cells)), cells)
    place = np.arange(len(image)) - np.repeat(np.cumsum([0, *cells[:-1]]), cells)
    gap = np.zeros(total, np.int64)
    gap[first[:-1]] = np.where(place > 0, 2, 0)
    wide = 1 + (raw == 255)
    to = np.cumsum(wide + gap) - wide
    out = np.zeros(int(to[-1] + wide[-1]), np.uint8)
    out[to] = raw
    marks = to[first[:-1]][place > 0]
    out[marks - 2], out[marks - 1] = 0xFF, 0xD0 + (place[place > 0] - 1) % 8
    stops = np.append(to, len(out))[first[np.cumsum([0, *cells])]]
    return [_header(u, *s) + out[a:z].tobytes() + b"\xff\xd9" for u, s, a, z in zip(units, shapes, stops[:-1], stops[1:], strict=True)]


@dataclass(frozen=True)
class Frame:
    """What the markers of one image say; two images with equal `tables` can be decoded together."""

    width: int
    height: int
    interval: int
    comment: bytes
    tables: tuple
    scan: bytes
    most: tuple[int, int] = (1, 1)

    @property
    def parts(self) -> list[tuple[int, int, int, int, int]]:
        """Of each component of the scan: h, v, quantisation number, DC and AC table."""
        return list(self.tables[0])

    @property
    def grid(self) -> tuple[int, int]:
        """MCUs in a row, and rows; in a scan of one component an MCU is one block, and there are as many as its own size needs."""
        (h, v), (x, y) = self.most, self.parts[0][:2]
        if len(self.parts) == 1:
            return -(-(-(-self.width * x // h)) // 8), -(-(-(-self.height * y // v)) // 8)
        return -(-self.width // (8 * h)), -(-self.height // (8 * v))


def parse(data: bytes) -> Frame:
    if data[:2] != b"\xff\xd8":
        raise ValueError("no start of image")
    at, interval, comment, frame, quant, huff = 2, 0, b"", None, {}, {}
    while True:
        while at < len(data) - 3 and data[at] == 0xFF and data[at + 1] == 0xFF:
            at += 1
        if at + 4 > len(data) or data[at] != 0xFF:
            raise ValueError("a marker is missing")
        marker, size = data[at + 1], int.from_bytes(data[at + 2 : at + 4], "big")
        body = data[at + 4 : at + 2 + size]
        if len(body) != size - 2:
            raise ValueError("a segment is cut off")
        at += 2 + size
        if marker == 0xDD:
            interval = int.from_bytes(body[:2], "big")
        elif marker == 0xFE:
            comment = body
        elif marker == 0xDB:
            while body:
                n = 64 * (1 + (body[0] >> 4))
                quant[body[0] & 15] = int.from_bytes(body[1 : 1 + n // 64], "big")  # of DC
                body = body[1 + n :]
        elif marker == 0xC4:
            while body:
                n = sum(body[1:17])
                huff[body[0]] = (body[1:17], body[17 : 17 + n])
                body = body[17 + n :]
        elif marker == 0xC0:
            frame = body
        elif 0xC1 <= marker <= 0xCF and marker != 0xC8:
            raise ValueError(f"not baseline: frame {marker:#x}")
        elif marker == 0xDA:
            end = _NEXT.search(data, at)
            if not end:
                raise ValueError("no end of image")
            # the scan with the first component, which is luminance; others are passed over
            if not frame or frame[6] in body[1 : 1 + 2 * body[0] : 2]:
                break
            at = end.start()
        elif marker == 0xD9:
            raise ValueError("no scan of the first component")
    if not frame or frame[0] != 8:
        raise ValueError("no 8-bit baseline frame")
    height, width = struct.unpack(">HH", frame[1:5])
    if not height or not width:
        raise ValueError("no size")
    kinds = {frame[6 + 3 * i]: (frame[7 + 3 * i] >> 4, frame[7 + 3 * i] & 15, frame[8 + 3 * i]) for i in range(frame[5])}
    parts = tuple((*kinds[body[1 + 2 * i]][:2], quant.get(kinds[body[1 + 2 * i]][2], 1), body[2 + 2 * i] >> 4, 16 | body[2 + 2 * i] & 15) for i in range(body[0]))
    most = max(k[0] for k in kinds.values()), max(k[1] for k in kinds.values())
    return Frame(width, height, interval, comment, (parts, tuple(sorted(huff.items()))), data[at : end.start()], most)


def _lookup(counts: bytes, symbols: bytes) -> np.ndarray:
    """For each 16 bits: code length * 256 + symbol, 0 where no code begins so."""
    out, code, k = np.zeros(1 << 16, np.int64), 0, 0
    for n in range(1, 17):
        for _ in range(counts[n - 1]):
            out[code << (16 - n) : (code + 1) << (16 - n)] = n << 8 | symbols[k]
            code, k = code + 1, k + 1
        code <<= 1
    return out


def decode(frames: list[Frame]) -> list[np.ndarray]:
    """Coefficients of each image as (MCUs, blocks of an MCU, 64 in scan order); all frames have equal tables."""
    parts, tables = frames[0].parts, {k: _lookup(*v) for k, v in frames[0].tables[1]}
    blocks = [i for i, p in enumerate(parts) for _ in range(1 if len(parts) == 1 else p[0] * p[1])]
    if any(p[3] not in tables or p[4] not in tables for p in parts):
        raise ValueError("a Huffman table is missing")
    # entropy-coded bytes without stuffing; a lane for each restart interval
    data = np.frombuffer(b"".join(f.scan + b"\xff\xd0" for f in frames), np.uint8)
    after_ff = np.concatenate([[False], data[:-1] == 255])
    mark = np.flatnonzero(after_ff & (data >= 0xD0) & (data <= 0xD7))
    drop = after_ff & (data == 0)
    drop[mark] = drop[mark - 1] = True
    kept = np.concatenate([[0], np.cumsum(~drop)])
    clean = np.concatenate([data[~drop], np.full(16, 255, np.uint8)])
    word = np.ndarray((len(clean) - 7,), ">u8", clean.data, strides=(1,))
    lane_end = kept[mark]
    lane_start = np.concatenate([[0], lane_end[:-1]])
    total = [f.grid[0] * f.grid[1] for f in frames]
    lanes = [-(-n // f.interval) if f.interval else 1 for n, f in zip(total, frames, strict=True)]
    if sum(lanes) != len(mark):
        raise ValueError("restart markers don't fit the size")
    per = np.concatenate([np.minimum(f.interval or n, n - np.arange(k) * (f.interval or n)) for n, k, f in zip(total, lanes, frames, strict=True)])
    out = np.zeros((sum(total), len(blocks), 64), np.int16)
    row = np.concatenate([[0], np.cumsum(per)[:-1]])
    p, last = lane_start * 8, np.zeros((len(mark), len(parts)), np.int64)
    stop = lane_end * 8

    def symbol(at: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """High digit and value of the symbols at these bits, and the bits taken; the value is 0 where no bits follow."""
        w = word[at >> 3].astype(np.uint64) << (at & 7).astype(np.uint64)
        e = table[(w >> np.uint64(48)).astype(np.int64)]
        n, s = e >> 8, e & 15
        if not n.all():
            raise ValueError("no Huffman code fits")
        bits = ((w << n.astype(np.uint64)) >> np.uint64(1) >> (63 - s).astype(np.uint64)).astype(np.int64)
        return (e & 255) >> 4, np.where(s > 0, bits - np.where(bits < (1 << s >> 1), (1 << s) - 1, 0), 0), n + s

    for m in range(int(per.max())):
        own = np.flatnonzero(per > m)
        for b, part in enumerate(blocks):
            _, v, n = symbol(p[own], tables[parts[part][3]])
            last[own, part] += v
            out[row[own] + m, b, 0] = last[own, part]
            p[own] += n
            table, live, k = tables[parts[part][4]], own, np.ones(len(own), np.int64)
            while len(live):
                run, v, n = symbol(p[live], table)
                p[live] += n
                if (p[live] > stop[live]).any():
                    raise ValueError("the scan is cut off")
                k += run
                if (k > 63).any() and (v[k > 63] != 0).any():
                    raise ValueError("a block has too many coefficients")
                some = v != 0
                if some.all():
                    out[row[live] + m, b, k] = v
                else:
                    out[(row[live] + m)[some], b, k[some]] = v[some]
                k = np.where(some | (run == 15), k + 1, 64)
                if (k > 63).any():
                    live, k = live[k < 64], k[k < 64]
    return np.split(out, np.cumsum(total)[:-1])


def unpack(files: list[bytes]) -> list[tuple[bytes, Frame, np.ndarray]]:
    """Payload, frame and coefficients of files that `pack` made."""
    frames = [parse(f) for f in files]
    out = []
    for f, c in zip(frames, decode(frames), strict=True):
        v = _COEF_TO_BYTE[c[: int(f.comment.removeprefix(b"units="))].astype(np.int64) + 1024]
        if (v < 0).any():
            raise ValueError("not a payload")
        out.append((v.astype(np.uint8).tobytes(), f, c))
    return out


def thumbnail(frame: Frame, coefficients: np.ndarray) -> np.ndarray:
    """One grey pixel for each luminance block, from its DC alone."""
    h, v, q = (1, 1, frame.parts[0][2]) if len(frame.parts) == 1 else frame.parts[0][:3]
    cols, rows = frame.grid
    dc = coefficients[:, : h * v, 0].astype(np.int64).reshape(rows, cols, v, h).transpose(0, 2, 1, 3).reshape(rows * v, cols * h)
    return np.clip((dc * q + 4) // 8 + 128, 0, 255).astype(np.uint8)


def difference_hash(grey: np.ndarray) -> str:
    """64 bits: which of neighbouring cells of a 9x8 reduction is brighter."""
    def cut(n: int, k: int) -> list[np.ndarray]:
        edge = np.arange(k + 1) * n // k
        return [np.arange(a, max(z, a + 1)) for a, z in zip(np.minimum(edge[:-1], n - 1), edge[1:], strict=True)]

    wide = np.stack([grey[:, c].mean(1) for c in cut(grey.shape[1], 9)], axis=1)
    small = np.stack([wide[r].mean(0) for r in cut(grey.shape[0], 8)])
    return np.packbits(small[:, 1:] > small[:, :-1]).tobytes().hex()


def feature(frame: Frame, grey: np.ndarray) -> str:
    return f"{frame.width}x{frame.height}:{difference_hash(grey)}:{hashlib.sha256(grey.tobytes()).hexdigest()[:16]}"


def store(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and each text's bytes as a JPEG in column media."""

    def of_batch(cols: dict[str, list]) -> dict[str, list]:
        data = [padded((t or "").encode()) for t in cols["text"]]
        media = [m for a, b in groups([len(d) for d in data]) for m in pack(data[a:b])]
        return {"doc_id": cols["doc_id"], "n_bytes": [len((t or "").encode()) for t in cols["text"]], "media": media}

    return arrow_map(docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")), "doc_id long, n_bytes long, media binary", of_batch, 256)


def thumbnails(media: DataFrame, key: str = "doc_id", column: str = "media") -> DataFrame:
    """doc_id, width, height, thumbnail, feature, the payload if `pack` made the file, and error for what can't be read."""

    def one(data: bytes | None) -> tuple:
        try:
            f = parse(data or b"")
            grey = thumbnail(f, decode([f])[0])
            return f.width, f.height, grey.tobytes(), feature(f, grey), unpack([data])[0][0] if f.comment.startswith(b"units=") else None, None
        except (ValueError, IndexError, KeyError, struct.error) as e:
            return None, None, None, None, None, str(e)

    def of_batch(cols: dict[str, list]) -> dict[str, list]:
        rows = []
        for a, b in groups([len(m or b"") for m in cols["media"]]):
            try:
                for payload, f, c in unpack(cols["media"][a:b]):
                    grey = thumbnail(f, c)
                    rows.append((f.width, f.height, grey.tobytes(), feature(f, grey), payload, None))
            except Exception:  # noqa: BLE001  one of them is of another kind or damaged
                del rows[a:]
                rows += [one(m) for m in cols["media"][a:b]]
        names = ("width", "height", "thumbnail", "feature", "payload", "error")
        return {"doc_id": cols["doc_id"], **{n: [r[i] for r in rows] for i, n in enumerate(names)}}

    return arrow_map(media.select(F.col(key).cast("long").alias("doc_id"), F.col(column).alias("media")), "doc_id long, width int, height int, thumbnail binary, feature string, payload binary, error string", of_batch, 256)


def op8_jpeg_columns(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")

    def of_batch(cols: dict[str, list]) -> dict[str, list]:
        texts = [(t or "").encode() for t in cols["text"]]
        rows = []
        for a, b in groups([len(t) for t in texts]):
            media = pack([padded(t) for t in texts[a:b]])
            for t, m, (payload, f, c) in zip(texts[a:b], media, unpack(media), strict=True):
                rows.append((len(t), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(m), hashlib.sha256(m).hexdigest(), feature(f, thumbnail(f, c))))
        names = ("n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature")
        return {"doc_id": cols["doc_id"], **{n: [r[i] for r in rows] for i, n in enumerate(names)}}

    return arrow_map(docs, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string", of_batch, 256)
