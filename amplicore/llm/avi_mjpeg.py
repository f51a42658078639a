"""AVI motion-JPEG columns (operator 3).

Reads AVI files (RIFF chunks, the idx1 index or, without one, a walk over the movi list), decodes baseline JPEG frames
(grey or YCbCr with any sampling, restart intervals, several Huffman tables) and finds shots: a frame begins a new one
where its grey histogram differs from the last frame's by more than an adaptive limit (mean plus ``SPREAD`` deviations of
the differences before it, ``FLOOR`` at least). ``clips`` gives one row for each shot with its times.

``store_payload`` writes bytes as such a file without loss. The format's unit is the quantised coefficient: a block of 64
payload bytes is one 8x8 block whose coefficients are byte + 256, so every coefficient has size category 9; with a restart
after each block the DC prediction is always zero, and with one code word a block is 640 bits. Frames hold ``FRAME_BLOCKS``
blocks; the last is filled up, and an APP15 segment in each frame gives the payload bytes it holds. ``load_payload`` reads
them back through the index and the entropy-coded bits. Frames whose tables have a single code word are decoded together,
all others by symbol; both ways give coefficients, and an inverse DCT the samples.

Null texts count as empty. A payload is padded to a positive multiple of 64. Damaged files raise ``ValueError`` in the
functions, and give a null row in ``clips``. Equal texts give equal files.
"""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from amplicore.llm._common import arrow_pass, table

FRAME_BLOCKS, ACROSS = 32, 8
FPS = 25
SPREAD, FLOOR, BINS = 3.0, 0.25, 16
#: Order of coefficients in a block: by diagonals, the direction changing (zigzag).
ZIGZAG = np.array([y * 8 + x for s in range(15) for x, y in sorted(((x, s - x) for x in range(8) if 0 <= s - x < 8), key=lambda p: p[1] if s % 2 else p[0])])
_N = np.arange(8)
_DCT = np.cos((2 * _N[None, :] + 1) * _N[:, None] * np.pi / 16) * np.where(_N[:, None] == 0, np.sqrt(1 / 8), 0.5)
#: Coefficients (in zigzag order) of blocks times this are their samples.
_INVERSE = np.einsum("vy,ux->vuyx", _DCT, _DCT).reshape(64, 64)[ZIGZAG].astype(np.float32)


# ---- writing


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


def _frame_head(width: int, height: int) -> bytes:
    table_9 = bytes([1] + [0] * 15 + [9])  # one code word of one bit: size category 9
    return (
        _segment(0xDB, bytes([0]) + bytes([1] * 64))
        + _segment(0xC0, struct.pack(">BHHB", 8, height, width, 1) + bytes([1, 0x11, 0]))
        + _segment(0xC4, bytes([0x00]) + table_9)
        + _segment(0xC4, bytes([0x10]) + table_9)
        + _segment(0xDD, struct.pack(">H", 1))
        + _segment(0xDA, bytes([1, 1, 0x00, 0, 63, 0]))
    )


_HEAD = _frame_head(8 * ACROSS, 8 * FRAME_BLOCKS // ACROSS)


def _coded(blocks: np.ndarray) -> np.ndarray:
    """Entropy-coded bytes, 80 a block: of each coefficient a code bit 0, then the nine bits of byte + 256."""
    v = blocks.reshape(-1, 4).astype(np.uint64) + np.uint64(256)
    bits = (v[:, 0] << np.uint64(30)) | (v[:, 1] << np.uint64(20)) | (v[:, 2] << np.uint64(10)) | v[:, 3]
    out = bits.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 3:]
    return np.ascontiguousarray(out).reshape(len(blocks), 80)


def _chunk(name: bytes, body: bytes) -> bytes:
    return name + struct.pack("<I", len(body)) + body + b"\0" * (len(body) % 2)


def avi(frames: list[bytes], width: int, height: int, fps: int = FPS) -> bytes:
    """An AVI file of one motion-JPEG stream, with an index."""
    size = max(map(len, frames), default=0)
    avih = struct.pack("<14I", 1_000_000 // fps, size * fps, 0, 0x10, len(frames), 0, 1, size, width, height, 0, 0, 0, 0)
    strh = b"vidsMJPG" + struct.pack("<IHHIIIIIIIIHHHH", 0, 0, 0, 0, 1, fps, 0, len(frames), size, 0xFFFFFFFF, 0, 0, 0, width, height)
    strf = struct.pack("<IiiHH4sIiiII", 40, width, height, 1, 24, b"MJPG", width * height * 3, 0, 0, 0, 0)
    head = b"hdrl" + _chunk(b"avih", avih) + _chunk(b"LIST", b"strl" + _chunk(b"strh", strh) + _chunk(b"strf", strf))
    movi, index, at = [b"movi"], [], 4
    for f in frames:
        c = _chunk(b"00dc", f)
        index.append(struct.pack("<4sIII", b"00dc", 0x10, at, len(f)))
        movi.append(c)
        at += len(c)
    return _chunk(b"RIFF", b"AVI " + _chunk(b"LIST", head) + _chunk(b"LIST", b"".join(movi)) + _chunk(b"idx1", b"".join(index)))


def padded(payload: bytes) -> bytes:
    return payload + b"\0" * (-len(payload) % 64 or 64 * (not payload))


def store_payload(payload: bytes) -> bytes:
    """The AVI file of a payload whose length is a positive multiple of 64."""
    x = np.frombuffer(payload, np.uint8).reshape(-1, 64)
    n = len(x)
    full = np.zeros((-(-n // FRAME_BLOCKS) * FRAME_BLOCKS, 64), np.uint8)
    full[:n] = x
    coded = _coded(full)
    plain = not (coded == 0xFF).any()
    marked = np.empty((len(coded), 82), np.uint8)
    marked[:, :80], marked[:, 80] = coded, 0xFF
    marked[:, 81] = 0xD0 + np.tile(np.arange(FRAME_BLOCKS) % 8, len(coded) // FRAME_BLOCKS)
    frames = []
    for at in range(0, len(coded), FRAME_BLOCKS):
        if plain:
            scan = marked[at : at + FRAME_BLOCKS].tobytes()[:-2]
        else:
            scan = b"".join(b.tobytes().replace(b"\xff", b"\xff\x00") + bytes([0xFF, 0xD0 + i % 8]) for i, b in enumerate(coded[at : at + FRAME_BLOCKS]))[:-2]
        held = _segment(0xEF, struct.pack(">I", 64 * min(FRAME_BLOCKS, n - at)))
        frames.append(b"\xff\xd8" + held + _HEAD + scan + b"\xff\xd9")
    return avi(frames, 8 * ACROSS, 8 * FRAME_BLOCKS // ACROSS)


# ---- reading


def _chunks(data: bytes, at: int, end: int):
    while at + 8 <= end:
        size = struct.unpack_from("<I", data, at + 4)[0]
        if at + 8 + size > end:
            raise ValueError("a RIFF chunk goes beyond its list")
        yield data[at : at + 4], at + 8, size
        at += 8 + size + size % 2


def read_avi(data: bytes) -> tuple[list[bytes], float]:
    """The frames of the first motion-JPEG stream, by the index if there is one, and frames a second."""
    if data[:4] != b"RIFF" or data[8:12] != b"AVI ":
        raise ValueError("not an AVI file")
    fps, movi, index, stream, streams = 0.0, None, None, -1, 0
    for name, at, size in _chunks(data, 12, min(len(data), 8 + struct.unpack_from("<I", data, 4)[0])):
        kind = data[at : at + 4]
        if name == b"LIST" and kind == b"hdrl":
            for n2, a2, s2 in _chunks(data, at + 4, at + size):
                if n2 == b"LIST" and data[a2 : a2 + 4] == b"strl":
                    for n3, a3, _ in _chunks(data, a2 + 4, a2 + s2):
                        if n3 == b"strh" and data[a3 : a3 + 4] == b"vids" and stream < 0:
                            stream = streams
                            scale, rate = struct.unpack_from("<II", data, a3 + 20)
                            fps = rate / max(scale, 1)
                    streams += 1
        elif name == b"LIST" and kind == b"movi":
            movi = (at, size)
        elif name == b"idx1":
            index = (at, size)
    if movi is None or stream < 0:
        raise ValueError("no video stream")
    own = b"%02ddc" % stream
    if index is None:
        return [data[a : a + s] for n, a, s in _chunks(data, movi[0] + 4, movi[0] + movi[1]) if n in (own, own[:2] + b"db")], fps
    entries = [struct.unpack_from("<4sIII", data, at) for at in range(index[0], index[0] + index[1] - 15, 16)]
    entries = [e for e in entries if e[0] in (own, own[:2] + b"db")]
    base = movi[0] if not entries or data[movi[0] + entries[0][2] : movi[0] + entries[0][2] + 4] == entries[0][0] else 0  # some files count from the file's start
    return [data[base + off + 8 : base + off + 8 + size] for _, _, off, size in entries], fps


class Jpeg:
    """The segments of a baseline JPEG: size, components, tables, restart interval, scan bytes and APP15 body."""

    def __init__(self, data: bytes) -> None:
        if data[:2] != b"\xff\xd8":
            raise ValueError("not a JPEG")
        self.quant: dict[int, np.ndarray] = {}
        self.huffman: dict[int, tuple[bytes, bytes]] = {}
        self.restart, self.note, self.scan = 0, b"", b""
        self.parts: list[list[int]] = []
        at = 2
        while at + 4 <= len(data):
            if data[at] != 0xFF:
                raise ValueError("a marker is missing")
            marker, size = data[at + 1], struct.unpack_from(">H", data, at + 2)[0]
            body = data[at + 4 : at + 2 + size]
            at += 2 + size
            if marker == 0xDB:
                while body:
                    wide = body[0] >> 4
                    self.quant[body[0] & 15] = np.frombuffer(body[1 : 1 + 64 * (1 + wide)], ">u2" if wide else np.uint8).astype(np.float32)
                    body = body[1 + 64 * (1 + wide) :]
            elif marker in (0xC0, 0xC1):
                _, self.height, self.width, n = struct.unpack_from(">BHHB", body)
                self.parts = [[body[6 + 3 * i], body[7 + 3 * i] >> 4, body[7 + 3 * i] & 15, body[8 + 3 * i], 0, 0] for i in range(n)]
            elif 0xC2 <= marker <= 0xCF and marker not in (0xC4, 0xC8, 0xCC):
                raise ValueError("only baseline JPEG is decoded")
            elif marker == 0xC4:
                while body:
                    n = sum(body[1:17])
                    self.huffman[body[0]] = (body[1:17], body[17 : 17 + n])
                    body = body[17 + n :]
            elif marker == 0xDD:
                self.restart = struct.unpack(">H", body[:2])[0]
            elif marker == 0xEF:
                self.note = body
            elif marker == 0xDA:
                for i in range(body[0]):
                    for p in self.parts:
                        if p[0] == body[1 + 2 * i]:
                            p[4], p[5] = body[2 + 2 * i] >> 4, body[2 + 2 * i] & 15
                end = data.rfind(b"\xff\xd9")
                self.scan = data[at : end if end >= at else len(data)]
                break
        if not self.parts or not self.scan:
            raise ValueError("no scan")

    @property
    def one_code(self) -> bool:
        one = (bytes([1] + [0] * 15), bytes([9]))
        p = self.parts
        return len(p) == 1 and p[0][1:3] == [1, 1] and self.restart == 1 and self.huffman.get(p[0][4]) == one and self.huffman.get(16 + p[0][5]) == one


def _one_code_blocks(scan: bytes) -> np.ndarray:
    """Coefficients of a scan with one code word and a restart after each block."""
    x = np.frombuffer(scan, np.uint8)
    if len(x) % 82 == 80 and not (x[np.arange(len(x)) % 82 < 80] == 0xFF).any():
        coded = np.append(x, np.zeros(2, np.uint8)).reshape(-1, 82)[:, :80]
    else:
        at = np.flatnonzero((x[:-1] == 0xFF) & (x[1:] >= 0xD0) & (x[1:] <= 0xD7))
        cuts = [0, *(at + 2).tolist()], [*at.tolist(), len(x)]
        parts = [scan[a:b].replace(b"\xff\x00", b"\xff") for a, b in zip(*cuts, strict=True)]
        if any(len(p) != 80 for p in parts):
            raise ValueError("a block isn't whole")
        coded = np.frombuffer(b"".join(parts), np.uint8).reshape(-1, 80)
    five = np.zeros((coded.shape[0] * 16, 8), np.uint8)
    five[:, 3:] = coded.reshape(-1, 5)
    bits = five.view(">u8").astype(np.uint64).ravel()
    v = np.stack([bits >> np.uint64(30), bits >> np.uint64(20), bits >> np.uint64(10), bits], 1) & np.uint64(1023)
    if (v < 256).any() or (v > 511).any():
        raise ValueError("a code word isn't in the table")
    return v.astype(np.int16).reshape(-1, 64)


def _any_blocks(j: Jpeg) -> list[np.ndarray]:
    """Coefficients of each component, by blocks across and down the whole MCU grid."""
    lookup = {}
    for key, (counts, symbols) in j.huffman.items():
        code, k, codes = 0, 0, {}
        for length in range(1, 17):
            for _ in range(counts[length - 1]):
                codes[length, code] = symbols[k]
                code, k = code + 1, k + 1
            code <<= 1
        lookup[key] = codes
    h_max, v_max = max(p[1] for p in j.parts), max(p[2] for p in j.parts)
    across, down = -(-j.width // (8 * h_max)), -(-j.height // (8 * v_max))
    if len(j.parts) == 1:
        j.parts[0][1] = j.parts[0][2] = h_max = v_max = 1
        across, down = -(-j.width // 8), -(-j.height // 8)
    out = [np.zeros((down * p[2], across * p[1], 64), np.int16) for p in j.parts]
    parts, at = [], 0
    for i in range(len(j.scan) - 1):
        if j.scan[i] == 0xFF and 0xD0 <= j.scan[i + 1] <= 0xD7:
            parts.append(j.scan[at:i])
            at = i + 2
    parts.append(j.scan[at:])
    mcu = 0
    for part in parts:
        raw = part.replace(b"\xff\x00", b"\xff")
        value, left = int.from_bytes(raw, "big"), 8 * len(raw)
        pred = [0] * len(j.parts)

        def take(n: int) -> int:
            nonlocal left
            left -= n
            if left < 0:
                raise ValueError("the scan ends early")
            return value >> left & (1 << n) - 1

        def symbol(codes: dict) -> int:
            code = 0
            for length in range(1, 17):
                code = code << 1 | take(1)
                if (s := codes.get((length, code))) is not None:
                    return s
            raise ValueError("a code word isn't in the table")

        def signed(n: int) -> int:
            v = take(n) if n else 0
            return v if not n or v >> n - 1 else v - (1 << n) + 1

        for _ in range(min(j.restart or across * down, across * down - mcu)):
            for k, p in enumerate(j.parts):
                for b in range(p[1] * p[2]):
                    block = out[k][mcu // across * p[2] + b // p[1], mcu % across * p[1] + b % p[1]]
                    pred[k] += signed(symbol(lookup[p[4]]))
                    block[0] = pred[k]
                    i = 1
                    while i < 64:
                        s = symbol(lookup[16 + p[5]])
                        if not s & 15:
                            if s != 0xF0:
                                break
                            i += 16
                            continue
                        i += s >> 4
                        if i > 63:
                            raise ValueError("a block is too long")
                        block[i] = signed(s & 15)
                        i += 1
            mcu += 1
    if mcu < across * down:
        raise ValueError("the scan ends early")
    return out


def _samples(blocks: np.ndarray, quant: np.ndarray) -> np.ndarray:
    return np.clip(np.rint((blocks.reshape(-1, 64) * quant) @ _INVERSE + 128), 0, 255).astype(np.uint8)


def decode_frame(data: bytes) -> np.ndarray:
    """Samples of a frame: height x width (grey) or height x width x 3 (RGB)."""
    j = Jpeg(data)
    planes = []
    blocks = _any_blocks(j)
    h_max, v_max = max(p[1] for p in j.parts), max(p[2] for p in j.parts)
    for p, b in zip(j.parts, blocks, strict=True):
        down, across = b.shape[:2]
        plane = _samples(b, j.quant[p[3]]).reshape(down, across, 8, 8).transpose(0, 2, 1, 3).reshape(8 * down, 8 * across)
        planes.append(plane.repeat(v_max // p[2], 0).repeat(h_max // p[1], 1)[: j.height, : j.width])
    if len(planes) == 1:
        return planes[0]
    y, cb, cr = (x.astype(np.float32) for x in planes[:3])
    rgb = np.stack([y + 1.402 * (cr - 128), y - 0.344136 * (cb - 128) - 0.714136 * (cr - 128), y + 1.772 * (cb - 128)], 2)
    return np.clip(np.rint(rgb), 0, 255).astype(np.uint8)


def load(data: bytes) -> tuple[bytes, np.ndarray, float]:
    """The payload that store_payload put into a file, histograms of its frames (shares), and frames a second."""
    frames, fps = read_avi(data)
    heads = [Jpeg(f) for f in frames]
    if not all(h.one_code for h in heads):
        raise ValueError("the file holds no payload")
    blocks = [_one_code_blocks(h.scan) for h in heads]
    payload = b"".join((b.ravel() - 256).astype(np.uint8).tobytes()[: struct.unpack(">I", h.note)[0]] for h, b in zip(heads, blocks, strict=True))
    samples = _samples(np.concatenate(blocks), heads[0].quant[0]).reshape(len(frames), -1)
    return payload, histograms(samples), fps


def load_payload(data: bytes) -> bytes:
    return load(data)[0]


def histograms(frames: np.ndarray) -> np.ndarray:
    """Shares of BINS equal ranges of grey values, by frame (frames x samples)."""
    n = len(frames)
    at = (frames >> np.uint8(4)).astype(np.int64) + BINS * np.arange(n)[:, None]
    return np.bincount(at.ravel(), minlength=n * BINS).reshape(n, BINS) / frames.shape[1]


def shots(hist: np.ndarray) -> list[int]:
    """Frames at which shots begin."""
    begins = [0]
    diffs: list[float] = []
    for i in range(1, len(hist)):
        d = float(np.abs(hist[i] - hist[i - 1]).sum()) / 2
        limit = max(FLOOR, float(np.mean(diffs) + SPREAD * np.std(diffs))) if diffs else FLOOR
        if d > limit:
            begins.append(i)
            diffs = []
        else:
            diffs.append(d)
    return begins if len(hist) else []


def clips(media: DataFrame, id_col: str, data_col: str) -> DataFrame:
    """One row for each shot: id, clip, start_s, end_s, frames, width, height, mean_grey; one with nulls for a damaged file."""

    def run(part: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {k: [] for k in ("id", "clip", "start_s", "end_s", "frames", "width", "height", "mean_grey")}
        for key, data in zip(part["id"], part["data"], strict=True):
            try:
                frames, fps = read_avi(data)
                grey = [f if f.ndim == 2 else (f @ np.array([0.299, 0.587, 0.114])).astype(np.uint8) for f in map(decode_frame, frames)]
                hist = np.concatenate([histograms(g.reshape(1, -1)) for g in grey]) if grey else np.empty((0, BINS))
            except (ValueError, TypeError, KeyError, IndexError, struct.error):
                for k, v in zip(out, (key, *[None] * 7), strict=True):
                    out[k].append(v)
                continue
            begins = shots(hist)
            for k, (a, b) in enumerate(zip(begins, [*begins[1:], len(grey)], strict=True)):
                row = (key, k, a / fps, b / fps, b - a, grey[a].shape[1], grey[a].shape[0], float(np.mean([g.mean() for g in grey[a:b]])))
                for name, v in zip(out, row, strict=True):
                    out[name].append(v)
        return out

    kind = media.schema[id_col].dataType.simpleString()
    return arrow_pass(media.select(F.col(id_col).alias("id"), F.col(data_col).alias("data")), run, f"id {kind}, clip int, start_s double, end_s double, frames int, width int, height int, mean_grey double")


def text_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_media: bool = False) -> DataFrame:
    """Each row's text stored as a file and read back: sizes, digests and shot features; with keep_media also the file."""

    def run(part: dict[str, list]) -> dict[str, list]:
        names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"] + ["media"] * keep_media
        out: dict[str, list] = {k: [] for k in names}
        for key, text in zip(part["id"], part["text"], strict=True):
            raw = (text or "").encode("utf-8", "surrogatepass")
            media = store_payload(padded(raw))
            payload, hist, fps = load(media)
            begins = shots(hist)
            row = {
                "doc_id": key, "n_bytes": len(raw), "payload_bytes": len(payload), "payload_sha256": hashlib.sha256(payload).hexdigest(),
                "tail_crc32": zlib.crc32(payload[-64:]), "media_bytes": len(media), "media_sha256": hashlib.sha256(media).hexdigest(),
                "feature": f"frames={len(hist)};seconds={len(hist) / fps:.2f};shots={','.join(f'{b / fps:.2f}' for b in begins)};grey={','.join(f'{x:.3f}' for x in hist.mean(0))}",
                "media": media,
            }
            for k in names:
                out[k].append(row[k])
        return out

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string" + ", media binary" * keep_media
    return arrow_pass(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), run, schema)


def op3_avi_mjpeg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_media(table(spark, sf_dir, "documents"))
