"""GIF as a media column (operator 8): write, read back, timed frames.

``read_gif`` decodes any GIF: LZW code streams with deferred clear codes,
interlacing, global and local palettes, transparency and the disposal rules.
``write_gif`` stores a byte string losslessly as grey frames of one fixed width.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from placeweave.llm.shared import released
from placeweave.llm.text_arrays import blocks

WIDTH = 64
FRAME_ROWS = 256
DELAY_MS = 100
#: Bins of each of the three colour channels.
HISTOGRAM = 16
#: A file that says it is larger is not decoded, and bytes of a worker's batch, about.
MOST_PIXELS, BATCH_BYTES = 1 << 26, 1 << 23
#: The format's limits: clear and end code of 8-bit images, most codes.
CLEAR, END, FIRST, CODES = 256, 257, 258, 4096


def _code_widths(count: int, root: int, clear: int) -> np.ndarray:
    """Bits of the codes that follow a clear code, the first, second and so on."""
    j = np.arange(count)
    known = np.minimum(clear + 1 + np.maximum(j, 1), CODES - 1)
    return np.maximum(np.floor(np.log2(known)).astype(np.int64) + 1, root + 1)


_WIDTHS8 = _code_widths(CODES, 8, CLEAR)


def lzw_pack(data: bytes) -> bytes:
    """The LZW code stream of 8-bit samples, a clear code whenever the table is full."""
    codes: list[int] = [CLEAR]
    spots: list[int] = [0]
    table: dict[int, int] = {}
    get, put = table.get, codes.append
    following, prefix = FIRST, -1
    for byte in data:
        if prefix < 0:
            prefix = byte
            continue
        key = prefix << 8 | byte
        code = get(key)
        if code is not None:
            prefix = code
            continue
        put(prefix)
        prefix = byte
        if following < CODES:
            table[key] = following
            following += 1
        else:
            spots.append(len(codes))
            put(CLEAR)
            table.clear()
            following = FIRST
    if prefix >= 0:
        put(prefix)
    put(END)
    values = np.array(codes, dtype=np.int64)
    runs = np.diff(np.append(spots, len(codes)))
    bits = np.concatenate([np.concatenate([[12 if k else 9], _WIDTHS8[: n - 1]]) for k, n in enumerate(runs)])
    # a clear code has the width its place in the run before it gives
    for k in range(1, len(spots)):
        bits[spots[k]] = _WIDTHS8[runs[k - 1] - 1]
    at = np.cumsum(bits) - bits
    shifted = values << (at & 7)
    out = np.zeros(int(at[-1] + bits[-1] + 7) // 8 + 3)
    for k in range(3):
        out += np.bincount((at >> 3) + k, weights=(shifted >> (8 * k)) & 255, minlength=len(out))
    return out[: int(at[-1] + bits[-1] + 7) // 8].astype(np.uint8).tobytes()


def lzw_unpack(data: bytes, root: int, size: int) -> bytes:
    """At most ``size`` samples of a code stream whose samples have ``root`` bits.

    Codes of a run between clear codes are cut out together; the table is then
    followed code by code.  A stream that ends early gives what it held.
    """
    clear, end = 1 << root, (1 << root) + 1
    raw = np.concatenate([np.frombuffer(data, np.uint8), np.zeros(3, np.uint8)]).astype(np.int64)
    total = 8 * len(data)
    singles = [bytes([k]) for k in range(clear)] + [b"", b""]
    widths = _WIDTHS8 if root == 8 else _code_widths(CODES, root, clear)
    parts: list[bytes] = []
    done, at, run = 0, 0, 0  # run: codes read since the last clear code
    table, before = list(singles), b""
    while done < size and at + root + 1 <= total:
        bits = widths[run : run + CODES] if run < CODES else np.full(CODES, 12)
        places = at + np.cumsum(bits) - bits
        fits = places + bits <= total
        bits, places = bits[fits], places[fits]
        if not len(bits):
            break
        low = places >> 3
        codes = (raw[low] | raw[low + 1] << 8 | raw[low + 2] << 16) >> (places & 7) & ((1 << bits) - 1)
        stops = np.flatnonzero((codes == clear) | (codes == end))
        take = int(stops[0]) if len(stops) else len(codes)
        for code in codes[:take].tolist():
            if not before:
                if code >= clear:
                    raise ValueError("a run starts with a code that is no sample")
                before = table[code]
                parts.append(before)
                continue
            known = len(table)
            if code < known:
                entry = table[code]
            elif code == known and known < CODES:
                entry = before + before[:1]
            else:
                raise ValueError("a code that the table does not have")
            parts.append(entry)
            if known < CODES:
                table.append(before + entry[:1])
            before = entry
        if len(stops):
            if codes[take] == end:
                break
            at = int(places[take] + bits[take])
            table, before, run = list(singles), b"", 0
        else:
            at = int(places[-1] + bits[-1])
            run += len(codes)
        if len(parts) > 1 << 16:
            parts = [b"".join(parts)]
            done = len(parts[0])
    return b"".join(parts)[:size]


def _blocks(data: bytes) -> bytes:
    return b"".join(bytes([len(data[k : k + 255])]) + data[k : k + 255] for k in range(0, len(data), 255)) + b"\0"


_GREY = bytes(v for k in range(256) for v in (k, k, k))


def write_gif(payload: bytes) -> bytes:
    """A payload (a positive multiple of WIDTH bytes) as an animated grey GIF."""
    rows = len(payload) // WIDTH
    height = min(rows, FRAME_ROWS)
    u16 = lambda n: n.to_bytes(2, "little")
    out = [b"GIF89a", u16(WIDTH), u16(height), b"\xf7\0\0", _GREY]
    for top in range(0, rows, FRAME_ROWS):
        part = payload[top * WIDTH : (top + FRAME_ROWS) * WIDTH]
        out += [b"\x21\xf9\x04\x04", u16(DELAY_MS // 10), b"\0\0"]
        out += [b"\x2c\0\0\0\0", u16(WIDTH), u16(len(part) // WIDTH), b"\0\x08", _blocks(lzw_pack(part))]
    out.append(b"\x3b")
    return b"".join(out)


@dataclass
class Frame:
    delay_ms: int
    left: int
    top: int
    width: int
    height: int
    canvas: np.ndarray  # height x width x 4 of the whole picture after this frame


def _palette(data: bytes, at: int, flags: int) -> tuple[np.ndarray | None, int]:
    if not flags & 0x80:
        return None, at
    n = 3 << ((flags & 7) + 1)
    if at + n > len(data):
        raise ValueError("a palette is cut off")
    return np.frombuffer(data, np.uint8, n, at).reshape(-1, 3), at + n


def _sub_blocks(data: bytes, at: int) -> tuple[bytes, int]:
    parts = []
    while at < len(data) and data[at]:
        parts.append(data[at + 1 : at + 1 + data[at]])
        at += 1 + data[at]
    return b"".join(parts), at + 1


def read_gif(data: bytes) -> Iterator[Frame]:
    """The frames of a GIF as they are shown one after the other.

    Disposal 2 clears a frame's rectangle to transparent, 3 restores what was
    there before, others leave it.  Raises ValueError where the file is broken or
    has more than MOST_PIXELS pixels.
    """
    if data[:6] not in (b"GIF87a", b"GIF89a") or len(data) < 13:
        raise ValueError("no GIF header")
    width, height = (int.from_bytes(data[k : k + 2], "little") for k in (6, 8))
    if width * height > MOST_PIXELS:
        raise ValueError("a picture of more pixels than are decoded")
    common, at = _palette(data, 13, data[10])
    canvas = np.zeros((height, width, 4), dtype=np.uint8)
    delay, disposal, clear_index = 0, 0, None
    while at < len(data):
        kind = data[at]
        if kind == 0x3B:
            return
        if kind == 0x21:
            if at + 7 < len(data) and data[at + 1] == 0xF9:
                flags = data[at + 3]
                delay = 10 * int.from_bytes(data[at + 4 : at + 6], "little")
                disposal = flags >> 2 & 7
                clear_index = data[at + 6] if flags & 1 else None
            _, at = _sub_blocks(data, at + 2)
            continue
        if kind != 0x2C or at + 11 > len(data):
            raise ValueError("an unknown or cut off block")
        left, top, w, h = (int.from_bytes(data[at + k : at + k + 2], "little") for k in (1, 3, 5, 7))
        flags = data[at + 9]
        own, at = _palette(data, at + 10, flags)
        root = data[at]
        if not 1 <= root <= 8:
            raise ValueError("a code size out of range")
        stream, at = _sub_blocks(data, at + 1)
        samples = lzw_unpack(stream, root, w * h)
        if len(samples) < w * h or left + w > width or top + h > height:
            raise ValueError("a frame is cut off or outside the picture")
        index = np.frombuffer(samples, np.uint8).reshape(h, w)
        if flags & 0x40:
            order = np.concatenate([np.arange(a, h, s) for a, s in ((0, 8), (4, 8), (2, 4), (1, 2))])
            index = index[np.argsort(order)]
        colours = own if own is not None else common
        if colours is None:
            raise ValueError("a frame without a palette")
        table = np.zeros((256, 4), dtype=np.uint8)
        table[: len(colours), :3] = colours
        table[: len(colours), 3] = 255
        before = canvas.copy() if disposal == 3 else None
        area = canvas[top : top + h, left : left + w]
        if clear_index is None:
            area[:] = table[index]
        else:
            drawn = index != clear_index
            area[drawn] = table[index[drawn]]
        yield Frame(delay, left, top, w, h, canvas)
        if disposal == 2:
            canvas[top : top + h, left : left + w] = 0
        elif disposal == 3:
            canvas = before
        delay, disposal, clear_index = 0, 0, None


FRAMES = "array<struct<delay_ms:int,left:int,top:int,width:int,height:int,grey:boolean,pixels:binary,histogram:array<long>>>"


def _frame_cells(frame: Frame) -> dict:
    """The picture as grey samples where red, green and blue agree, else RGBA; the
    histogram counts HISTOGRAM bins of red, then of green, then of blue of the frame's
    rectangle."""
    c = frame.canvas
    grey = bool((c[..., 0] == c[..., 1]).all() and (c[..., 0] == c[..., 2]).all())
    area = c[frame.top : frame.top + frame.height, frame.left : frame.left + frame.width]
    counts = [np.bincount((area[..., k] >> 4).ravel(), minlength=HISTOGRAM) for k in range(1 if grey else 3)]
    bins = np.concatenate(counts * 3 if grey else counts)
    return {
        "delay_ms": frame.delay_ms, "left": frame.left, "top": frame.top, "width": frame.width, "height": frame.height,
        "grey": grey, "pixels": (c[..., 0] if grey else c).tobytes(), "histogram": bins.tolist(),
    }


def _by_column(df: DataFrame, source: str, added: list[tuple[str, str | DataType, pa.DataType]], make, drop: bool) -> DataFrame:
    kept = [c for c in df.columns if c not in {a[0] for a in added} and not (drop and c == source)]
    schema = df.select(*kept).schema
    for name, kind, _ in added:
        schema = schema.add(name, kind)
    order = [source, *kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(0)), 0).to_numpy(zero_copy_only=False)
            for first, last in blocks(np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]), BATCH_BYTES):
                part = batch.slice(first, last - first)
                cells = [make(x) for x in part.column(0).to_pylist()]
                columns = [pa.array([c[k] for c in cells], added[k][2]) for k in range(len(added))]
                yield pa.RecordBatch.from_arrays([*part.columns[1:], *columns], names=[*kept, *(a[0] for a in added)])

    return df.select(F.col(source).alias("__source"), *order[1:]).mapInArrow(released(run), schema)


def with_gif(df: DataFrame, payload: str = "payload", media: str = "media") -> DataFrame:
    """``df`` with its payload column stored as GIF instead; a null payload gives null."""
    return _by_column(df, payload, [(media, "binary", pa.binary())], lambda x: (None if x is None else write_gif(x),), drop=True)


_FRAME_TYPE = pa.list_(
    pa.struct([("delay_ms", pa.int32()), ("left", pa.int32()), ("top", pa.int32()), ("width", pa.int32()), ("height", pa.int32()),
               ("grey", pa.bool_()), ("pixels", pa.binary()), ("histogram", pa.list_(pa.int64()))])
)


def with_frames(df: DataFrame, media: str = "media") -> DataFrame:
    """``df`` with frames (FRAMES) and error added.

    A null or broken file gives null frames and, if broken, what is wrong; a frame
    carries its delay, rectangle, the whole picture and a colour histogram.
    """

    def make(data: bytes | None):
        if data is None:
            return None, None
        try:
            return [_frame_cells(f) for f in read_gif(data)], None
        except (ValueError, IndexError) as why:
            return None, str(why)

    return _by_column(df, media, [("frames", StructType.fromDDL(f"frames {FRAMES}")["frames"].dataType, _FRAME_TYPE), ("error", "string", pa.string())], make, drop=False)


def payload_of(text: F.Column) -> F.Column:
    """UTF-8 bytes, then bytes 0 up to a positive multiple of 64; a null text is empty."""
    raw = F.coalesce(text, F.lit("")).cast("binary")
    zeros = WIDTH - F.pmod(F.octet_length(raw), F.lit(WIDTH))
    zeros = F.when((zeros == WIDTH) & (F.octet_length(raw) > 0), 0).otherwise(zeros)
    return F.concat(raw, F.substring(F.unhex(F.lit("00" * WIDTH)), F.lit(1), zeros))


def media_digests(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes,
    media_sha256, feature) of the texts stored as GIF and read back.

    A null text is an empty one (64 bytes 0); null and repeated ids are passed
    through; an empty table gives no rows; further columns are ignored.
    """
    raw = docs.select(
        F.col(id).cast("long").alias("id"), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"), payload_of(F.col(text)).alias("payload")
    )
    back = with_frames(with_gif(raw))
    area = F.transform("frames", lambda f: F.substring(f["pixels"], f["top"] * f["width"] + 1, f["height"] * f["width"]))
    # arrays are joined as strings, in time linear in the bytes
    payload = F.unhex(F.array_join(F.transform(area, F.hex), ""))
    histogram = F.aggregate(
        "frames",
        F.array_repeat(F.lit(0).cast("long"), 3 * HISTOGRAM),
        lambda a, f: F.zip_with(a, f["histogram"], lambda x, y: x + y),
    )
    shown = back.select(
        F.col("id"), "n_bytes", payload.alias("payload"), F.octet_length("media").cast("long").alias("media_bytes"), F.sha2("media", 256).alias("media_sha256"),
        F.concat_ws(";", F.concat(F.lit("frames="), F.size("frames")), F.concat(F.lit("ms="), F.aggregate("frames", F.lit(0), lambda a, f: a + f["delay_ms"])),
                    F.concat(F.lit("histogram="), F.array_join(histogram.cast("array<string>"), ","))).alias("feature"),
    )
    return shown.select(
        F.col("id").alias(id), "n_bytes", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_sha256"),
        F.crc32(F.substring("payload", -WIDTH, WIDTH)).alias("tail_crc32"), "media_bytes", "media_sha256", "feature",
    )
