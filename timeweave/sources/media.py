"""Capture times and sizes of media files, from their headers alone.

Files are listed without their content (Spark's binaryFile source reads none
when the column isn't asked for). Tasks then open each file, seek from header to
header and read a bounded number of bytes: the boxes of an MP4 or QuickTime
container, the segments and EXIF directories of a JPEG, the chunks of a PNG or
WAV file, the clock that AVCHD cameras put into the video stream. A file that
can't be read gives its error and nothing else.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import values as V
from ..functions.text import natural_key

# Kinds by extension.
KINDS = {"video": ["mov", "mp4", "m4v", "mts", "m2ts", "avi", "mkv"], "photo": ["jpg", "jpeg", "heic", "png", "tif", "tiff"], "audio": ["m4a", "mp3", "wav", "flac", "aac", "ogg", "wma"]}
#: Bytes of one header or directory that are read at most, boxes and directory entries that are looked at, bytes of a stream searched for its clock.
HEADER, ENTRIES, SEARCHED, STEP = 1 << 20, 10_000, 8_000_000, 1 << 18
#: Seconds from the epoch of QuickTime (1904) to that of Unix.
QUICKTIME = 2_082_844_800


class Damaged(ValueError):
    pass


def _read(f, at: int, n: int) -> bytes:
    if n > HEADER:
        raise Damaged(f"a header of {n} bytes")
    f.seek(at)
    data = f.read(n)
    if len(data) < n:
        raise Damaged("ends early")
    return data


# ---------------------------------------------------------------- MP4 and QuickTime


def boxes(f, start: int, end: int) -> Iterator[tuple[bytes, int, int]]:
    """(type, start, end) of the contents of the boxes from ``start`` to ``end``."""
    at = start
    for _ in range(ENTRIES):
        if end - at < 8:
            return
        size, kind = struct.unpack(">I4s", _read(f, at, 8))
        head = 8
        if size == 1:
            size, head = struct.unpack(">Q", _read(f, at + 8, 8))[0], 16
        size = end - at if size == 0 else size
        if size < head or at + size > end:
            raise Damaged(f"box of {size} bytes")
        yield kind, at + head, at + size
        at += size
    raise Damaged("too many boxes")


def _child(f, start: int, end: int, *path: bytes) -> tuple[int, int] | None:
    for kind in path:
        found = next(((a, b) for k, a, b in boxes(f, start, end) if k == kind), None)
        if found is None:
            return None
        start, end = found
    return start, end


def _quicktime_tags(f, start: int, end: int) -> dict[str, str]:
    """The metadata keys of a ``meta`` box and their texts."""
    if _read(f, start, 8)[4:8] != b"hdlr":
        start += 4  # the version of an ISO box
    keys, values = _child(f, start, end, b"keys"), _child(f, start, end, b"ilst")
    if not keys or not values:
        return {}
    names = [_read(f, a, b - a).decode("utf-8", "replace") for _, a, b in boxes(f, keys[0] + 8, keys[1])]
    out = {}
    for number, a, b in boxes(f, *values):
        data, no = _child(f, a, b, b"data"), struct.unpack(">I", number)[0]
        if data and 1 <= no <= len(names):
            out[names[no - 1]] = _read(f, data[0], data[1] - data[0])[8:].decode("utf-8", "replace")
    return out


def probe_mp4(f, size: int) -> dict:
    movie = _child(f, 0, size, b"moov")
    if not movie:
        raise Damaged("no moov box")
    out: dict = {}
    header = _child(f, *movie, b"mvhd")
    if header:
        data = _read(f, header[0], min(header[1] - header[0], 32))
        made, _, scale, length = struct.unpack(">QQIQ", data[4:32]) if data[0] == 1 else struct.unpack(">IIII", data[4:20])
        out["duration_s"] = length / scale if scale else None
        if made > QUICKTIME:
            out["unix_s"] = made - QUICKTIME
    for path in ((b"meta",), (b"udta", b"meta")):
        meta = _child(f, *movie, *path)
        if meta:
            tags = _quicktime_tags(f, *meta)
            out["creation_raw"] = out.get("creation_raw") or tags.get("com.apple.quicktime.creationdate")
            out["model"] = out.get("model") or tags.get("com.apple.quicktime.model")
    if not out.get("creation_raw") and "unix_s" in out:
        from datetime import UTC, datetime

        out["creation_raw"] = datetime.fromtimestamp(out["unix_s"], UTC).strftime("%Y-%m-%dT%H:%M:%S.000000Z")
    out.pop("unix_s", None)
    return out


# ---------------------------------------------------------------- pictures

# EXIF tags.
MODEL, CHANGED, EXIF_DIRECTORY, ORIGINAL = 0x0110, 0x0132, 0x8769, 0x9003


def exif(data: bytes) -> dict:
    """Time and model of a TIFF structure: the time of the picture, else of the file."""
    order = {b"II": "<", b"MM": ">"}.get(data[:2])
    if order is None or len(data) < 8:
        raise Damaged("no TIFF header")

    def directory(at: int) -> dict[int, str | int]:
        out: dict[int, str | int] = {}
        (n,) = struct.unpack_from(order + "H", data, at)
        for i in range(n):
            tag, kind, count, value = struct.unpack_from(order + "HHI4s", data, at + 2 + 12 * i)
            if kind == 2:
                where = at + 10 + 12 * i if count <= 4 else struct.unpack(order + "I", value)[0]
                out[tag] = data[where : where + count].split(b"\0")[0].decode("latin-1").strip()
            elif kind == 4:
                out[tag] = struct.unpack(order + "I", value)[0]
        return out

    try:
        first = directory(struct.unpack_from(order + "I", data, 4)[0])
        at = first.get(EXIF_DIRECTORY)
        inner = directory(at) if isinstance(at, int) else {}
    except struct.error as e:
        raise Damaged("directory outside the file") from e
    return {"creation_raw": first.get(ORIGINAL) or first.get(CHANGED) or inner.get(ORIGINAL) or None, "model": first.get(MODEL)}


def probe_jpeg(f, size: int) -> dict:
    if _read(f, 0, 2) != b"\xff\xd8":
        raise Damaged("no JPEG")
    out, at = {}, 2
    for _ in range(ENTRIES):
        mark, kind, n = struct.unpack(">BBH", _read(f, at, 4))
        if mark != 0xFF or n < 2:
            raise Damaged("no segment where one should be")
        if kind == 0xE1 and n >= 14 and _read(f, at + 4, 6) == b"Exif\0\0":
            out |= exif(_read(f, at + 10, n - 8))
        elif 0xC0 <= kind <= 0xCF and kind not in (0xC4, 0xC8, 0xCC):
            out["height"], out["width"] = struct.unpack(">HH", _read(f, at + 5, 4))
            return out
        elif kind == 0xDA:
            return out
        at += 2 + n
    raise Damaged("too many segments")


def probe_png(f, size: int) -> dict:
    if _read(f, 0, 8) != b"\x89PNG\r\n\x1a\n":
        raise Damaged("no PNG")
    out, at = {}, 8
    for _ in range(ENTRIES):
        n, kind = struct.unpack(">I4s", _read(f, at, 8))
        if kind == b"IHDR":
            out["width"], out["height"] = struct.unpack(">II", _read(f, at + 8, 8))
        elif kind == b"eXIf":
            out |= exif(_read(f, at + 8, n))
        elif kind in (b"IDAT", b"IEND"):
            return out
        at += 12 + n
    raise Damaged("too many chunks")


def probe_tiff(f, size: int) -> dict:
    return exif(_read(f, 0, min(size, HEADER)))


# ---------------------------------------------------------------- sound and AVCHD


def probe_wav(f, size: int) -> dict:
    head = _read(f, 0, 12)
    if head[:4] != b"RIFF" or head[8:] != b"WAVE":
        raise Damaged("no WAV")
    at, rate = 12, None
    for _ in range(ENTRIES):
        kind, n = struct.unpack("<4sI", _read(f, at, 8))
        if kind == b"fmt ":
            rate = struct.unpack("<I", _read(f, at + 16, 4))[0]
        elif kind == b"data":
            return {"duration_s": n / rate if rate else None}
        at += 8 + n + n % 2
    raise Damaged("too many chunks")


def stream_clock(data: bytes) -> str | None:
    """The first date and time packs after an MDPM mark: 0x18 zone 0x20 year month, 0x19 day hour minute second, decimal digits by half bytes."""
    at = data.find(b"MDPM")
    while at >= 0:
        near = data[at + 4 : at + 260]
        for j in range(len(near) - 9):
            if near[j] == 0x18 and near[j + 2] == 0x20 and near[j + 5] == 0x19:
                digits = [f"{b:02x}" for b in (*near[j + 2 : j + 5], *near[j + 6 : j + 10])]
                if all(d.isdecimal() for d in digits) and 1 <= int(digits[2]) <= 12 and 1 <= int(digits[3]) <= 31 and int(digits[4]) < 24 and int(digits[5]) < 60 and int(digits[6]) < 60:
                    return "{}{}-{}-{} {}:{}:{}".format(*digits)
        at = data.find(b"MDPM", at + 4)
    return None


def probe_avchd(f, size: int) -> dict:
    kept, at = b"", 0
    while at < min(size, SEARCHED):
        f.seek(at)
        data = f.read(STEP)
        found = stream_clock(kept + data)
        if found or not data:
            return {"creation_raw": found, "model": "AVCHD" if found else None, "hint": "avchd-mdpm" if found else None}
        kept, at = (kept + data)[-300:], at + len(data)
    return {}


PROBES = {"mov": probe_mp4, "mp4": probe_mp4, "m4v": probe_mp4, "m4a": probe_mp4, "jpg": probe_jpeg, "jpeg": probe_jpeg, "png": probe_png, "tif": probe_tiff, "tiff": probe_tiff, "wav": probe_wav, "mts": probe_avchd, "m2ts": probe_avchd}


# ---------------------------------------------------------------- tables

_FIELDS = {"duration_s": pa.float64(), "creation_raw": pa.string(), "model": pa.string(), "hint": pa.string(), "width": pa.int32(), "height": pa.int32(), "error": pa.string()}
_DDL = "duration_s double, creation_raw string, model string, hint string, width int, height int, error string"


@lru_cache(maxsize=8)
def _store(root: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(root)[0]


def _open(path: str):
    from pyarrow import fs

    scheme, _, rest = path.partition("://") if "://" in path else ("file", "", path.removeprefix("file:"))
    if scheme == "file":
        return fs.LocalFileSystem().open_input_file("/" + rest.lstrip("/"))
    host = rest.partition("/")[0]
    return _store(f"{scheme}://{host}/").open_input_file(fs.FileSystem.from_uri(path)[1])


def probe(path: str, length: int) -> dict:
    """What the headers of a file say, by its extension."""
    reader = PROBES.get(path.rpartition(".")[2].lower())
    if reader is None:
        return {}
    try:
        with _open(path) as f:
            return reader(f, length)
    except (Damaged, struct.error) as e:
        return {"error": f"unreadable: {e}"[:200]}
    except OSError as e:
        return {"error": f"{type(e).__name__}: {e}"[:200]}


def listing(spark: SparkSession, folder: str) -> DataFrame:
    """path, file, modified, length, kind of all media files below a folder; no content is read. Spark leaves out empty files."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path", F.col("modificationTime").alias("modified"), "length")
    ext = F.lower(F.regexp_extract("path", "\\.([^./]+)$", 1))
    kind = F.coalesce(*(F.when(ext.isin(*names), k) for k, names in KINDS.items()))
    return files.select("path", F.regexp_extract("path", "([^/]*)$", 1).alias("file"), "modified", "length", kind.alias("kind")).where("kind is not null")


def probed(files: DataFrame) -> DataFrame:
    """``files`` (path, length and what else they have) with duration_s, creation_raw, model, hint, width, height, error."""
    held = files.select("path", "length", F.struct(*(c for c in files.columns if c not in ("path", "length"))).alias("rest"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [probe(p, n) for p, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns, *(pa.array([r.get(k) for r in found], t) for k, t in _FIELDS.items())], [*b.schema.names, *_FIELDS])

    kinds = dict(held.dtypes)
    return held.mapInArrow(run, f"path string, length long, rest {kinds['rest']}, {_DDL}").select("path", "length", "rest.*", *_FIELDS)


def capture_index(files: DataFrame, utc_offset_h: float = 8, refine: bool = True) -> DataFrame:
    """Files with start, start_source and reliable: the container's or picture's time, the stream's, the name's, and last the file's own, which isn't reliable."""
    rows = probed(files).withColumn("__tw_own", V.local_time(F.col("creation_raw"), utc_offset_h))
    named = V.filename_time(F.col("file"))
    borne_out = F.coalesce(F.date_trunc("minute", named) == F.date_trunc("minute", "modified"), F.lit(False)) & F.lit(refine)
    whole = F.when(borne_out, V.refine_seconds(named, F.date_trunc("second", "modified"))).otherwise(named)
    rows = rows.withColumns({"__tw_name": F.when(F.col("kind") == "audio", whole), "__tw_out": borne_out})
    own = F.coalesce(F.col("hint"), F.col("__tw_own.source"))
    by_name = F.when(F.col("__tw_out"), "filename+mtime-seconds").otherwise("filename")
    source = F.when(F.col("__tw_own.at").isNotNull(), own).when(F.col("__tw_name").isNotNull(), by_name).when(F.col("modified").isNotNull(), "mtime").otherwise("none")
    rows = rows.withColumns({"start": F.coalesce("__tw_own.at", "__tw_name", F.date_trunc("second", "modified")), "start_source": source})
    return rows.withColumn("reliable", V.reliable(F.col("start_source"))).drop("__tw_own", "__tw_name", "__tw_out")


def image_slides(images: DataFrame, keys: list[str], audio_s: Column | None = None, clock: Column | None = None, between: tuple[Column, Column] | None = None) -> DataFrame:
    """A deck's images as slides: slide_id from 1, order_source, timestamp_start and _end, no_audio.

    ``images``: capture_index rows. They are ordered by capture time and then by
    name (numbers as numbers), untimed ones last; where a deck's images share
    one time or have none, by name. ``between`` keeps those taken in a span.
    With ``clock`` (when the recording began) a slide starts at its own time
    after that and ends with the next, the last with ``audio_s``; with ``audio_s``
    alone slides are spread evenly; without both times are 0 and there is no audio.
    """
    rows = images.where(F.col("start").between(*between)) if between else images
    deck = Window.partitionBy(*keys)
    n, times = F.count("*").over(deck), F.size(F.collect_set("start").over(deck))
    rows = rows.withColumns({"__tw_n": n, "__tw_by_name": (times == 0) | ((n > 1) & (times < 2))})
    taken = F.when(~F.col("__tw_by_name"), F.col("start"))
    origin = F.when(F.col("__tw_by_name") | F.col("start").isNull(), "filename").when(F.col("reliable"), "exif").otherwise("mtime")
    rows = rows.withColumns({"order_source": origin, "__tw_t": taken, "__tw_key": natural_key(F.lower("file"))})
    order = deck.orderBy(F.col("__tw_t").asc_nulls_last(), "__tw_key", "path")
    rows = rows.withColumn("slide_id", F.row_number().over(order))
    zero, i = F.lit(0).cast("long"), F.col("slide_id")
    if clock is not None:
        at = F.unix_timestamp("start") - F.unix_timestamp(clock)
        first = F.greatest(zero, at)
        after = F.lead(at).over(order)
        end = F.when(i < F.col("__tw_n"), F.greatest(first, after)).otherwise(F.coalesce(audio_s.cast("long"), first) if audio_s is not None else first)
    elif audio_s is not None:
        first, end = (F.floor(x * (audio_s / F.col("__tw_n"))) for x in (i - 1, i))
    else:
        first = end = zero
    rows = rows.withColumns({"timestamp_start": first, "timestamp_end": end, "no_audio": F.lit(clock is None and audio_s is None)})
    return rows.drop("__tw_n", "__tw_by_name", "__tw_t", "__tw_key")
