"""Media headers written from the events' times and read back, damaged files, and decks of images."""

import os
import struct
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from timeweave.functions import values as V
from timeweave.sources import media

EVENTS = "/root/testdata/sf0.001/events.parquet"


def box(kind, body, wide=False):
    return (struct.pack(">I4sQ", 1, kind, 16 + len(body)) if wide else struct.pack(">I4s", 8 + len(body), kind)) + body


def mp4(made, seconds, tags=None, version=0, wide=False, last=True):
    stamp = int((made - datetime(1904, 1, 1)).total_seconds())
    head = struct.pack(">B3xQQIQ", 1, stamp, stamp, 600, round(seconds * 600)) if version else struct.pack(">B3xIIII", 0, stamp, stamp, 600, round(seconds * 600))
    body = box(b"mvhd", head + bytes(80))
    if tags:
        keys = box(b"keys", struct.pack(">II", 0, len(tags)) + b"".join(box(b"mdta", k.encode()) for k in tags))
        items = b"".join(box(struct.pack(">I", i), box(b"data", struct.pack(">II", 1, 0) + v.encode())) for i, v in enumerate(tags.values(), 1))
        body += box(b"meta", box(b"hdlr", bytes(24)) + keys + box(b"ilst", items))
    movie, data = box(b"moov", body), box(b"mdat", os.urandom(200_000), wide)
    return box(b"ftyp", b"isom") + (data + movie if last else movie + data)


def tiff(order, made, model, inner=True):
    def entry(tag, kind, count, value):
        return struct.pack(order + "HHI", tag, kind, count) + value

    text = made.strftime("%Y:%m:%d %H:%M:%S").encode() + b"\0"
    name = model.encode() + b"\0"
    first = 8 + 2 + 12 * 2 + 4
    after = first + len(name)
    number = lambda x: struct.pack(order + "I", x)
    short = lambda b: (b + bytes(4))[:4] if len(b) <= 4 else number(first)
    out = {"<": b"II*\0", ">": b"MM\0*"}[order] + number(8) + struct.pack(order + "H", 2) + entry(0x0110, 2, len(name), short(name))
    if not inner:
        return out + entry(0x0132, 2, 20, number(after)) + number(0) + name + text
    out += entry(0x8769, 4, 1, number(after)) + number(0) + name
    return out + struct.pack(order + "H", 1) + entry(0x9003, 2, 20, number(after + 18)) + number(0) + text


def jpeg(made, model="Cam X", order="<", inner=True, size=(640, 480)):
    body = b"Exif\0\0" + tiff(order, made, model, inner)
    frame = struct.pack(">BHHB", 8, size[1], size[0], 3) + bytes(9)
    segment = lambda kind, b: struct.pack(">BBH", 0xFF, kind, len(b) + 2) + b
    return b"\xff\xd8" + segment(0xE0, b"JFIF\0" + bytes(9)) + segment(0xE1, body) + segment(0xDB, bytes(65)) + segment(0xC0, frame) + segment(0xDA, bytes(10)) + os.urandom(50_000)


def png(made=None, size=(33, 44)):
    chunk = lambda kind, b: struct.pack(">I4s", len(b), kind) + b + bytes(4)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">II", *size) + bytes(5)) + (chunk(b"eXIf", tiff(">", made, "P")) if made else b"") + chunk(b"IDAT", bytes(900)) + chunk(b"IEND", b"")


def avchd(made, before=300_000):
    bcd = lambda text: bytes.fromhex(text)
    pack = b"MDPM" + bytes([3, 0x17, 1, 2, 3, 4]) + bytes([0x18, 0x90]) + bcd(made.strftime("%Y%m")) + bytes([0x19]) + bcd(made.strftime("%d%H%M%S"))
    return b"G" + b"MDPM" + bytes(before) + pack + bytes(1000)


def wav(seconds):
    body = b"fmt " + struct.pack("<IHHIIHH", 16, 1, 1, 8000, 16000, 2, 16) + b"data" + struct.pack("<I", seconds * 16000)
    return b"RIFF" + struct.pack("<I", len(body) + 4) + b"WAVE" + body


def write(folder, name, data, modified=None):
    path = os.path.join(folder, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data)
    if modified:
        os.utime(path, (modified.timestamp(),) * 2)
    return path


@pytest.fixture(scope="module")
def times(spark):
    rows = spark.read.parquet(EVENTS).select(F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("t"), "value").orderBy("event_id").limit(60).collect()
    return [(datetime.fromisoformat(r["t"]), round(r["value"], 1)) for r in rows]


def test_headers_give_back_what_was_written(spark, times, tmp_path):
    want = {}
    for i, (t, s) in enumerate(times):
        wide = i % 2 == 1
        want[f"a{i}.mp4"] = (t + timedelta(hours=8), "utc+8", None, s, None)
        write(tmp_path, f"v/a{i}.mp4", mp4(t, s, version=i % 2, wide=wide, last=i % 3 == 0))
        want[f"b{i}.MOV"] = (t, "tz-tagged", "Phone 9", s, None)
        write(tmp_path, f"v/b{i}.MOV", mp4(t, s, {"com.apple.quicktime.model": "Phone 9", "com.apple.quicktime.creationdate": t.strftime("%Y-%m-%dT%H:%M:%S+0300")}))
        want[f"c{i}.jpg"] = (t, "exif", ["Cam X", "C"][i % 2], None, 640)
        write(tmp_path, f"p/c{i}.jpg", jpeg(t, ["Cam X", "C"][i % 2], "<>"[i % 2], inner=i % 3 > 0))
        want[f"d{i}.png"] = (t, "exif", "P", None, 33)
        write(tmp_path, f"p/d{i}.png", png(t))
        want[f"e{i}.MTS"] = (t, "avchd-mdpm", "AVCHD", None, None)
        write(tmp_path, f"v/e{i}.MTS", avchd(t, 300_000 - i))
        want[f"REC_{t:%y%m%d_%H%M}_{i}.wav"] = (t, "filename+mtime-seconds", None, 7.0, None)
        write(tmp_path, f"s/REC_{t:%y%m%d_%H%M}_{i}.wav", wav(7), t)
    write(tmp_path, "readme.txt", b"no media")
    got = media.capture_index(media.listing(spark, str(tmp_path))).collect()
    found = {r["file"]: (r["start"], r["start_source"], r["model"], r["duration_s"] and round(r["duration_s"], 1), r["width"]) for r in got}
    assert found == want and all(r["reliable"] and r["error"] is None for r in got)


def test_damaged_files_give_their_error(spark, times, tmp_path):
    t, at = times[0][0], datetime(2024, 3, 1, 12, 30, 5)
    bad = {"cut.mp4": mp4(t, 3)[:40], "no.mp4": b"0", "long.mp4": struct.pack(">I4s", 2**31, b"moov") + bytes(50), "x.jpg": b"\xff\xd8" + bytes(90), "y.jpg": jpeg(t)[:30], "z.png": b"\x89PNG\r\n\x1a\n" + struct.pack(">I4s", 2**31, b"eXIf"), "t.tif": b"II*\0" + struct.pack("<I", 9999), "w.wav": b"RIFF"}
    for name, data in bad.items():
        write(tmp_path, name, data, at)
    write(tmp_path, "none.png", png(), at)
    write(tmp_path, "empty.mts", bytes(5000), at)
    write(tmp_path, "240301_1230.m4a", b"0", at)
    write(tmp_path, "9999x9999_20240301-123005.mp3", b"0", at)
    got = {r["file"]: r for r in media.capture_index(media.listing(spark, str(tmp_path))).collect()}
    assert {n for n, r in got.items() if r["error"]} == {*bad, "240301_1230.m4a"}
    assert {(r["start"], r["start_source"], r["reliable"]) for n, r in got.items() if r["kind"] != "audio"} == {(at, "mtime", False)}
    assert (got["240301_1230.m4a"]["start"], got["240301_1230.m4a"]["start_source"]) == (at, "filename+mtime-seconds")
    # two numbers that are no date come first
    assert (got["9999x9999_20240301-123005.mp3"]["start"], got["9999x9999_20240301-123005.mp3"]["start_source"]) == (at, "filename+mtime-seconds")


def test_names_hold_times(spark):
    cases = {"240526_1119.wav": "2024-05-26 11:19:00", "20240526_111936": "2024-05-26 11:19:36", "x 2024-05-26_11-19": "2024-05-26 11:19:00", "1920_1080_24-60 then 240526_1119": "2024-05-26 11:19:00", "241399_1119": None, "9240526_1119": None, "no": None, "2024_02_30 10:00 and 2024_02_28 10:00:59": "2024-02-28 10:00:59"}
    df = spark.createDataFrame([(k,) for k in cases], "n string")
    assert [r[0] and str(r[0]) for r in df.select(V.filename_time(F.col("n"))).collect()] == list(cases.values())


def test_listing_reads_no_content(spark, tmp_path):
    write(tmp_path, "a.mp4", b"x")
    plan = media.listing(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema" in plan and "content" not in plan.split("ReadSchema")[1]


def slides(df, **more):
    return [(r["file"], r["order_source"], r["timestamp_start"], r["timestamp_end"], r["no_audio"]) for r in media.image_slides(df, ["deck"], **more).orderBy("slide_id").collect()]


def test_images_become_slides(spark):
    t = datetime(2024, 5, 1, 9)
    rows = [("d", f"IMG_{n}.jpg", f"/d/IMG_{n}.jpg", at and t + timedelta(seconds=at), ok) for n, at, ok in ((10, 300, True), (9, 100, True), (2, 100, True), (1, 20, False), (3, None, False))]
    df = spark.createDataFrame(rows, "deck string, file string, path string, start timestamp, reliable boolean")
    assert slides(df) == [("IMG_1.jpg", "mtime", 0, 0, True), ("IMG_2.jpg", "exif", 0, 0, True), ("IMG_9.jpg", "exif", 0, 0, True), ("IMG_10.jpg", "exif", 0, 0, True), ("IMG_3.jpg", "filename", 0, 0, True)]
    assert [s[2:] for s in slides(df, audio_s=F.lit(99))] == [(0, 19, False), (19, 39, False), (39, 59, False), (59, 79, False), (79, 99, False)]
    timed = df.where("start is not null")
    assert [s[2:4] for s in slides(timed, clock=F.lit(t + timedelta(seconds=50)), audio_s=F.lit(400))] == [(0, 50), (50, 50), (50, 250), (250, 400)]
    assert [s[0] for s in slides(df, between=(F.lit(t + timedelta(seconds=50)), F.lit(t + timedelta(seconds=200))))] == ["IMG_2.jpg", "IMG_9.jpg"]
    same = df.withColumn("start", F.lit(t))
    assert [s[:2] for s in slides(same)] == [(f"IMG_{n}.jpg", "filename") for n in (1, 2, 3, 9, 10)]
    assert slides(df.limit(0)) == []
