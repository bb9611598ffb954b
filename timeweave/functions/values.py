"""Scalar functions on scores, times, hashes and signals. Unknown (null) is never taken for zero."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def skip_gate(density: Column, text_len: Column, size_kb: Column, sharpness: Column) -> Column:
    """Decorative frames: every metric is known and low."""
    return F.coalesce((density < 0.05) & (text_len < 20) & (size_kb < 80) & (sharpness < 100), F.lit(False))


def skip_reasons(density: Column, text_len: Column, size_kb: Column, sharpness: Column) -> Column:
    tests = (("low_density", density < 0.05), ("little_text", text_len < 20), ("small_file", size_kb < 80), ("flat_image", sharpness < 100))
    return F.array_compact(F.array(*[F.when(t, n) for n, t in tests]))


def ocr_route(is_pdf: Column, text_len: Column, density: Column, has_image: Column) -> Column:
    return F.when(is_pdf, "pdf").when(~has_image, "image-missing").when(density.isNotNull() & (text_len < 12) & (density < 0.03), "skip").otherwise("engine")


def ocr_fallback(result: Column, error: Column, confidence: Column, least: float = 0.60) -> Column:
    """Reason to use the fallback engine, or null."""
    return F.when(result.isNull(), "no_result").when(error.isNotNull(), "error").when(confidence < least, "low_confidence")


def polygon_density(points: Column, area: Column) -> Column:
    """Area of a polygon (array of x, y structs) by the shoelace formula over ``area``, at most 1."""
    n = F.size(points)
    twice = F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0.0), lambda a, i: a + F.get(points, i)["x"] * F.get(points, (i + 1) % n)["y"] - F.get(points, (i + 1) % n)["x"] * F.get(points, i)["y"])
    return F.least(F.abs(twice) / 2 / area, F.lit(1.0))


def reading_order(blocks: Column, joiner: str = " ") -> Column:
    """Texts of blocks (top, left, text) from top to bottom and left to right."""
    return F.array_join(F.transform(F.array_sort(F.transform(blocks, lambda b: F.struct(b["top"].alias("top"), b["left"].alias("left"), b["text"].alias("text")))), lambda b: b["text"]), joiner)


def mean_confidence(values: Column) -> Column:
    return F.when(F.size(values) > 0, F.aggregate(values, F.lit(0.0), lambda a, x: a + x) / F.size(values))


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def changed_fraction(a: Column, b: Column, levels: float) -> Column:
    """Share of places that differ by more than ``levels``."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: (F.abs(x - y) > levels).cast("int")), F.lit(0), lambda s, x: s + x) / F.size(a)


def bhattacharyya(a: Column, b: Column) -> Column:
    """Distance of two histograms, each scaled to sum 1."""
    total = lambda h: F.aggregate(h, F.lit(0.0), lambda s, x: s + x)
    mix = F.aggregate(F.zip_with(a, b, lambda x, y: F.sqrt(x * y)), F.lit(0.0), lambda s, x: s + x)
    return F.sqrt(F.greatest(F.lit(0.0), 1 - mix / F.sqrt(total(a) * total(b))))


def layout_similarity(ssim: Column, distance: Column) -> Column:
    return 0.6 * ssim + 0.4 * (1 - distance)


def skip_score(dwell_s: Column, words: Column, density: Column) -> Column:
    return F.when((dwell_s < 10) & (words < 30), F.lit(0.9)).otherwise(F.least(F.greatest(1 - density, F.lit(0.0)), F.lit(1.0)))


# Kinds of content that tiers and widths depend on.
CHARTS = ("flowchart", "chart", "kaplan_meier", "scatter_plot")
IMAGES = ("ultrasound", "xray", "mri")
FLOOR = (*IMAGES, "anatomy", *CHARTS)


def _strings(values) -> Column:
    return F.array(*map(F.lit, values)).cast("array<string>")


def tier_score(s: dict[str, Column], weights: dict[str, float], bonuses: dict[str, float], penalties: dict[str, float], redundancy_over: float) -> Column:
    """Weighted score of a slide's signals, with bonuses for kinds of content and penalties, held in 0..1.

    ``s``: visual_complexity, information_density, reference_density, emphasis,
    time_s, skip, confusion, redundancy (null counts as 0) and types (an array).
    """
    v = {k: F.coalesce(c, F.lit(0.0)) for k, c in s.items() if k != "types"}
    raw = weights["visual_complexity"] * v["visual_complexity"] + weights["information_density"] * v["information_density"] + weights["reference_density"] * v["reference_density"] + weights["emphasis"] * v["emphasis"] + weights["time"] * F.least(v["time_s"] / 120, F.lit(1.0))
    for kind, bonus in bonuses.items():
        raw = raw + F.when(F.array_contains(s["types"], kind), bonus).otherwise(0.0)
    raw = raw + penalties["skip"] * v["skip"] + penalties["confusion"] * v["confusion"] + F.when(v["redundancy"] > redundancy_over, penalties["redundancy"]).otherwise(0.0)
    return F.least(F.greatest(raw, F.lit(0.0)), F.lit(1.0))


def tier(score: Column, types: Column, functions: Column, redundancy: Column, imaging: Column, algorithm: Column, canonical: Column, thresholds: tuple[float, float], force_1: list[str], force_3: list[list[str]]) -> Column:
    """1, 2 or 3 by score, then the overrides in their order.

    A function of ``force_1`` makes 1; else a set of kinds equal to one of
    ``force_3``, or redundant text without any visual kind, makes 3; else a
    canonical slide with an image or chart isn't let below 2.
    """
    types, functions = F.coalesce(types, _strings([])), F.coalesce(functions, _strings([]))
    red, clinical, steps = F.coalesce(redundancy, F.lit(0.0)), F.coalesce(imaging, F.lit(False)), F.coalesce(algorithm, F.lit(False))
    same = F.lit(False)
    for kinds in force_3:
        same |= (F.size(F.array_except(types, _strings(kinds))) == 0) & (F.size(F.array_except(_strings(kinds), types)) == 0)
    wordy = (red >= 0.7) & (F.size(F.array_except(types, _strings(["text", "title", "decorative"]))) == 0) & ~clinical & ~steps
    base = F.when(score >= thresholds[0], 1).when(score >= thresholds[1], 2).otherwise(3)
    kept = F.coalesce(canonical, F.lit(False)) & (clinical | F.arrays_overlap(types, _strings(FLOOR)))
    return F.when(F.arrays_overlap(functions, _strings(force_1)), 1).when(same | wordy, 3).otherwise(F.when((base == 3) & kept, 2).otherwise(base))


def embed_width(types: Column, functions: Column, imaging: Column, algorithm: Column, force_1: list[str], widths: dict[str, int] | None = None) -> Column:
    """Width in pixels by the first rule that holds: imaging, diagram, chart, nothing but tables, default."""
    # The default widths.
    w = {"imaging": 800, "diagram": 700, "chart": 700, "table": 600, "default": 700} | (widths or {})
    types, functions = F.coalesce(types, _strings([])), F.coalesce(functions, _strings([]))
    has = lambda *k: F.arrays_overlap(types, _strings(k))
    diagram = has("anatomy", "flowchart") | F.coalesce(algorithm, F.lit(False)) | F.arrays_overlap(functions, _strings(force_1))
    table = has("table") & (F.size(F.array_except(types, _strings(["title", "table"]))) == 0)
    return F.when(has(*IMAGES) | F.coalesce(imaging, F.lit(False)), w["imaging"]).when(diagram, w["diagram"]).when(has("chart", "kaplan_meier", "scatter_plot"), w["chart"]).when(table, w["table"]).otherwise(w["default"])


def parse_tier(text: Column) -> Column:
    """The first digit 1-9; absent is 3, unreadable is 1, so a bad label never drops a slide."""
    d = F.regexp_extract(text, "[1-9]", 0)
    return F.when(text.isNull(), 3).when(d == "", 1).otherwise(F.nullif(d, F.lit("")).cast("int"))


def fmt_hms(seconds: Column) -> Column:
    s = F.floor(seconds)
    return F.when(s >= 3600, F.format_string("%d:%02d:%02d", F.floor(s / 3600), F.floor(s % 3600 / 60), s % 60)).otherwise(F.format_string("%02d:%02d", F.floor(s / 60), s % 60))


def parse_time(text: Column) -> Column:
    """Seconds of ``s``, ``MM:SS`` or ``H:MM:SS``."""
    return F.aggregate(F.split(text, ":"), F.lit(0.0), lambda a, x: a * 60 + F.coalesce(x.try_cast("double"), F.lit(None).cast("double")))


# Fixed value: how recorders write a time into a name (240526_1119, 20240526_111936, 2024-05-26_11-19).
NAMED_TIME = r"(?<!\d)(\d{2}|\d{4})[-_]?(\d{2})[-_]?(\d{2})[ _T-]+(\d{2})[-:]?(\d{2})(?:[-:]?(\d{2}))?(?!\d)"


def filename_time(name: Column) -> Column:
    """The first time in a name that is a date, two-digit years as 20xx; null when there is none."""

    def read(found: Column) -> Column:
        year, *rest = (F.regexp_extract(found, NAMED_TIME, i) for i in range(1, 7))
        year = F.when(F.length(year) == 2, F.concat(F.lit("20"), year)).otherwise(year)
        rest[-1] = F.when(rest[-1] == "", "00").otherwise(rest[-1])
        return F.try_to_timestamp(F.concat_ws(" ", year, *rest), F.lit("yyyy MM dd HH mm ss"))

    return F.get(F.filter(F.transform(F.regexp_extract_all(name, F.lit(NAMED_TIME), 0), read), lambda t: t.isNotNull()), F.lit(0))


def refine_seconds(taken: Column, modified: Column) -> Column:
    """The file's own time when it lies in the same minute."""
    return F.when(F.date_trunc("minute", taken) == F.date_trunc("minute", modified), modified).otherwise(taken)


def reliable(source: Column) -> Column:
    return ~F.coalesce(source, F.lit("none")).rlike("^(mtime|none)")


def gpu_verdict(free_mb: Column, util_pct: Column, processes_mb: Column, min_free_mb: int, util_over: int, heavy_mb: int = 1024) -> Column:
    """blocked when too little memory is free, or the device is busy while others hold much; warning when others only hold much."""
    heavy = F.exists(F.coalesce(processes_mb, F.array().cast("array<double>")), lambda m: F.coalesce(m >= heavy_mb, F.lit(False)))
    return F.when((free_mb < min_free_mb) | (heavy & (util_pct > util_over)), "blocked").when(heavy, "warning").otherwise("ok")


def local_time(raw: Column, utc_offset_h: float) -> Column:
    """Capture time as a struct (at, source): universal time shifted, a time with a zone as it stands, camera format, plain ISO; nulls else."""
    s = F.trim(raw)
    iso, tagged = F.substring(F.replace(s, F.lit("T"), F.lit(" ")), 1, 19), s.rlike("^.{10}.*[+-]") & F.contains(s, F.lit("T"))
    # a zone or a fraction after the seconds is dropped: the clock's own reading counts
    zone = F.regexp_extract(F.replace(s, F.lit("T"), F.lit(" ")), "^(\\d{4}-\\d\\d-\\d\\d \\d\\d:\\d\\d(?::\\d\\d(?:\\.\\d{1,6})?)?)", 1)
    exif = F.regexp_replace(F.substring(s, 1, 19), "^(\\d{4}):(\\d\\d):(\\d\\d) ", "$1-$2-$3 ")
    zulu = F.try_to_timestamp(iso, F.lit("yyyy-MM-dd HH:mm:ss")) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(utc_offset_h * 3600).cast("decimal(18,6)"))
    at = F.when(F.endswith(s, F.lit("Z")), zulu).when(tagged, F.try_to_timestamp(zone)).when((F.length(s) >= 19) & (F.substring(s, 5, 1) == ":"), F.try_to_timestamp(exif, F.lit("yyyy-MM-dd HH:mm:ss"))).otherwise(F.try_to_timestamp(iso))
    name = F.when(F.endswith(s, F.lit("Z")), f"utc{int(utc_offset_h):+d}").when(tagged, "tz-tagged").when((F.length(s) >= 19) & (F.substring(s, 5, 1) == ":"), "exif").otherwise("iso")
    return F.struct(at.alias("at"), F.when(at.isNotNull(), name).alias("source"))


def clock_offset(source: Column, model: Column, file: Column, rules: list[tuple[str, float]]) -> Column:
    """Seconds of the first rule whose glob matches the source, the model or the file name; null without one."""
    out = None
    for glob, seconds in rules:
        pattern = F.lit(_glob(glob))
        hit = F.lit(False)
        for c in (source, model, file):
            hit |= F.regexp_like(F.coalesce(c, F.lit("")), pattern)
        out = F.when(hit, F.lit(float(seconds))) if out is None else out.when(hit, F.lit(float(seconds)))
    return F.lit(None).cast("double") if out is None else out


def _glob(glob: str) -> str:
    """A shell pattern (* ? [seq] [!seq]) as a regular expression."""
    out, i = "^(?s)", 0
    while i < len(glob):
        c, i = glob[i], i + 1
        end = glob.find("]", i + 1 + (glob[i : i + 1] == "!")) if c == "[" else -1
        if c == "*":
            out += ".*"
        elif c == "?":
            out += "."
        elif end > 0:
            body = glob[i:end].replace("\\", "\\\\").replace("[", "\\[")
            out += "[" + ("^" + body[1:] if body[0] == "!" else "\\" + body if body[0] == "^" else body) + "]"
            i = end + 1
        else:
            out += "\\" + c if not c.isalnum() and c.isascii() else c
    return out + "$"


def fingerprint(data: Column, size: Column, modified: Column, edge: int = 65536) -> Column:
    """Digest of a file's size, time of change, first and last bytes."""
    text = lambda c: F.concat(c.cast("string"), F.lit("|")).cast("binary")
    tail = F.substring(data, F.greatest(F.octet_length(data) - edge + 1, F.lit(1)), F.lit(edge))
    return F.sha2(F.concat(text(size), text(modified), F.substring(data, 1, edge), tail), 256)
