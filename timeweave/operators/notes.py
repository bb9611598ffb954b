"""Lint of Markdown notes: one pass, every check an expression on the note's own row. Nothing is rewritten."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.loops import payload_repetition
from ..functions.values import fmt_hms

HAN = "[一-鿿]"
EMBED = "!\\[\\[([^\\]]+\\.(?:png|jpe?g|gif|webp|svg)[^\\]]*)\\]\\]"
FRONT = "(?s)\\A---\\n(.*?)\\n---(?:\\n|\\z)"
HEADING = "^#{1,6}\\s+\\S"


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def _matching(lines: Column, *patterns: str) -> Column:
    """How many lines match all of the patterns."""
    def test(line: Column) -> Column:
        out = line.rlike(patterns[0])
        for p in patterns[1:]:
            out &= line.rlike(p)
        return out

    return F.size(F.filter(lines, test))


def widthless(text: Column) -> Column:
    """Image embeds without a width."""
    return F.size(F.filter(F.regexp_extract_all(text, F.lit("(?i)" + EMBED), 1), lambda e: ~e.rlike("\\|\\s*[0-9]+\\s*(\\||$)")))


def cited_headings(lines: Column) -> Column:
    """Headings that end in a source: a code span that is no time, or a mark of citation."""
    code = F.transform(F.filter(lines, lambda l: l.rlike("^#{1,6}\\s")), lambda l: F.struct(F.regexp_extract(l, "`([^`]+)`\\s*$", 1).alias("code"), l.rlike("(來源|出處|DOI|（s\\d+）|\\(s\\d+\\))\\s*$").alias("cited")))
    return F.size(F.filter(code, lambda c: c["cited"] | ((c["code"] != "") & ~F.trim(c["code"]).rlike("^[0-9:\\-\\s~–.]+$"))))


def bare_pipes(lines: Column) -> Column:
    """Table lines with a wiki link whose pipe isn't escaped."""
    links = lambda l: F.regexp_extract_all(l, F.lit("\\[\\[[^\\]]*\\]\\]"), 0)
    return F.size(F.filter(lines, lambda l: F.ltrim(l).startswith("|") & F.exists(links(l), lambda w: F.contains(w, F.lit("|")) & ~F.contains(w, F.lit("\\|")))))


def hugged(lines: Column) -> Column:
    """Lines in which a Han character touches the outside of a highlight."""
    return F.size(F.filter(lines, lambda l: F.exists(F.regexp_extract_all(l, F.lit(f"({HAN}?)==[^=]+==({HAN}?)"), 0), lambda m: m.rlike(f"^{HAN}|{HAN}$"))))


def unescaped(lines: Column) -> Column:
    """Highlights with a <, >, | or # that isn't escaped."""
    return F.size(F.filter(F.flatten(F.transform(lines, lambda l: F.regexp_extract_all(l, F.lit("==([^=]+)=="), 1))), lambda h: h.rlike("(?<!\\\\)[<>|#]")))


def spaced_bullets(text: Column) -> Column:
    """Bullets indented by blanks, below the front matter."""
    return _matching(F.split(F.regexp_replace(text, FRONT, ""), "\n", -1), "^ +[-*] ")


def empty_headings(lines: Column) -> Column:
    """Headings with nothing before the next one, unless that is deeper; a heading at the end has nothing, too."""
    kept = F.filter(lines, lambda l: l.rlike("\\S"))
    level = lambda l: F.length(F.regexp_extract(l, "^(#{1,6})\\s+\\S", 1))
    after = F.concat(F.slice(kept, 2, F.greatest(F.size(kept), F.lit(1))), F.array(F.lit("# end")))
    return F.size(F.filter(F.zip_with(kept, after, lambda a, b: (level(a) > 0) & (level(b) > 0) & (level(b) <= level(a))), lambda x: F.coalesce(x, F.lit(False))))


def galleries(lines: Column, least: int = 3) -> Column:
    """Runs of at least ``least`` images with no prose between; blank and quoted lines don't part them."""
    state = "struct<run:int,found:int>"
    start = F.struct(F.lit(0).alias("run"), F.lit(0).alias("found")).cast(state)

    def step(a: Column, l: Column) -> Column:
        n, ends = _count(l, "(?i)" + EMBED), ~F.trim(l).rlike("^(>.*)?$")
        return F.when(n > 0, F.struct((a["run"] + n).alias("run"), a["found"].alias("found"))).when(ends, F.struct(F.lit(0).alias("run"), (a["found"] + (a["run"] >= least).cast("int")).alias("found"))).otherwise(a).cast(state)

    return F.aggregate(lines, start, step, lambda a: a["found"] + (a["run"] >= least).cast("int"))


def long_bullets(lines: Column, most: int = 50) -> Column:
    """Bullets of more than ``most`` Han characters above the list of sources."""
    at = F.array_position(F.transform(lines, lambda l: l.rlike("^#\\s+Resource\\s*$")), True)
    above = F.when(at > 0, F.slice(lines, F.lit(1), (at - 1).cast("int"))).otherwise(lines)
    return F.size(F.filter(above, lambda l: F.trim(l).rlike("^[-*] ") & (_count(l, HAN) > most)))


def repeated_tables(text: Column, least: int = 3) -> Column:
    """Different tables of ``least`` rows or more that occur more than once, white space aside."""
    blocks = F.transform(F.regexp_extract_all(F.concat(F.lit("\n"), text), F.lit("(?:\\n[ \\t]*\\|[^\\n]*){%d,}" % least), 0), lambda b: F.regexp_replace(b, "[ \\t]+", ""))
    return F.size(F.filter(F.array_distinct(blocks), lambda b: F.size(F.filter(blocks, lambda x: x == b)) > 1))


#: Checks of every mode: name, level of a finding, count of what is wrong.
def checks(text: Column, mode: str, headings: list[str]) -> list[tuple[str, str, Column]]:
    lines = lines_of(text)
    missing = lambda pattern: (~text.rlike(pattern)).cast("int")
    out = [
        ("STRUCT sources", "FAIL", missing("(?m)^#\\s+Resource\\s*$")),
        ("STRUCT summary", "FAIL", missing("(?m)^>\\s*\\[!summary\\]")),
        ("STRUCT tags", "FAIL", (~F.regexp_extract(text, FRONT, 1).rlike("(?m)^tags:")).cast("int")),
        ("FIG width", "FAIL", widthless(text)),
        ("FIG todo", "FAIL", _count(text, "\\[!todo\\]")),
        ("FMT source on heading", "FAIL", cited_headings(lines)),
        ("FMT pipe in table link", "FAIL", bare_pipes(lines)),
        ("FMT highlight touched", "WARN", hugged(lines)),
        ("FMT highlight escapes", "WARN", unescaped(lines)),
        ("FMT code block", "WARN", F.floor((_count(text, "```") + 1) / 2).cast("int")),
        ("FMT blank indent", "WARN", spaced_bullets(text)),
        ("FMT empty heading", "WARN", empty_headings(lines)),
        ("REP repetition", "WARN", payload_repetition(text)["degenerate"].cast("int")),
    ]
    out += [(f"STRUCT {h}", "FAIL", missing(f"(?m)^#\\s+\\Q{h}\\E\\b")) for h in headings]
    if mode == "lecture":
        titles = F.zip_with(lines, F.slice(lines, 2, F.greatest(F.size(lines), F.lit(1))), lambda a, b: F.length(F.regexp_extract(a, "^>\\s*\\[!figure\\]\\s*(.*?)\\s*$", 1)) * b.rlike("^>\\s*!\\[\\[").cast("int"))
        out += [("LEC gallery", "WARN", galleries(lines)), ("LEC long figure title", "WARN", F.size(F.filter(titles, lambda n: n > 45))), ("LEC speaker", "WARN", (~F.contains(text, F.lit("🗣️"))).cast("int"))]
    if mode == "textbook":
        out += [("TXT citation", "FAIL", _count(text, "\\(citation\\b")), ("TXT long bullet", "WARN", long_bullets(lines)), ("TXT repeated table", "WARN", repeated_tables(text))]
    return out


def audit_notes(notes: DataFrame, key: str, text: str, mode: str = "lecture", headings: list[str] | None = None) -> DataFrame:
    """(key, level, check, n): every check of the mode on every note, PASS where nothing is wrong. Null notes count as empty."""
    rows = notes.select(key, F.coalesce(F.col(text), F.lit("")).alias("__tw_t"))
    made = [F.struct(F.when(n > 0, level).otherwise("PASS").alias("level"), F.lit(name).alias("check"), n.cast("int").alias("n")) for name, level, n in checks(F.col("__tw_t"), mode, headings or [])]
    return rows.select(key, F.explode(F.array(*made)).alias("f")).select(key, "f.*")


# ---------------------------------------------------------------- time citations

MEDIA = "(?:MTS|mts|mp4|MP4|mov|MOV|m2ts|M2TS|avi|AVI|mp3|MP3|m4a|M4A|wav|WAV|aac|AAC)"


def declared_labels(notes: DataFrame, key: str, text: str, section: str = "影片代號") -> DataFrame:
    """(key, label, file): the note's own table of labels for media files; the cell's comments are left out."""
    table = F.regexp_extract(text, f"(?s)##\\s*{section}.*?\\n(.*?)(?=\\n#|\\z)", 1)
    row = "(?m)^\\|\\s*([A-Za-z]\\d+)\\s*\\|\\s*([^|\\n]+?)\\s*\\|"
    pairs = F.arrays_zip(F.regexp_extract_all(table, F.lit(row), 1).alias("label"), F.regexp_extract_all(table, F.lit(row), 2).alias("cell"))
    cells = notes.select(key, F.posexplode(pairs).alias("at", "p")).select(key, "at", "p.label", F.regexp_extract("p.cell", f"^\\s*`?\\s*(.+?\\.{MEDIA})\\s*`?(?:\\s|$|[（(])", 1).alias("file")).where("file <> ''")
    # the last row of a label counts
    return cells.groupBy(key, "label").agg(F.max_by("file", "at").alias("file"))


def time_citations(notes: DataFrame, key: str, text: str, labels: DataFrame) -> DataFrame:
    """(key, at, file, start_s, until): the jumps of ``(V1 04:22–04:31, 06:13)`` citations, in order of text.

    A citation is a bracket of nothing but times with a label, a file name or
    neither, and separators; a note without a clock may lead it. ``-``, ``–`` and
    ``~`` make a range within one file (``28:30-42`` ends in the same minute),
    other separators a list. A time without a label takes the one before it, the
    first takes the note's only file. A bracket with any label or file that
    ``labels`` (key, label, file) doesn't know is prose and gives no row.
    """
    item = f"(?:([A-Za-z]\\d+)\\s+|([^,;/、；，→~–—:\\n()]+?\\.{MEDIA})\\s+)?(?:⚠️?\\s*approx\\s*|approx\\s*)?(\\d{{1,3}}:[0-5]\\d(?::[0-5]\\d)?)"
    runs = notes.select(key, F.posexplode(F.regexp_extract_all(text, F.lit("\\(([^()`]*\\d{1,2}:\\d{2}[^()`]*)\\)"), 1)).alias("at", "run"))
    # blanks before the first time that hold no clock are a note
    lead = "^[^:()]*?(?=(?:[A-Za-z]\\d+\\s+|[^,;/、；，→~–—:\\n()]+?\\." + MEDIA + "\\s+)?(?:⚠️?\\s*approx\\s*|approx\\s*)?\\d{1,3}:[0-5]\\d)"
    body = F.regexp_replace("run", lead, "")
    gaps = F.regexp_replace(F.regexp_replace(body, item, "\u0001"), "[~\\-–—][0-5]?\\d$", "")
    fits = runs.where(gaps.rlike("^(\u0001[\\s,;/、；，→和及~\\-–—]*)+$"))
    parts = F.regexp_extract_all(body, F.lit(f"([\\s,;/、；，→和及~\\-–—]*){item}"), 0)
    each = fits.select(key, "at", F.regexp_extract(body, "[~\\-–—]([0-5]?\\d)$", 1).alias("tail"), F.posexplode(parts).alias("no", "part"), F.size(parts).alias("n"))
    got = lambda i: F.nullif(F.trim(F.regexp_extract("part", f"^([\\s,;/、；，→和及~\\-–—]*){item}$", i)), F.lit(""))
    each = each.select(key, "at", "no", "n", "tail", F.regexp_extract("part", "^([\\s,;/、；，→和及~\\-–—]*)", 1).rlike("[~\\-–—]").alias("ranged"), got(2).alias("label"), got(3).alias("named"), got(4).alias("clock"))
    known = labels.select(key, F.col("label"), F.col("file").alias("of"))
    lone = labels.groupBy(key).agg(F.when(F.count_distinct("file") == 1, F.max("file")).alias("lone"))
    files = labels.select(key, F.col("file").alias("named")).distinct().withColumn("__tw_k", F.lit(True))
    each = each.join(known, [key, "label"], "left").join(files, [key, "named"], "left").join(lone, key, "left")
    w = Window.partitionBy(key, "at").orderBy("no")
    own = F.when(F.col("label").isNotNull(), F.coalesce("of", F.lit("?"))).when(F.col("named").isNotNull(), F.when(F.col("__tw_k"), F.col("named")).otherwise("?")).when(F.col("no") == 0, F.coalesce("lone", F.lit("?")))
    seconds = F.aggregate(F.split("clock", ":"), F.lit(0), lambda a, x: a * 60 + x.cast("int"))
    each = each.withColumns({"file": F.last(own, True).over(w), "own": own, "t": seconds})
    whole = Window.partitionBy(key, "at")
    each = each.withColumn("bad", F.max(F.col("file") == "?").over(whole)).where("not bad")
    folded = F.col("ranged") & (F.col("label").isNull() & F.col("named").isNull()) & (F.col("no") > 0)
    each = each.withColumn("head", F.sum((~folded).cast("int")).over(w))
    group = each.groupBy(key, "at", "head").agg(F.min_by("file", "no").alias("file"), F.min_by("t", "no").alias("start_s"), F.when(F.count("*") > 1, F.max_by("t", "no")).alias("until"), F.max_by("t", "no").alias("last"), F.max("no").alias("no"), F.max("n").alias("n"), F.max("tail").alias("tail"))
    ending = F.when((F.col("no") == F.col("n") - 1) & (F.col("tail") != ""), F.floor(F.col("last") / 60) * 60 + F.col("tail").cast("int")).otherwise(F.col("until"))
    return group.select(key, "at", F.col("head").cast("int").alias("nth"), "file", "start_s", ending.cast("int").alias("until"), fmt_hms(F.col("start_s")).alias("clock"))
