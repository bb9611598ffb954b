"""Scalar functions on text, as column expressions that stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HAN = "\\p{IsHan}"


def drop_lines(text: Column, tokens: list[str], max_len: int | None = None) -> Column:
    """Lines that hold one of ``tokens`` go (only lines up to ``max_len`` characters, if given)."""
    bad = lambda line: F.exists(F.array(*map(F.lit, tokens)), lambda t: F.contains(line, t)) & (F.lit(True) if max_len is None else F.length(F.trim(line)) <= max_len)
    return F.array_join(F.filter(F.split(text, "\n"), lambda line: ~bad(line)), "\n")


def drop_pattern_lines(text: Column, pattern: str) -> Column:
    return F.array_join(F.filter(F.split(text, "\n"), lambda line: ~line.rlike(pattern)), "\n")


def classify_keyword(word: Column, drug_endings: list[str], medical_endings: list[str], abbreviations: list[str], glued: int = 19) -> Column:
    """cjk, abbreviation, drug, medical_term, general, or null; the first that holds.

    Long Latin runs without a hyphen are glued words (null), and so is what is
    shorter than five characters and nothing else. An ending counts only behind
    three characters or more.
    """
    t = F.trim(word)
    low = F.lower(t)

    def ends(endings: list[str]) -> Column:
        out = F.lit(False)
        for e in endings:
            out |= F.endswith(low, F.lit(e.lower())) & (F.length(t) > len(e) + 2)
        return out

    known = F.upper(t).isin(*[a.upper() for a in abbreviations])
    kind = F.when(t.rlike(f"^{HAN}{{2,}}$"), "cjk").when((F.length(t) >= glued) & ~F.contains(t, F.lit("-")), F.lit(None).cast("string"))
    kind = kind.when(t.rlike("^\\p{Lu}{1,4}$") | known, "abbreviation").when(ends(drug_endings), "drug").when(ends(medical_endings), "medical_term")
    return kind.when(F.length(t) >= 5, "general")


def keywords(text: Column) -> Column:
    """Latin words of two and more characters and Han runs, as written, each once, in order."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(f"([A-Za-z][A-Za-z0-9-]+|{HAN}{{2,}})"), 1))


def wordless(text: Column) -> Column:
    return ~F.coalesce(text, F.lit("")).rlike("[\\p{L}\\p{N}]")


def script_class(text: Column, share: float = 0.3) -> Column:
    """cjk when ``share`` of the characters that aren't white space are Han, else latin."""
    bare = F.regexp_replace(text, "\\s+", "")
    return F.when(F.regexp_count(bare, F.lit(HAN)) >= share * F.greatest(F.length(bare), F.lit(1)), "cjk").otherwise("latin")


def language_verdict(text: Column, low: float = 0.1, high: float = 0.6) -> Column:
    """zh, en or bilingual by the share of Han among Han and Latin characters; unknown without either."""
    han, latin = F.regexp_count(text, F.lit(HAN)), F.regexp_count(text, F.lit("[A-Za-z]"))
    share = han / F.nullif(han + latin, F.lit(0))
    return F.when(share.isNull(), "unknown").when(share >= high, "zh").when(share <= low, "en").otherwise("bilingual")


# The marks that comparison ignores, and the full-width forms of ASCII (for SQL that has no normal forms).
MARKS = "[\\s\u3000，。、；：！？「」『』（）()\\[\\]【】《》〈〉…—–\\-~～·．,.;:!?\"'“”‘’/\\\\|]+"
WIDE = "".join(chr(c + 0xFEE0) for c in range(0x21, 0x7F))
NARROW = "".join(chr(c) for c in range(0x21, 0x7F))


def all_grams(text: Column, n: int) -> Column:
    """Every run of n characters, in order; none for shorter texts. One scan of the text."""
    return F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{n}}}))"), 1)


def char_grams(text: Column, n: int = 2) -> Column:
    """Distinct character n-grams; none for shorter texts."""
    return F.array_distinct(all_grams(text, n))


def top_count(values: Column) -> Column:
    """How often the most frequent value of an array occurs (0 for an empty one), by one pass over its sorted form."""
    state = "struct<last:string,run:int,best:int>"
    start = F.struct(F.lit(None).cast("string").alias("last"), F.lit(0).alias("run"), F.lit(0).alias("best")).cast(state)

    def step(a: Column, x: Column) -> Column:
        run = F.when(a["last"].eqNullSafe(x), a["run"] + 1).otherwise(1)
        return F.struct(x.alias("last"), run.alias("run"), F.greatest(a["best"], run).alias("best")).cast(state)

    return F.aggregate(F.array_sort(values), start, step)["best"]


def inline_repeat(line: Column) -> Column:
    """The greatest number of times that a unit of 3 to 14 characters follows itself (4 at least, else 0); numbers don't count."""
    pattern = "(.{3,14}?)\\1{3,}"
    runs = F.arrays_zip(F.regexp_extract_all(line, F.lit(pattern), 0).alias("run"), F.regexp_extract_all(line, F.lit(pattern), 1).alias("unit"))
    real = F.filter(runs, lambda r: ~r["unit"].rlike("^[0-9%.]+$"))
    return F.coalesce(F.array_max(F.transform(real, lambda r: F.floor(F.length(r["run"]) / F.length(r["unit"])).cast("int"))), F.lit(0))


def bigram_jaccard(a: Column, b: Column, min_len: int = 20) -> Column:
    """Jaccard similarity of character bigrams; null when a side is too short to tell."""
    x, y = char_grams(a), char_grams(b)
    return F.when((F.length(a) >= min_len) & (F.length(b) >= min_len), F.size(F.array_intersect(x, y)) / F.size(F.array_union(x, y)))


def cue_hit(text: Column, cues: list[str]) -> Column:
    low = F.lower(text)
    return F.exists(F.array(*[F.lit(c.lower()) for c in cues]), lambda c: F.contains(low, c))


def _quoted(word: Column) -> Column:
    return F.concat(F.lit("\\Q"), F.replace(word, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E"))


def word_start_hit(text: Column, word: Column) -> Column:
    """A Latin word at the start of a word (its end is free), anything else anywhere; without regard to case."""
    low, key = F.lower(text), F.lower(word)
    latin = key.rlike("^[a-z0-9][a-z0-9-]*$")
    return F.when(latin, F.regexp_like(low, F.concat(F.lit("(?<![a-z0-9])"), _quoted(key)))).otherwise(F.contains(low, key))


def abbreviation_hit(text: Column, word: Column) -> Column:
    """The word as written, between characters that are neither letters nor digits."""
    return F.regexp_like(text, F.concat(F.lit("(?<![A-Za-z0-9])"), _quoted(word), F.lit("(?![A-Za-z0-9])")))


def gram_hit(texts: Column, word: Column, least: float = 0.4) -> Column:
    """A Han word in a window's texts (an array): short ones verbatim in one run of Han, longer ones by ``least`` of their distinct bigrams.

    White space between Han characters is taken out first; no run spans two texts.
    """
    joined = F.transform(texts, lambda t: F.regexp_replace(t, f"(?<={HAN})\\s+(?={HAN})", ""))
    runs = F.flatten(F.transform(joined, lambda t: F.regexp_extract_all(t, F.lit(f"({HAN}{{2,}})"), 1)))
    wanted, held = char_grams(word, 2), F.array_distinct(F.flatten(F.transform(runs, lambda r: all_grams(r, 2))))
    share = F.size(F.array_intersect(wanted, held)) / F.nullif(F.size(wanted), F.lit(0))
    return F.when(F.length(word) < 4, F.exists(runs, lambda r: F.contains(r, word))).otherwise(F.coalesce(share >= least, F.lit(False)))


def cue_density(texts: Column, cues: list[str]) -> Column:
    """Share of a window's texts that hold any cue; 0 without texts."""
    return F.when(F.size(texts) > 0, F.size(F.filter(texts, lambda t: F.coalesce(cue_hit(t, cues), F.lit(False)))) / F.size(texts)).otherwise(F.lit(0.0))


def domains(text: Column, hints: dict[str, list[str] | str]) -> Column:
    """Names of the domains of which a hint stands in the text, in the map's order; a single hint may be a string."""
    low = F.lower(text)
    tests = [F.when(F.exists(F.array(*[F.lit(h.lower()) for h in ([hs] if isinstance(hs, str) else hs) if h]), lambda h: F.contains(low, h)), F.lit(name)) for name, hs in hints.items() if hs]
    return F.array_compact(F.array(*tests)) if tests else F.array().cast("array<string>")


#: A line of nothing but numbers and their marks.
PURE_NUMBER = "^[\\d\\s.,%:;/\\\\\\-–—+()（）\\[\\]#*]+$"


def good_line(line: Column, chrome: list[str], patterns: list[str] = ()) -> Column:
    """Whether a line can be a title: two letters or Han characters at least, no number, none of the words ``chrome`` and no match of ``patterns``.

    Both are settings: what the programs in use write into a picture.
    """
    t = F.trim(F.regexp_replace(line, "^\\s+|\\s+$", ""))
    ok = (F.regexp_count(t, F.lit("[A-Za-z一-鿿]")) >= 2) & ~t.rlike(PURE_NUMBER)
    for pattern in patterns:
        ok &= ~t.rlike(pattern)
    for token in chrome:
        ok &= ~F.contains(t, F.lit(token))
    return F.coalesce(ok, F.lit(False))


def clean_title(guess: Column, text: Column, labels: Column, chrome: list[str], patterns: list[str] = ()) -> Column:
    """The first good line of the guess, the text's lines and the labels (an array), its white space single; empty if none."""
    none = F.array().cast("array<string>")
    lines = F.concat(F.array(F.coalesce(guess, F.lit(""))), F.coalesce(F.split(text, "\\r?\\n"), none), F.coalesce(labels, none))
    return F.coalesce(F.regexp_replace(F.regexp_replace(F.get(F.filter(lines, lambda x: good_line(x, chrome, patterns)), F.lit(0)), "^\\s+|\\s+$", ""), "\\s+", " "), F.lit(""))


def salient_tokens(text: Column, stop: list[str]) -> Column:
    """Distinct Latin words of three letters and more, without stop words, in order."""
    return F.array_except(F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit("[a-z]{3,}"), 0)), F.array(*map(F.lit, stop)))


def wordy_chars(text: Column) -> Column:
    """Characters in Latin words of three and more and Han runs of two and more."""
    return F.aggregate(F.regexp_extract_all(text, F.lit(f"([A-Za-z]{{3,}}|{HAN}{{2,}})"), 1), F.lit(0), lambda a, w: a + F.length(w))


def strip_tags(text: Column) -> Column:
    """Markup, the common entities and runs of white space removed."""
    out = F.regexp_replace(text, "<[^>]*>", " ")
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        out = F.replace(out, F.lit(entity), F.lit(char))
    return F.trim(F.regexp_replace(out, "[ \\t\\n\\r]+", " "))


def note_payload(text: Column) -> Column:
    """A note without front matter, embeds, link syntax, time codes, addresses and white space."""
    out = F.regexp_replace(text, "(?s)^---\\n.*?\\n---\\n", "")
    for pattern, to in (("!\\[\\[[^\\]]*\\]\\]", ""), ("\\[\\[([^\\]|]*\\|)?([^\\]]*)\\]\\]", "$2"), ("https?://[^ \\n]+", ""), ("[0-9]{1,2}:[0-9]{2}(:[0-9]{2})?", ""), ("[ \\t\\n\\r]+", "")):
        out = F.regexp_replace(out, pattern, to)
    return out


def slug(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "-"), "^-|-$", "")


def natural_key(text: Column, width: int = 8) -> Column:
    """A sort key in which runs of digits compare as numbers."""
    parts = F.regexp_extract_all(text, F.lit("([0-9]+|[^0-9]+)"), 1)
    return F.array_join(F.transform(parts, lambda p: F.when(p.rlike("^[0-9]+$"), F.lpad(p, width, "0")).otherwise(p)), "")


def truncate_words(text: Column, budget: int, least: float = 0.8) -> Column:
    """At most ``budget`` characters, cut at white space if that keeps enough of them."""
    cut = F.substring(text, 1, budget)
    at = F.length(cut) - F.instr(F.reverse(cut), " ")
    return F.when(F.length(text) <= budget, text).when((F.instr(cut, " ") > 0) & (at >= least * budget), F.substring(cut, F.lit(1), at)).otherwise(cut)


def capital_terms(text: Column, limit: int = 50) -> Column:
    return F.slice(F.array_sort(F.array_distinct(F.regexp_extract_all(text, F.lit("[A-Z][a-z]{3,}"), 0))), 1, limit)


def transient_error(kind: Column, status: Column) -> Column:
    """Whether a failed call is worth another try: time-outs, lost connections, broken streams, and a server's own errors."""
    return F.coalesce(kind.isin("timeout", "connection", "chunked") | ((kind == "http") & status.isin(500, 502, 503, 504, 522, 524)), F.lit(False))


def repetition_score(text: Column) -> Column:
    """Greatest count of a word trigram over the number of distinct trigrams, to three places; 0 under six words."""
    w = F.regexp_extract_all(F.lower(text), F.lit("[\\p{L}\\p{N}_]+"), 0)
    grams = F.zip_with(F.zip_with(w, F.slice(w, 2, F.greatest(F.size(w), F.lit(1))), lambda a, b: F.concat(a, F.lit(" "), b)), F.slice(w, 3, F.greatest(F.size(w), F.lit(1))), lambda a, b: F.concat(a, F.lit(" "), b))
    whole = F.filter(grams, lambda g: g.isNotNull())
    return F.when(F.size(w) >= 6, F.round(top_count(whole) / F.size(F.array_distinct(whole)), 3)).otherwise(F.lit(0.0))


def snippet(text: Column, terms: list[str], before: int = 24, size: int = 90) -> Column:
    """Text around the earliest of ``terms``; its start when none is found."""
    at = F.least(*[F.nullif(F.instr(F.lower(text), t.lower()), F.lit(0)) for t in [*terms, terms[0]]])
    return F.substring(text, F.greatest(F.coalesce(at, F.lit(1)) - before, F.lit(1)), F.lit(size))
