"""Texts and titles of slides, captions, names of courses, and answers of OCR engines, as expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import wordy_chars

# Kinds of slide that carry information, and kinds that are scenes.
INFORMATION = ("table", "flowchart", "diagram", "algorithm", "chart")
SCENES = ("ultrasound", "decorative")
#: Longest caption, and what it may be cut at.
CAPTION = 34
SEPARATORS = ("——", "：", "，", "（", "；")
EDGES = "，、；：—\\- "


def bare(text: Column) -> Column:
    """Without white space at either end; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), "^\\s+|\\s+$", "")


def title_guess(blocks: Column, height: Column, band: float = 0.35, longest: int = 60) -> Column:
    """The tallest text of blocks (top, height, text) that begin in the upper band; the first of equals, empty if none."""
    made = F.transform(blocks, lambda b, i: F.struct((-b["height"]).alias("h"), i.alias("i"), bare(b["text"]).alias("t"), b["top"].alias("top"), F.length(b["text"]).alias("n")))
    fit = F.filter(made, lambda b: (b["t"] != "") & (b["n"] <= longest) & (b["top"] <= height * band))
    return F.coalesce(F.array_min(fit)["t"], F.lit(""))


def slide_text(clean: Column, quick: Column, summary: Column, types: Column, least: int = 14, longest: int = 240) -> Column:
    """What a slide is searched by: its text, unless it is a scene or has too few words; else an information graphic's summary."""
    text = F.when(bare(clean) != "", bare(clean)).otherwise(bare(quick))
    kinds = F.coalesce(types, F.array().cast("array<string>"))
    has = lambda names: F.arrays_overlap(kinds, F.array(*map(F.lit, names)))
    chosen = F.when((wordy_chars(text) >= least) & ~has(SCENES), text).when(has(INFORMATION), bare(summary)).otherwise("")
    return F.substring(bare(F.regexp_replace(chosen, "\\s+", " ")), 1, longest)


def course_name(slug: Column) -> Column:
    """Date, speaker and topic of ``20250914_L1_speaker_topic``: a struct; unknown speakers and topics have stand-ins."""
    parts = F.split(slug, "_")
    dated = F.get(parts, F.lit(0)).rlike("^[0-9]{8}$")
    rest = F.filter(F.when(dated, F.slice(parts, 2, F.greatest(F.size(parts), F.lit(1)))).otherwise(parts), lambda p: ~p.rlike("^L[0-9]+$"))
    topic = F.array_join(F.slice(rest, 2, F.greatest(F.size(rest), F.lit(1))), "_")
    return F.struct(F.when(dated, F.get(parts, F.lit(0))).otherwise("").alias("date"), F.coalesce(F.get(rest, F.lit(0)), F.lit("unknown")).alias("speaker"), F.when(F.size(rest) > 1, topic).otherwise("lecture").alias("topic"))


def held(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def split_caption(caption: Column, longest: int = CAPTION) -> Column:
    """(short, rest) of a caption: cut at its first separator within reach, else between words; no bracket is left alone.

    Each step is held by the next: an expression that repeats its parts would compute the caption anew for each.
    """
    pair = lambda short, rest: F.struct(short.alias("short"), rest.alias("rest"))
    count = lambda x, ch: F.regexp_count(x, F.lit(ch))

    def placed(c: Column) -> Column:
        reach = F.substring(c, 1, longest + max(map(len, SEPARATORS)))
        places = F.array_compact(F.array(*[F.when((F.instr(reach, s) > 1) & (F.instr(reach, s) <= longest + 1), F.struct((F.instr(reach, s) - 1).alias("at"), F.lit(s).alias("sep"))) for s in SEPARATORS]))
        return F.when(F.length(c) <= longest, pair(c, F.lit(""))).otherwise(held(F.array_min(places), lambda first: divided(c, first)))

    def divided(c: Column, first: Column) -> Column:
        inside = F.substring(c, longest, 2).rlike("^[A-Za-z0-9]{2}$")
        blank = F.length(F.regexp_extract(F.substring(c, 1, longest), "^(.*) [^ ]*$", 1))
        cut = F.when(first.isNotNull(), first["at"]).when(inside & (blank > 0), blank).otherwise(longest)
        after = lambda cut: F.substring(c, cut + F.coalesce(F.length(first["sep"]), F.lit(0)) + 1, F.length(c))
        closed = lambda x: F.when(first["sep"] == "（", F.regexp_replace(x, "^([^）]*)）", "$1")).otherwise(x)
        return held(cut, lambda cut: held(after(cut), lambda x: held(closed(x), lambda after: tidied(F.substring(c, F.lit(1), cut), after))))

    def tidied(short: Column, after: Column) -> Column:
        opened = count(short, "（") > count(short, "）")
        inner, outer = F.regexp_extract(short, "（([^（]*)$", 1), F.regexp_replace(short, "（[^（]*$", "")
        rest = F.when(opened, F.concat(inner, F.when(after.rlike("^($|[，；：])"), after).otherwise(F.concat(F.lit(" "), after)))).otherwise(after)
        trimmed = bare(F.regexp_replace(bare(F.when(opened, outer).otherwise(short)), f"[{EDGES}]+$", ""))
        whole = lambda rest: F.when(count(rest, "）") > count(rest, "（"), bare(F.regexp_replace(rest, "）([^）]*)$", "$1"))).otherwise(rest)
        return pair(trimmed, held(F.regexp_replace(bare(rest), f"^[{EDGES}]+", ""), whole))

    return held(bare(caption), placed)


#: Fields of an engine's answer and the kinds that they may have.
ANSWER = {"fixture": "STRING", "engine": "STRING", "blocks": "ARRAY", "reading_order": "ARRAY", "labels": "ARRAY", "page_confidence": "BIGINT|DOUBLE|DECIMAL", "latency_s": "BIGINT|DOUBLE|DECIMAL"}


def answer_fault(json: Column) -> Column:
    """What is wrong with an engine's answer (JSON text): the first fault, null for a valid one."""
    v = F.try_parse_json(json)
    kind = lambda x: F.schema_of_variant(x)
    at = lambda name: F.try_variant_get(v, f"$.{name}", "variant")
    fault = F.when(v.isNull() | ~kind(v).startswith("OBJECT"), "not an object")
    for name, kinds in ANSWER.items():
        fault = fault.when(at(name).isNull(), f"missing {name}").when(~kind(at(name)).rlike(f"^({kinds})"), f"{name} of a wrong kind")
    many = lambda name: F.try_variant_get(v, f"$.{name}", "array<variant>")
    fault = fault.when(F.exists(many("blocks"), lambda b: ~kind(b).startswith("OBJECT") | F.try_variant_get(b, "$.text", "variant").isNull()), "malformed block")
    return fault.when(F.exists(many("reading_order"), lambda i: kind(i) != "BIGINT"), "reading order not of integers")


def answer_text(json: Column) -> Column:
    """The blocks' texts in reading order (in their own order without one), a line each; blank ones and wrong places left out."""
    v = F.try_parse_json(json)
    texts = F.transform(F.coalesce(F.try_variant_get(v, "$.blocks", "array<variant>"), F.array().cast("array<variant>")), lambda b: F.coalesce(F.try_variant_get(b, "$.text", "string"), F.lit("")))
    order = F.coalesce(F.try_variant_get(v, "$.reading_order", "array<int>"), F.array().cast("array<int>"))
    own = F.when(F.size(order) > 0, order).otherwise(F.filter(F.sequence(F.lit(-1), F.size(texts) - 1), lambda i: i >= 0))
    picked = F.transform(F.filter(own, lambda i: (i >= 0) & (i < F.size(texts))), lambda i: F.get(texts, i))
    return F.array_join(F.filter(picked, lambda t: t != ""), "\n")


def term_recall(text: Column, terms: Column) -> Column:
    """Share of the expected terms that the text holds, without regard to case; null without terms."""
    low = F.lower(text)
    return F.when(F.size(terms) > 0, F.size(F.filter(terms, lambda t: F.contains(low, F.lower(t)))) / F.size(terms))
