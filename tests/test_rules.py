"""Operators against plain versions of their rules, on small tables that reach every branch."""

import fnmatch
import hashlib
import itertools
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from timeweave.functions import fuzzy, grams, loops, numbers, rewrite, signals, slides
from timeweave.functions import text as X
from timeweave.functions import values as V
from timeweave.operators import aggregates, audit, joins, matching, notes, offsets, ranks, rules, sequences
from timeweave.plans import join_queries, scalar_queries, sequence_queries, signal_queries
from timeweave.sources import engines


def column(spark, values, build, kind="string"):
    rows = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}").select("i", build(F.col("v")).alias("o")).orderBy("i").collect()
    return [r["o"] for r in rows]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("80%，12.50，3萬人", ["80%", "12.5", "30000"]),
        ("百分之八十 和 百分之12.5", ["80%", "12.5%"]),
        ("12,345,678 與 1957,1968", ["12345678", "1957", "1968"]),
        ("7、8、9 月 和 1.5億", ["789", "150000000"]),
        ("二零二四年三月，第一名，萬一，千萬不要", ["2024", "3"]),
        ("2千3百萬 與 230萬 與 三百二十點五", ["23000000", "2300000", "320.5"]),
        ("一個 五 十二 十", ["12"]),
        ("", []),
        (None, []),
    ],
)
def test_numbers(text, want):
    assert numbers.numbers_in(text) == want


def test_chinese_numerals():
    assert [numbers.chinese_number(s) for s in ("零", "十", "二十", "一百零五", "三億二千萬", "點五", "五點", "五點十", "二x")] == ["0", "10", "20", "105", "320000000", None, None, None, None]


def subsequence(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        held = row[:]
        for j, y in enumerate(b, 1):
            row[j] = held[j - 1] + 1 if x == y else max(held[j], row[j - 1])
    return row[-1]


def test_partial_ratio_is_the_best_over_all_stretches():
    rng = random.Random(1)
    for _ in range(400):
        a, b = ("".join(rng.choices("abc ", k=rng.randint(0, n))) for n in (7, 16))
        short, long = sorted((a, b), key=len)
        n = len(short)
        pieces = {long[max(0, e - n) : e] for e in range(1, len(long) + n)}
        want = max((200 * subsequence(short, p) / (n + len(p)) for p in pieces), default=0.0) if n else 0.0
        assert fuzzy.partial_ratio(a, b) == pytest.approx(want), (a, b)


def test_keyword_hits(spark):
    rows = [("the emotional part", "motion", "general", False), ("all tendons", "tendon", "general", True), ("we gave ibuprofene today", "ibuprofen", "drug", True), ("we gave naproxen today", "ibuprofen", "drug", False), ("arthroscopie helps", "arthroscopy", "medical_term", True), ("arthroscopie helps", "arthroscopy", "drug", True), (None, "tendon", "drug", None)]
    got = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, t string, w string, k string, want boolean").select("i", "want", fuzzy.keyword_hit(F.col("t"), F.col("w"), F.col("k")).alias("v")).orderBy("i").collect()
    assert [r["v"] for r in got] == [r["want"] for r in got]


def test_repeats_inside_lines(spark):
    lines = ["淋巴結是,淋巴結是,淋巴結是,淋巴結是", "20% 20% 20% 20% 20%", "abcabcabcabcabc", "abcabcabc", "", "no repeat here", "abcd" * 6 + "xyzxyzxyzxyzxyzxyzxyz"]

    def plain(line):
        best, sq = 0, re.sub(X.MARKS, "", line.lower())
        for m in re.finditer(r"(.{3,14}?)\1{3,}", sq):
            if not re.fullmatch(r"[\d%.]+", m[1]):
                best = max(best, len(m[0]) // len(m[1]))
        return best

    assert column(spark, lines, lambda c: X.inline_repeat(loops.squash(c))) == [plain(x) for x in lines]


def plain_loop(lines):
    flat = [re.sub(X.MARKS, "", x.lower()) for x in lines]
    top = max(Counter(x for x in flat if len(x) >= 4).values(), default=0)
    joined = "".join(flat)
    grams = [joined[i : i + 8] for i in range(len(joined) - 7)]
    diversity = round(len(set(grams)) / len(grams), 3) if len(grams) >= 30 else None
    inner = max((len(m[0]) // len(m[1]) for x in flat for m in re.finditer(r"(.{3,14}?)\1{3,}", x) if not re.fullmatch(r"[\d%.]+", m[1])), default=0)
    return top, inner, diversity, top >= 3 or inner >= 4 or (diversity is not None and diversity < 0.5)


def test_loops(spark):
    windows = [["Yes, yes.", "yes yes", "YES YES!", "no"], ["a b c d e f g h i j k l m n o p q r s t u v w x y z 1 2 3 4 5 6 7 8 9 0"], ["wordwordwordwordword and more"], ["the same long line again"] * 2 + ["the same long line again, the same long line again"], [], ["ok"] * 9]
    rows = spark.createDataFrame(list(enumerate(windows)), "i int, v array<string>")
    got = aggregates.loops(rows, ["i"], F.col("v")).orderBy("i").collect()
    assert [tuple(r)[1:] for r in got] == [plain_loop(w) for w in windows]
    assert aggregates.loops(rows, ["i"], F.col("v"), repeats=4).where("i = 0").first()["loop"] is False


def test_whole_files_are_fingerprinted(spark, tmp_path):
    texts = ["", "short", "é" * 70_000 + "end"]
    spark.createDataFrame([(i, t, len(t)) for i, t in enumerate(texts)], "doc_id long, text string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r["v"] for r in scalar_queries.QUERIES["f68_fingerprint"](spark, str(tmp_path)).collect()}
    for i, t in enumerate(texts):
        b = t.encode()
        assert got[i] == hashlib.sha256(f"{len(b)}|{len(t)}|".encode() + b[:65536] + b[-65536:]).hexdigest()
    repeats = {r["doc_id"]: r["v"] for r in scalar_queries.QUERIES["f36_inline_repeat"](spark, str(tmp_path)).collect()}
    assert repeats == {0: 0, 1: 0, 2: 70_000 // 3}


def test_clocks(spark):
    raw = ["2024-05-26T03:04:05Z", "2024-05-26T03:04:05.123456+09:00", "2024:05:26 03:04:05", "2024-05-26 03:04:05", "2024-05-26T03:04:05", "2024-13-01 00:00:00", "x", "", None]
    got = column(spark, raw, lambda c: V.local_time(c, 8))
    assert [r["source"] for r in got] == ["utc+8", "tz-tagged", "exif", "iso", "iso", None, None, None, None]
    assert [str(r["at"])[:19] for r in got[:5]] == ["2024-05-26 11:04:05"] + ["2024-05-26 03:04:05"] * 4
    names = ["CANON_1.mp4", "canon", "a1", "a9", "b!x", "c^d", "1.5", ""]
    for glob in ("CANON*", "a[1-3]", "[!ab]*", "?", "*.?", "b!*", "c[^]d", "*"):
        want = [7.0 if any(fnmatch.fnmatchcase(v, glob) for v in (n, "")) else None for n in names]
        assert column(spark, names, lambda c, g=glob: V.clock_offset(c, F.lit(None).cast("string"), F.lit(""), [(g, 7)])) == want, glob


def test_model_answers(spark):
    raw = ['{"a": 1}', '```json\n{"a": 1}\n```', 'Here: {"a": {"b": 2}} so', '{"a": ', "", None, "[1]"]
    assert column(spark, raw, signals.repaired_json) == ['{"a": 1}', '{"a": 1}', '{"a": {"b": 2}}', None, None, None, "[1]"]
    answers = ['{"l": ["x", 2], "b": true, "n": "0.5"}', '{"l": "x", "b": 0, "n": "many"}', '{"l": null, "b": "yes", "n": true}', '{"b": []}', None]
    got = column(spark, answers, lambda c: signals.coerced(c, {"l": "list", "b": "bool", "n": "number"}))
    assert [tuple(r) for r in got] == [(["x", "2"], True, 0.5), (["x"], False, 0.0), ([], True, 1.0), ([], False, 0.0), ([], False, 0.0)]
    labels = [["聊天室", "Heart", " ", "10:30", "a label with 10:30 that is long enough", "2024-01-05"]]
    assert column(spark, labels, lambda c: signals.clean_labels(c, ["聊天"]), "array<string>") == [["Heart", "a label with 10:30 that is long enough"]]


def plain_audit(p, o, window=60):
    n = max(1, -(-max(e for _, e, _ in p + o) // window))
    side = {}
    for name, segs in (("p", p), ("o", o)):
        side[name] = [[t for a, b, t in sorted(segs) if min(int((a + b) / 2 // window), n - 1) == w and t.strip()] for w in range(n)]
    num = {k: [Counter(numbers.numbers_in("".join(x))) for x in v] for k, v in side.items()}
    out = []
    for w in range(n):
        flat = {k: re.sub(X.MARKS, "", "".join(v[w]).lower()) for k, v in side.items()}
        loop = {k: plain_loop(v[w])[3] for k, v in side.items()}
        near = {k: set().union(*(set(num[k][j]) for j in (w - 1, w + 1) if 0 <= j < n)) for k in num}
        only = {"p": {x: c for x, c in (num["p"][w] - num["o"][w]).items() if x not in near["o"]}, "o": {x: c for x, c in (num["o"][w] - num["p"][w]).items() if x not in near["p"]}}
        pairs = [{s[i : i + 2] for i in range(len(s) - 1)} for s in flat.values()]
        sim = len(pairs[0] & pairs[1]) / len(pairs[0] | pairs[1]) if min(map(len, flat.values())) >= 20 else None
        gap = len(flat["o"]) >= 40 and len(flat["p"]) < 0.2 * len(flat["o"])
        told = any(len(re.sub(r"\D", "", x)) >= 2 or "%" in x or "." in x for k in only for x in only[k]) or (only["p"] and only["o"])
        flags = [f for f, on in (("LOOP_PRIMARY", loop["p"]), ("LOOP_OTHER", loop["o"]), ("GAP_PRIMARY", gap), ("NUMBER_MISMATCH", flat["p"] and flat["o"] and (only["p"] or only["o"]) and told), ("LOW_SIM", sim is not None and sim < 0.4 and not gap)) if on]
        gone = [f for f in flags if loop["o"] and f in ("GAP_PRIMARY", "NUMBER_MISMATCH", "LOW_SIM")]
        out.append((w, sorted(Counter(only["p"]).elements()), sorted(Counter(only["o"]).elements()), [f for f in flags if f not in gone], gone))
    return out


def test_window_audit(spark):
    base = "the quick brown fox jumps over one lazy dog near the bank "
    p = [(0, 30, base + "80%"), (30, 55, "more 12 words"), (62, 70, "short"), (130, 150, base + "7"), (190, 200, base * 2), (245, 250, base + "80%"), (310, 330, base)]
    o = [(0, 30, base + "85%"), (64, 70, base * 3 + "12"), (130, 150, base), (190, 200, "loop words here " * 12), (250, 255, "again and " * 12 + "44%"), (310, 330, "zzz completely different talk about nuclear stuff")]
    rows = lambda s: spark.createDataFrame([("a", float(x), float(y), t) for x, y, t in s], "k string, start_s double, end_s double, text string")
    got = audit.compare_windows(rows(p), rows(o), ["k"]).orderBy("window").collect()
    assert [(r["window"], r["only_primary"], r["only_other"], r["flags"], r["suppressed"]) for r in got] == plain_audit(p, o)
    flags = {f for r in got for f in [*r["flags"], *r["suppressed"]]}
    assert flags == {"LOOP_OTHER", "GAP_PRIMARY", "NUMBER_MISMATCH", "LOW_SIM"} and any(r["excused"] for r in got)
    assert audit.compare_windows(rows(p).limit(0), rows(o).limit(0), ["k"]).count() == 0


def test_alignment_is_the_best_path(spark):
    rng = random.Random(5)
    for _ in range(3):
        n, pages = 5, 4
        score = [[rng.random() for _ in range(pages)] for _ in range(n)]
        rows = spark.createDataFrame([("x", r, c, score[r][c]) for r in range(n) for c in range(pages)], "k string, r int, c int, s double")
        got = [r["c"] for r in sequences.monotone_align(rows, "k", "r", "c", "s", jump=0.15).orderBy("r").collect()]
        worth = lambda path: sum(score[r][c] for r, c in enumerate(path)) - 0.15 * (path[-1] - path[0])
        best = max((p for p in itertools.product(range(pages), repeat=n) if list(p) == sorted(p)), key=worth)
        assert worth(got) == pytest.approx(worth(best))


def test_timed_splits(spark):
    words = [(w, float(a), float(b)) for w, a, b in (("你好", 0, 0.5), ("嗎？", 0.5, 1), ("好，", 1, 2), ("一二，", 2, 6), ("三", 6, 7), ("四", 11, 12), ("五", 12, 13), ("六", 13, 21), ("!", 21, 22))]
    rows = spark.createDataFrame([("a", words), ("b", [(None, 0.0, 1.0), ("x", 1.0, 2.0)]), ("c", []), ("d", None)], "k string, words array<struct<w:string,start_s:double,end_s:double>>")
    assert [tuple(r) for r in sequences.split_sentences(rows.where("k <> 'a'"), ["k"]).collect()] == [("b", 1, 0, 2, "x")]
    got = sequences.split_sentences(rows.where("k = 'a'"), ["k"]).orderBy("sentence_no").collect()
    assert [(r["start_s"], r["end_s"], r["text"]) for r in got] == [(0, 1, "你好 嗎？"), (1, 6, "好， 一二，"), (6, 7, "三"), (11, 13, "四 五"), (13, 21, "六"), (21, 22, "!")]
    segs = spark.createDataFrame([("s", 1, 0.0, 6.0, " short。still "), ("l", 2, 10.0, 30.0, "一二三四五。六七八九十百千萬。"), ("e", 3, 0.0, 50.0, "  ")], "k string, n int, start_s double, end_s double, text string")
    got = sequences.split_untimed(segs, ["k", "n"]).orderBy("n", "pos").collect()
    assert [(r["k"], r["sentence"], r["from_s"], r["to_s"]) for r in got] == [("s", "short。still", 0, 6), ("l", "一二三四五。", 10, 18), ("l", "六七八九十百", 18, 26), ("l", "千萬。", 26, 30), ("e", "", 0, 50)]


def test_low_rate_windows(spark):
    fast, slow = "x" * 60, "x" * 3
    rows = [("a", 5.0 * i, 5.0 * i + 5, slow if 8 <= i < 20 else fast) for i in range(30)] + [("h", 5.0 * i, 5.0 * i + 5, "心" * (12 if i < 8 else 2)) for i in range(16)] + [("h", 80 + 5.0 * i, 85 + 5.0 * i, fast) for i in range(4)]
    got = sequences.low_rate_windows(spark.createDataFrame(rows, "k string, start_s double, end_s double, text string"), ["k"]).orderBy("k", "lo").collect()
    assert [(r["k"], r["lo"], r["hi"], r["script"]) for r in got] == [("a", 35, 60, "latin"), ("a", 60, 85, "latin"), ("h", 40, 65, "cjk")]


def test_names_in_any_number_of_passes(spark):
    rng = random.Random(2)
    texts = ["".join(rng.choices("ab ", k=rng.randint(0, 30))) for _ in range(40)] + [None]
    names = [*{"".join(rng.choices("ab", k=rng.randint(1, 4))) for _ in range(15)}, "", None]
    t = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    n = spark.createDataFrame([(x,) for x in names], "name string")
    want = {(i, x, s.index(x) + 1) for i, s in enumerate(texts) if s for x in names if x and x in s}
    for size in (1 << 20, 8):
        assert {tuple(r) for r in matching.mentions(t, "id", "text", n, "name", size).collect()} == want
    assert matching.mentions(t, "id", "text", n.limit(0), "name").count() == 0
    plan = joins.names_in_text(t, n, "id", "text")._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_closest_terms_lose_none(spark):
    rng = random.Random(3)
    words = sorted({"".join(rng.choices("abc", k=rng.randint(1, 8))) for _ in range(150)})
    tokens, terms = words[::2], words[1::2]
    got = joins.closest_terms(spark.createDataFrame([(w,) for w in tokens], "token string"), spark.createDataFrame([(w,) for w in terms], "term string"), top=1000).collect()
    assert {(r["token"], r["term"], r["distance"]) for r in got} == {(a, b, edits(a, b)) for a in tokens for b in terms if a != b and edits(a, b) <= 2}


def test_nearest_hashes_lose_none(spark):
    rng = random.Random(4)
    base = [rng.getrandbits(64) for _ in range(30)]
    near = [b ^ sum(1 << p for p in rng.sample(range(64), rng.randint(0, 9))) for b in base]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    left = spark.createDataFrame([(i, signed(x)) for i, x in enumerate(near)], "id long, h long")
    right = spark.createDataFrame([(i, signed(x)) for i, x in enumerate(base)], "rid long, rh long")
    want = {}
    for i, x in enumerate(near):
        d, r = min(((x ^ y).bit_count(), j) for j, y in enumerate(base))
        if d <= 6:
            want[i] = (r, d)
    assert {r["id"]: (r["rid"], r["dist"]) for r in joins.hamming_nn(left, right).collect()} == want
    guarded = joins.hamming_nn(left, right, guard=F.col("rid") % 2 == 0).collect()
    assert {r["id"]: r["rid"] for r in guarded} == {i: r if r % 2 == 0 else None for i, (r, _) in want.items()}


def test_changed_pixels_open_a_group(spark):
    rows = [("a", 1, 0, None), ("a", 2, 0, 0.001), ("a", 3, 0, 0.5), ("a", 4, 1, 0.0)]
    got = sequences.adjacent_dedup(spark.createDataFrame(rows, "k string, o long, h long, c double"), ["k"], "o", changed="c").orderBy("grp").collect()
    assert [(r["first_frame"], r["kept_frame"]) for r in got] == [(1, 2), (3, 4)]


def plain_notes(t):
    """Counts of what is wrong with a note, check by check."""
    lines = t.split("\n")
    heads = [(i, len(m[1])) for i, x in enumerate(lines) if (m := re.match(r"(#{1,6})\s+\S", x))]
    empty = 0
    for n, (i, level) in enumerate(heads):
        after = heads[n + 1] if n + 1 < len(heads) else (len(lines), 0)
        empty += not any(x.strip() for x in lines[i + 1 : after[0]]) and after[1] <= level
    found, run = 0, 0
    for x in [*lines, "end"]:
        n = len(re.findall(r"!\[\[[^\]]+\.(?:png|jpg)[^\]]*\]\]", x))
        if n:
            run += n
        elif x.strip() and not x.strip().startswith(">"):
            found, run = found + (run >= 3), 0
    hugged = sum(any(re.match("[一-鿿]", x[m.start() - 1 : m.start()] or " ") or re.match("[一-鿿]", x[m.end() : m.end() + 1] or " ") for m in re.finditer("==[^=]+==", x)) for x in lines)
    escapes = sum(bool(re.search(r"(?<!\\)[<>|#]", h)) for x in lines for h in re.findall("==([^=]+)==", x))
    tables, cur = Counter(), []
    for x in [*lines, ""]:
        if x.lstrip().startswith("|"):
            cur.append(re.sub(r"\s+", "", x))
        else:
            tables["\n".join(cur)] += len(cur) >= 3
            cur = []
    above = lines[: next((i for i, x in enumerate(lines) if re.match(r"#\s+Resource\s*$", x)), len(lines))]
    return {
        "FMT empty heading": empty,
        "LEC gallery": found,
        "FMT highlight touched": hugged,
        "FMT highlight escapes": escapes,
        "TXT repeated table": sum(c > 1 for c in tables.values()),
        "TXT long bullet": sum(x.strip().startswith(("- ", "* ")) and len(re.findall("[一-鿿]", x)) > 50 for x in above),
        "FMT blank indent": sum(bool(re.match(" +[-*] ", x)) for x in lines),
        "FIG todo": t.count("[!todo]"),
        "TXT citation": len(re.findall(r"\(citation\b", t)),
    }


def test_note_lint(spark):
    rng = random.Random(6)
    pieces = ["# A", "## B", "### C", "text", "", "> quote", "![[a.png|300]]", "![[b.png]] ![[c.png]]", "中==high==文", "a ==x<y== b", "==ok== ==p\\|q==", "| a | b |\n|---|---|\n| 1 | 2 |", "|a|b|\n|---|---|\n|1|2|", "  - bullet", "- " + "漢" * 51, "# Resource", "[!todo] (citation 3)", "| [[x|y]] |", "> [!figure] " + "long " * 12 + "\n> ![[d.png]]", "# Head `book` ", "# At `01:20`"]
    texts = ["\n".join(rng.choices(pieces, k=rng.randint(0, 14))) for _ in range(120)] + ["", None, "# only"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = {(r["i"], r["check"]): (r["level"], r["n"]) for mode in ("lecture", "textbook") for r in notes.audit_notes(df, "i", "t", mode, headings=["A"]).collect()}
    for i, t in enumerate(texts):
        for check, n in plain_notes(t or "").items():
            assert got[i, check][1] == n, (check, t)
            assert (got[i, check][0] == "PASS") == (n == 0)
        assert got[i, "STRUCT A"][1] == (not re.search(r"(?m)^#\s+A\b", t or ""))
        assert got[i, "FMT pipe in table link"][1] == (t or "").count("[[x|y]]") and got[i, "LEC long figure title"][1] == (t or "").count("[!figure]")
        assert got[i, "FMT source on heading"][1] == (t or "").count("`book`")


@pytest.mark.parametrize(
    ("caption", "want"),
    [
        (" short ", ("short", "")),
        ("一二三：" + "四" * 40, ("一二三", "四" * 40)),
        ("頭（內容）尾" + "長" * 40, ("頭", "內容尾" + "長" * 40)),
        ("a" * 20 + " " + "b" * 30, ("a" * 20, "b" * 30)),
        ("字" * 40, ("字" * 34, "字" * 6)),
        ("前" * 10 + "，後（開" + "長" * 40, ("前" * 10, "後（開" + "長" * 40)),
        (None, ("", "")),
    ],
)
def test_captions(spark, caption, want):
    assert tuple(column(spark, [caption], slides.split_caption)[0]) == want


def test_caption_is_computed_once(spark):
    caption = F.regexp_replace("t", "marker", "x")
    df = spark.createDataFrame([("標：" + "長" * 40,)], "t string").select(slides.split_caption(caption).alias("c")).select("c.*")
    assert df._jdf.queryExecution().optimizedPlan().toString().count("marker") == 1
    assert tuple(df.first()) == ("標", "長" * 40)


def test_paste_guard_hears_the_text_below(spark, tmp_path):
    """Labels of a text's first line are always in that text: only the lines below can speak against them."""
    told = {1: "alpha beta gamma\n" + "other words " * 10, 2: "alpha beta gamma\n" + "alpha words " * 10, 3: "alpha beta gamma " * 10, 4: "\n" + "words " * 20}
    spark.createDataFrame(list(told.items()), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    rows = signal_queries.QUERIES["f43_paste_guard"](spark, str(tmp_path)).collect()
    assert {r["doc_id"]: (r["v"], r["v_below"]) for r in rows} == {1: (True, False), 2: (True, False), 3: (True, True), 4: (False, False)}


def test_plan_rows_that_begin_together_have_one_order(spark, tmp_path):
    rows = [(i, "2024-01-01 00:00:00", 1, "view", float(i)) for i in range(1, 9)]
    want = {(i, "overlap") for i in range(1, 8)} | {(8, "ok")}
    for name, given in (("up", rows), ("down", rows[::-1])):
        spark.createDataFrame(given, "event_id long, ts string, user_id long, event_type string, value double").withColumn("ts", F.col("ts").cast("timestamp")).coalesce(1).write.parquet(str(tmp_path / name / "events.parquet"))
        assert {(r["event_id"], r["finding"]) for r in sequence_queries.QUERIES["w27_plan_findings"](spark, str(tmp_path / name)).collect()} == want


def test_offset_votes_without_rows_of_pairs(spark, monkeypatch):
    monkeypatch.setattr(offsets, "PLACES", 40)
    monkeypatch.setattr(offsets, "PAIRS", 7)
    rng = random.Random(9)
    made = lambda n: [(i, rng.randint(0, 90), "".join(rng.choices("ab c", k=rng.randint(0, 30)))) for i in range(n) for _ in range(rng.randint(1, 4))]
    clips, recs = [*made(9), (None, 1, "abab"), (1, 2, None)], made(7)
    seen, want, runs = Counter(), Counter(), lambda x: [x[i : i + 3] for i in range(len(x) - 2)]
    plain = lambda rows: [(i, t, g) for i, t, x in rows if None not in (i, x) for g in runs(x.replace(" ", ""))]
    for r, _, g in plain(recs):
        seen[r, g] += 1
    for (c, t, g), (r, u, h) in itertools.product(plain(clips), plain(recs)):
        if g == h and seen[r, h] <= 4:
            want[c, r, round((u - t) / 5) * 5] += 1
    sides = [spark.createDataFrame(rows, f"{k} long, t long, text string") for k, rows in (("clip", clips), ("rec", recs))]
    votes = offsets.offset_votes(*sides, n=3)
    assert {(r["clip"], r["rec"], r["offset_s"]): r["votes"] for r in votes.collect()} == want
    best = {}
    for c, r, o in want:
        best[c] = min(best.get(c, (0,)), (-sum(want[c, r, o + d] for d in (-5, 0, 5)), r, o))
    assert {r["clip"]: (-r["votes"], r["rec"], r["offset_s"]) for r in offsets.best_offset(*sides, n=3).collect()} == best
    plan = join_queries.QUERIES["j7_offset_votes"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan  # the equal runs of two texts are counted, not listed


def test_crop_rules(spark):
    kind = "slides string, x int, y int, w int, h int"
    rows = [("1-10", 0, 0, 200, 200), ("5-6", 0, 0, 200, 200), ("x", 0, 0, 200, 200), ("20-12", 0, 0, 200, 200), ("30", -1, 0, 200, 200), ("40", 0, 0, 199, 200), ("50", 0, 0, 300, 300)]
    assert {r["slides"]: r["fault"] for r in rules.crop_rules(spark.createDataFrame(rows, kind)).collect()} == {"1-10": None, "5-6": "overlap", "x": "range", "20-12": "bounds", "30": "bounds", "40": "bounds", "50": None}
    with pytest.raises(ValueError, match="crop rule"):
        rules.crop_boxes(spark.range(3), "id", spark.createDataFrame(rows, kind))


def test_orders_and_settings(spark):
    assert rules.merged_config({"a": {"x": 1, "y": 2}, "b": 3}, {"a": {"x": None, "y": 5, "z": None}, "b": None, "c": 4}) == {"a": {"x": 1, "y": 5, "z": None}, "b": 3, "c": 4}
    s = spark.createDataFrame([("b", 2, 5), ("a", 2, 1), ("c", 9, 7)], "token string, n int, first_seg int")
    assert [r["token"] for r in rules.suspects_first(s).collect()] == ["c", "a", "b"]
    pages = spark.createDataFrame([("p", 2), ("q", 1)], "name string, at int")
    assert [r["name"] for r in rules.intro_then(pages.limit(1), pages, "at").orderBy("page_no").collect()][1:] == ["q", "p"]
    assert rules.with_overview(pages, pages).groupBy("is_overview").count().count() == 2


def test_helper_columns_do_not_clash(spark):
    """Columns named as a helper might be are kept as they are."""
    names = ("_r", "_b", "_n", "_new", "_m", "_p", "_i", "_h", "_t", "island")
    rows = [("a", i, 1.0 * i, 1.0 * i + 1, f"t{i % 2}") for i in range(6)]
    df = spark.createDataFrame(rows, "k string, o int, start_s double, end_s double, text string").withColumns({n: F.lit("own") for n in names})
    held = [
        sequences.drop_repeats(df, ["k"], "o", "text"),
        sequences.context_rows(df, ["k"], "o", F.col("o") == 2),
        sequences.sections(df, ["k"], "o", F.col("o") == 3),
        joins.seek(df, ["k"], F.lit(2.5), "start_s", "end_s", [F.col("o")]),
        joins.interval_join(df, spark.createDataFrame([("a", 1.0, 2.0)], "k string, lo double, hi double"), ("start_s", "end_s"), ("lo", "hi"), ["k"], 2),
        rules.even_sample(df, ["k"], "o", 3),
    ]
    for out in held:
        assert {tuple(r) for r in out.select(*names).collect()} == {("own",) * len(names)}
    runs = sequences.runs(df.withColumn("start_s", F.col("start_s")), ["k"], "o", F.lit(True))
    assert [(r["first"], r["last"]) for r in runs.collect()] == [(0, 5)]


def test_engines(spark):
    engines.register("shout", "string", lambda library: lambda xs: [library.capwords(x) for x in xs])
    engines.register("absent", "no_such_library_here", lambda library: None)
    df = spark.createDataFrame([(1, "a b"), (2, "c")], "i int, t string")
    assert {r["i"]: r["answer"] for r in engines.answers(df, "shout", "i", "t").collect()} == {1: "A B", 2: "C"}
    for name in ("absent", "unknown"):
        with pytest.raises(engines.NotInstalled, match="engine"):
            engines.answers(df, name, "i", "t")
    waits, left = [], [engines.Transient("http", 503), engines.Transient("timeout"), None]

    def call():
        if failure := left.pop(0):
            raise failure
        return "done"

    assert engines.with_retries(call, sleep=waits.append) == "done" and waits == [2, 4]
    with pytest.raises(engines.Transient):
        engines.with_retries(lambda: (_ for _ in ()).throw(engines.Transient("timeout")), sleep=waits.append)
    with pytest.raises(KeyError):
        engines.with_retries(lambda: {}["x"], sleep=waits.append)
    sizes = []

    def run(batch):
        sizes.append(len(batch))
        if len(batch) > 3:
            raise MemoryError
        return [x * 2 for x in batch]

    assert list(engines.in_batches(range(7), run, (8, 4, 2, 1))) == [0, 2, 4, 6, 8, 10, 12] and sizes == [7, 4, 2, 2, 2, 1]


def test_rewriting_is_leftmost_longest(spark, monkeypatch):
    rng = random.Random(3)
    for _ in range(150):
        table = {"".join(rng.choices("abc中", k=rng.randrange(1, 5))): rng.choice(["", "X", "ab", "國"]) for _ in range(rng.randrange(1, 9))}
        text = "".join(rng.choices("abc中 ", k=rng.randrange(0, 60)))
        want, at = "", 0
        while at < len(text):
            word = max((w for w in table if text.startswith(w, at)), key=len, default=None)
            want, at = (want + table[word], at + len(word)) if word else (want + text[at], at + 1)
        for step in (1, 7, 1 << 16):
            monkeypatch.setattr(rewrite, "STEP", step)
            assert rewrite.rewritten(text, tuple(sorted(table.items()))) == want
    df = spark.createDataFrame([("ab", "x"), ("a", "y"), ("a", "w"), ("", "z"), (None, "z"), ("c", None)], "w string, t string")
    held = rewrite.table_of(df, "w", "t")
    assert held == {"ab": "x", "a": "w"}
    assert column(spark, ["abac", None, ""], lambda c: rewrite.rewrite(c, held)) == ["xwc", None, ""] and column(spark, ["ab"], lambda c: rewrite.rewrite(c, {})) == ["ab"]
    monkeypatch.setattr(rewrite, "MAX_ENTRIES", 1)
    with pytest.raises(ValueError, match="entries"):
        rewrite.table_of(df, "w", "t")


@pytest.mark.parametrize(("small", "block", "most"), [(4096, 65536, 1024), (10, 20, 8), (0, 1, 64)])
def test_discordant_pairs_match_all_pairs(spark, monkeypatch, small, block, most):
    """Ties, copies and nulls, groups of one array and groups in blocks."""
    for k, v in (("SMALL", small), ("BLOCK", block), ("MOST", most)):
        monkeypatch.setattr(ranks, k, v)
    rng = random.Random(8)
    rows = [(k, rng.choice([None, *range(40)]), rng.choice([None, *range(30)])) for k in "abc" for _ in range({"a": 300, "b": 30, "c": 4}[k])] + [("d", 1, 2), ("d", 1, 3), ("e", 1, None), ("e", 2, 5)] + [("f", 1, 1)] * 50 + [("f", 2, 0)] * 70
    want = {}
    for k in "abcdef":
        pairs = [(x, y) for a, x in [(r[1], r[2]) for r in rows if r[0] == k] for b, y in [(r[1], r[2]) for r in rows if r[0] == k] if a is not None and b is not None and a < b]
        known = [x > y for x, y in pairs if x is not None and y is not None]
        if pairs:
            want[k] = (sum(known) / len(known) if known else None, len(pairs))
    got = ranks.discordant_fraction(spark.createDataFrame(rows, "k string, a int, b int"), ["k"], "a", "b").collect()
    assert {r["k"]: (r["discordant"] if r["discordant"] is None else pytest.approx(r["discordant"]), r["pairs"]) for r in got} == want


def test_gram_hashes_are_those_of_each_text(spark, monkeypatch):
    rng = random.Random(1)
    texts = ["".join(rng.choices("ab中𝒜 ", k=rng.randrange(0, 30))) for _ in range(300)]
    seen = {}
    for step in (1, 50, 1 << 20):
        monkeypatch.setattr(grams, "STEP", step)
        got = column(spark, [*texts, None], lambda c: grams.gram_hashes(c, 6))
        assert got[-1] == []
        for t, found in zip(texts, got[:-1], strict=True):
            runs = [t[i : i + 6] for i in range(len(t) - 5)]
            assert len(found) == len(runs) and all(seen.setdefault(r, h) == h for r, h in zip(runs, found, strict=True))
    assert len(set(seen.values())) == len(seen)


def test_parts_of_long_files(spark):
    media = spark.createDataFrame([("a", 24 << 20, 9999.0), ("b", (24 << 20) + 1, 2400.0), ("c", 1 << 30, 2400.5), ("d", 1 << 30, None), ("e", None, 5000.0), ("f", 1 << 30, 0.0)], "k string, size long, s double")
    parts = sequences.transcription_parts(media, ["k"], "size", "s")
    assert sorted(((r["k"], r["part"], r["offset_s"], r["until_s"]) for r in parts.collect()), key=repr) == [("a", 0, 0, 9999), ("b", 0, 0, 1200), ("b", 1, 1200, 2400), ("c", 0, 0, 1200), ("c", 1, 1200, 2400), ("c", 2, 2400, 2400.5), ("d", 0, 0, None), ("e", 0, 0, 5000), ("f", 0, 0, 0)]
    heard = spark.createDataFrame([("c", 2, 0.005, 0.333, "x"), ("b", 0, 1.0, 2.0, "y"), ("z", 0, 1.0, 2.0, "no such file")], "k string, part int, start_s double, end_s double, text string")
    assert sorted(tuple(r) for r in sequences.joined_parts(heard, parts, ["k"]).collect()) == [("b", 0, 1.0, 2.0, "y"), ("c", 2, 2400.01, 2400.33, "x")]
