"""Every registered query and the whole pipeline, against plain versions of their contracts."""

import hashlib
import re
import zlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from timeweave.llm import byte_bpe, decontaminate, jaccard_join, language_id, queries, secret_scan
from timeweave.llm.common import scratch, scratch_path, stored

DIR = "/root/testdata/sf0.001"
#: Table, columns of the contract with their kinds, rows for each row of the table.
CONTRACT = {
    "op1_secret_scan": ("documents", {"doc_id": "bigint", "n_assign": "bigint", "n_access": "bigint", "n_hex": "bigint", "base_sha256": "string", "spans": "string"}),
    "op2_token_files": ("documents", {"doc_id": "bigint", "start": "bigint", "n_tokens": "bigint", "ids_crc32": "bigint"}),
    "op3_jaccard_join": ("documents", {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint"}),
    "op4_html_text": ("pages", {"page_id": "bigint", "url": "string", "text": "string", "n_chars": "bigint"}),
    "op5_decontaminate": (None, {"doc_id": "bigint", "item_id": "bigint"}),
    "op6_quality_model": ("documents", {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"}),
    "op7_toxicity": ("documents", {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"}),
    "op8_vector_search": (None, {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "double"}),
    "op9_byte_bpe": ("documents", {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"}),
    "op10_language_id": ("documents", {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"}),
}


@pytest.fixture(scope="module")
def got(spark):
    held = {}

    def rows(name):
        if name not in held:
            held[name] = queries.QUERIES[name](spark, DIR).cache()
        return held[name]

    return rows


@pytest.mark.parametrize("name", sorted(CONTRACT))
def test_contract(spark, got, name):
    df, (source, kinds) = got(name), CONTRACT[name]
    assert {c: dict(df.dtypes)[c] for c in kinds} == kinds
    if source:
        key = next(iter(kinds))
        want = sorted(r[0] for r in spark.read.parquet(f"{DIR}/{source}.parquet").select(key).collect())
        assert sorted(r[0] for r in df.select(key).collect()) == want


def texts(spark):
    return {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{DIR}/documents.parquet").select("doc_id", "text").collect()}


def words(text):
    return text.encode().lower().split()


def shingles(text, size):
    w = words(text)
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def components(sets, threshold):
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            if sets[i] and 100 * len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: find(i) for i in ids}


def test_near_duplicates(spark, got):
    sets = {i: shingles(t, 4) for i, t in texts(spark).items()}
    assert {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in got("op3_jaccard_join").collect()} == {(i, len(sets[i]), c) for i, c in components(sets, 85).items()}


def leaked(text, items):
    """Items whose question and answer both lie, to four fifths of their words, in five-word runs of the text."""
    clean = lambda t: t.lower().encode().translate(decontaminate._BLANK).split()
    w = clean(text)
    held = {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
    out = set()
    for item, t in items.items():
        q = clean(t)
        covered = [False] * len(q)
        for i in range(len(q) - 4):
            if tuple(q[i : i + 5]) in held:
                covered[i : i + 5] = [True] * 5
        cut = decontaminate.Index._answer_at(t, len(q))
        if q and sum(covered[:cut]) >= 0.8 * cut and sum(covered[cut:]) >= 0.8 * (len(q) - cut):
            out.add(item)
    return out


def items_of(spark):
    return {r["item_id"]: r["text"] for r in spark.read.parquet(f"{DIR}/benchmark.parquet").collect()}


def test_leaks_match_an_exhaustive_search(spark, got):
    items = items_of(spark)
    want = {(i, item) for i, t in texts(spark).items() for item in leaked(t, items)}
    assert {(r["doc_id"], r["item_id"]) for r in got("op5_decontaminate").collect()} == want and want


def test_encodings_match_the_libraries(spark, got):
    import base64

    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    path, pattern = byte_bpe.default_vocabulary()
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    library, held, start = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), texts(spark), 0
    bpe = {r["doc_id"]: r for r in got("op9_byte_bpe").collect()}
    for r in got("op2_token_files").orderBy("doc_id").collect():
        ids = [*library.encode(held[r["doc_id"]], add_special_tokens=False).ids, 2]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids)))
        start += len(ids)
        own = encoding.encode_ordinary(held[r["doc_id"]])
        assert (bpe[r["doc_id"]]["n_tokens"], bpe[r["doc_id"]]["ids_sha256"]) == (len(own), hashlib.sha256(",".join(map(str, own)).encode()).hexdigest())


@pytest.mark.parametrize("name", ["op6_quality_model", "op7_toxicity"])
def test_scores_are_shares_of_one(got, name):
    limit = 0.3 if name.startswith("op6") else 0.7
    for r in got(name).collect():
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= limit)


def test_held_out_quality_and_toxicity(spark, got):
    labels = spark.read.parquet(f"{DIR}/labels.parquet")
    for name, label, least in (("op6_quality_model", "quality", 0.9), ("op7_toxicity", "toxic", 0.6)):
        rows = got(name).where("held_out").join(labels.where(F.col(label).isNotNull()), "doc_id").select("score", label).collect()
        good, bad = ([r[0] for r in rows if r[1] == y] for y in (1, 0))
        if good and bad:
            assert sum((a > b) + 0.5 * (a == b) for a in good for b in bad) / len(good) / len(bad) >= least


def test_languages(spark, got):
    known = spark.read.parquet(f"{DIR}/documents.parquet").where("lang is not null").select("doc_id", "lang")
    rows = got("op10_language_id").where("held_out and lang_pred <> 'und'").join(known, "doc_id").collect()
    assert sum(r["lang_pred"] == r["lang"] for r in rows) >= 0.95 * len(rows) > 0


def test_neighbours_reach_the_recall(spark, got):
    import numpy as np

    rows = spark.read.parquet(f"{DIR}/embeddings.parquet").select("vec_id", "embedding").collect()
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    x /= np.sqrt((x * x).sum(1, keepdims=True))
    found = {}
    for r in got("op8_vector_search").collect():
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = 0
    for q, own in found.items():
        s = x @ x[ids == q][0]
        s[ids == q] = -9
        hits += len(own & set(ids[np.lexsort((ids, -s))[:5]].tolist()))
    assert set(found) == {i for i in ids.tolist() if i % 50 == 0} and hits >= 0.9 * 5 * len(found)


def test_pipeline_matches_its_stages_done_plainly(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    rows = {r["doc_id"]: r for r in corpus_pipeline.run(spark, DIR).collect()}
    judged = language_id.identify(docs, language_id.train(docs), out=("p", "s", "k"))
    kept = {r["doc_id"]: r["text"] for r in judged.where(f"p <> 'und' and k >= {language_id.LEAST_KNOWN}").collect()}
    roots = components({i: shingles(t, 5) for i, t in kept.items()}, 80)
    items = items_of(spark)
    kept = {i: t for i, t in kept.items() if roots[i] == i and not leaked(t, items)}
    costs = secret_scan.Costs(secret_scan.learn_words(spark.createDataFrame(list(kept.items()), "doc_id long, text string")))
    codec = byte_bpe.codec(*byte_bpe.default_vocabulary())
    assert {i: (r["n_tokens"], r["ids"]) for i, r in rows.items()} == {i: (len(ids), ids) for i, t in kept.items() for ids in [codec.encode(secret_scan.redact(t, costs=costs))]}


def test_pipeline_of_odd_tables(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, _found int, _pred string, bpe int"
    text = "the words of a longer english text that says nothing new at all about anything in the world of words"
    rows = [(1, text, "en", "a", None, 1, "x", 1), (1, text, "en", "a", None, 1, "x", 1), (2, None, None, None, None, 1, "x", 1), (3, "", "en", "a", 0, 1, "x", 1), (None, text + " end", None, "a", 9, 1, "x", 1), (None, "... 12", "en", "a", 9, 1, "x", 1)]
    rows += [(10 + i, f"{text} {i} {' '.join(f'w{i}x{k} and the words' for k in range(40))}", "en", "a", 5, 1, "x", 1) for i in range(8)]
    spark.read.parquet(f"{DIR}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    df = spark.createDataFrame(rows, schema)
    df.write.parquet(f"{tmp_path}/documents.parquet")
    assert sorted(r["doc_id"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()) == [1, *range(10, 18)]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, df, str(tmp_path)).columns == df.columns
    df.limit(0).write.parquet(f"{tmp_path}/empty/documents.parquet")
    spark.read.parquet(f"{DIR}/benchmark.parquet").write.parquet(f"{tmp_path}/empty/benchmark.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/empty").count() == 0


def test_scratch_tables_go_with_their_block(spark):
    with scratch(spark):
        kept, gone = stored(spark.range(3), "kept", keep=True), scratch_path(spark, "gone")
        spark.range(2).write.parquet(gone)
    assert kept.count() == 3
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(gone)


def test_blocks_of_one_family_meet(spark, monkeypatch):
    """One family of near copies in many blocks becomes one component without its pairs being listed."""
    monkeypatch.setattr(jaccard_join, "BLOCK", 16)
    base = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(base[:k] + [f"x{i}"] + base[k + 1 :])) for i in range(120) for k in [37 * i % 200]]
    listed = []
    verified = jaccard_join.Corpus.verified
    monkeypatch.setattr(jaccard_join.Corpus, "verified", lambda self, pairs: listed.append(pairs.count()) or verified(self, pairs))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["component_id"] for r in jaccard_join.similar_documents(df).collect()} == {0}
    assert sum(listed) < 10 * len(rows)
