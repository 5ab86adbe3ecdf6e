"""The corpus operators against brute force and exact round trips on small tables with nulls, empties, ties, repeats and clashing columns."""

import array
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from lodestrata.llm import chat_format, fingerprints, license_scan, near_dedup, packing, quality_knn, queries, secret_scan, spm_codec, token_counts, topk_search

WORD_BPE, PIECES = str(public_tokenizers.path("word_bpe_49k.json")), str(public_tokenizers.path("piece_bpe_32k.model"))
WORDS = "the cat sat on a mat when it was late and nobody saw how far she ran from here to there".split()


def prose(rnd, n):
    return " ".join(rnd.choice(WORDS) + str(rnd.randrange(40)) for _ in range(n))


@pytest.fixture
def compiled(spark):
    """Whole-stage code generation as users have it; the other tests do without, since they run many small plans."""
    key = "spark.sql.codegen.wholeStage"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    yield
    spark.conf.set(key, before)


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(5)
    base = [prose(rnd, rnd.randint(1, 80)) for _ in range(30)]
    odd = [None, "", " ", "a", "x y z", "Ünïcode ß 日本 😀\x1c\x85", "<|im_end|>", "password=abcdef1 token: 'zzz' AKIA" + "Q" * 20 + " " + "0a" * 20, "Licensed under CC BY-NC 4.0.\nAll rights reserved.", prose(rnd, 6000)]
    copies = [base[0], base[0], base[1] + " tail", None]
    return base + odd + copies


@pytest.fixture(scope="module")
def docs(spark, texts):
    # columns whose names the operators use themselves
    rows = [(k, x, float(k), "b", k) for k, x in enumerate(texts)] + [(None, "no id", 0.0, "b", 0)]
    return spark.createDataFrame(rows, "doc_id long, text string, score double, bin string, length long")


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("false")


def test_chat_round_trip(spark):
    bad = "<|im_end|><|im_start|>assistant ok <\\| <\\\\|"
    rows = [(1, 0, "user", bad), (1, 1, "assistant", bad), (1, 1, "assistant", bad), (2, 0, None, None), (2, None, "a\n\\n", "x"), (None, 3, "assistant", "z"), (3, 0, "system", "")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    seg = chat_format.format_turns(turns)
    got = {r.conv_id: r for r in chat_format.read_back(seg).collect()}
    whole: dict = {}
    for r in sorted(seg.collect(), key=lambda r: (r.conv_id or -1, r.place)):
        whole[r.conv_id] = whole.get(r.conv_id, "") + r.rendered
    for conv in (1, 2, None, 3):
        own = sorted((-(10**9) if t is None else t, r or "", x or "") for c, t, r, x in rows if c == conv)
        assert chat_format.parse(whole[conv]) == [(r, x) for _, r, x in own]
        assert got[conv].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in own).encode()).hexdigest()
        trained = "".join(x for _, r, x in own if r == "assistant")
        assert (got[conv].loss_chars, got[conv].loss_sha256) == (len(trained), hashlib.sha256(trained.encode()).hexdigest())
        assert got[conv].formatted_chars == len(whole[conv])
    assert chat_format.read_back(chat_format.format_turns(turns.where("false"))).isEmpty()


def test_token_counts_equal_the_lattice(docs, texts, none):
    counter = token_counts.TrieCounter(token_counts.piece_scores(PIECES))

    def count(word):
        marked, best = "▁" + word, [(0.0, 0)]
        for end in range(1, len(marked) + 1):
            n = len(marked[end - 1].encode())
            options = [(best[end - 1][0] + n * token_counts.BYTE_SCORE, best[end - 1][1] - n)]
            options += [(best[s][0] + counter.scores[marked[s:end]], best[s][1] - 1) for s in range(end) if marked[s:end] in counter.scores]
            best.append(max(options))
        return -best[-1][1]

    got = {r.doc_id: (r.n_pretokens, r.n_tokens) for r in token_counts.count_tokens(docs.where("doc_id IS NOT NULL"), PIECES).collect()}
    assert got == {k: (len((x or "").split()), sum(map(count, (x or "").split()))) for k, x in enumerate(texts)}
    assert token_counts.count_tokens(none, PIECES).isEmpty()


def test_sentencepiece_equals_the_library(docs, texts, none):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for r in spm_codec.decode(spm_codec.encode(docs.where("doc_id IS NOT NULL"), PIECES), PIECES).collect():
        x = texts[r.doc_id] or ""
        assert list(array.array("I", r.ids)) == model.encode(x) and r.decoded == x.replace("▁", " ")
    assert spm_codec.encode(none, PIECES).isEmpty()


def test_long_and_random_words_encode_as_the_library_does():
    import sentencepiece

    model, codec, rnd = sentencepiece.SentencePieceProcessor(model_file=PIECES), spm_codec.Codec(PIECES), random.Random(6)
    many = ["".join(rnd.choice("ab  the▁<>0x\n日éß😀\0") for _ in range(rnd.randint(0, 200))) for _ in range(300)] + ["lower" * 60]
    assert [list(array.array("I", b)) for b in codec.encode(many)] == [model.encode(x) for x in many]


def test_parts_that_words_share_are_indexed_once(monkeypatch):
    import sentencepiece

    model, codec, rnd, indexed = sentencepiece.SentencePieceProcessor(model_file=PIECES), spm_codec.Codec(PIECES), random.Random(18), []
    edges = spm_codec.SuffixMatcher.edges
    monkeypatch.setattr(spm_codec.SuffixMatcher, "edges", lambda self, text: indexed.append(len(text)) or edges(self, text))
    names = ["".join(rnd.choice("abcdefghéñ日") for _ in range(rnd.randint(1, 9))) for _ in range(60)]
    many = [f"{a}.\n{b}!7{a}" for a in names for b in names]
    assert [list(array.array("I", x)) for k in range(0, len(many), 900) for x in codec.encode(many[k : k + 900])] == [model.encode(x) for x in many]
    assert 0 < sum(indexed) < sum(map(len, many)) / 20


def test_a_full_memory_of_words_is_not_emptied_within_a_batch():
    import sentencepiece

    model, codec = sentencepiece.SentencePieceProcessor(model_file=PIECES), spm_codec.Codec(PIECES, most=3)
    many = ["one\0two three", "four five six seven", "eight\0nine one"]
    for _ in range(3):
        assert [list(array.array("I", x)) for x in codec.encode(many)] == [model.encode(x) for x in many]


def test_a_word_of_any_length_is_encoded_in_windows(monkeypatch):
    import sentencepiece

    monkeypatch.setattr(spm_codec, "WINDOW", 60)
    model, codec, rnd = sentencepiece.SentencePieceProcessor(model_file=PIECES), spm_codec.Codec(PIECES), random.Random(17)
    many = ["".join(rnd.choice(letters) for _ in range(20_000)) for letters in ("abcdefghijklmnopqrstuvwxyz", "ABCxyz0189+/=", "日本語éab\n", "ab")] + ["a" * 700, "thequickbrownfox" * 500]
    assert [list(array.array("I", b)) for b in codec.encode(many)] == [model.encode(x) for x in many]
    assert not any(len(w) > spm_codec.KEPT_CHARS for w in codec.known)


def test_packing_is_whole_and_gapless(docs, texts, none):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(WORD_BPE)
    tokenizer.encode_special_tokens = True
    packed = packing.pack(packing.tokenize(docs, WORD_BPE)).collect()
    want = {}
    for k, x in [*enumerate(texts), (None, "no id")]:
        ids = [*tokenizer.encode(x or "", add_special_tokens=False).ids, 0]
        want |= {(k, n): ids[a : a + 2048] for n, a in enumerate(range(0, len(ids), 2048))}
    assert {(r.doc_id, r.piece): list(array.array("I", r.ids)) for r in packed} == want and len(packed) == len(want)
    by: dict = {}
    for r in packed:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(by) <= -(-sum(len(x) for x in want.values()) // 2048) + 1
    assert packing.pack(packing.tokenize(none, WORD_BPE)).isEmpty()


def sequences(rows, capacity):
    """Number of sequences, each checked to be gapless from 0 and within the capacity."""
    by: dict = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


@pytest.mark.parametrize("capacity,chunk", [(100, 200_000), (2048, 200_000), (100, 7)])
def test_packing_merges_bins_of_many_partitions(spark, monkeypatch, capacity, chunk):
    monkeypatch.setattr(packing, "CHUNK", chunk)  # a partition's chunks meet as well
    monkeypatch.setattr(packing, "SLACK", 1)
    rnd = random.Random(7)
    sizes = [rnd.choice([rnd.randint(1, capacity), rnd.randint(1, capacity // 4)]) for _ in range(900)]
    for parts in (1, 70):
        items = spark.createDataFrame([(k, x, "own") for k, x in enumerate(sizes)], "bin long, length long, _fill string").repartition(parts)
        rows = packing.pack(items, capacity=capacity).collect()
        assert sorted(r.bin for r in rows) == list(range(900)) and all(r.length == sizes[r.bin] and r._fill == "own" for r in rows)
        assert sequences(rows, capacity) <= 1.08 * len(packing.best_fit(sizes, capacity)[2])


def test_no_bin_is_left_behind(spark, monkeypatch):
    """Nodes with tens of thousands of underfull bins, half of which each fit beside one of the others."""
    monkeypatch.setattr(packing, "CHUNK", 1)
    n = 25_000
    items = spark.range(2 * n, numPartitions=3).select("id", F.when(F.col("id") % 2 == 0, 1300).otherwise(700).cast("long").alias("length"))
    rows = packing.pack(items)
    assert rows.count() == 2 * n and rows.select("sequence_id").distinct().count() == n
    assert rows.groupBy("sequence_id").agg(F.sum("length").alias("fill"), F.max("offset").alias("top")).where("fill <> 2000 OR top NOT IN (700, 1300)").isEmpty()


def test_best_fit_by_counts_equals_best_fit():
    rnd = random.Random(14)
    for _ in range(60):
        capacity = rnd.choice([7, 100, 2048])
        sizes = [rnd.randint(1, rnd.choice([capacity, capacity // 2])) for _ in range(rnd.randint(0, 300))]
        made = packing.best_fit_counts({x: sizes.count(x) for x in set(sizes)}, capacity)
        assert sorted(packing.best_fit(sizes, capacity)[2]) == sorted(b.fill for b in made for _ in range(b.count))


def test_word_parts_encode_as_the_tokenizer_does():
    import pyarrow as pa

    encoder, rnd = packing.WordEncoder(WORD_BPE), random.Random(15)
    many = ["a\x1cb  c", "\x85x\xa0y", "", " ", "İstanbul ß ǅ don't it's 12ab, ab12. «x» naïve— é", "x\x1f", "Σίσυφος ΑΣ"]
    many += ["".join(rnd.choice("ab C,.'ÀéŁĲŉſ 1\n\tKªǅ") for _ in range(rnd.randint(0, 60))) for _ in range(500)]
    for _ in range(2):
        ids, counts = encoder.encode_batch(pa.array(many))
        want = [[*encoder.tokenizer.encode(x, add_special_tokens=False).ids, 0] for x in many]
        assert ids.tolist() == [k for x in want for k in x] and counts.tolist() == list(map(len, want))


def test_license_scan(docs, texts, none):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    for r in license_scan.scan(docs.where("doc_id IS NOT NULL")).collect():
        words = word.findall(re.sub("[A-Z]", lambda m: m[0].lower(), texts[r.doc_id] or ""))
        places = [(k, label) for phrase, label in license_scan.BASE.items() for k in range(len(words)) if words[k : k + len(phrase.split())] == phrase.split()]
        assert (r.n_words, r.n_base) == (len(words), len(places))
        assert (r.first_word, r.last_word) == (min((k for k, _ in places), default=None), max((k for k, _ in places), default=None))
        assert r.base_labels == ",".join(sorted({x for _, x in places})) and set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        assert 0 <= r.score <= 1
    assert license_scan.scan(none).isEmpty() and len(license_scan.rules()) > 300


def test_an_interval_within_a_stronger_one_is_suppressed():
    found = license_scan.detect(b" licensed under the gnu general public license version 3 ")
    assert [d.label for d in found] == ["gpl-3"]


LICENSES = [
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation", "mit"),
    ("SPDX-License-Identifier: GPL-2.0-or-later\nint main", "gpl-2.0-or-later"), ("under GPLv2, see there", "gpl-2.0"), ("the LGPLv2.1 applies", "lgpl-2.1"), ("(AGPLv3)", "agpl-3.0"),
    ("see https://creativecommons.org/licenses/by-sa/4.0/ for it", "cc-by-sa-4.0"), ("Licensed under the Apache License, Version 2.0 (the", "apache-2.0"), ("Copyright (c) 2019 Someone", "copyright"),
    ("This is free and unencumbered software released into the public domain.", "unlicense"), ("no part of this book may be reproduced in any form", "proprietary"),
]


def test_license_labels_suppression_and_score(spark):
    """Against a loop over all rules without gates, and over all pairs of detections."""
    rnd = random.Random(16)
    texts_ = [x for x, _ in LICENSES] + [" ".join(rnd.choice([x for x, _ in LICENSES] + [prose(rnd, 5)]) for _ in range(6)) for _ in range(40)] + ["", "plain words only"]
    got = {r.doc_id: r for r in license_scan.scan(spark.createDataFrame(list(enumerate(texts_)), "doc_id long, text string")).collect()}
    for k, x in enumerate(texts_):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", x.lower())
        spaced = (" " + " ".join(words) + " ").encode()
        found = sorted(((r.priority, m.start() - m.end(), n, m.start(), m.end(), r) for n, r in enumerate(license_scan.rules()) for m in r.regex.finditer(spaced)), key=lambda f: f[:4])
        kept: list = []
        for f in found:
            if not any(g[3] <= f[3] and f[4] <= g[4] for g in kept):
                kept.append(f)
        base = {label for phrase, label in license_scan.BASE.items() if f" {phrase} ".encode() in spaced}
        miss = float(np.prod([1 - f[5].confidence for f in kept]))
        assert got[k].labels == ",".join(sorted(base | {f[5].label for f in kept}))
        assert abs(got[k].score - (1.0 if base and miss == 1 else 1 - miss)) < 1e-9
        assert [(d.start, d.end, d.label) for d in got[k].detections] == sorted((spaced.count(b" ", 0, f[3]), spaced.count(b" ", 0, f[4]), f[5].label) for f in kept)
    assert all(label in got[k].labels.split(",") for k, (_, label) in enumerate(LICENSES))


def test_every_license_rule_is_gated_by_what_it_needs():
    """No gate hides a match: each signature's keyword lies within a part of its regex that does not vary."""
    rows = [x for level in (license_scan.TEXTS, license_scan.HEADERS, license_scan.NAMES, license_scan.NOTICES) for x in level]
    own = [r for r in license_scan.rules() if r.priority < 3 or r.priority == 3 + len(license_scan.FORMS)]
    assert len(rows) > 200 and len(set(rows)) == len(rows)
    for r, (_, _, regex) in zip(own, rows, strict=True):
        fixed = re.split(r"\(\?[:!=][^)]*\)\??|\[[^\]]*\]\+?|\.\{[^}]*\}\?|\)|\(|\w\?|\{", re.sub(r"licen\[cs\]", "licens", regex))
        assert any(r.keyword.decode() in f" {x} " for x in fixed), regex


def test_topk_equals_brute_force(spark):
    rnd = random.Random(8)
    rows = [(k, [rnd.uniform(-1, 1) for _ in range(4)]) for k in range(400)] + [(1000 + k, [0.5] * 4) for k in range(30)] + [(2000, None), (2050, [float("nan")] * 4), (2100, [1.0, None, 0.0, 0.0]), (2150, [0.25] * 3), (2200, [])]
    rows += [(2250, [0.9] * 4), (2250, [0.8] * 4), (2250, [0.8] * 4)]  # an id that repeats, with one vector and another
    vectors = topk_search.quantize(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), 256)
    good = [(k, np.floor(256 * np.array(v, np.float32).astype(np.float64)).astype(np.int64)) for k, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    want = []
    for n, (q, v) in enumerate(good):
        if q % 50 == 0:
            best = sorted((-int(v @ w), k) for m, (k, w) in enumerate(good) if m != n and len(w) == len(v))[:5]
            want += [(q, rank, k, -x) for rank, (x, k) in enumerate(best, 1)]
    queries_ = vectors.where("vec_id % 50 = 0")
    got = topk_search.search(vectors, queries_, 5).collect()
    assert sorted(map(tuple, got)) == sorted(want) and any(r.query_id == r.vec_id == 2250 for r in got)
    assert topk_search.search(vectors.where("false"), queries_.where("false"), 5).isEmpty()


def test_topk_past_the_broadcast_bound(spark, monkeypatch):
    monkeypatch.setattr(topk_search, "BROADCAST_BYTES", 2000)
    monkeypatch.setattr(topk_search, "QUERY_BLOCK", 3)
    test_topk_equals_brute_force(spark)


def test_scores_past_63_bits_stay_at_the_bound(spark):
    rows = [(0, [1e30, 1.0]), (1, [1e30, 2.0]), (2, [-1e30, 0.0]), (3, [0.0, 5.0])]
    vectors = topk_search.quantize(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 256)
    got = topk_search.search(vectors, vectors.where("vec_id = 0"), 3).collect()
    assert sorted((r.rank, r.vec_id, r.score) for r in got) == [(1, 1, topk_search.MOST), (2, 3, 256 * 5 * 256), (3, 2, -topk_search.MOST)]


SECRETS = [
    "secret=token:abcdefg password = 'hunter22' Api_Key:ZZZZZZZ token=ab", "AKIA" + "A" * 16 + " AKIA" + "B" * 15, "f" * 23 + " " + "f" * 24 + "g" + "0" * 30, "😀 é passwd: qwerty1",
    "eyJabcdefghijk.eyJabcdefghijk.abcdefghijklm", "https://user:secretpw@host ghp_" + "a" * 36, "sk_live_" + "a" * 20 + " xoxb-1234567890a",
]


def test_secret_scan_equals_regexes(spark, compiled, docs, texts, none):
    many = [*texts, *SECRETS]
    got = {r.doc_id: [(s.start, s.rank, s.end, s.kind) for s in r.secret_spans] for r in secret_scan.scan(spark.createDataFrame(list(enumerate(many)), "doc_id long, text string")).collect()}
    for k, x in enumerate(many):
        want = sorted((m.start(), n, m.end(), r.kind) for n, r in enumerate(secret_scan.RULES) for m in re.finditer(r.regex, x or "", re.ASCII | (re.IGNORECASE if r.any_case else 0)) if len(m[r.group]) >= r.least)
        assert got[k] == want
    assert any(got[len(texts) + k] for k in range(len(SECRETS))) and secret_scan.scan(none).isEmpty()


def test_postings_are_the_trigrams_of_each_text(spark):
    rows = spark.createDataFrame([(k, x) for k, x in enumerate([*SECRETS, *SECRETS, None, "", "nothing here"])], "doc_id long, text string")
    keyed = rows.select("text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("key")).distinct().collect()
    for block in (2, 4096):
        got = {(r.trigram, k) for r in secret_scan.index(rows, block=block).collect() for k in r["keys"]}
        assert got == {(w, r.key) for r in keyed for w in secret_scan.vocabulary() if w in (r.text or "").lower()}
    holds = lambda q, x: q in x if isinstance(q, str) else (all if q[0] == "and" else any)(holds(p, x) for p in q[1:])
    found = {r.key: r.rules for r in secret_scan.candidates(secret_scan.index(rows, block=2)).collect()}
    asked = [(1 << k, q) for k, q in enumerate(secret_scan.trigram_query(r.regex) for r in secret_scan.RULES) if q != ("and",)]
    assert found == {r.key: m for r in keyed if (m := sum(bit for bit, q in asked if holds(q, (r.text or "").lower())))}


def test_many_secrets_in_one_text_and_columns_that_clash(spark):
    text = " ".join(f"token=abcdef{k} é" for k in range(1500))
    docs = spark.createDataFrame([(1, text, "own", 7)], "doc_id long, text string, secret_spans string, _key int")
    want = [(m.start(), m.end()) for m in re.finditer(r"token=[a-z0-9]+", text)]
    row = secret_scan.scan(docs).first()
    assert [(s.start, s.end) for s in row.secret_spans if s.kind == "assign"] == want and row._key == 7
    out = secret_scan.redact(docs).first()
    assert (out.text, out.secret_spans, out._key) == (re.sub(r"token=[a-z0-9]+", "[secret]", text), "own", 7)


def test_redaction_leaves_the_rest(spark):
    rows = spark.createDataFrame([(1, "a password=abcdef1 b"), (2, None), (3, "clean"), (4, "token=" + "0a" * 20)], "doc_id long, text string")
    assert {r.doc_id: r.text for r in secret_scan.redact(rows).collect()} == {1: "a [secret] b", 2: None, 3: "clean", 4: "[secret]"}


def test_trigram_queries_hold_for_every_match():
    def holds(q, text):
        return q in text if isinstance(q, str) else (all if q[0] == "and" else any)(holds(x, text) for x in q[1:])

    for r in secret_scan.RULES:
        for x in SECRETS:
            if re.search(r.regex, x, re.IGNORECASE if r.any_case else 0):
                assert holds(secret_scan.trigram_query(r.regex), x.lower())


def test_quality_learns_only_from_rows_not_held_out(spark):
    rnd = random.Random(9)
    rows, labels = [], []
    for k in range(300):
        bad = k % 3 == 0
        x = prose(rnd, 40)
        rows.append((k, " ".join(w.upper() + "!!" for w in x.split()) if bad else x))
        labels.append((k, int(not bad), 0))
    rows += [(900, None), (901, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = quality_knn.score(docs, quality_knn.fit(docs, marks)).collect()
    right = [(r.score >= 0.5) == bool(labels[r.doc_id][1]) for r in got if r.doc_id < 300 and zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert len(right) > 50 and sum(right) / len(right) > 0.97 and all(0 <= r.score <= 1 for r in got)
    # changing the labels that are held out changes nothing
    flipped = [(k, 1 - y if zlib.crc32(str(k).encode()) % 3 == 1 else y, t) for k, y, t in labels]
    again = quality_knn.score(docs, quality_knn.fit(docs, spark.createDataFrame(flipped, "doc_id long, quality int, toxic int"))).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, again), key=str)
    nothing = quality_knn.fit(docs, marks.where("false"))
    assert {r.score for r in quality_knn.score(docs, nothing).collect()} == {0.5}


def test_quality_votes_equal_a_plain_neighbour_search(spark):
    rnd = random.Random(18)
    rows = [(k, prose(rnd, rnd.randint(5, 60)) if k % 2 else " ".join(rnd.choice("%&* 12 || AB").upper() for _ in range(rnd.randint(5, 90)))) for k in range(160)] + [(500, None), (501, "")]
    docs = spark.createDataFrame(rows + [(3, "again")], "doc_id long, text string")
    model = quality_knn.fit(docs, spark.createDataFrame([(k, k % 2, 0) for k in range(160)], "doc_id long, quality int, toxic int"), dims=8)
    got = {(r.doc_id, r.text): r.score for r in quality_knn.score(docs, model).collect()}
    for (_, text), have in got.items():
        full = np.zeros(quality_knn.TRIPLES + quality_knn.RATES)
        at, x = quality_knn.features(text or "")
        full[at] = x
        latent = full[model.kept] @ model.axes.astype(np.float64)
        if np.linalg.norm(latent) < 1e-9:
            assert have == model.prior
            continue
        near = sorted(((float(v @ latent / np.linalg.norm(latent)), y) for v, y in zip(model.vectors.astype(np.float64), model.labels, strict=True)), reverse=True)[: quality_knn.K]
        weights = [max(0.0, s) ** quality_knn.SHARPNESS for s, _ in near]
        assert abs(have - sum(w * y for w, (_, y) in zip(weights, near, strict=True)) / sum(weights)) < 2e-3


def shingle_set(x):
    w = (x or "").encode().lower().split()
    return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[k : k + 5]) for k in range(len(w) - 4)}


def components_of(rows):
    sets = {k: shingle_set(x) for k, x in rows}
    label = {k: k for k in sets}
    moved = True
    while moved:
        moved = False
        for a in sets:
            for b in sets:
                if label[a] < label[b] and sets[a] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                    label[b] = label[a]
                    moved = True
    return {k: (len(sets[k]), label[k], label[k] == k) for k in sets}


def near_copies(rnd, n):
    """A text and copies with more and more words replaced, chains included."""
    base = prose(rnd, 120).split()
    out = [" ".join(base)]
    for k in range(n):
        words = list(base if k % 2 else out[-1].split())
        for _ in range(rnd.randint(0, 4)):
            words[rnd.randrange(len(words))] = f"new{rnd.randrange(10**6)}"
        out.append(" ".join(words))
    return out


def test_near_dedup_equals_all_pairs(spark, texts, none):
    rnd = random.Random(10)
    many = [*texts, *near_copies(rnd, 40), *near_copies(rnd, 25), *near_copies(rnd, 25), "one two", "ONE two", "three"]
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dedup.link(spark.createDataFrame(list(enumerate(many)), "doc_id long, text string")).collect()}
    assert got == components_of(list(enumerate(many)))
    assert near_dedup.link(none).isEmpty()


def test_large_buckets_are_dealt_as_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 5)
    many = list(enumerate(near_copies(random.Random(11), 60)))
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dedup.link(spark.createDataFrame(many, "doc_id long, text string")).collect()}
    assert got == components_of(many)


def test_one_of_each_group_stays(spark):
    rows = [(1, "a b c d e f"), (2, "a b c d e f"), (3, None), (4, ""), (None, "z"), (5, "q"), (5, "q")]
    kept = near_dedup.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(str(r.doc_id) for r in kept) == ["1", "3", "4", "5", "None"]


def test_superminhash_estimates_similarity():
    rnd = np.random.default_rng(1)
    common = rnd.integers(0, 2**63, 800).astype(np.uint64)
    a, b = (np.unique(np.concatenate([common, rnd.integers(0, 2**63, 100).astype(np.uint64)])) for _ in range(2))
    x, y, z = near_dedup.signatures([a, b, a[:1]])
    assert abs((x == y).mean() - 0.8) < 0.08 and (z < np.iinfo(np.int64).max).all()
    # the least over elements, each with its own permutation: a union's registers are the least of both
    assert (near_dedup.signatures([np.union1d(a, b)])[0] == np.minimum(x, y)).all()


def test_fingerprints_equal_paragraph_sets(spark, compiled, texts, none):
    rows = [(k, x) for k, x in enumerate([*texts, "One. Two. Three.\nFour", "One. Two. Three.\nFour"])]
    parts = lambda x: {p for p in re.split(r"\n+|(?<=[.!?]) +", x) if p}
    like = lambda a, b: len(parts(a) & parts(b)) / len(parts(a) | parts(b)) if parts(a) | parts(b) else 1.0
    got = {r.doc_id: r for r in fingerprints.compare_versions(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    order = [x or "" for _, x in reversed(rows)]
    for n, (k, _) in enumerate(reversed(rows)):
        x, following = order[n], order[(n + 1) % len(order)]
        cut = len(x) // 3
        edited = x[: len(x) - cut] + following[:cut]
        r = got[k]
        assert (r.text, r.edited_text, r.next_text) == (x, edited, following)
        assert len(r.edited_text_difference) == len(parts(x) ^ parts(edited)) and len(r.next_text_difference) == len(parts(x) ^ parts(following))
    assert got[len(rows) - 1].fingerprint == got[len(rows) - 2].fingerprint and like("", "") == 1.0
    assert fingerprints.compare_versions(none.select("doc_id", "text")).isEmpty()


def test_large_differences_are_peeled_in_larger_sketches(spark):
    rnd = random.Random(12)
    rows = [(k, "\n".join(prose(rnd, 6) for _ in range(n))) for k, n in enumerate((3, 40, 200, 700))]
    for r in fingerprints.compare_versions(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        assert len(r.next_text_difference) == len(set(r.text.split("\n")) ^ set(r.next_text.split("\n")))


def test_registered_queries_hold_their_contracts(spark, tmp_path):
    rnd = random.Random(19)
    many = [prose(rnd, rnd.randint(1, 60)).replace(" t", ". T") for _ in range(25)] + [None, "", "password=hunter22 cc by", SECRETS[0]]
    many += [many[0], many[1] + " end", "\n".join(prose(rnd, 5) for _ in range(60))]
    whole = dict(enumerate(many))
    spark.createDataFrame([(k, x, "en", "s", len(x or "")) for k, x in whole.items()], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(k, k % 2, 0) for k in whole], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(7, 0, "user", "hi"), (7, 1, "assistant", None)], "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    spark.createDataFrame([(k, [rnd.uniform(-1, 1) for _ in range(3)]) for k in range(60)], "vec_id long, embedding array<float>").write.parquet(str(tmp_path / "embeddings.parquet"))
    out = {name: query(spark, str(tmp_path)).collect() for name, query in queries.QUERIES.items()}
    by = lambda name: {r.doc_id: r for r in out[name]}
    assert [len(out[f"{x}"]) for x in ("op1_chat_format", "op6_exact_topk")] == [2, 10]
    assert all(len(out[x]) == len(whole) for x in queries.QUERIES if x not in ("op1_chat_format", "op4_best_fit_packing", "op6_exact_topk"))
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(WORD_BPE)
    for r in out["op4_best_fit_packing"]:
        ids = [*tokenizer.encode(whole[r.doc_id] or "", add_special_tokens=False).ids, 0]
        assert (r.piece, r.start, r.length, r.ids_crc32) == (0, 0, len(ids), zlib.crc32(array.array("I", ids).tobytes()))
    assert sequences(out["op4_best_fit_packing"], 2048) == 1 + sum(r.length for r in out["op4_best_fit_packing"]) // 2048
    parts = lambda x: {p for p in re.split(r"\n+|(?<=[.!?]) +", x) if p}
    like = lambda a, b: len(parts(a) & parts(b)) / len(parts(a) | parts(b)) if parts(a) | parts(b) else 1.0
    for k, x in whole.items():
        x, following = x or "", whole[k - 1 if k else max(whole)] or ""
        cut = len(x) // 3
        edited, r = x[: len(x) - cut] + following[:cut], by("op10_fingerprints")[k]
        assert (r.n_chars, r.edited_sha256) == (len(x), hashlib.sha256(edited.encode()).hexdigest())
        assert abs(r.near_edited - like(x, edited)) < 1e-9 and abs(r.near_next - like(x, following)) < 1e-9
        q = by("op8_quality_knn")[k]
        assert q.held_out == (zlib.crc32(str(k).encode()) % 3 == 1) and q.predicted == int(q.score >= 0.5)
        assert by("op3_sentencepiece")[k].decoded_sha256 == hashlib.sha256(x.encode()).hexdigest()
    assert {k: (r.n_shingles, r.component_id, r.kept) for k, r in by("op9_near_dedup").items()} == components_of(list(whole.items()))


def test_every_operator_has_a_query():
    assert [int(x.split("_")[0][2:]) for x in queries.QUERIES] == list(range(1, 11))
