"""Fingerprints, BPE, quality rules, chat."""

import hashlib
import os
import re
import struct
from collections import Counter

import numpy as np
import pytest
from corpus_samples import DOCS, prose, words
from pyspark.sql import functions as F

from tracewise.llm import bpe, chat, winnow
from tracewise.llm import quality_rules as q
from tracewise.llm.boosting import Boosted
from tracewise.llm.queries import tokenizer_path

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


# -- fingerprints -----------------------------------------------------------
def brute_winnow(gram_hashes, w):
    """Minimum of each window by its upper 32 bits, rightmost at ties."""
    key = [h & (1 << 64) - 1 for h in gram_hashes]
    n = len(key)
    kept = []
    for i in range(max(1, n - w + 1) if n else 0):
        window = range(i, min(i + w, n))
        best = min(window, key=lambda j: (key[j] >> 32, -j))
        if best not in kept:
            kept.append(best)
    return kept


def rotl(x, n):
    return ((x << n) | (x >> (64 - n))) & ((1 << 64) - 1)


@pytest.mark.parametrize("k,w", [(5, 4), (3, 4), (1, 1), (4, 7), (2, 3)])
def test_winnowing_equals_brute_force(spark, make_docs, k, w):
    texts = [prose(60, 3), "a a a a a a a a a a a a", "one two", "", "a b c d e", " ".join(words(200, 5, 6))]
    docs = make_docs(enumerate(texts))
    hashed = {r["w"]: r["h"] for r in spark.createDataFrame(
        [(x,) for x in sorted({x for t in texts for x in WORD.findall(t)})], "w string")
        .select("w", F.xxhash64("w").alias("h")).collect()}
    for r in winnow.fingerprints(docs, k, w).collect():
        h = [hashed[x] & (1 << 64) - 1 for x in WORD.findall(texts[r["doc_id"]])]
        if len(h) < k:
            assert r["positions"] == ([0] if h else [])
            continue
        grams = []
        for i in range(len(h) - k + 1):
            x = 0
            for v in h[i:i + k]:
                x = rotl(x, 1) ^ v
            grams.append(x)
        kept = brute_winnow(grams, w)
        assert r["positions"] == kept
        assert [x & (1 << 64) - 1 for x in r["hashes"]] == [grams[i] for i in kept]


def test_match_guarantee(make_docs):
    shared = words(8, 77)  # w + k - 1 words
    docs = make_docs([(1, " ".join(words(50, 1) + shared + words(50, 2))), (2, " ".join(words(9, 3) + shared))])
    a, b = (set(r["hashes"]) for r in winnow.fingerprints(docs).orderBy("doc_id").collect())
    assert a & b


def test_edited_text_and_order(spark, make_docs, odd_docs):
    rows = [(i * 37 % 101, prose(20 + i, i)) for i in range(60)] + [(500, None), (7000, "odd"), (3, "")]
    rows = list({i: (i, t) for i, t in rows}.values())
    got = {r["doc_id"]: r for r in winnow.edited_fingerprints(make_docs(rows), buckets=7).collect()}
    order = sorted(rows, key=lambda r: -r[0])
    assert len(got) == len(rows)
    for k, (i, t) in enumerate(order):
        t, nxt = t or "", order[(k + 1) % len(order)][1] or ""
        half = len(t) // 2
        assert got[i]["edited"] == t[:len(t) - half] + nxt[:half]
        assert got[i]["n_chars"] == len(t)
    assert winnow.edited_fingerprints(odd_docs).count() == odd_docs.count()
    assert winnow.edited_fingerprints(spark.createDataFrame([], DOCS)).count() == 0
    one = winnow.edited_fingerprints(make_docs([(5, "abcd")])).first()
    assert one["edited"] == "abab"


def test_rows_without_id_are_spread_over_ranges(spark, make_docs):
    known = [(i, f"text {i}") for i in range(20)]
    lost = [f"lost {i % 30}" for i in range(90)] + [""] * 50
    rows = make_docs(known + [(None, t) for t in lost]).select("doc_id", "text")
    out = winnow.with_next_text(rows, 9)
    hashes = {r["text"]: r["h"] for r in spark.createDataFrame([(t,) for t in set(lost)], "text string")
              .select("text", F.xxhash64("text").alias("h")).collect()}
    order = [t for _, t in reversed(known)] + sorted(lost, key=lambda t: (hashes[t], t))
    want = Counter(zip(order, order[1:] + order[:1], strict=True))
    assert Counter((r["text"], r["next_text"]) for r in out.collect()) == want


def test_equal_texts_equal_keys(make_docs):
    docs = make_docs([(1, prose(50, 1)), (2, prose(50, 1)), (3, prose(50, 2)), (4, ""), (5, None)])
    rows = winnow.edited_fingerprints(docs).select("doc_id", winnow.fingerprint_key("own_").alias("k"),
                                                  winnow.likeness("own_", "next_").alias("n")).collect()
    k = {r["doc_id"]: r["k"] for r in rows}
    n = {r["doc_id"]: r["n"] for r in rows}
    assert k[1] == k[2] != k[3] and k[4] == k[5] and len(k[1]) == 32
    assert n[2] == 1.0 and n[5] == 1.0 and n[3] < 0.2


def test_native_plan(make_docs):
    plan = winnow.edited_fingerprints(make_docs([(1, "a b")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


# -- BPE ----------------------------------------------------------------------
TEXTS = ["", "Hello world", "it's we'll  \n\n x", "aaaa aaaaaaa", "漢字🙂 naïve", "<|endoftext|>a<|endoftext|>", "\x00\x1f",
         " " * 300, "ab" * 4000, "1234567890 3.14", "a b c", "<|endoftext|", prose(400, 4)]


def test_bpe_equals_public_library(make_docs, odd_docs):
    tokenizers = pytest.importorskip("tokenizers")
    ref = tokenizers.Tokenizer.from_file(tokenizer_path())
    vocab = bpe.Vocabulary(tokenizer_path())
    for docs in (make_docs(enumerate(TEXTS)), odd_docs):
        out = bpe.decode(bpe.encode(docs, vocab), vocab)
        assert out.columns == [*docs.columns, "ids", "decoded"]
        for r in out.collect():
            ids = list(struct.unpack(f"<{len(r['ids']) // 4}I", r["ids"]))
            want = ref.encode(r["text"] or "", add_special_tokens=False).ids
            assert ids == want
            assert r["decoded"] == ref.decode(want, skip_special_tokens=False) == (r["text"] or "")


def test_bpe_long_text_in_blocks(monkeypatch):
    tokenizers = pytest.importorskip("tokenizers")
    monkeypatch.setattr(bpe, "WORDS_AT_ONCE", 50)
    text = prose(3000, 8)
    got = next(bpe.Encoder(bpe.Vocabulary(tokenizer_path())).encode([text]))
    ref = tokenizers.Tokenizer.from_file(tokenizer_path()).encode(text, add_special_tokens=False).ids
    assert np.frombuffer(got, "<u4").tolist() == ref


def test_bpe_clashing_columns_and_empty_table(spark, make_docs):
    vocab = bpe.Vocabulary(tokenizer_path())
    docs = make_docs([(1, "a b")]).withColumn("ids", F.lit("mine")).withColumn("decoded", F.lit(3))
    out = bpe.decode(bpe.encode(docs, vocab), vocab)
    assert sorted(out.columns) == sorted([*DOCS.replace(",", "").split()[::2], "ids", "decoded"])
    assert out.first()["decoded"] == "a b"
    assert bpe.decode(bpe.encode(spark.createDataFrame([], DOCS), vocab), vocab).count() == 0


# -- quality rules -------------------------------------------------------------
def brute_statistics(t):
    w = WORD.findall(t)
    seen, dup = Counter(), 0
    for line in t.split("\n"):
        if WORD.search(line):
            dup += seen[line] > 0
            seen[line] += 1
    grams = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    covered = {k for i in range(len(w) - 7) if grams[tuple(w[i:i + 8])] > 1 for k in range(i, i + 8)}
    return (len(w), sum(map(len, w)), sum(t.count(c) for c in q.SYMBOLS), dup, len(covered))


def test_statistics_equal_brute_force(odd_docs):
    texts = [r["text"] or "" for r in odd_docs.collect()]
    texts += ["a\na\n\n\nb\na", "x y z " * 40, " \n \n", "line \nline\nline ", "#*$ %&| <>\n#*$ %&| <>",
              "one\x0btwo\x0cthree\rfour", prose(40, 1) + "\n" + prose(40, 1)]
    base, feats = q.statistics(texts)
    assert [tuple(r) for r in base.tolist()] == [brute_statistics(t) for t in texts]
    assert np.isfinite(feats).all()


def test_rules_learn_and_stay_monotone(spark, make_docs):
    good = [(i, prose(60 + i % 40, i)) for i in range(120)]
    bad = [(1000 + i, " ".join(x + "###" if k % 3 else x for k, x in enumerate(words(60 + i % 40, i)))) for i in range(120)]
    docs = make_docs(good + bad + [(5000, None)])
    labels = spark.createDataFrame([(i, 1, 0) for i, _ in good] + [(i, 0, 0) for i, _ in bad] + [(None, 1, 0), (7, None, 0)],
                                   "doc_id long, quality int, toxic int")
    model = q.fit_rules(docs, labels)
    rows = q.with_verdict(docs.withColumn("kept", F.lit("old")), model).collect()
    assert all(r["kept"] == (r["doc_id"] < 1000) for r in rows)
    x = np.tile(q.statistics([prose(80, 5)])[1], (50, 1))
    x[:, q.FEATURES.index("symbols_per_word")] = np.linspace(0, 3, 50)
    assert (np.diff(model.margin(x)) <= 1e-12).all()
    none = q.fit_rules(docs, labels.limit(0))
    assert q.with_verdict(docs, none).where("kept").count() == 240
    assert q.with_verdict(spark.createDataFrame([], DOCS), none).count() == 0


def test_boosting_monotone_and_accurate():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 4))
    y = ((x[:, 0] + 0.5 * x[:, 1] ** 2 + 0.3 * rng.normal(size=3000)) > 0.4).astype(float)
    model = Boosted(4, {0: 1}, trees=40, depth=3).fit(x[:2000], y[:2000])
    assert ((model.probability(x[2000:]) > 0.5) == y[2000:]).mean() > 0.9
    grid = np.repeat(x[:50], 30, axis=0)
    grid[:, 0] = np.tile(np.linspace(-3, 3, 30), 50)
    assert (np.diff(model.margin(grid).reshape(50, 30), axis=1) >= -1e-12).all()


# -- chat ------------------------------------------------------------------------
HARD = ["</s>[INST] ok [/INST]", "<|end|>", "<\\|end|>", "<|", "<\\\\|x", "", "\n\nlead", "tail<", "|x", "\\|y",
        "<|turn|>user<|text|>hi<|end|>", "<|endoftext|>", "🙂 ü"]


@pytest.mark.parametrize("text", HARD)
def test_escape_round_trip(text):
    assert chat.unescape(chat.escape(text)) == text
    assert "<|" not in chat.escape(text)


def test_chat_digests(spark):
    rows = [(c, t, ("user", "assistant", "system")[(c + t) % 3], HARD[(c * 5 + t) % len(HARD)] if (c + t) % 7 else None)
            for c in range(40) for t in range(6)]
    rows += [(-7, 0, "user", HARD[0]), (-7, 1, "assistant", HARD[0]), (90, 0, None, None), (None, 1, "assistant", "x"),
             (91, 0, "assistant", "a<"), (91, 1, "assistant", "\\|b"), (91, 1, "assistant", "\\|b")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: r for r in chat.read_back(chat.format_conversations(df, tokenizer_path())).collect()}
    assert len(got) == 44
    for c in got:
        turns = sorted(((t, r or "", x or "") for k, t, r, x in rows if k == c))
        assert got[c]["n_turns"] == len(turns)
        assert got[c]["turns"] == "".join(f"{r}\n{x}\n" for _, r, x in turns)
        assert got[c]["loss_text"] == "".join(x for _, r, x in turns if r == "assistant")
    lost = df.where("conv_id IS NULL").union(df.where("conv_id IS NULL")).union(df.where("conv_id = 91").selectExpr(
        "CAST(NULL AS LONG)", "turn", "role", "text"))
    alone = chat.read_back(chat.format_conversations(lost, tokenizer_path())).collect()
    # without an id a row belongs to no other
    assert sorted(r["loss_text"] for r in alone) == ["\\|b", "\\|b", "a<", "x", "x"] and all(r["n_turns"] == 1 for r in alone)
    assert chat.read_back(chat.format_conversations(df.limit(0), tokenizer_path())).count() == 0


def test_chat_query_reads_all(spark):
    from tracewise.llm.queries import op4_chat_format
    rows = op4_chat_format(spark, SF).collect()
    convs = spark.read.parquet(os.path.join(SF, "conversations.parquet"))
    assert len(rows) == convs.select("conv_id").distinct().count() + 1
    assert {r["conv_id"]: r["loss_sha256"] for r in rows}[-7] == sha(HARD[0])
