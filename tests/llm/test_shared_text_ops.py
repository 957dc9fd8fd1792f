"""Prefix trie, spelling variants, line dedup."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from corpus_samples import DOCS, prose
from pyspark.sql import functions as F

from tracewise.llm import line_dedup, prefix_trie, spelling

CONV = "conv_id long, turn long, role string, text string"


# -- prefix trie ------------------------------------------------------------------
def brute_trie(talks):
    """talks: id -> list of (role, text)."""
    members, ends = defaultdict(list), defaultdict(list)
    for c, ts in talks.items():
        for d in range(len(ts) + 1):
            members[tuple(ts[:d])].append(c)
        ends[tuple(ts)].append(c)
    kids, leaves, saved = Counter(), Counter(), Counter()
    for p in members:
        if p:
            kids[p[:-1]] += 1
    for p in members:
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += (len(members[p]) - 1) * (len(p[-1][1]) if p else 0)
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), kids[p], leaves[p], saved[p],
                   hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest())
                  for p, m in members.items()) if members else []


def trie_rows(keyed, **options):
    return sorted((tuple(r) for r in prefix_trie.prefix_trie(keyed, **options).collect()), key=lambda r: (r[0], r[1]))


def random_talks(n, seed):
    rng = random.Random(seed)
    talks = {}
    for c in rng.sample(range(10 * n), n):
        talks[c] = [(rng.choice(["user", "assistant"]), "xy"[:rng.randrange(3)] * (d + 1)) for d in range(rng.randrange(6))]
    hot = [("user", "hello there"), ("assistant", "hi")]
    talks |= {100_000 + i: hot for i in range(n)}  # equal conversations over many blocks
    talks |= {200_000 + i: [*hot, ("user", f"q{i}")] for i in range(n // 2)}
    talks[300_000] = hot * 150
    return talks


def talk_rows(talks):
    return [(c, d, r, t) for c, ts in talks.items() for d, (r, t) in enumerate(ts)]


@pytest.mark.parametrize("parts,block,fan_in", [(1, 1 << 16, 64), (13, 5, 2), (7, 40, 3), (5, 1, 2)])
def test_trie_equals_brute_force(spark, parts, block, fan_in):
    talks = {c: ts for c, ts in random_talks(60, parts).items() if ts}
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        keyed = prefix_trie.conversation_keys(spark.createDataFrame(talk_rows(talks), CONV))
        got = trie_rows(keyed, block_turns=block, fan_in=fan_in)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == sorted(brute_trie(talks), key=lambda r: (r[0], r[1]))


def test_trie_with_shared_starts_and_no_turns(spark):
    talks = {c: ts for c, ts in random_talks(80, 3).items() if ts}
    keyed = prefix_trie.conversation_keys(spark.createDataFrame(talk_rows(talks), CONV))
    rebuilt = prefix_trie.with_shared_starts(keyed, 5, 100, lambda c: F.crc32(c.cast("string").cast("binary")) % 6)
    want = {}
    for c, ts in talks.items():
        h = zlib.crc32(str(c).encode()) % 6
        want[c] = talks.get(c - c % 100, [])[:h] + ts[h:]
    assert any(not ts for ts in want.values())
    assert trie_rows(rebuilt) == sorted(brute_trie(want), key=lambda r: (r[0], r[1]))


def test_trie_edge_cases(spark):
    rows = [(1, 0, "user", "a"), (1, None, "user", "first"), (2, 5, None, None), (2, 5, None, None), (3, 1, "", ""),
            (3, 2, "", ""), (None, 0, "user", "lost"), (4, 1, "user", "b"), (4, 1, "user", "c"), (5, 1, "user", "c"),
            (5, 1, "user", "b"), (6, 0, "r:", "x"), (7, 0, "r", ":x"), (8, 0, "user", "long " * 100_000)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], CONV + ", depth string, key int")
    got = trie_rows(prefix_trie.conversation_keys(df))
    by_depth = {(r[0], r[1]): r for r in got}
    assert by_depth[1, 0][3] == 8  # eight conversations; the row without an id is in none
    assert by_depth[2, 2][3] == 2  # nulls are empty; repeated rows are repeated turns
    assert by_depth[4, 2][3] == 2  # equal turn numbers come in one order
    assert by_depth[6, 1][3] == by_depth[7, 1][3] == 1
    assert by_depth[1, 2][6] == 0 and by_depth[1, 1][2] == 1
    assert trie_rows(prefix_trie.conversation_keys(spark.createDataFrame([], CONV))) == []


# -- spelling variants ----------------------------------------------------------------
def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def brute_spelling(counts, ratio=2):
    out = {}
    for w, n in counts.items():
        found = sorted((-counts[v], v) for v in counts if near(w, v))
        form = found[0][1] if found and -found[0][0] >= ratio * n else None
        out[w] = [form, None, n, len(found), counts[form] if form else None]
    for w, row in out.items():
        at = w
        while out[at][0]:
            at = out[at][0]
        row[1] = at
    return {w: tuple(r) for w, r in out.items()}


def random_words(seed, n=400):
    rng = random.Random(seed)
    words = {"".join(rng.choice("abé") for _ in range(rng.randrange(5, 9))) for _ in range(n)}
    return {w: int(3 * 2 ** rng.uniform(0, 10)) for w in sorted(words)}


@pytest.mark.parametrize("batch", ["10000", "3"])
def test_spelling_equals_brute_force(spark, batch):
    counts = random_words(int(batch))
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
        rows = spelling.spelling_variants(spark.createDataFrame(list(counts.items()), "word string, n long")).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    got = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}
    want = brute_spelling(counts)
    assert got == want and len(rows) == len(want)
    assert any(r[1] != r[0] and r[0] for r in want.values())  # chains of forms


def test_word_counts_with_damage(spark, make_docs, odd_docs):
    docs = [(i, prose(300, i % 7) + " Straße ÀÉÎ naïve x×y÷z O'Neill") for i in range(40)] + [(None, "naïve " * 20)]
    want = Counter()
    for i, t in docs:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t):
            w = "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in w)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 7 == 0:
                k = h % len(w)
                w = w[:k] + w[k + 1:]
            want[w] += 1
    want = {w: n for w, n in want.items() if len(w) >= 4 and n >= 3}
    got = {r["word"]: r["n"] for r in spelling.word_counts(make_docs(docs), 7, 4).collect()}
    assert got == want and "naïve" in got and "x×y÷z" in got and "ÀÉÎ" not in got
    plain = {r["word"]: r["n"] for r in spelling.word_counts(odd_docs.withColumn("n", F.lit("x")), min_count=1).collect()}
    assert plain["naïve"] == 1 and plain["x" * 5000] == 1
    assert spelling.word_counts(spark.createDataFrame([], DOCS)).count() == 0
    none = spark.createDataFrame([], "word string, n long")
    assert spelling.spelling_variants(none).count() == 0


def test_spelling_edge_cases(spark):
    rows = [("aaaaa", 3), ("aaaa", 6), ("aaaaaa", 12), ("zzzzz", 5), ("yyyyy", 9)]
    got = {r["word"]: tuple(r)[1:] for r in spelling.spelling_variants(
        spark.createDataFrame([(w, n, "x") for w, n in rows], "word string, n long, form string")).collect()}
    assert got == brute_spelling(dict(rows))
    assert got["aaaaa"] == ("aaaaaa", "aaaaaa", 3, 2, 12) and got["zzzzz"] == (None, "zzzzz", 5, 0, None)
    with pytest.raises(ValueError):
        spelling.spelling_variants(spark.createDataFrame(rows, "word string, n long"), ratio=1)


# -- line dedup --------------------------------------------------------------------
def brute_lines(docs, least):
    def key(line):
        return "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in line.strip(" \t\n\v\f\r"))
    seen = defaultdict(set)
    for i, t in docs:
        for line in (t or "").split("\n"):
            seen[key(line)].add(("text", t) if i is None else i)
    out = []
    for i, t in docs:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (key(x) and len(seen[key(x)]) >= least)]
        out.append((i, None if t is None else "\n".join(kept), len(lines), len(lines) - len(kept)))
    return Counter(out)


def line_docs():
    rng = random.Random(11)
    common = [f"Share line {k}" for k in range(8)]
    docs = []
    for i in range(60):
        lines = [prose(12, 100 * i + j) for j in range(rng.randrange(4))]
        lines += [rng.choice([" ", "\t", ""]) + rng.choice([c, c.upper()]) + rng.choice(["", " \r"])
                  for c in rng.sample(common, rng.randrange(8))]
        lines += [rng.choice(["", "  ", "É line", "é line", "twice", "twice"]) for _ in range(3)]
        rng.shuffle(lines)
        docs.append((i, "\n".join(lines)))
    docs += [(0, docs[0][1]), (1, "other text\nSHARE LINE 0"), (None, "no id\nshare line 1"), (None, "no id\nshare line 1"),
             (None, "no id 2\nshare line 1"), (70, None), (71, ""), (72, "\n\n"), (73, ("long " * 40_000) + "\nshare line 2")]
    return docs


@pytest.mark.parametrize("listed", [50_000, 1])
def test_line_dedup_equals_brute_force(make_docs, monkeypatch, listed):
    docs = line_docs()
    monkeypatch.setattr(line_dedup, "MAX_LISTED", listed)  # 1: all but the most frequent are joined
    rows = line_dedup.drop_frequent_lines(make_docs(docs)).collect()
    assert Counter((r["doc_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in rows) == brute_lines(docs, 10)
    assert sum(r["n_dropped"] for r in rows) > 100


def test_line_dedup_edge_cases(spark, make_docs, odd_docs):
    docs = [(i, "É\nab\ntail %d" % i) for i in range(5)]
    two = line_dedup.drop_frequent_lines(make_docs(docs), min_docs=5, min_chars=2).collect()
    assert [r["text"] for r in two] == ["É\ntail %d" % r["doc_id"] for r in two]  # code points, not bytes
    clash = odd_docs.withColumn("n_lines", F.lit("x")).withColumn("ha", F.lit(1)).withColumn("row", F.lit(2))
    out = line_dedup.drop_frequent_lines(clash, min_docs=2)
    assert out.count() == odd_docs.count() and {"ha", "row"} <= set(out.columns)
    by = {r["doc_id"]: r for r in out.where("doc_id IN (2, 3, 7)").collect()}
    assert by[2]["text"] is None and by[2]["n_lines"] == 1 and by[3]["n_dropped"] == 0 and by[7]["text"] == ""
    assert line_dedup.drop_frequent_lines(spark.createDataFrame([], DOCS)).count() == 0
