"""Packing, sentence dedup, near-dedup, URL filter, PII, byte network."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from corpus_samples import DOCS, prose, words
from pyspark.sql import functions as F

from tracewise.llm import byte_cnn, lsh_forest, packing, pii, sentence_dedup, url_filter
from tracewise.llm.boosting import Boosted
from tracewise.llm.components import connected_components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# -- components ---------------------------------------------------------------
def brute_components(edges):
    up = {}

    def find(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x
    for a, b in edges:
        if a is None or b is None or a == b:
            continue
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {x: find(x) for x in up}


@pytest.mark.parametrize("edges", [
    [(i, i + 1) for i in range(40)], [(100, i) for i in range(60)] + [(7, 200), (200, 201)],
    [(1, 1), (2, None), (None, 3), (5, 4), (4, 5), (5, 4)], [],
    [(i * 31 % 97, i * 57 % 97) for i in range(70)]])
def test_components(spark, edges):
    out = connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()
    assert {r["node"]: r["component"] for r in out} == brute_components(edges)
    assert len(out) == len({r["node"] for r in out})


def test_components_of_strings(spark):
    out = connected_components(spark.createDataFrame([("b", "c"), ("c", "a"), ("x", "y")], "src string, dst string"))
    assert {r["node"]: r["component"] for r in out.collect()} == {"a": "a", "b": "a", "c": "a", "x": "x", "y": "x"}


# -- near-dedup -----------------------------------------------------------------
def shingles(t, k):
    w = WORD.findall((t or "").translate(FOLD))
    if len(w) >= k:
        return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}
    return {tuple(w)} if w else set()


def brute_near(rows, k, percent):
    sets = [(i, shingles(t, k)) for i, t in rows if i is not None]
    links = []
    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y:
                common = len(x & y)
                if 100 * common >= percent * (len(x) + len(y) - common):
                    links.append((sets[a][0], sets[b][0]))
    return brute_components(links)


def near_rows():
    rows = [(i, prose(60 + i % 50, i)) for i in range(100, 160)]
    for g in range(12):  # groups of near copies of one text
        w = prose(120, 900 + g).split()
        for c in range(2 + 5 * (g % 3)):
            v = list(w)
            for e in range(c % 5):
                v[(c * 17 + e * 31) % len(v)] = f"edit{c}x{e}"
            rows.append((1000 * (g + 1) + c, " ".join(v)))
    rows += [(40, prose(60, 130).upper()), (41, prose(60, 130)), (42, ""), (43, None), (44, "a b"), (45, "A  b"), (46, "a c"),
             (47, " \n")]
    return rows


@pytest.mark.parametrize("k,percent", [(4, 80), (5, 80)])
def test_near_duplicates_equal_brute_force(make_docs, k, percent):
    rows = near_rows()
    want = brute_near(rows, k, percent)
    got = lsh_forest.near_duplicates(make_docs(rows), words=k, percent=percent).collect()
    assert len(got) == len(rows)
    for r in got:
        i = r["doc_id"]
        assert r["component_id"] == want.get(i, i)
        assert r["kept"] == (r["component_id"] == i)
        assert r["n_shingles"] == len(shingles(dict(rows)[i], k))
    assert any(not r["kept"] for r in got)


def test_near_duplicates_edge_cases(spark, odd_docs):
    got = lsh_forest.near_duplicates(odd_docs).collect()
    assert len(got) == odd_docs.count()
    by = defaultdict(set)
    for r in got:
        by[r["doc_id"]].add(r["component_id"])
    assert by[7] == by[1] == {1} and by[None] == {None} and by[2] == {2} and by[3] == {3}
    kept = lsh_forest.keep_one(odd_docs.withColumn("component_id", F.lit("mine")).withColumn("sig", F.lit(1)))
    assert Counter(r["doc_id"] for r in kept.collect()) == {1: 1, 2: 1, 3: 1, 4: 1, None: 2, 5: 1, 6: 1, 8: 1, 9: 1}
    assert kept.columns[-2:] == ["component_id", "sig"]
    assert lsh_forest.near_duplicates(spark.createDataFrame([], DOCS)).count() == 0


def test_near_duplicates_any_partitioning(spark, make_docs):
    rows = near_rows()
    results = []
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("1", "13"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            results.append({r["doc_id"]: r["component_id"] for r in lsh_forest.near_duplicates(
                make_docs(rows).repartition(int(n))).collect()})
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert results[0] == results[1]


def test_near_duplicates_inside_a_family_of_near_misses(make_docs):
    base = prose(800, 4242).split()
    rng = np.random.default_rng(5)
    rows = []

    def variant(i, at):
        v = list(base)
        for k in at:
            v[5 * k] = f"v{i}q{k}"
        rows.append((i, " ".join(v)))

    for i in range(360):  # one template, pairwise at about 0.76
        variant(i, rng.choice(160, 11, replace=False))
    for i in range(20):  # isolated pairs at about 0.81: six changes at the same places, in different words
        at = rng.choice(160, 16, replace=False)
        variant(1000 + 2 * i, at[:11])
        variant(1001 + 2 * i, at[5:])
    want = brute_near(rows, 5, 80)
    assert all(want[1000 + 2 * i] == want[1001 + 2 * i] for i in range(20))
    assert len(set(want.values())) >= 20 and len(rows) - len(want) >= 100
    # few neighbours, so that a small family crowds the windows as a large one does at 16
    got = {r["doc_id"]: r["component_id"] for r in lsh_forest.near_duplicates(make_docs(rows), neighbours=2).collect()}
    assert got == {i: want.get(i, i) for i, _ in rows}


def family(n, changes, seed, places=80):
    """n variants of one text of 5 * places words, each with some words changed."""
    base, rng = prose(5 * places, 4000 + seed).split(), np.random.default_rng(seed)
    rows = []
    for i in range(n):
        v = list(base)
        for k in rng.choice(places, changes, replace=False):
            v[5 * k] = f"v{i}q{k}"
        rows.append((i, " ".join(v)))
    return rows


@pytest.mark.parametrize("n,changes", [(150, 4), (450, 4), (150, 8)])
def test_confirmed_pairs_grow_with_the_family(make_docs, monkeypatch, n, changes):
    tried = []
    confirmed = lsh_forest.confirmed

    def counting(pairs, *args):
        tried.append(pairs.count())
        return confirmed(pairs, *args)
    monkeypatch.setattr(lsh_forest, "confirmed", counting)
    rows = family(n, changes, n + changes)
    got = {r["doc_id"]: r["component_id"] for r in lsh_forest.near_duplicates(make_docs(rows)).collect()}
    want = brute_near(rows, 5, 80)
    assert got == {i: want.get(i, i) for i, _ in rows}
    assert sum(tried) <= 4 * n


def test_pairs_are_met_under_their_first_shared_shingle():
    lists = [[1, 2, 3], [2, 3], [3, 4], [4], [1, 4]]
    assert lsh_forest._first_shared(lists, 3)[[0, 0, 1]][:, [1, 2]].tolist() == [[False, True], [False, True], [False, True]]
    first = lsh_forest._first_shared(lists, 4)
    assert first[2, 3] and not first[0, 4] and first[1, 4] and not first[0, 1]


def test_ids_with_several_texts_join_their_classes(make_docs, monkeypatch):
    a, b, c = prose(80, 1), prose(80, 2), prose(80, 3)
    rows = [(1, a), (2, a), (2, b), (3, b), (3, b), (4, c), (5, c), (5, ""), (6, "")] + [(100 + i, a) for i in range(40)]
    got = []
    for listed in (10_000, 1):  # 1: only the largest class is broadcast
        monkeypatch.setattr(lsh_forest, "MAX_LISTED", listed)
        got.append(sorted((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"])
                          for r in lsh_forest.near_duplicates(make_docs(rows)).collect()))
    assert got[0] == got[1] and len(got[0]) == len(rows)
    comp = {i: c for i, _, c, _ in got[0]}
    assert all(comp[i] == 1 for i in (1, 2, 3, 100, 139)) and comp[4] == comp[5] == 4 and comp[6] == 6


def test_keep_one_keeps_texts_that_share_an_id(make_docs):
    a, b = prose(80, 1), prose(80, 2)
    rows = make_docs([(1, a), (1, a), (1, b), (2, a), (3, "x"), (3, "x")]).withColumn("n_chars", F.lit(7).cast("long"))
    more = rows.union(rows.withColumn("lang", F.lit("aa")))
    for docs in (more, more.withColumn("m", F.create_map(F.lit("k"), F.col("lang")))):
        out = lsh_forest.keep_one(docs)
        assert out.columns == docs.columns
        assert Counter((r["doc_id"], r["text"], r["lang"]) for r in out.collect()) == Counter(
            {(1, a, "aa"): 1, (1, b, "aa"): 1, (3, "x", "aa"): 1})


def test_blocks_split_a_hot_shingle(spark):
    sets = [(i, i, 100, [*range(90), *range(1000 * i + 1000, 1000 * i + 1010)]) for i in range(1200)]
    sets += [(5000 + i, 5000 + i, 100, [*range(90), *range(9_000_000, 9_000_006), *range(10 * i - 100, 10 * i - 96)])
             for i in range(2)]
    df = spark.createDataFrame(sets, "doc_id long, component long, n long, shingles array<long>") \
        .withColumn("small", F.lit(bytes(160)))
    got = [tuple(r) for r in lsh_forest.crowded_links(df, 90, 0.7).collect()]
    assert got == [(5000, 5001)]


def test_signatures_estimate_likeness():
    mul, add = lsh_forest._coefficients(160, 7)
    a, b = (next(lsh_forest.shingle_sets([" ".join(w)], 4)) for w in (words(400, 1, 9000), words(360, 1, 9000)))
    true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert abs((lsh_forest.signature(a, mul, add) == lsh_forest.signature(b, mul, add)).mean() - true) < 0.12


# -- sentence dedup ---------------------------------------------------------------
CLOSE = "[\"')\\]}»’”」』）】]"


def brute_sentences(t):
    """Pieces of the text (with the white space that follows), their words, and what these count."""
    out, begin = [], 0
    piece = rf"([^\x20\x09-\x0D]*?[。！？](?:{CLOSE}*[。！？])*{CLOSE}*|[^\x20\x09-\x0D]+)([\x20\x09-\x0D]*)"
    words = []
    for m in re.finditer(piece, t):
        words.append(m.group(1).translate(FOLD))
        if re.search(rf"[.!?。！？]{CLOSE}*$", m.group(1)) or "\n" in m.group(2):
            out.append((t[begin:m.end()], words))
            begin, words = m.end(), []
    if begin < len(t):
        out.append((t[begin:], words))
    return [(s, w, sum(max(1, sum(c > "\u07ff" for c in x) // 2) for x in w)) for s, w in out if s]


def brute_dedup(rows, m=2, w=25, long=25):
    spans = defaultdict(list)
    split = {}
    for i, t in rows:
        s = split[i] = brute_sentences(t or "")
        for a in range(len(s)):
            for b in range(a + 1, len(s) + 1):
                n = sum(x[2] for x in s[a:b])
                if b - a >= m and n >= w:
                    spans[tuple(x for y in s[a:b] for x in y[1])].append((i, a, b))
                    break
            if s[a][2] >= long:
                spans[tuple(s[a][1])].append((i, a, a + 1))
        for a in range(len(s) - m, -1, -1):
            if sum(x[2] for x in s[a:]) >= w:
                spans[tuple(x for y in s[a:] for x in y[1])].append((i, a, len(s)))
                break
    gone = defaultdict(set)
    for found in spans.values():
        for i, a, b in sorted(set(found))[1:]:
            gone[i].update(range(a, b))
    return {i: ("".join(x[0] for k, x in enumerate(split[i]) if k not in gone[i]), len(gone[i])) for i, _ in rows}


def test_sentence_dedup_equals_brute_force(make_docs):
    passage, other = prose(70, 501), " ".join(words(55, 502)) + "."
    rows = [(i, prose(40 + 7 * (i % 9), i)) for i in range(30)]
    rows += [(100, prose(30, 600) + "\n" + passage + "\n" + prose(20, 601)), (101, passage.upper()),
             (102, prose(50, 602) + " " + passage + " " + passage), (103, "intro line\n" + other + "\nend."),
             (104, other + " " + prose(30, 603)), (105, prose(60, 604)), (106, prose(60, 604)), (107, ""),
             (108, "a. b. c. " * 30), (109, "Short. One."), (110, "  \n lead " + passage)]
    want = brute_dedup(rows)
    got = {r["doc_id"]: (r["text"], r["n_removed"]) for r in sentence_dedup.without_repeats(make_docs(rows)).collect()}
    assert got == want
    assert got[101] == ("", got[101][1]) and got[105][1] == 0 and got[106][0] == ""


def test_sentences_in_scripts_without_blanks_and_before_closers(make_docs):
    han = "".join(chr(0x4E00 + (i * 37) % 900) for i in range(40))
    passage = f"{han}。{han[::-1]}！？「{han[5:30]}。」{han[3:]}）x"
    quoted = '"' + " ".join(words(14, 700)) + '." (' + " ".join(words(14, 701)) + "!) " + " ".join(words(9, 702)) + "?’"
    rows = [(1, "序" * 20 + "。" + passage), (2, passage + "。" + "跋" * 30), (3, "漢" * 200), (4, "漢" * 200 + "。"),
            (5, prose(30, 703) + " " + quoted + " " + prose(10, 704)), (6, "Lead. " + quoted), (7, "。。！」」"), (8, ')))"'),
            (9, "🙂" * 60 + "." + "é" * 60 + "."), (10, "🙂" * 60 + "。" + "é" * 60 + "."), (11, "a。 b！c？d")]
    want = brute_dedup(rows)
    got = {r["doc_id"]: (r["text"], r["n_removed"]) for r in sentence_dedup.without_repeats(make_docs(rows)).collect()}
    assert got == want
    assert got[2][1] >= 3 and got[6][1] == 2 and got[6][0].startswith("Lead. w")


def test_sentence_dedup_edge_cases(spark, make_docs, odd_docs):
    out = sentence_dedup.without_repeats(odd_docs.withColumn("n_removed", F.lit("x")).withColumn("digest", F.lit(1))).collect()
    assert len(out) == odd_docs.count()
    texts = defaultdict(list)
    for r in out:
        texts[r["doc_id"]].append(r["text"])
    assert texts[2] == [None] and sorted(texts[None], key=str) == [None, "lost row"] and texts[7] == [""]
    assert texts[1] == [prose(80, 1)] * 2  # one document, given twice
    assert sentence_dedup.without_repeats(spark.createDataFrame([], DOCS)).count() == 0


# -- packing -----------------------------------------------------------------------
def check_packing(rows, docs, capacities):
    want = Counter()
    for i, t in docs:
        if t:
            want[i] += len(t)
    got, bins, spans = Counter(), defaultdict(list), defaultdict(list)
    for r in rows:
        got[r["doc_id"]] += r["size"]
        bins[r["sequence"]].append(r)
        spans[r["doc_id"], r["length"], r["copy"]].append((r["start"], r["start"] + r["size"]))
    assert got == want
    for s in spans.values():  # pieces are consecutive and start at 0
        s.sort()
        assert s[0][0] == 0 and all(a[1] == b[0] for a, b in zip(s, s[1:], strict=False))
    for b in bins.values():
        b.sort(key=lambda r: r["offset"])
        used = sum(r["size"] for r in b)
        assert [r["offset"] for r in b] == np.cumsum([0, *[r["size"] for r in b][:-1]]).tolist()
        assert {r["capacity"] for r in b} == {min(c for c in capacities if c >= used)}
    return bins


def test_packing(spark, make_docs, odd_docs):
    docs = [(i, "x" * (1 + i * 7919 % 3000)) for i in range(400)] + [(900, "y" * 10_000), (901, "z" * 10_000), (902, ""),
                                                                    (903, None), (1, "x" * 50), (5, "q"), (5, "q")]
    caps = (500, 1000, 2000, 4000)
    rows = packing.pack(make_docs(docs), caps).collect()
    bins = check_packing(rows, docs, caps)
    total = sum(len(t or "") for _, t in docs)
    assert sum(b[0]["capacity"] for b in bins.values()) < 1.03 * total
    several = packing.pack(make_docs(docs), caps, group_pieces=50).collect()
    check_packing(several, docs, caps)
    assert len({r["sequence"] >> 32 for r in several}) > 3
    assert sorted(rows) == sorted(packing.pack(make_docs(docs).repartition(7), caps).collect())
    odd = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    check_packing(packing.pack(odd_docs.withColumn("copy", F.lit(1)).withColumn("grp", F.lit(1))).collect(), odd,
                  packing.CAPACITIES)
    assert packing.pack(spark.createDataFrame([], DOCS)).count() == 0


def test_joint_lengths_cost_no_more():
    rng = np.random.default_rng(1)
    for _ in range(20):
        sizes = np.sort(rng.integers(1, 2000, 60))[::-1]
        bins, final = packing.pack_group(sizes, (500, 1000, 2000), 8, 0.0)
        cost = sum(final) + 8 * len(final)
        only = packing.best_fit(sizes, (2000,), 8, 0.0)
        assert cost <= len(only[1]) * 2008
        assert (np.bincount(bins, sizes) <= final).all()


def cheapest(sizes, caps, overhead, attention):
    """Least cost over all ways to deal the pieces to sequences."""
    best, cost = [float("inf")], [packing.sequence_cost(c, overhead, attention) for c in caps]

    def price(used):
        return min(c for c, cap in zip(cost, caps, strict=True) if cap >= used)

    def put(k, bins):
        if sum(price(b) for b in bins) >= best[0]:
            return
        if k == len(sizes):
            best[0] = sum(price(b) for b in bins)
            return
        for i in range(len(bins)):
            if bins[i] + sizes[k] <= caps[-1] and bins[i] not in bins[:i]:
                put(k + 1, [*bins[:i], bins[i] + sizes[k], *bins[i + 1:]])
        put(k + 1, [*bins, sizes[k]])
    put(0, [])
    return best[0]


def test_packing_against_exhaustive_search():
    rng = np.random.default_rng(8)
    caps, overhead, attention = (10, 20, 40), 1.0, 0.01
    ratios = []
    for _ in range(60):
        sizes = np.sort(rng.integers(1, rng.choice([8, 21, 41]), 8))[::-1]
        bins, final = packing.pack_group(sizes, caps, overhead, attention)
        used = np.bincount(bins, sizes, len(final))
        assert all(u <= c for u, c in zip(used, final, strict=True))
        ratios.append(sum(packing.sequence_cost(c, overhead, attention) for c in final)
                      / cheapest(sizes.tolist(), caps, overhead, attention))
    assert max(ratios) < 1.2 and np.mean(ratios) < 1.03 and np.mean(np.array(ratios) < 1 + 1e-9) > 0.5


def test_lengths_are_weighed_jointly():
    caps = packing.CAPACITIES
    rng = np.random.default_rng(4)
    sizes = np.sort(np.concatenate([rng.integers(15_500, 16_300, 20), rng.integers(7800, 8190, 60),
                                    rng.integers(990, 1024, 400)]))[::-1]
    bins, final = packing.pack_group(sizes, caps)
    cost = sum(packing.sequence_cost(c, packing.OVERHEAD, packing.ATTENTION) for c in final)
    assert {1024, 8192, 16_384} <= set(final)
    # cheaper than opening any one length with downsizing, even with long pieces apart
    one = [packing.best_fit(sizes, caps, choice=(c,))[2] for c in caps]
    assert cost < min(one[1:]) and cost <= one[0]
    # one long piece does not decide for the short ones
    bins, final = packing.pack_group(np.array([16_000] + [1000] * 50), caps)
    assert final.count(16_384) == 1 and set(final) - {16_384} == {1024}


def test_registered_packing_opens_several_lengths(spark):
    from tracewise.llm.queries import op5_best_fit_packing
    rows = op5_best_fit_packing(spark, "/root/testdata/sf0.001").select("sequence", "capacity").distinct()
    n = {r["capacity"]: r["n"] for r in rows.groupBy("capacity").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert len(n) >= 3 and sorted(n.values())[-2] >= 0.1 * sum(n.values())


def test_packed_sequences_are_rebuilt_from_their_rows(make_docs, odd_docs):
    docs = [(i, prose(40 + 13 * i, i)) for i in range(30)] + [(1, "é" * 50), (1, "ab" * 25), (1, "é" * 50), (None, "q" * 50),
                                                             (None, "r" * 50), (3, None), (4, "")]
    for rows, caps in ((make_docs(docs), (64, 200)), (odd_docs, packing.CAPACITIES)):
        placed = packing.pack(rows, caps)
        out = packing.with_texts(placed, rows, caps[-1]).collect()
        assert len(out) == placed.count()
        whole = defaultdict(dict)
        for r in out:
            assert len(r["piece_text"]) == r["size"]
            whole[r["doc_id"], r["length"], r["copy"]][r["start"]] = r["piece_text"]
        got = Counter((k[0], "".join(t for _, t in sorted(v.items()))) for k, v in whole.items())
        assert got == Counter((r["doc_id"], r["text"]) for r in rows.collect() if r["text"])


# -- URL filter -----------------------------------------------------------------------
RULES = [url_filter.parse_rule(r) for r in
         ("allow com/", "block example.com/en/", "allow www.example.com/en/", "block net/es/", "block net/fr/")]


def brute_rule(url):
    if not url or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    host = host.translate(FOLD)
    fits = [(len(h + p), v == "allow", h + p, v) for v, h, p in RULES
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, 0, None, None))
    return host, path, best[2], best[3]


URLS = ["http://example.com/en/1", "https://WWW.Example.COM/en/x?q#f", "http://a.www.example.com/en/", "http://x.net/es/1",
        "http://net/fr/", "http://notnet/fr/", "http://example.com", "http://example.com/de/", "ftp://q.org?a/b", None, "",
        "example.com/en/", "://com/", "http://x.net/es", "http://xnet/es/1", "http://b.example.com#/en/", "http://ÄB.com/é"]


def test_rules_equal_brute_force(spark):
    rows = [(k, u, None) for k, u in enumerate(URLS)] * 2
    out = url_filter.judge(spark.createDataFrame(rows, "page_id long, url string, html string")
                           .withColumn("host", F.lit("mine")).withColumn("node", F.lit(1)), RULES).collect()
    assert len(out) == len(rows)
    for r in out:
        host, path, rule, verdict = brute_rule(r["url"])
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == (host, path, rule, verdict or "allow")


def test_aliases(spark):
    def link(h):
        return f'<html><head><LINK href="{h}" rel=canonical ></head>'

    def go(h):
        return f"<meta http-equiv='Refresh' content='0; URL={h}'>"

    pages = [(1, "http://x.net/es/a", None), (2, "http://y.org/b", link("http://x.net/es/a")),
             (3, "http://z.org/c", go("http://y.org/b")), (4, "http://w.org/d", "<p>canonical</p>"),
             (5, "https://Y.org/b#frag", None), (6, "http://v.com/e", link("http://z.org/c")),
             (7, "http://p.org/1", go("/2")), (8, "http://p.org/2", link("//net/fr/q")), (9, "http://p.org/sub/3", go("../x")),
             (10, "http://p.org/sub/4", link("5")), (11, "http://p.org/sub/5", link("http://net/es/?a&amp;b")),
             (12, "http://lone.org/", link("mailto:x")), (13, None, link("http://x.net/es/a"))]
    rows = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in url_filter.judge(rows, RULES).collect()}
    # 6 is allowed by its own rule and joins the class of 1, 2, 3: the explicit allow takes precedence there
    assert got[1] == ("net/es/", "block") and got[6] == ("com/", "allow")
    assert got[2] == got[3] == got[5] == (None, "allow")
    without = {r["page_id"]: r["verdict"] for r in url_filter.judge(rows.where("page_id <> 6"), RULES).collect()}
    assert [without[k] for k in (2, 3, 5)] == ["block"] * 3
    assert got[4][1] == got[12][1] == got[13][1] == "allow"
    assert got[7][1] == got[8][1] == "block" and got[10][1] == got[11][1] == "block"
    long = "x" * 5000
    odd = [(1, "http://x.net/es/a", None), (2, "http://a.org/1", f'<link data-a="{long}" rel="alternate Canonical" title="{long}" '
                                                                 f'href="http://x.net/es/a">'),
           (3, "http://a.org/d/e/2", link("../.././1")), (4, "http://b.org/q/", '<base href="http://a.org/d/">' + link("../1")),
           (5, "http://a.org/5", '<link rel="canonicals" href="http://x.net/es/a"><link data-href="http://x.net/es/a" rel="canonical">'),
           (6, "http://a.org/6", "<meta content=\"0;url='http://a.org/1'\" http-equiv=refresh>")]
    odd = spark.createDataFrame(odd, "page_id long, url string, html string")
    got = {r["page_id"]: r["verdict"] for r in url_filter.judge(odd, RULES).collect()}
    assert got == {1: "block", 2: "block", 3: "block", 4: "block", 5: "allow", 6: "block"}
    assert url_filter.judge(rows.limit(0), RULES).count() == 0
    with pytest.raises(ValueError):
        url_filter.judge(rows, RULES * 300)


def test_random_aliases_equal_brute_force(spark):
    rng = np.random.default_rng(6)
    hosts = ["a.org", "b.org", "x.net", "c.com", "example.com", "www.example.com"]
    urls = [f"http://{hosts[rng.integers(len(hosts))]}/{rng.choice(['en', 'es', 'de'])}/{i}" for i in range(300)]
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (110, 2))]
    html = defaultdict(str)
    for a, b in edges:
        html[a] += f'<link rel="canonical" href="{urls[b]}">' if (a + b) % 2 else f'<meta http-equiv="refresh" content="1; url={urls[b]}">'
    comp = brute_components(edges)
    classes = defaultdict(set)
    for i, u in enumerate(urls):
        if brute_rule(u)[3]:
            classes[comp.get(i, i)].add(brute_rule(u)[3])
    rows = spark.createDataFrame([(i, u, html[i] or None) for i, u in enumerate(urls)], "page_id long, url string, html string")
    got = {r["page_id"]: r["verdict"] for r in url_filter.judge(rows, RULES).collect()}
    want = {i: brute_rule(u)[3] or ("block" if classes[comp.get(i, i)] == {"block"} else "allow") for i, u in enumerate(urls)}
    assert got == want and sum(brute_rule(u)[3] is None and want[i] == "block" for i, u in enumerate(urls)) >= 5


# -- PII -------------------------------------------------------------------------------
def luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def brute_spans(t):
    out = []
    for kind, p in BASE.items():
        for m in re.finditer(p, t):
            d = re.sub("[^0-9]", "", m.group())
            ok = {"email": True, "ip": all(int(x) <= 255 for x in m.group().split(".") if x) if kind == "ip" else True,
                  "card": 12 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]
            if ok:
                out.append((m.start(), list(BASE).index(kind), m.end()))
    return sorted(out)


PII = ["", "a@b.c%d@e.f x", "é🙂 mail: jo.do+x@mail.example.com.", "1.2.3.4.5.6.7.8 0.0.0.0256 255.255.255.0255", "12.3.4",
       "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (555) 010-9999 +49 30 123456", "++1 2", "@a.b x@y", "a@@b.c",
       "1" * 3000, "1 " * 2000, "a" * 5000, ".".join("9" * 600), "x@" + "a." * 500, "+1" + " " * 50, "a@b.c" * 700,
       " 10.0.0.1" * 600, "+1-2-3-4-5-6-7-8-9-0-1-2-3-4-5-6", "card 4111111111111111, ip 10.1.2.3; tel +33 1 23 45 67 89"]


def test_base_spans_equal_brute_force(spark, make_docs, odd_docs):
    rows = [(i, t) for i, t in enumerate(PII)] + [(100, None), (None, PII[2]), (2, PII[2])]
    for docs in (make_docs(rows).withColumn("spans", F.lit("x")), odd_docs):
        for r in pii.with_spans(docs, pii.Selector()).collect():
            want = brute_spans(r["text"] or "")
            assert [tuple(s) for s in r["base_spans"]] == want == [tuple(s) for s in r["spans"]]
    assert pii.with_spans(spark.createDataFrame([], DOCS), pii.Selector()).count() == 0


def test_boosted_candidates_add_lookalikes(make_docs):
    rows = []
    for i in range(400):
        n = f"{200 + i % 700} {100 + i * 7 % 900}-{1000 + i * 13 % 9000}"
        body = {0: f"please call +1 {n} soon", 1: f"mail to user{i}@mail{i % 7}.example.com today",
                2: f"meet at noon at place {i} in room {1000 + i * 37} of {10000 + i * 91}", 3: f"values {i} at {i * 31} 12345 67"}[i % 4]
        rows.append((i, f"some words before {body} and words after"))
    rows += [(1000, "please call 212 555-1234 soon"), (1001, "write me: jane.doe [at] mail3 [dot] example [dot] com today"),
             (1002, "look at this in room 4711 of 10000"), (1003, "nothing here")]
    docs = make_docs(rows)
    selector = pii.fit_selector(docs)
    assert {"email", "phone"} <= set(selector.models)
    got = {r["doc_id"]: [(s["kind"], r["text"][s["start"]:s["end"]]) for s in r["spans"]]
           for r in pii.with_spans(docs, selector).where("doc_id >= 1000").collect()}
    assert (3, "212 555-1234") in got[1000]
    assert got[1001] and got[1001][0][0] == 0 and "jane.doe" in got[1001][0][1]
    assert got[1002] == [] and got[1003] == []
    clean = {r["doc_id"]: r["text"] for r in pii.redact(docs, selector).collect()}
    assert "[PHONE]" in clean[1000] and "555" not in clean[1000] and clean[1003] == "nothing here"


def test_candidates_reach_the_end_of_their_run(make_docs):
    texts = ["x" * 90 + " [at] " + "mail dot " * 7 + "org", "1 " * 40 + "2", "a@" + "b." * 5000 + "c", "7" + " " * 5000, "9 " * 5000 + "9",
             "no", "u at v"]
    rows = pii.with_candidates(make_docs(enumerate(texts)), "text").orderBy("doc_id").collect()
    got = [{k: [(c["start"], c["end"]) for c in r[f"__tw_cand_{k}"]] for k in pii.KINDS} for r in rows]
    assert got[0]["email"] == [(0, len(texts[0]))] and got[2]["email"] == [(0, len(texts[2]))] and got[6]["email"] == [(0, 6)]
    assert got[1]["phone"] == got[1]["card"] == [(0, 81)] and got[4]["card"] == [(0, 10_001)]
    assert got[3]["phone"] == [] and not any(got[5].values())


def test_rare_kinds_are_learnt_from_all_documents(spark, make_docs):
    order = [r["id"] for r in spark.range(3400).orderBy(F.xxhash64("id"), "id").collect()]
    rows = [(i, "no candidate here") for i in order[:3000]]
    for at, i in enumerate(order[3000:]):  # the last in hash order alone hold candidates
        n = f"{200 + at % 700} {100 + at * 7 % 900}-{1000 + at * 13 % 9000}"
        body = f"please call +1 {n} soon" if at % 2 else f"meet at place {at} in room {1000 + at * 37} of {10000 + at * 91}"
        rows.append((i, f"some words before {body} and words after"))
    selector = pii.fit_selector(make_docs(rows))
    assert "phone" in selector.models
    got = pii.redact(make_docs([(1, "please call 212 555-1234 soon")]), selector).first()["text"]
    assert got == "please call [PHONE] soon"


def test_trees_as_sql_equal_numpy(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, len(pii.FEATURES)))
    y = (x[:, 0] + x[:, 3] > 0).astype(int)
    s = pii.Selector()
    s.models["email"] = Boosted(len(pii.FEATURES), trees=pii.TREES, depth=3).fit(x, y.astype(float))
    s.thresholds["email"] = float(np.median(s.models["email"].margin(x)))
    df = spark.createDataFrame([(i, x[i].tolist()) for i in range(400)], "i long, x array<double>")
    got = {r["i"]: r["a"] for r in df.select("i", s.accepts("email", F.col("x")).alias("a")).collect()}
    want = s.models["email"].margin(x) >= s.thresholds["email"] - 1e-9
    assert [got[i] for i in range(400)] == want.tolist()


def test_redaction_merges_overlaps_and_is_native(make_docs):
    docs = make_docs([(1, "🙂 a@b.cc +1 (555) 010-9999 x"), (2, None), (3, "é"), (4, "+4111 1111 1111 1111")])
    out = pii.redact(docs, pii.Selector())
    got = {r["doc_id"]: r["text"] for r in out.collect()}
    assert got[1] == "🙂 [EMAIL] [PHONE] x" and got[2] is None and got[3] == "é" and "1111" not in got[4]
    assert not re.search("Python|Arrow", out._jdf.queryExecution().toString())


# -- byte network -------------------------------------------------------------------------
def test_network_learns_and_reads_whole_texts(spark, make_docs, odd_docs):
    good = [(i, prose(30 + i % 60, i)) for i in range(300)]
    bad = [(1000 + i, " ".join(f"{w}&&&" for w in words(30 + i % 60, i))) for i in range(300)]
    docs = make_docs(good + bad)
    labels = spark.createDataFrame([(i, int(i < 1000), 0) for i, _ in good + bad] + [(None, 1, 1), (3, None, 0), (4, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    sample = byte_cnn.labelled_sample(docs, labels, 10_000).collect()
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 3 != 1 for r in sample)
    model = byte_cnn.fit_quality(docs, labels)
    rows = byte_cnn.with_score(docs.withColumn("score", F.lit("x")), model).collect()
    held = [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1]
    assert np.mean([(r["score"] >= 0.5) == (r["doc_id"] < 1000) for r in held]) > 0.97
    # junk far behind a long clean beginning is seen
    long = prose(20_000, 5)
    assert model.logit((long + " " + bad[0][1]).encode()) < model.logit(long.encode())
    out = byte_cnn.with_score(odd_docs, model).collect()
    assert len(out) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in out)
    assert byte_cnn.with_score(spark.createDataFrame([], DOCS), model).count() == 0
    assert byte_cnn.fit_quality(docs, labels.limit(0)).score("x") == 0.5
    assert byte_cnn.fit_quality(docs, labels.where("quality = 1")).score("x") == 1.0


def test_network_segments_equal_direct_convolution():
    net = byte_cnn.ByteCnn(seed=1, filters=3, segment=16)
    data = prose(100, 3).encode()
    seg, _ = net.segment_maxima(data)
    buf = np.frombuffer(data + bytes(net.width), np.uint8)
    conv = sum(net.p["table"][k][buf[k:k + len(data)]] for k in range(net.width))
    want = [conv[i:i + 16].max(axis=0) for i in range(0, len(data), 16)]
    assert np.allclose(seg, want, atol=1e-5)


def test_network_gradient_is_the_slope():
    net = byte_cnn.ByteCnn(seed=4, filters=4, segment=16, hidden=5)
    data = prose(40, 9).encode()

    def loss(label=1.0):
        return np.log1p(np.exp(-net.logit(data)))

    grad = {k: np.zeros_like(v, np.float64) for k, v in net.p.items()}
    net._gradient(data, 1.0, 1.0, grad)
    for name in ("w2", "b1", "w1"):
        flat = net.p[name].reshape(-1)
        for at in range(0, flat.size, max(1, flat.size // 4)):
            old, eps = flat[at], 1e-2
            flat[at] = old + eps
            high = loss()
            flat[at] = old - eps
            low = loss()
            flat[at] = old
            assert abs((high - low) / (2 * eps) - grad[name].reshape(-1)[at]) < 2e-2
