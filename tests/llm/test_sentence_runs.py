"""Sentence runs of many texts at once, and how often they are made."""

import contextlib
import io

import numpy as np
import pyarrow as pa
from corpus_samples import prose

from tracewise.llm import sentence_dedup
from tracewise.llm.wordhash import joined

TEXTS = ["", "One two. Three four five! Six", ' \n"A b." (c)\nd e f g. h', "字字。字字字！」字 x.", "a", "...", prose(60, 1),
         "no end here", "\n\n", "x y. " * 9, ""]


def brute_runs(sizes, m, words, long):
    found, n = [], len(sizes)
    for a in range(n):
        ends = [b for b in range(a + m, n + 1) if sum(sizes[a:b]) >= words]
        found += [(a, ends[0])] if ends else []
        found += [(a, a + 1)] if sizes[a] >= long else []
    tails = [a for a in range(n - m + 1) if sum(sizes[a:]) >= words]
    return sorted(found + [(a, n) for a in tails[-1:]])


def test_runs_of_joined_texts_are_those_of_each():
    buf, at = joined(TEXTS)
    starts, ends = sentence_dedup.text_words(buf)
    cuts = sentence_dedup.sentences(buf, starts, ends)
    units = sentence_dedup.word_units(buf, starts, ends)
    bounds = np.searchsorted(cuts, np.searchsorted(starts, at))
    for m, words, long in ((2, 25, 25), (1, 3, 5), (3, 8, 4), (2, 2, 100)):
        text, i, j = sentence_dedup.sentence_runs(units[cuts], bounds, m, words, long)
        for k, t in enumerate(TEXTS):
            one, _ = joined([t])
            s, e = sentence_dedup.text_words(one)
            alone = sentence_dedup.sentences(one, s, e)
            sizes = np.diff(sentence_dedup.word_units(one, s, e)[alone]).tolist()
            assert np.diff(units[cuts])[bounds[k]:bounds[k + 1]].tolist() == sizes
            mine = text == k
            assert sorted(zip((i[mine] - bounds[k]).tolist(), (j[mine] - bounds[k]).tolist(), strict=True)) \
                == brute_runs(sizes, m, words, long)


def test_covered_ranges_of_neighbouring_texts_stay_apart():
    got = sentence_dedup.merged(*(np.array(c) for c in ([0, 1, 0, 1, 1], [0, 3, 1, 5, 9], [2, 5, 3, 7, 10])))
    assert [c.tolist() for c in got] == [[0, 1, 1], [0, 3, 9], [3, 7, 10]]
    assert [len(c) for c in sentence_dedup.merged(*[np.zeros(0, np.int64)] * 3)] == [0, 0, 0]


def test_texts_are_cut_once_a_chunk(monkeypatch):
    calls = []
    cut = sentence_dedup.sentences
    monkeypatch.setattr(sentence_dedup, "sentences", lambda *a: calls.append(1) or cut(*a))
    made = []

    class Rows:
        sparkSession = None

        def where(self, condition):
            return self

        def mapInArrow(self, fn, schema):
            made.append(fn)

    sentence_dedup.runs(Rows(), 2, 25, 25)
    batch = pa.record_batch({"doc_id": pa.array(range(50), pa.int64()), "text": pa.array([prose(60, k) for k in range(50)])})
    assert sum(b.num_rows for b in made[0](iter([batch]))) > 50 and len(calls) == 1


def test_lookup_and_join_share_one_pass_over_the_texts(make_docs):
    passage = prose(70, 2)
    rows = [(k, prose(30, 10 + k) + "\n" + passage) for k in range(6)] + [(9, prose(60, 3)), (8, prose(60, 3))]
    again = sentence_dedup.repeated_runs(make_docs(rows))
    with contextlib.redirect_stdout(io.StringIO()) as plan:
        again.explain()
    assert plan.getvalue().count("MapInArrow") == 1
    got = {r["doc_id"] for r in again.collect()}
    assert got == {1, 2, 3, 4, 5, 9}
