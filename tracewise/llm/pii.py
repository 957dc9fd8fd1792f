"""Personal data by candidate boosting (operator 9), DataFrame functions only.

Base spans: exact patterns with checks (see BASE).  Beside them, high-recall
generators propose overlapping candidates: anything that reads like an address
with ``@`` or a written-out "at", numbers in groups, and groups of hex digits.
Each candidate is described by format and context features of its normalised
form; boosted trees score it, and a calibrated threshold per kind selects the
ones that are added to the base spans.

The trees learn from weak labels: a candidate is positive if a base span of its
kind overlaps it.  They see at most ``max_candidates`` of each kind and label,
the first in hash order among the candidates of all documents.  Whatever defines the base pattern alone (the ``+``, the
``@`` itself) is no feature, so look-alikes score as high.  The threshold of a
kind is the lowest (in steps of 1/STEPS) that keeps all held-out candidates, a
quarter of all, at PRECISION; a kind without positives or negatives in either
part adds nothing.  Fitting sees numbers
only, on the driver; the trees then become one SQL expression, so every
document is scored by DataFrame functions, without a shuffle.

A candidate reaches the end of its run, however long; the trees see its length.
Offsets are code points, ends exclusive.  Patterns use possessive quantifiers
and start at run borders (or where the previous match ended), which gives the
same matches without quadratic search or deep recursion.

Defined results: null and empty texts have no spans; repeated rows get equal
spans; an empty table gives an empty table."""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewise.llm.boosting import Boosted
from tracewise.llm.common import materialise

KINDS = ("email", "ip", "card", "phone")
MAX_CANDIDATES = 20_000
PRECISION = 0.95
TREES = 20
STEPS = 1000

BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: a text without this cannot hold the kind
_NEEDS = {"email": r"@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}

GENERATORS = {
    "address": r"(?:\G|(?<![\p{L}\p{N}._%+-]))[\p{L}\p{N}._%+-]++(?:@|\x20?[\[({]at[\])}]\x20?|\x20at\x20)"
               r"[\p{L}\p{N}-]++(?:(?:\.|\x20?[\[({]dot[\])}]\x20?|\x20dot\x20)[\p{L}\p{N}-]++)*+",
    "number": r"(?<![\p{L}\p{N}])[+(]{0,2}[0-9][0-9\x20()./-]{3,}[0-9]",
    "hex": r"(?i)(?<![\p{L}\p{N}:.])[0-9a-f]{1,4}(?:[:.][0-9a-f]{0,4}){2,7}(?![\p{L}\p{N}])",
}
_GENERATOR_NEEDS = {"address": r"@|[\[({ ]at[\])} ]", "number": r"[0-9][0-9\x20()./-]{3}",
                    "hex": r"(?i)[0-9a-f][:.][0-9a-f]"}
#: which kinds a generator proposes
PROPOSES = {"address": ("email",), "number": ("card", "phone"), "hex": ("ip",)}

_BLOCK = 256
_SPAN = "array<struct<start:int,end:int,s:string,before:string,after:string>>"


def find_all(df: DataFrame, text: str, pattern: str, needs: str, out: str) -> DataFrame:
    """Append ``out``: every non-overlapping match from the left, with its
    offsets and 24 characters of context on both sides.  Prefix sums run over
    blocks of matches, so their cost stays near linear in the matches."""
    m, p, lens, blocks = (f"__tw_{out}_{x}" for x in "mplb")
    has = F.col(text).rlike(needs)
    df = df.withColumn(m, F.when(has, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))))
    df = df.withColumn(p, F.when(F.size(m) > 0, F.split(text, pattern, -1)))
    df = df.withColumn(lens, F.zip_with(F.slice(p, F.lit(1), F.size(m)), F.col(m), lambda a, b: F.struct(
        F.char_length(a).alias("a"), F.char_length(b).alias("b"))))
    df = df.withColumn(blocks, F.transform(
        F.sequence(F.lit(0), ((F.size(lens) - 1) / _BLOCK).cast("int")),
        lambda k: F.slice(F.col(lens), k * _BLOCK + 1, F.lit(_BLOCK))))
    totals = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), lambda acc, x: acc + x["a"] + x["b"]))
    begins = F.aggregate(totals, F.array(F.lit(0)),
                         lambda acc, t: F.concat(acc, F.array(F.element_at(acc, -1) + t)))
    none = F.array().cast("array<int>")
    starts = F.flatten(F.zip_with(blocks, F.slice(begins, F.lit(1), F.size(blocks)), lambda b, o: F.aggregate(
        b, F.struct(o.alias("at"), none.alias("out")),
        lambda acc, x: F.struct((acc["at"] + x["a"] + x["b"]).alias("at"),
                                F.concat(acc["out"], F.array(acc["at"] + x["a"])).alias("out")),
        lambda acc: acc["out"])))
    at = f"__tw_{out}_s"
    df = df.withColumn(at, F.when(F.size(m) > 0, starts))
    spans = F.transform(at, lambda s, i: F.struct(
        s.alias("start"), (s + F.get(F.col(lens), i)["b"]).alias("end"), F.get(F.col(m), i).alias("s"),
        F.substring(F.get(F.col(p), i), -24, 24).alias("before"),
        F.substring(F.get(F.col(p), i + 1), 1, 24).alias("after")))
    df = df.withColumn(out, F.coalesce(F.when(F.size(m) > 0, spans), F.array().cast(_SPAN)))
    return df.drop(m, p, lens, blocks, at)


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    n = F.char_length(digits)

    def add(acc, i):
        d = F.substring(digits, n - i, F.lit(1)).cast("int")
        twice = d * 2
        return acc + F.when(i % 2 == 0, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add) % 10 == 0


def _part_ok(part: Column) -> Column:
    bare = F.regexp_replace(part, "^0+(?=[0-9])", "")
    return (F.char_length(bare) <= 3) & (F.when(F.char_length(bare) <= 3, bare).otherwise("999").cast("int") <= 255)


def _valid(kind: str, s: Column) -> Column:
    n = F.char_length(_digits(s))
    return {"email": F.lit(True), "phone": n.between(9, 15),
            "ip": F.forall(F.split(s, r"\."), _part_ok),
            "card": F.when(n.between(12, 19), _luhn(_digits(s))).otherwise(F.lit(False))}[kind]


def with_base(df: DataFrame, text: str) -> DataFrame:
    """Append ``__tw_base_<kind>``: the valid base spans of each kind."""
    for kind in KINDS:
        out = f"__tw_base_{kind}"
        df = find_all(df, text, BASE[kind], _NEEDS[kind], out)
        df = df.withColumn(out, F.filter(out, _valid_of(kind)))
    return df


def _valid_of(kind: str):
    return lambda x: _valid(kind, x["s"])


def _overlaps(span: Column, others: str) -> Column:
    return F.exists(others, lambda o: (o["start"] < span["end"]) & (span["start"] < o["end"]))


def _context(before: Column, words: str) -> Column:
    return before.rlike(rf"(?i)(?:^|[^\p{{L}}])(?:{words})").cast("double")


FEATURES = ["length", "digits", "letters", "groups", "first_group", "last_group", "spaces", "dashes", "dots",
            "brackets", "slashes", "luhn", "word_before", "word_after", "glued_before", "glued_after", "says_call",
            "says_card", "says_mail", "says_host"]


def features(kind: str, c: Column) -> list[Column]:
    """Format features of the normalised candidate, and its context's."""
    s = c["s"]
    if kind == "email":
        s = F.regexp_replace(s, r"@|\x20?[\[({]at[\])}]\x20?|\x20at\x20", "@")
        s = F.regexp_replace(s, r"\x20?[\[({]dot[\])}]\x20?|\x20dot\x20", ".")
        groups = F.split(s, r"[@.]")
    else:
        if kind == "phone":  # the international prefix is what defines a base phone number
            s = F.regexp_replace(s, r"^\(?\+[0-9]{1,3}[\x20.-]?", "")
        s = F.regexp_replace(s, r"^[+(]+", "")
        groups = F.filter(F.split(s, r"[^0-9A-Za-z]+"), lambda g: g != "")
    digits = _digits(s)

    def count(chars: str) -> Column:
        return (F.char_length(s) - F.char_length(F.regexp_replace(s, chars, ""))).cast("double")

    n = F.char_length(digits)
    luhn = F.when(n.between(12, 19), _luhn(digits).cast("double")).otherwise(F.lit(0.0)) if kind == "card" else F.lit(0.0)
    return [F.char_length(s).cast("double"), n.cast("double"), count(r"\p{L}"), F.size(groups).cast("double"),
            F.char_length(F.element_at(groups, 1)).cast("double"), F.char_length(F.element_at(groups, -1)).cast("double"),
            count(r"\x20"), count("-"), count(r"\."), count(r"[()]"), count("/"), luhn,
            c["before"].rlike(r"\p{L}\x20$").cast("double"), c["after"].rlike(r"^\x20\p{L}").cast("double"),
            c["before"].rlike(r"[^\s(\[]$").cast("double"), c["after"].rlike(r"^[^\s.,;:!?)\]]").cast("double"),
            _context(c["before"], "tel|phone|call|fax|mobil|cell|number|numéro|nummer|teléfono"),
            _context(c["before"], "card|visa|credit|master|account|karte|carte|tarjeta"),
            _context(c["before"], "mail|contact|write|kontakt|correo|courriel"),
            _context(c["before"], "ip|host|addr|server|node")]


def with_candidates(df: DataFrame, text: str) -> DataFrame:
    """Append ``__tw_cand_<kind>``: candidates with a feature array ``x``."""
    for g, pattern in GENERATORS.items():
        raw = f"__tw_gen_{g}"
        df = find_all(df, text, pattern, _GENERATOR_NEEDS[g], raw)
        for kind in PROPOSES[g]:
            df = df.withColumn(f"__tw_cand_{kind}", F.transform(raw, _described(kind)))
        df = df.drop(raw)
    return df


def _described(kind: str):
    return lambda c: F.struct(c["start"].alias("start"), c["end"].alias("end"),
                              F.array(*features(kind, c)).alias("x"))


class Selector:
    """Boosted trees and calibrated threshold of each kind."""

    def __init__(self):
        self.models: dict[str, Boosted] = {}
        self.thresholds: dict[str, float] = {}

    def accepts(self, kind: str, x: Column) -> Column:
        """SQL expression: does the trees' margin reach the threshold?"""
        if kind not in self.models:
            return F.lit(False)
        return self.margin(kind, x) >= F.lit(self.thresholds[kind] - 1e-9)

    def margin(self, kind: str, x: Column) -> Column:
        """SQL expression: the trees' margin."""
        model = self.models[kind]

        def node(at: int) -> Column:
            if model.left[at] < 0:
                return F.lit(float(model.value[at]))
            return F.when(F.get(x, F.lit(int(model.feature[at]))) <= F.lit(float(model.threshold[at])),
                          node(model.left[at])).otherwise(node(model.right[at]))

        return reduce(lambda a, b: a + b, [node(int(r)) for r in model.roots], F.lit(float(model.base)))


def fit_selector(docs: DataFrame, max_candidates: int = MAX_CANDIDATES) -> Selector:
    """Fit on the candidates of all documents: at most ``max_candidates`` of
    each kind and label (hash order) come to the driver; thresholds come from
    counts over all of the held-out quarter."""
    rows = docs.where("doc_id IS NOT NULL").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = with_candidates(with_base(rows, "text"), "text")
    labelled = [F.transform(f"__tw_cand_{k}", _labelled(i, k)) for i, k in enumerate(KINDS)]
    flat = rows.select("doc_id", F.explode(F.concat(*labelled)).alias("c")).select("doc_id", "c.*")
    flat = materialise(flat.withColumn("h", F.xxhash64("doc_id", "start", "kind"))
                       .withColumn("held", F.pmod("h", F.lit(4)) == 0))
    counts = {(r["kind"], r["y"], r["held"]): r["n"] for r in
              flat.groupBy("kind", "y", "held").agg(F.count(F.lit(1)).alias("n")).collect()}
    selector = Selector()
    for i, kind in enumerate(KINDS):
        if any((i, y, held) not in counts for y in (0, 1) for held in (False, True)):
            continue
        found = []
        for y in (0, 1):
            # only about as many rows as wanted are sorted
            share = min(1.0, 1.2 * max_candidates / counts[i, y, False])
            bound = min((1 << 63) - 1, -(1 << 63) + int(share * (1 << 64)))
            found += flat.where((F.col("kind") == i) & (F.col("y") == y) & ~F.col("held") & (F.col("h") <= bound)) \
                .orderBy("h", "doc_id", "start").limit(max_candidates).select("x", "y").collect()
        if len({r["y"] for r in found}) < 2:
            continue
        selector.models[kind] = Boosted(len(FEATURES), trees=TREES, depth=3).fit(
            np.array([r["x"] for r in found]), np.array([r["y"] for r in found], float))
        steps = flat.where((F.col("kind") == i) & F.col("held")) \
            .groupBy(F.floor(selector.margin(kind, F.col("x")) * STEPS).alias("step")) \
            .agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("good")).orderBy(F.desc("step")).collect()
        good = np.cumsum([r["good"] for r in steps]) / np.cumsum([r["n"] for r in steps])
        fine = np.flatnonzero(good >= PRECISION)
        if len(fine):
            selector.thresholds[kind] = steps[fine[-1]]["step"] / STEPS
        else:
            del selector.models[kind]
    return selector


def _labelled(i: int, kind: str):
    return lambda c: F.struct(F.lit(i).alias("kind"), c["start"].alias("start"), c["x"].alias("x"),
                              _overlaps(c, f"__tw_base_{kind}").cast("int").alias("y"))


def with_spans(docs: DataFrame, selector: Selector, text_col: str = "text", base_col: str = "base_spans",
               spans_col: str = "spans") -> DataFrame:
    """Append ``base_col`` and ``spans_col`` (array<struct<start, kind, end>>,
    kind as its index in KINDS, sorted): the base spans, and those plus the
    accepted candidates that overlap no base span of their kind."""
    text = "__tw_text"
    rows = with_base(docs.withColumn(text, F.coalesce(text_col, F.lit(""))), text)
    rows = with_candidates(rows, text)
    base, added = [], []
    for i, kind in enumerate(KINDS):
        base.append(F.transform(f"__tw_base_{kind}", _span(i)))
        added.append(F.transform(F.filter(f"__tw_cand_{kind}", _accepted(selector, kind)), _span(i)))
    rows = rows.withColumn(base_col, F.array_sort(F.concat(*base)))
    rows = rows.withColumn(spans_col, F.array_sort(F.array_distinct(F.concat(base_col, *added))))
    return rows.drop(text, *(f"__tw_{x}_{k}" for x in ("base", "cand") for k in KINDS))


def _span(i: int):
    return lambda c: F.struct(c["start"].alias("start"), F.lit(i).alias("kind"), c["end"].alias("end"))


def _accepted(selector: Selector, kind: str):
    return lambda c: selector.accepts(kind, c["x"]) & ~_overlaps(c, f"__tw_base_{kind}")


def span_text(spans: str) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat(
        F.get(names, s["kind"]), F.lit(":"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, selector: Selector, text_col: str = "text") -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets, such as
    ``[EMAIL]``; overlapping spans become one, named after the first."""
    rows = with_spans(docs, selector, text_col, "__tw_base", "__tw_spans")
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    text = F.col(text_col)
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc, s):
        covered = s["start"] < acc["at"]
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(covered, acc["out"]).otherwise(F.concat(
                acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]),
                F.get(names, s["kind"]))).alias("out"))

    made = F.aggregate("__tw_spans", start, step, lambda acc: F.concat(
        acc["out"], F.substring(text, acc["at"] + 1, F.char_length(text))))
    return rows.withColumn(text_col, F.when(F.size("__tw_spans") > 0, made).otherwise(text)) \
        .drop("__tw_base", "__tw_spans")
