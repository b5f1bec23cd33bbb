"""Personal data by weak supervision: patterns, word lists and context vote on spans, and a classifier decides.

Everything is DataFrame functions; texts are read once, in one pass without a shuffle.

1. Candidates of each kind come from a broad pattern, with their places in the text. Matches of the base patterns that
   pass their check (`BASE`) are personal data in any case. Others are open: base matches that fail their
   check, telephone numbers without a country code, and secrets such as keys and passwords.
2. Labelers vote on every candidate: its exact form, its check digits, lists of known endings and prefixes, cue words
   before it, and what it touches. Expectation-maximisation over the counted vote patterns estimates how reliable
   each labeler is (`labelmodel`).
3. The posteriors train a naive Bayes classifier on features of the span itself (kind, length, share of digits, the
   characters around it), whose counts are one aggregate. Where classifier and labelers together give a chance of
   at least one half, an open candidate is added, unless it overlaps a base span.

Matching is leftmost and non-overlapping per kind. Places count code points. Patterns use possessive repeats and start
only where a match can start, which gives the same matches in time that grows with the text.

A null text is empty and has no spans. Repeated rows and null ids give a row each; other columns are not looked at; an
empty table gives an empty table.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.common import keyed, let, stage
from tradeloom.llm.labelmodel import LabelModel

KINDS = ("email", "ip", "card", "phone", "secret")
EMAIL, IP, CARD, PHONE, SECRET = range(5)

_LOCAL = "[A-Za-z0-9._%+-]"
_CUES = "password|passwd|pwd|token|secret|api[_-]?key|access[_-]?key"
# Java's \G is where the last match ended: there, a match may start inside a run of local characters.
PATTERNS = {
    EMAIL: rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)++",
    IP: r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    CARD: r"[0-9](?:[\x20-]?[0-9])++",
    PHONE: r"\+[0-9][\x20().0-9-]+[0-9]",
    SECRET: rf"AKIA[0-9A-Z]{{16}}|(?i:{_CUES})\x20?[=:]\x20?\"?[^\s\"',;]{{6,}}+\"?",
}
LOCAL_PHONE = r"(?<![0-9+(])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])"
#: A text without this has no match; looking for it is cheaper than matching.
NEEDS = {EMAIL: "@", IP: "[0-9]\\.[0-9]", CARD: "[0-9]", PHONE: "\\+[0-9]", SECRET: f"AKIA|(?i:{_CUES})\\x20?[=:]"}

# Endings of domains, first digits of card issuers, country codes.
DOMAINS = ("com", "org", "net", "edu", "gov", "info", "io", "de", "fr", "es", "uk", "eu", "us")
ISSUERS = ("4", "51", "52", "53", "54", "55", "34", "37", "6011", "65", "35", "36", "30", "38")
COUNTRIES = ("1", "44", "33", "49", "34", "39", "31", "41", "43", "46", "47", "48", "55", "61", "81", "86", "91")
CUE_WORDS = {
    EMAIL: "mail|contact|write|address|kontakt|correo",
    IP: "ip|host|server|address|ping|client|from",
    CARD: "card|visa|credit|payment|amex|karte|carte|tarjeta",
    PHONE: "tel|phone|call|fax|mobile|contact",
    SECRET: "password|passwd|pwd|token|secret|key",
}
AGAINST = "version|release|v|section|isbn|issn|page|line|no"
CONTEXT = 24
LABELERS = {"form": 0.8, "check": 0.8, "lists": 0.8, "cues": 0.7, "edges": 0.7}
FEATURES = ("kind", "length", "digits", "before", "after")
PIECES_AT_ONCE = 512


def _running(values: Column, op, zero: Column) -> Column:
    """``op`` over all values before each, from ``zero`` on. In pieces, as an aggregate that carries its list along
    copies it at each step."""

    def within(piece: Column, start: Column) -> Column:
        first = F.struct(start.alias("n"), F.array().cast("array<int>").alias("out"))
        step = F.aggregate(
            piece, first, lambda a, x: F.struct(op(a["n"], x).alias("n"), F.concat(a["out"], F.array(a["n"])).alias("out"))
        )
        return step["out"]

    def of_pieces(pieces: Column) -> Column:
        totals = F.transform(pieces, lambda p: F.aggregate(p, zero, op))
        return let(
            within(totals, zero), lambda starts: F.flatten(F.transform(pieces, lambda p, i: within(p, F.get(starts, i))))
        )

    cut = F.transform(
        F.sequence(F.lit(0), ((F.size(values) - 1) / PIECES_AT_ONCE).cast("int")),
        lambda i: F.slice(values, i * PIECES_AT_ONCE + 1, PIECES_AT_ONCE),
    )
    return let(cut, of_pieces)


def _matches(text: Column, pattern: str, kind: int) -> Column:
    """The pattern's matches: kind, start, finish, value, and the characters before and after."""

    def place(found: Column, between: Column) -> Column:
        steps = F.transform(found, lambda m, i: F.length(F.get(between, i)) + F.length(m))
        return let(
            _running(steps, lambda n, x: n + x, F.lit(0)),
            lambda at: F.transform(
                found,
                lambda m, i: F.struct(
                    F.lit(kind).alias("kind"),
                    (F.get(at, i) + F.length(F.get(between, i))).alias("start"),
                    (F.get(at, i) + F.length(F.get(between, i)) + F.length(m)).alias("finish"),
                    m.alias("value"),
                    F.right(F.get(between, i), F.lit(CONTEXT)).alias("before"),
                    F.left(F.get(between, i + 1), F.lit(1)).alias("after"),
                ),
            ),
        )

    found = F.regexp_extract_all(text, F.lit(f"({pattern})"), 1)
    none = F.array().cast("array<struct<kind:int,start:int,finish:int,value:string,before:string,after:string>>")
    spans = let(
        found, lambda m: F.when(F.size(m) > 0, let(F.split(text, pattern, -1), lambda b: place(m, b))).otherwise(none)
    )
    return F.when(text.rlike(NEEDS[kind]), spans).otherwise(none)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    each = F.transform(F.split(F.reverse(digits), ""), lambda c: c.cast("int"))
    return F.aggregate(
        each,
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("i")),
        lambda a, d: F.struct(
            (a["n"] + F.when(a["i"] % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d)).alias("n"), (a["i"] + 1).alias("i")
        ),
    )["n"] % 10 == 0


def _passes(span: Column) -> Column:
    """The base's own checks."""
    digits = F.length(_digits(span["value"]))
    octets = F.split(span["value"], "\\.")
    small = F.forall(octets, lambda o: F.regexp_replace(o, "^0+", "").rlike("^([0-9]{0,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    # a number of any length comes here; only one of the right length is summed up
    card = F.when(digits.between(14, 19), _luhn(_digits(span["value"]))).otherwise(False)
    kind = span["kind"]
    return F.when(kind == EMAIL, True).when(kind == IP, small).when(kind == CARD, card).when(
        kind == PHONE, digits.between(10, 15)
    ).otherwise(False)


def _starts(value: Column, heads: tuple[str, ...]) -> Column:
    return value.rlike(f"^({'|'.join(heads)})")


def _votes(span: Column, passes: Column) -> list[Column]:
    """The labelers' votes on a candidate."""
    kind, value, before = span["kind"], span["value"], span["before"]
    digits = _digits(value)

    def yes_no(sign: Column) -> Column:
        return F.when(sign, 1).otherwise(-1)

    form = (
        F.when(kind == EMAIL, value.rlike(r"^[A-Za-z0-9][^@]*@.*\.[A-Za-z]{2,}$"))
        .when(kind == IP, ~span["after"].isin(".", "-") & ~before.rlike("[0-9]\\.$"))
        .when(kind == CARD, value.rlike("^[0-9]{13,19}$|^[0-9]{4}([ -][0-9]{4}){3}"))
        .when(kind == PHONE, value.rlike(r"^\+[0-9]{1,3}[ .-]?\(?[0-9]|^\(?[0-9]{3}\)?"))
        .otherwise(value.rlike("AKIA|[0-9]"))
    )
    strong = F.when(kind == SECRET, value.rlike("[0-9]") & value.rlike("[A-Za-z]") & (F.length(value) >= 16))
    check = strong.when((kind == PHONE) & ~value.startswith("+"), F.length(digits) == 10).otherwise(passes)
    lists = (
        F.when(kind == EMAIL, F.lower(F.substring_index(value, ".", -1)).isin(*DOMAINS))
        .when(kind == CARD, _starts(digits, ISSUERS))
        .when(kind == PHONE, F.when(value.startswith("+"), _starts(digits, COUNTRIES)))
        .when(kind == SECRET, value.rlike(f"AKIA|(?i:{_CUES})"))
    )
    cue = F.lit(False)
    for k, words in CUE_WORDS.items():
        near = F.concat(before, F.when(kind == SECRET, value).otherwise(""))
        cue = F.when(kind == k, near.rlike(rf"(?i)\b({words})")).otherwise(cue)
    against = before.rlike(rf"(?i)\b({AGAINST})[.:]?\s*$")
    edges = before.rlike(r"[\p{L}\p{N}=/]$") | span["after"].rlike(r"^[\p{L}\p{N}=/]")
    return [
        yes_no(form).alias("form"),
        yes_no(check).alias("check"),
        F.when(lists.isNull(), 0).when(lists, 1).otherwise(-1).alias("lists"),
        F.when(against, -1).when(cue, 1).otherwise(0).alias("cues"),
        yes_no(~edges).alias("edges"),
    ]


def _features(span: Column) -> list[Column]:
    value = span["value"]
    length = F.length(value)

    def touch(c: Column) -> Column:
        return F.when(c == "", "end").when(c.rlike(r"\s"), "space").when(c.rlike(r"[\p{L}\p{N}]"), "word").otherwise("mark")

    share = F.length(_digits(value)) / length
    return [
        F.element_at(F.array(*map(F.lit, KINDS)), span["kind"] + 1).alias("kind"),
        F.when(length < 8, "short").when(length < 14, "middle").when(length < 24, "long").otherwise("longer").alias("length"),
        F.when(share < 0.1, "few").when(share < 0.5, "some").when(share < 0.9, "most").otherwise("all").alias("digits"),
        touch(F.right(span["before"], F.lit(1))).alias("before"),
        touch(span["after"]).alias("after"),
    ]


def candidates(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``row``, the columns to keep, and the text's candidates: kind, start, finish, base (bool), votes and features."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    spans = [_matches(text, PATTERNS[k], k) for k in range(len(KINDS))]
    near = _matches(text, LOCAL_PHONE, PHONE)
    local = F.when(text.rlike("[0-9]{3}[\\x20.-][0-9]{4}"), near)  # no plus is needed here
    none = F.array().cast("array<struct<kind:int,start:int,finish:int,value:string,before:string,after:string>>")
    found = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.concat(*spans, F.coalesce(local, none)).alias("found"))

    def judged(span: Column) -> Column:
        return let(
            _passes(span) & ((span["kind"] != PHONE) | span["value"].startswith("+")),
            lambda passes: F.struct(
                span["start"].alias("start"),
                span["kind"].alias("kind"),
                span["finish"].alias("finish"),
                passes.alias("base"),
                F.struct(*_votes(span, passes)).alias("votes"),
                F.struct(*_features(span)).alias("features"),
            ),
        )

    return found.select("row", F.sort_array(F.transform("found", judged)).alias("candidates"))


class SpanClassifier:
    """Naive Bayes over the features, trained with the labelers' posteriors as soft labels."""

    def __init__(self, counts: dict[tuple[str, str], tuple[float, float]], share: float):
        self.prior = math.log(share / (1 - share))
        self.weights: dict[str, dict[str, float]] = {f: {} for f in FEATURES}
        for f in FEATURES:
            own = {v: c for (g, v), c in counts.items() if g == f}
            good, bad = (sum(c[i] + 1 for c in own.values()) for i in (0, 1))
            for v, c in own.items():
                self.weights[f][v] = math.log((c[0] + 1) / good) - math.log((c[1] + 1) / bad)

    def odds(self, features: Column) -> Column:
        total = F.lit(self.prior)
        for f, weights in self.weights.items():
            part = F.lit(0.0)
            for v, w in weights.items():
                part = F.when(features[f] == v, w).otherwise(part)
            total = total + part
        return total


def find(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``row``, the columns to keep, and ``spans``: start, finish, kind (its name), base, and the chance that it is
    personal data."""
    rows = stage(candidates(docs, keep), "candidates")
    each = rows.select(F.explode("candidates").alias("c")).select("c.votes.*", "c.features")
    patterns = stage(each.groupBy(*LABELERS).agg(F.count(F.lit(1)).alias("n")), "votes")
    labels = LabelModel(LABELERS, share=0.7).fit(patterns)
    pairs = F.array(*[F.struct(F.lit(f).alias("f"), F.col("features")[f].alias("v")) for f in FEATURES])
    soft = each.select(labels.posterior(F.col).alias("p"), F.explode(pairs).alias("x"))
    sums = soft.groupBy("x.f", "x.v").agg(F.sum("p").alias("good"), F.sum(1 - F.col("p")).alias("bad")).collect()
    classifier = SpanClassifier({(r["f"], r["v"]): (r["good"], r["bad"]) for r in sums}, labels.share)

    def chance(c: Column) -> Column:
        votes = labels.posterior(lambda rule: c["votes"][rule])
        features = 1 / (1 + F.exp(-classifier.odds(c["features"])))
        return (votes + features) / 2

    def scored(c: Column) -> Column:
        name = F.element_at(F.array(*map(F.lit, KINDS)), c["kind"] + 1)
        return F.struct(
            c["start"].alias("start"), c["kind"].alias("number"), c["finish"].alias("finish"), name.alias("kind"),
            c["base"].alias("base"), chance(c).alias("chance"),
        )

    def chosen(spans: Column) -> Column:
        base = F.filter(spans, lambda s: s["base"])
        return let(
            base,
            lambda b: F.filter(
                spans,
                lambda s: s["base"]
                | ((s["chance"] >= 0.5) & ~F.exists(b, lambda x: (x["start"] < s["finish"]) & (s["start"] < x["finish"]))),
            ),
        )

    return rows.select("row", let(F.transform("candidates", scored), chosen).alias("spans"))


def report(docs: DataFrame) -> DataFrame:
    """Per document: base spans by kind, a digest of them, and all spans as kind:start:end."""

    def listed(spans: Column) -> Column:
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["finish"].cast("string"))), ","
        )

    def number(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("bigint").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["base"])
    counts = [number(k) for k in KINDS[:4]]
    found = find(keyed(docs), ["doc_id"])
    return found.select("row.*", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def mask(docs: DataFrame) -> DataFrame:
    """All columns of ``docs``, with each span of ``text`` replaced by its kind in brackets; spans that overlap are
    replaced together, by the first one's kind. Texts without spans, and nulls, stay as they are."""
    text = F.col("row")["text"].cast("string")

    def masked(spans: Column, reach: Column) -> Column:
        """``reach``: how far the spans before each one go."""
        heads = F.filter(
            F.transform(spans, lambda s, i: F.struct(s["start"], F.get(reach, i).alias("reach"), s["kind"])),
            lambda s: s["start"] >= s["reach"],
        )
        parts = F.transform(
            heads,
            lambda s: F.concat(F.substring(text, s["reach"] + 1, s["start"] - s["reach"]), F.lit("["), F.upper(s["kind"]), F.lit("]")),
        )
        end = F.aggregate(spans, F.lit(0), lambda a, s: F.greatest(a, s["finish"]))
        return F.concat(F.array_join(parts, ""), let(end, lambda e: F.substring(text, e + 1, F.length(text))))

    def of_spans(spans: Column) -> Column:
        finishes = F.transform(spans, lambda s: s["finish"])
        return let(_running(finishes, lambda a, x: F.greatest(a, x), F.lit(0)), lambda reach: masked(spans, reach))

    found = find(docs, docs.columns).withColumn("clean", F.when(F.size("spans") > 0, let(F.col("spans"), of_spans)).otherwise(text))
    return found.select(*[F.col("clean").alias(c) if c == "text" else F.col("row")[c].alias(c) for c in docs.columns])
