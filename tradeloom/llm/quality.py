"""Quality rules under weak supervision: rules vote or abstain, and the posterior decides.

Everything is DataFrame functions. Texts are read once; what the rules measure goes to a narrow table, one row per
document. Votes are counted by pattern, expectation-maximisation estimates how reliable each rule is
(`labelmodel`), and a document is kept when its chance of being good is at least one half. Documents that fail
the base (under 50 words, or more than half of the words in repeated three-word windows) are never kept.

A null text has no words, fails the base and isn't kept. A null ``doc_id`` stays null; repeated rows are judged one
by one and alike; other columns are not looked at; an empty table gives an empty table.

Repeated windows within a text are found by sorting. A window's 64-bit hash gives up as many low bits as the position
needs, so one sort of plain numbers brings equal windows together and keeps their places. Where neighbours in that
order have unequal full hashes, the text's full hashes are sorted with their places instead, so the count is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.common import SPACE, keyed, let, stage, words_of
from tradeloom.llm.labelmodel import LabelModel

MIN_WORDS = 50
WINDOW = 3
SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words_in_repeats(h: Column) -> Column:
    """How many words lie in windows whose hash occurs twice or more; ``h``: two hashes at least, by position."""

    def of_sorted(low: Column) -> Column:
        marked = F.transform(h, lambda x, i: x.bitwiseAND(F.bitwise_not(low)).bitwiseOR(i.cast("bigint")))
        return let(F.sort_array(marked), lambda s: covered(F.when(mixed(s, low), exact()).otherwise(repeats(s, low))))

    def near(x: Column, y: Column, low: Column) -> Column:
        return x.bitwiseOR(low) == y.bitwiseOR(low)

    def mixed(s: Column, low: Column) -> Column:
        """Whether unequal hashes share their high bits, and so may part equal ones."""
        apart = F.filter(
            s, lambda x, i: F.when(near(x, F.get(s, i + 1), low), place(x, low) != place(F.get(s, i + 1), low)).otherwise(False)
        )
        return F.size(apart) > 0

    def repeats(s: Column, low: Column) -> Column:
        def same(x: Column, y: Column) -> Column:
            return F.when(near(x, y, low), F.lit(True)).otherwise(False)

        twice = F.filter(s, lambda x, i: same(x, F.get(s, i - 1)) | same(x, F.get(s, i + 1)))
        return F.sort_array(F.transform(twice, lambda x: x.bitwiseAND(low).cast("int")))

    def exact() -> Column:
        def same(x: Column, y: Column) -> Column:
            return F.coalesce(x["h"] == y["h"], F.lit(False))

        def of_pairs(s: Column) -> Column:
            twice = F.filter(s, lambda x, i: same(x, F.get(s, i - 1)) | same(x, F.get(s, i + 1)))
            return F.sort_array(F.transform(twice, lambda x: x["i"]))

        return let(F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))), of_pairs)

    def place(x: Column, low: Column) -> Column:
        return F.get(h, x.bitwiseAND(low).cast("int"))

    def covered(at: Column) -> Column:
        start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n"))
        step = F.aggregate(
            at, start, lambda a, x: F.struct(x.alias("last"), (a["n"] + F.least(F.lit(WINDOW), x - a["last"])).alias("n"))
        )
        return step["n"]

    bits = F.length(F.bin(F.size(h).cast("bigint")))
    return let(F.call_function("shiftleft", F.lit(1).cast("bigint"), bits) - 1, of_sorted)


def repeated_words(words: Column) -> Column:
    """How many words lie in a window of three words that occurs twice or more."""

    def of_words(w: Column) -> Column:
        windows = F.transform(
            F.sequence(F.lit(0), F.size(w) - WINDOW), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
        )
        return let(windows, words_in_repeats)

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) > WINDOW, let(hashes, of_words)).otherwise(0)


def without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def measures(docs: DataFrame) -> DataFrame:
    """One row per document with everything that the rules look at."""
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(f"[^{SPACE}]"))

    def of_words(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("bigint").alias("n_words"),
            repeated_words(w).cast("bigint").alias("n_repeat_words"),
            F.size(F.array_distinct(w)).cast("bigint").alias("n_distinct"),
            F.size(F.filter(w, lambda x: F.length(x) <= 3)).cast("bigint").alias("n_short"),
        )

    def of_lines(x: Column) -> Column:
        return F.struct(
            F.size(x).cast("bigint").alias("n_lines"),
            (F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"),
        )

    rows = keyed(docs).select(
        "doc_id",
        let(words_of(F.col("text")), of_words).alias("w"),
        let(lines, of_lines).alias("l"),
        F.length(text).cast("bigint").alias("n_chars"),
        F.length(without(text, " \t\n\x0b\x0c\r")).cast("bigint").alias("word_chars"),
        (F.length(text) - F.length(without(text, SYMBOLS))).cast("bigint").alias("n_symbols"),
        (F.length(text) - F.length(without(text, CAPITALS))).cast("bigint").alias("n_capitals"),
        (F.length(text) - F.length(without(text, "!?"))).cast("bigint").alias("n_shouts"),
        (F.length(text) - F.length(without(text, "."))).cast("bigint").alias("n_stops"),
        (F.length(text) - F.length(without(text, "|"))).cast("bigint").alias("n_bars"),
    )
    rows = rows.select("doc_id", "w.*", "l.*", "word_chars", "n_symbols", "n_capitals", "n_shouts", "n_stops", "n_bars")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return rows.withColumn("base_failed", failed)


#: How often a rule is first taken to be right: signs of junk are sharp, signs of good text only a hint.
SHARP, HINT = 0.97, 0.6


def rules() -> dict[str, tuple[Column, float]]:
    """Each rule's vote, 1 (good), -1 (bad) or 0 (can't tell), and the trust put in it at first.

    Rules that look for junk abstain where they find none: that a text isn't shouted doesn't make it good.
    """
    words = F.greatest(F.col("n_words"), F.lit(1))
    per_word = {k: F.col(k) / words for k in ("word_chars", "n_symbols", "n_capitals", "n_shouts", "n_stops", "n_short", "n_bars")}

    def junk(sign: Column) -> tuple[Column, float]:
        return F.when(sign, -1).otherwise(0), SHARP

    def hint(bad: Column, good: Column) -> tuple[Column, float]:
        return F.when(bad, -1).when(good, 1).otherwise(0), HINT

    return {
        "symbols": junk(per_word["n_symbols"] > 0.1),
        "capitals": junk(per_word["n_capitals"] > 1.5),
        "shouts": junk(per_word["n_shouts"] > 0.2),
        "bars": junk(per_word["n_bars"] > 0.2),
        "same_lines": junk(5 * F.col("n_dup_lines") > 2 * F.col("n_lines")),
        "same_windows": junk(3 * F.col("n_repeat_words") > F.col("n_words")),
        "few_words": junk(F.col("n_distinct") < 0.1 * words),
        "odd_words": junk((per_word["word_chars"] < 2) | (per_word["word_chars"] > 15)),
        "length": hint(F.col("n_words") < MIN_WORDS, F.col("n_words") >= 2 * MIN_WORDS),
        "sentences": hint(per_word["n_stops"] > 0.5, (per_word["n_stops"] > 0.02) & (per_word["n_stops"] < 0.3)),
        "short_words": hint(per_word["n_short"] < 0.05, (per_word["n_short"] > 0.15) & (per_word["n_short"] < 0.8)),
    }


def judge(docs: DataFrame) -> DataFrame:
    """The measures of each document, its chance of being good, and whether it is kept."""
    found = stage(measures(docs).withColumns({f"vote_{k}": v.cast("tinyint") for k, (v, _) in rules().items()}), "measures")
    trust = {f"vote_{k}": t for k, (_, t) in rules().items()}
    patterns = stage(found.groupBy(*trust).agg(F.count(F.lit(1)).alias("n")), "votes")
    model = LabelModel(trust).fit(patterns)
    good = found.withColumn("quality", model.posterior(F.col))
    return good.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= 0.5)).drop(*trust)
