"""Document quality by weak supervision.

Rules look at counts of a text and vote good (1), bad (-1) or abstain (0). Expectation
maximisation estimates each rule's accuracy and the share of good documents from how the votes
agree, without labels. A document is kept where its posterior probability of being good reaches
the threshold; no single rule rejects it.

The texts are read once. Only the counts of distinct vote combinations, at most 3 to the number
of rules whatever the number of documents, reach the driver; the posterior is a sum of
constants that Spark evaluates. All expressions are built-in functions.
"""

from __future__ import annotations

import math
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbstar.llm.common import SPACES, let
from curbstar.sources.scratch import stored

SYMBOLS = "#*$%&|<>"
#: Base rules of the contract.
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50
#: Up to this many words a window's hash and position share one long; beyond, they are a struct.
PACKED_WORDS = 1 << 16

#: Frequent function words of the corpus languages.
FUNCTION_WORDS = (
    "a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "in", "is", "it", "of", "on", "or", "that", "the",
    "this", "to", "was", "with", "au", "aux", "avec", "ce", "dans", "de", "des", "du", "elle", "en", "est", "et", "il",
    "la", "le", "les", "par", "pas", "pour", "que", "qui", "sur", "un", "une", "auf", "das", "dem", "den", "der", "die",
    "ein", "eine", "für", "ist", "mit", "nicht", "sich", "und", "von", "zu", "con", "del", "el", "los", "las", "no",
    "por", "se", "su", "una", "y",
)


@dataclass(frozen=True)
class Rule:
    """Votes bad where ``bad`` holds, else good where ``good`` holds, else abstains."""

    name: str
    bad: str
    good: str


#: Conditions over the columns of :func:`signals`. A text without words gets no good vote.
RULES = (
    Rule("symbols", "n_symbols > 0.2 * n_words", "n_symbols <= 0.05 * n_words and n_words > 0"),
    Rule("capitals", "n_capitals > 0.4 * word_chars", "n_capitals <= 0.15 * word_chars and n_words > 0"),
    Rule("word_length", "word_chars > 12 * n_words or word_chars < 2 * n_words", "word_chars between 3 * n_words and 9 * n_words and n_words > 0"),
    Rule("duplicate_lines", "n_dup_lines > 0.3 * n_lines", "n_dup_lines <= 0.1 * n_lines and n_words > 0"),
    Rule("repetition", "n_repeat_words > 0.3 * n_words", "n_repeat_words <= 0.1 * n_words and n_words > 0"),
    Rule("plain_words", "n_plain_words < 0.6 * n_words", "n_plain_words >= 0.8 * n_words and n_words > 0"),
    Rule("function_words", "n_function_words < 0.02 * n_words", "n_function_words >= 0.08 * n_words and n_words > 0"),
    Rule("length", "n_words < 20", "n_words >= 100"),
)


def _n_repeat_words(words: Column) -> Column:
    """Words inside a 3-word window whose words occur as a window again in the text."""
    n = F.size(words)
    hash_of = lambda w, i: F.xxhash64(w[i], w[i + 1], w[i + 2])
    windows = F.sequence(F.lit(0), n - 3)

    def positions(keyed: Column, at, same) -> Column:
        """Start positions of repeated windows, from windows sorted by key and position."""
        return let(
            F.sort_array(keyed),
            lambda s: F.filter(
                F.transform(
                    s,
                    lambda x, k: F.when(
                        ((k > 0) & same(x, F.get(s, k - 1))) | ((k < F.size(s) - 1) & same(x, F.get(s, k + 1))), at(x)
                    ),
                ),
                lambda p: p.isNotNull(),
            ),
        )

    def covered(starts: Column) -> Column:
        """Words in windows of three at the given starts."""
        return let(
            F.sort_array(starts),
            lambda p: F.aggregate(
                F.transform(p, lambda x, k: F.coalesce(F.least(F.get(p, k + 1) - x, F.lit(3)), F.lit(3))),
                F.lit(0).cast("long"),
                lambda total, x: total + x,
            ),
        )

    low = PACKED_WORDS - 1
    packed = F.transform(windows, lambda i: hash_of(words, i).bitwiseAND(~low).bitwiseOR(i.cast("long")))
    near = positions(packed, lambda x: x.bitwiseAND(low).cast("int"), lambda x, y: x.bitwiseAND(~low) == y.bitwiseAND(~low))
    wide = F.transform(windows, lambda i: F.struct(hash_of(words, i).alias("h"), i.alias("i")))
    far = positions(wide, lambda x: x["i"], lambda x, y: x["h"] == y["h"])
    return F.when(n < 3, F.lit(0).cast("long")).when(n < PACKED_WORDS, covered(near)).otherwise(covered(far))


def signals(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and the counts that the rules look at; a null text counts as empty."""
    t = F.coalesce(F.col(text), F.lit(""))
    bare = F.translate(t, SPACES, "")
    words = F.filter(F.split(t, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    lines = F.filter(F.split(t, "\n"), lambda line: F.length(F.translate(line, SPACES, "")) > 0)
    functional = "(?i)(?<![^\\x20\\x09-\\x0D])(?:" + "|".join(FUNCTION_WORDS) + ")(?![^\\x20\\x09-\\x0D.,;:])"
    plain = "(?<![^\\x20\\x09-\\x0D])\\p{L}++[.,;:?!\"')]?(?![^\\x20\\x09-\\x0D])"
    long = lambda c: c.cast("long")
    first = documents.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        let(words, lambda w: F.struct(long(F.size(w)).alias("n_words"), _n_repeat_words(w).alias("n_repeat_words"))).alias("w"),
        long(F.length(bare)).alias("word_chars"),
        let(lines, lambda x: F.struct(long(F.size(x)).alias("n_lines"), long(F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines"))).alias("l"),
        long(F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).alias("n_symbols"),
        long(F.regexp_count(t, F.lit("[A-Z]"))).alias("n_capitals"),
        long(F.regexp_count(t, F.lit(plain))).alias("n_plain_words"),
        long(F.regexp_count(t, F.lit(functional))).alias("n_function_words"),
    )
    return first.select("doc_id", "w.*", "word_chars", "l.*", "n_symbols", "n_capitals", "n_plain_words", "n_function_words")


def _votes(rules: Iterable[Rule]) -> list[Column]:
    return [F.expr(f"case when {r.bad} then -1 when {r.good} then 1 else 0 end").alias(f"vote_{r.name}") for r in rules]


def fit(patterns: list[tuple[tuple[int, ...], int]], rounds: int = 100) -> Model:
    """The model that explains counted vote combinations best, from a fixed start.

    Each rule has two accuracies: how often its vote is right on good and on bad documents.
    Abstaining says nothing. The two add up to 1 at least, and the share of good documents is
    a half at least, so a bad vote never speaks for a document, and a document that no rule votes
    against is kept, however the corpus looks.
    """
    rules = len(patterns[0][0]) if patterns else 0
    share, on_good, on_bad = 0.9, [0.95] * rules, [0.4] * rules
    for _ in range(rounds):
        model = Model(share, on_good, on_bad)
        total = good = 0.0
        # Each pair holds (right votes, votes), started with a few imagined ones.
        g, b = [[9.5, 10.0] for _ in range(rules)], [[4.0, 10.0] for _ in range(rules)]
        for votes, n in sorted(patterns):
            p = model.posterior(votes)
            total += n
            good += n * p
            for i, v in enumerate(votes):
                if v:
                    g[i][0] += n * p * (v > 0)
                    g[i][1] += n * p
                    b[i][0] += n * (1 - p) * (v < 0)
                    b[i][1] += n * (1 - p)
        share = min(0.99, max(0.5, good / total)) if total else share
        on_good = [min(0.99, r / n) for r, n in g]
        on_bad = [min(0.99, max(1 - a, r / n)) for a, (r, n) in zip(on_good, b, strict=True)]
    return Model(share, on_good, on_bad)


@dataclass(frozen=True)
class Model:
    share: float
    on_good: list[float]
    on_bad: list[float]

    def start(self) -> float:
        return math.log(self.share / (1 - self.share))

    def weights(self) -> list[tuple[float, float]]:
        """What a good and a bad vote of each rule add to the log odds."""
        return [(math.log(g / (1 - b)), math.log((1 - g) / b)) for g, b in zip(self.on_good, self.on_bad, strict=True)]

    def posterior(self, votes: tuple[int, ...]) -> float:
        score = self.start() + sum(w[v < 0] for v, w in zip(votes, self.weights(), strict=True) if v)
        return 1 / (1 + math.exp(-score))


def judged_documents(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES, threshold: float = 0.5
) -> DataFrame:
    """One row per input row: doc_id, the counts, each rule's vote, posterior, base_failed, kept.

    Null, empty and blank texts have no words and fail the base rule. Repeated rows are judged
    alike, and count as often as they occur. An empty table gives an empty result. Other columns
    of the input are ignored.
    """
    voted = stored(signals(documents, doc_id, text).select("*", *_votes(rules)), "quality")
    names = [f"vote_{r.name}" for r in rules]
    counted = voted.groupBy(*names).agg(F.count("*").alias("n")).collect()
    model = fit([(tuple(r[n] for n in names), r["n"]) for r in counted])
    score = F.lit(model.start())
    for name, (good, bad) in zip(names, model.weights(), strict=False):
        score = score + F.when(F.col(name) > 0, good).when(F.col(name) < 0, bad).otherwise(0.0)
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))
    return (
        voted.withColumn("posterior", 1 / (1 + F.exp(-score)))
        .withColumn("base_failed", failed)
        .withColumn("kept", ~failed & (F.col("posterior") >= threshold))
    )
