"""Personal data: checked patterns, and identifiers found from their contexts by bootstrapping.

Base kinds (email, ip, card, phone) are regular expressions with a check of each match. Their
matches seed the second part. The word before and the word after an entity, with the punctuation between
them, are lexical patterns. In rounds, a pattern's confidence is the score of the accepted entities
that stand in it over how often its word occurs in the whole corpus, less the places of candidates
that are still undecided; so plain words at its place count against a pattern, unseen identifiers
don't. A candidate's score combines the confidences of its patterns. Patterns of high confidence
so accept identifiers of shapes that no expression describes, which then support further patterns,
until no more are accepted. Candidates are tokens with digits outside all base spans.

Everything is built-in functions: positions come from the pieces between matches and running
sums. The texts are read twice, for matches and for counts of words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curbstar.llm.common import let
from curbstar.sources.scratch import stored

#: The contract's expressions. Possessive repetition and the guard on where a match may begin
#: change no match; they keep the time linear on long runs of letters or digits.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = [*BASE, "context"]
#: A candidate: a token of letters, digits and joining signs with four digits or more.
CANDIDATE = r"(?:\G|(?<![A-Za-z0-9]))(?=(?:[-_./@:+A-Za-z]*+[0-9]){4})[A-Za-z0-9]++(?:[-_./@:+][A-Za-z0-9]++)*+"
CANDIDATE_DIGITS = 4
CANDIDATE_CHARS = 6
#: Code points of text next to an entity in which its neighbour words are sought.
CONTEXT_CHARS = 64

LEAST_CONFIDENCE = 0.5
LEAST_INSTANCES = 3


#: A word as a pattern before or after an entity: letters, and the punctuation towards the entity.
CONTEXT_WORDS = {
    "before": r"\p{L}++[^\x20\x09-\x0D\p{L}\p{N}]*+",
    "after": r"[^\x20\x09-\x0D\p{L}\p{N}]*+\p{L}++",
}


def _word_before(piece: Column) -> Column:
    return F.lower(F.regexp_extract(F.right(piece, F.lit(CONTEXT_CHARS)), rf"({CONTEXT_WORDS['before']})[\x20\x09-\x0D]*+$", 1))


def _word_after(piece: Column) -> Column:
    return F.lower(F.regexp_extract(F.left(piece, F.lit(CONTEXT_CHARS)), rf"^[\x20\x09-\x0D]*+({CONTEXT_WORDS['after']})", 1))


def located(text: Column, regex: str) -> Column:
    """Matches in order, each with the length of the text between it and the one before, and its
    neighbour words; null without a match."""
    found = let(
        F.split(text, regex, -1),
        lambda pieces: F.transform(
            F.regexp_extract_all(text, F.lit(regex), F.lit(0)),
            lambda m, i: F.struct(
                F.length(F.get(pieces, i)).alias("gap"), m.alias("match"),
                _word_before(F.get(pieces, i)).alias("before"), _word_after(F.get(pieces, i + 1)).alias("after"),
            ),
        ),
    )
    return F.when(text.rlike(regex), found)


def _luhn(digits: Column) -> Column:
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, n - i, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add) % 10 == 0


def _valid(kind: Column, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    n = F.length(digits)
    part_fits = lambda p: let(F.ltrim(p, F.lit("0")), lambda q: (F.length(q) < 3) | ((F.length(q) == 3) & (q <= "255")))
    return (
        F.when(kind == "ip", F.forall(F.split(match, r"\."), part_fits))
        .when(kind == "card", F.when(n.between(16, 19), _luhn(digits)).otherwise(False))
        .when(kind == "phone", n.between(8, 15))
        .when(kind == "context", (n >= CANDIDATE_DIGITS) & (F.length(match) >= CANDIDATE_CHARS))
        .otherwise(True)
    )


def _occurrences(docs: DataFrame, kinds: list[str]) -> DataFrame:
    """row, kind, start, end, match, before, after of the valid matches; the columns ``kinds`` of
    ``docs`` hold what :func:`located` finds. Positions are running sums, a row of input at a time."""
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("found")) for k in kinds]))
    rows = docs.select("row", each.alias("k")).filter("k.found is not null")
    rows = rows.select("row", "k.kind", F.posexplode("k.found").alias("i", "m")).select("row", "kind", "i", "m.*")
    so_far = Window.partitionBy("row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.length("match")).over(so_far)
    rows = rows.withColumn("end", end).withColumn("start", F.col("end") - F.length("match"))
    return rows.filter(_valid(F.col("kind"), F.col("match"))).select("row", "kind", "start", "end", "match", "before", "after")


def _patterns(occurrences: DataFrame) -> DataFrame:
    """One row per occurrence and pattern: pattern (side and word), word, instance."""
    sides = F.explode(F.array(F.struct(F.lit("before").alias("side"), F.col("before").alias("word")), F.struct(F.lit("after").alias("side"), F.col("after").alias("word"))))
    rows = occurrences.select(F.lower("match").alias("instance"), "seed", sides.alias("p"))
    return rows.filter("p.word <> ''").select("instance", "seed", "p.side", "p.word")


def bootstrapped_instances(texts: DataFrame, base: DataFrame, candidates: DataFrame) -> DataFrame:
    """(instance, score) of the candidates that patterns of high confidence accept.

    A pattern needs ``LEAST_INSTANCES`` different accepted entities. Its confidence counts each of
    their occurrences with the entity's score, 1 for base entities, and divides by the occurrences
    of its word in all texts but those next to undecided candidates. What is accepted stays so;
    rounds end when one accepts nothing new.
    """
    both = base.withColumn("seed", F.lit(1.0)).unionByName(candidates.withColumn("seed", F.lit(0.0)))
    edges = _patterns(both).groupBy("side", "word", "instance").agg(F.max("seed").alias("seed"), F.count("*").alias("times"))
    # Words next to too few different entities, of either sort, can never be patterns.
    broad = edges.groupBy("side", "word").agg(F.count("*").alias("kinds")).filter(F.col("kinds") >= LEAST_INSTANCES)
    edges = stored(edges.join(broad, ["side", "word"]).drop("kinds"), "pii-edges")
    wanted = edges.select("word").distinct()
    # The words of both sides, from the texts as they are, so that they agree with the patterns.
    each = F.explode(F.array(*[
        F.struct(F.lit(side).alias("side"), F.regexp_extract_all("text", F.lit(regex), F.lit(0)).alias("words")) for side, regex in CONTEXT_WORDS.items()
    ]))
    words = texts.select(each.alias("s")).select("s.side", F.explode("s.words").alias("word")).withColumn("word", F.lower("word"))
    wanted = edges.select("side", "word").distinct()
    totals = words.groupBy("side", "word").agg(F.count("*").alias("total")).join(wanted, ["side", "word"])
    edges = stored(edges.join(totals, ["side", "word"]), "pii-graph")
    scores, accepted = None, 0
    while True:
        scored = edges.withColumn("score", F.col("seed")) if scores is None else (
            edges.join(scores, "instance", "left").withColumn("score", F.greatest("seed", F.coalesce("found", F.lit(0.0)))).drop("found")
        )
        decided = F.col("score") >= LEAST_CONFIDENCE
        confident = scored.groupBy("side", "word").agg(
            F.sum(F.when(decided, F.col("score") * F.col("times")).otherwise(0.0)).alias("hits"),
            F.sum(F.when(decided, F.col("times")).otherwise(0)).alias("taken"),
            F.sum(F.when(decided, 0).otherwise(F.col("times"))).alias("undecided"),
            F.sum(decided.cast("int")).alias("entities"), F.max("total").alias("total"),
        ).filter(F.col("entities") >= LEAST_INSTANCES)
        confident = confident.withColumn("confidence", F.least(F.col("hits") / F.greatest(F.col("total") - F.col("undecided"), "taken"), F.lit(0.99)))
        confident = confident.filter(F.col("confidence") >= LEAST_CONFIDENCE).select("side", "word", "confidence")
        reached = edges.filter("seed = 0").join(confident, ["side", "word"])
        combined = reached.groupBy("instance").agg((1 - F.exp(F.sum(F.log(1 - F.col("confidence"))))).alias("found"))
        new = combined.filter(F.col("found") >= LEAST_CONFIDENCE)
        if scores is not None:
            new = new.unionByName(scores).groupBy("instance").agg(F.max("found").alias("found"))
        scores = stored(new, "pii-scores")
        before, accepted = accepted, scores.count()
        if accepted == before:
            return scores.withColumnRenamed("found", "score")


def personal_spans(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(documents as row and doc_id, spans as row, kind, start, end, match, score).

    Positions count code points, the end exclusive. Base spans have score 1; kind ``context`` are
    those the method adds, none of which overlaps a base span. A null text counts as empty.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    kinds = [located(t, regex).alias(kind) for kind, regex in BASE.items()]
    docs = stored(
        documents.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).cast("long").alias("doc_id"), *kinds, located(t, CANDIDATE).alias("context")), "pii"
    )
    base = stored(_occurrences(docs, list(BASE)), "pii-base")
    found = _occurrences(docs, ["context"])
    spans = base.select("row", F.col("start").alias("s"), F.col("end").alias("e"))
    inside = (F.col("c.row") == F.col("b.row")) & (F.col("c.start") < F.col("b.e")) & (F.col("c.end") > F.col("b.s"))
    candidates = stored(found.alias("c").join(spans.alias("b"), inside, "left_anti"), "pii-candidates")
    accepted = bootstrapped_instances(documents.select(t.alias("text")), base, candidates)
    more = candidates.withColumn("instance", F.lower("match")).join(accepted, "instance").drop("instance")
    columns = ["row", "kind", "start", "end", "match", "score"]
    return docs.select("row", "doc_id"), base.withColumn("score", F.lit(1.0)).unionByName(more.select(*base.columns, "score")).select(*columns)


def span_report(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_context.

    Null and empty texts have no spans. Repeated rows give repeated results; other columns are
    ignored; an empty table gives an empty result.
    """
    docs, spans = personal_spans(documents, doc_id, text)
    number = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    lists = spans.groupBy("row").agg(F.array_sort(F.collect_list(F.struct(number.alias("k"), "start", "end", "kind"))).alias("all"))
    out = docs.join(lists, "row", "left").withColumn("all", F.coalesce("all", F.expr("cast(array() as array<struct<k:long,start:long,end:long,kind:string>>)")))
    joined = lambda s: F.array_join(F.transform(s, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    of_kind = lambda k: F.filter("all", lambda x: x["kind"] == k)
    counts = [F.size(of_kind(k)).cast("long").alias(f"n_{k}") for k in KINDS]
    base = F.filter("all", lambda x: x["kind"] != "context")
    return out.select("doc_id", *counts[:4], F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("all")).alias("spans"), counts[4])
