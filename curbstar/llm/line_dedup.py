"""Near-duplicate lines by an exact set-similarity join; later matches go.

A line is its set of words in lower case. With ``shingle=5`` it is its set of 5-word shingles, which
matches far fewer edited lines; one of fewer words is then a single token of all of them, or left
alone with ``short=False``. Lines with the same text are one class, at its first occurrence.

Tokens have a global order by rarity: frequent tokens come last, by their count in the corpus, and
the hash decides among the others. Two sets with Jaccard 0.8 or more share a token within the first
``n - ceil(0.8 n) + 1`` of each under any order, so only those prefixes are joined. Pairs must pass
bounds on length and position, and on the difference of the sets that 128 parity bits of each line
show; the rest is verified. A line that matches an earlier line is removed, also where that one is
removed itself.

All tokens are counted with partial aggregation. At most ``FREQUENT_TOKENS`` of them, the most
frequent, reach the driver; a table of ``RANK_SLOTS`` small numbers made of them gives each token its
rank by hash. A rare token that falls on a frequent one's place is ranked as frequent, which is an
order like any other.

Large groups of near copies: of each shared prefix token two lines are tried first, the first and
the plainest, and a line they remove needs no more comparisons. Only the lines left are compared
with all earlier ones.

A line is known by (key of its row, line number), and earlier means smaller; keys follow the ids. All expressions are built-in
functions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curbstar.llm.common import KEY, keyed, let
from curbstar.sources.scratch import discard, stored

PERCENT = 80
SHINGLE = 1
#: So many of the most frequent tokens are ranked by their counts.
FREQUENT_TOKENS = 1 << 16
#: Places of the table of ranks, a power of two.
RANK_SLOTS = 1 << 18
#: Lines to compare are sent to all executors up to so many bytes, else joined with a shuffle.
BROADCAST_BYTES = 64 << 20


def _lines(documents: DataFrame) -> DataFrame:
    """doc, line, content; a null text gives one empty line."""
    split = F.split(F.coalesce("text", F.lit("")), "\n")
    return documents.select("doc", F.posexplode(split).alias("line", "content"))


def line_tokens(content: Column, shingle: int = SHINGLE, short: bool = True) -> Column:
    """Distinct runs of ``shingle`` words of a line as hashes. A line of fewer words is one
    token if ``short``, else null; a line without words is null."""
    # One literal space splits several times faster than an expression; other white space is rare.
    spaced = F.when(content.rlike("[\\x09-\\x0D]"), F.translate(content, "\t\x0b\x0c\r", "    ")).otherwise(content)
    words = F.filter(F.split(F.lower(spaced), " "), lambda w: w != "")

    def tokens(w: Column) -> Column:
        if shingle == 1:
            return F.when(F.size(w) > 0, F.array_distinct(F.transform(w, lambda x: F.xxhash64(x))))
        hash_at = lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(shingle)])
        hashes = F.array_distinct(F.transform(F.sequence(F.lit(0), F.size(w) - shingle), hash_at))
        runs = F.when(F.size(w) >= shingle, F.sort_array(hashes))
        return runs.when(F.size(w) > 0, F.array(F.xxhash64(w))) if short else runs

    return let(words, tokens)


def _rank_class(count: Column) -> Column:
    """Half octaves, so any count fits seven bits."""
    return F.floor(2 * F.log2(count)).cast("int")


def rank_table(tokens: DataFrame) -> Column:
    """The rank of each place, as a constant array; ``tokens`` has one row per occurrence in ``token``.

    The most frequent tokens, ``FREQUENT_TOKENS`` or fewer, have the class of their count; a place
    without any of them has rank 0.
    """
    counts = stored(tokens.groupBy("token").agg(F.count("*").alias("n")).filter("n > 1").select("token", _rank_class(F.col("n")).alias("rank")), "line-counts")
    held, least = 0, None
    for r in counts.groupBy("rank").agg(F.count("*").alias("n")).orderBy(F.desc("rank")).collect():
        held += r["n"]
        if held > FREQUENT_TOKENS:
            break
        least = r["rank"]
    ranks = [0] * RANK_SLOTS
    if least is not None:
        slot = F.col("token").bitwiseAND(RANK_SLOTS - 1)
        for r in counts.filter(F.col("rank") >= least).groupBy(slot.alias("slot")).agg(F.max("rank").alias("rank")).collect():
            ranks[r["slot"]] = r["rank"]
    discard(counts)
    return F.split(F.lit(",".join(map(str, ranks))), ",").cast("array<int>")


def _ordered(tokens: Column, ranks: Column) -> Column:
    """Tokens in the global order, each with its rank in the upper bits."""
    ranked = lambda t: F.shiftleft(F.get(ranks, t.bitwiseAND(RANK_SLOTS - 1)).cast("long"), 56).bitwiseOR(t.bitwiseAND((1 << 56) - 1))
    return F.sort_array(F.transform(tokens, ranked))


def _parity(tokens: Column, half: int) -> Column:
    """64 bits of a line, each the parity of the number of its tokens that fall on it."""
    bit = lambda t: F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(t, 24).bitwiseAND(63).cast("int"))
    own = lambda t: F.shiftright(t, 30).bitwiseAND(1) == half
    return F.aggregate(tokens, F.lit(0).cast("long"), lambda bits, t: F.when(own(t), bits.bitwiseXOR(bit(t))).otherwise(bits))


def _prefix(tokens: Column, percent: int) -> Column:
    n = F.size(tokens)
    return F.slice(tokens, 1, n - F.floor((n * percent + 99) / 100).cast("int") + 1)


def _similar(n_x: Column, n_y: Column, both: Column, percent: int) -> Column:
    return (100 + percent) * both >= percent * (n_x + n_y)


def matched_lines(documents: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT, shingle: int = SHINGLE, short: bool = True) -> DataFrame:
    """(doc, line) of every line to remove: it has the text, or nearly the tokens, of an earlier line.

    Lines of fewer than ``shingle`` words are compared as a whole if ``short``, else never removed;
    lines without words, so all lines of null and empty texts, are never removed.
    ``key`` tells all rows apart, as :func:`keyed` does.
    """
    docs = documents.select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text"))
    tokens_of = lambda content: line_tokens(content, shingle, short)
    ranks = rank_table(_lines(docs).select(F.explode(tokens_of(F.col("content"))).alias("token")))
    hashed = let(
        tokens_of(F.col("content")),
        lambda t: F.struct(
            F.size(t).alias("n"), _prefix(_ordered(t, ranks), percent).alias("prefix"), _parity(t, 0).alias("even"), _parity(t, 1).alias("odd")
        ),
    )
    lines = stored(
        _lines(docs)
        .select("doc", "line", F.xxhash64("content").alias("g1"), F.xxhash64(F.lit(1), "content").alias("g2"), hashed.alias("t"))
        .select("doc", "line", "g1", "g2", "t.*").filter("n > 0"),
        "lines",
    )
    classes = lines.groupBy("g1", "g2").agg(F.min(F.struct("doc", "line")).alias("first"), F.count("*").alias("copies"))
    repeated = stored(classes.filter("copies > 1").select("g1", "g2", "first"), "line-copies")
    copied = lines.select("doc", "line", "g1", "g2").join(repeated, ["g1", "g2"])
    copied = stored(copied.filter((F.col("doc") != F.col("first.doc")) | (F.col("line") != F.col("first.line"))).select("doc", "line").distinct(), "line-repeats")

    def can_match(x: str, y: str) -> Column:
        """y is earlier, and length, position and parities leave room for the overlap."""
        c = lambda side, name: F.col(f"{side}.{name}")
        earlier = (c(y, "doc") < c(x, "doc")) | ((c(y, "doc") == c(x, "doc")) & (c(y, "line") < c(x, "line")))
        lengths = 100 * F.least(c(x, "n"), c(y, "n")) >= percent * F.greatest(c(x, "n"), c(y, "n"))
        apart = F.bit_count(c(x, "even").bitwiseXOR(c(y, "even"))) + F.bit_count(c(x, "odd").bitwiseXOR(c(y, "odd")))
        close = (100 + percent) * apart <= (100 - percent) * (c(x, "n") + c(y, "n"))
        return earlier & lengths & _similar(c(x, "n"), c(y, "n"), F.least(c(x, "rest"), c(y, "rest")), percent) & close

    # Only the first line of a class has postings. Of each token two lead: the first line, and the one
    # with the fewest rarer tokens ahead, which is the plainest of a group of edited copies.
    firsts = lines.join(copied, ["doc", "line"], "left_anti")
    postings = firsts.select("doc", "line", "n", "even", "odd", F.posexplode("prefix").alias("pos", "token")).withColumn("rest", F.col("n") - F.col("pos"))
    own = ["doc", "line", "n", "rest", "even", "odd"]
    # One shuffle of the postings by token: the leaders are window aggregates over it, not an
    # aggregate joined back, which shuffled the postings twice and wide partial rows besides. The
    # explicit repartition keeps the window's struct inputs out of the shuffled rows.
    by_token = Window.partitionBy("token")
    leaders = postings.repartition("token").select(
        "token", *own, F.count("*").over(by_token).alias("held"),
        F.min(F.struct(*own)).over(by_token).alias("first"), F.min(F.struct("pos", *own)).over(by_token).alias("plain"),
    ).filter("held > 1")
    is_same = lambda y: (F.col("x.doc") == F.col(f"{y}.doc")) & (F.col("x.line") == F.col(f"{y}.line"))
    tried_with = lambda y: F.when(can_match("x", y), F.struct(F.col(f"{y}.doc").alias("to_doc"), F.col(f"{y}.line").alias("to_line")))
    shared = stored(
        leaders.alias("x").select(
            "token", *own, "held", (is_same("first") | is_same("plain")).alias("leads"),
            tried_with("first").alias("to_first"), tried_with("plain").alias("to_plain"),
        ),
        "line-postings",
    )
    discard(lines, repeated)
    pairs = shared.filter("to_first is not null or to_plain is not null").select("doc", "line", F.explode(F.array("to_first", "to_plain")).alias("to"))
    tried = stored(pairs.filter("to is not null").select("doc", "line", "to.*").distinct(), "line-tries")
    near = _verified(docs, tried, percent, tokens_of)
    # A token of two lines has no pair but with its first.
    open_tokens = shared.filter("held > 2")
    left = open_tokens.join(near, ["doc", "line"], "left_anti").alias("x")
    others = open_tokens.filter("not leads").alias("y")
    rest = left.join(others, "token").filter(can_match("x", "y"))
    rest = rest.select(F.col("x.doc").alias("doc"), F.col("x.line").alias("line"), F.col("y.doc").alias("to_doc"), F.col("y.line").alias("to_line")).distinct()
    rest = stored(rest.join(tried, ["doc", "line", "to_doc", "to_line"], "left_anti"), "line-rest")
    more = _verified(docs, rest, percent, tokens_of)
    found = stored(copied.unionByName(near).unionByName(more).distinct(), "line-matches")
    discard(copied, shared, tried, near, rest, more)
    return found


def _tokens_of(docs: DataFrame, wanted: DataFrame, tokens_of: Callable[[Column], Column]) -> DataFrame:
    """doc, line, tokens of the lines in ``wanted``, from the texts."""
    wanted = stored(wanted.groupBy("doc").agg(F.array_sort(F.collect_set("line")).alias("wanted")), "line-wanted")
    size = wanted.agg(F.coalesce(F.sum(64 + 8 * F.size("wanted")), F.lit(0)).alias("bytes")).first()["bytes"]
    side = F.broadcast(wanted) if size <= BROADCAST_BYTES else wanted
    own = let(F.split("text", "\n"), lambda lines: F.transform("wanted", lambda i: F.struct(i.alias("line"), F.get(lines, i).alias("content"))))
    lines = docs.join(side, "doc").select("doc", F.explode(own).alias("z"))
    return lines.select("doc", "z.line", tokens_of(F.col("z.content")).alias("tokens")).filter("tokens is not null")


def _verified(docs: DataFrame, pairs: DataFrame, percent: int, tokens_of: Callable[[Column], Column]) -> DataFrame:
    """(doc, line) of the pairs' later lines whose sets are similar enough."""
    other = pairs.select(F.col("to_doc").alias("doc"), F.col("to_line").alias("line"))
    sets = stored(_tokens_of(docs, pairs.select("doc", "line").unionByName(other), tokens_of), "line-sets")
    to_sets = sets.select(F.col("doc").alias("to_doc"), F.col("line").alias("to_line"), F.col("tokens").alias("to_tokens"))
    both = F.size(F.array_intersect("tokens", "to_tokens"))
    near = pairs.join(to_sets, ["to_doc", "to_line"]).join(sets, ["doc", "line"])
    near = near.filter(_similar(F.size("tokens"), F.size("to_tokens"), both, percent))
    found = stored(near.select("doc", "line").distinct(), "line-near")
    discard(sets)
    return found


def _removed_numbers(rows: DataFrame, text: str, percent: int, shingle: int, short: bool) -> DataFrame:
    found = matched_lines(rows, KEY, text, percent, shingle, short)
    return found.groupBy(F.col("doc").alias(KEY)).agg(F.array_sort(F.collect_set("line")).alias("removed"))


def line_report(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT, shingle: int = SHINGLE, short: bool = True) -> DataFrame:
    """One row per input row: doc_id, n_lines, n_removed, removed (line numbers from 0, comma-joined).

    A null or empty text has one empty line and loses nothing; an empty table gives an empty result.
    Rows without an id come after all others. Rows that share an id are documents of their own, in
    the order of the input.
    """
    rows = keyed(documents, doc_id)
    removed = _removed_numbers(rows, text, percent, shingle, short)
    lines = F.size(F.split(F.coalesce(F.col(text), F.lit("")), "\n")).cast("long")
    docs = rows.select(F.col(doc_id).alias("doc_id"), KEY, lines.alias("n_lines"))
    out = docs.join(removed, KEY, "left")
    return out.select(
        "doc_id", "n_lines", F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce(F.array_join(F.col("removed").cast("array<string>"), ","), F.lit("")).alias("removed"),
    )


def deduplicated_documents(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT, shingle: int = SHINGLE, short: bool = True) -> DataFrame:
    """``documents`` without their removed lines, all other columns as they are.

    A document whose words are all in removed lines goes; texts that lose nothing are unchanged.
    """
    rows = keyed(documents, doc_id)
    removed = _removed_numbers(rows, text, percent, shingle, short).withColumnRenamed("removed", "__curbstar_removed")
    joined = rows.join(removed, KEY, "left")
    kept = let(
        F.split(F.col(text), "\n"),
        lambda lines: F.array_join(F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("__curbstar_removed")), lambda i: F.get(lines, i)), "\n"),
    )
    out = joined.withColumn(text, F.when(F.col("__curbstar_removed").isNull(), F.col(text)).otherwise(kept))
    return out.filter(F.col("__curbstar_removed").isNull() | F.col(text).rlike("[^\\x20\\x09-\\x0D]")).select(*documents.columns)
