"""The numbered operators against plain Python, on given documents and on hand-made rows."""

import collections
import gzip
import random

import brute
import pytest
from pyspark.sql import functions as F

from curbstar.llm import decontaminate, licenses, line_dedup, main_text, mixing, ngram_join, pii, quality, token_counts, warc
from curbstar.sources.scratch import scratch_path

SCHEMA = "doc_id long, text string, source string, row string, n long, token string"
ODD = [
    (None, "a null id, and a text of some words that goes on"),
    (9001, None),
    (9002, ""),
    (9003, " \n\t \x0b\n"),
    (9004, "one two three four"),
    (9005, "one two three four"),
    (9006, "ONE two three FOUR"),
    (9007, "long " * 30_000),
    (9008, "é😀漢字\n" * 50),
    (9009, "a b c d e f g h\na b c d e f g h\nx"),
    (9010, "a b c d e f g h i j k l m n o p q r s t u v w x y z"),
    (9011, "a b c d e f g h i j k l m n o p q r s t u v w x y ZZ"),
]


def near_copies(count, words, edits, seed):
    """Texts that differ from one base in a few words each."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(10**6)}" for _ in range(words)]
    out = []
    for i in range(count):
        own = list(base)
        for _ in range(rng.randrange(edits + 1)):
            own[rng.randrange(words)] = f"e{rng.randrange(10**6)}"
        out.append((20_000 + 1_000 * seed + i, " ".join(own)))
    return out


@pytest.fixture(scope="module")
def rows(spark, sf_dir):
    given = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    return [tuple(r) for r in given] + ODD + near_copies(120, 60, 3, 1) + near_copies(40, 200, 12, 2)


@pytest.fixture(scope="module")
def docs(spark, rows):
    """Documents in several partitions, with further columns whose names the operators use inside."""
    full = [(d, t, None if d is None else f"s{d % 5}", "x", 1, "y") for d, t in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(6)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def same(df, want, *columns):
    got = sorted(map(str, (tuple(r) for r in df.select(*columns).collect())))
    assert got == sorted(map(str, want))


def test_linked_documents(docs, rows):
    same(ngram_join.linked_documents(docs), brute.linked(rows), "doc_id", "n_shingles", "component_id")


def test_linked_documents_with_tokens_beyond_the_counted(docs, rows, monkeypatch):
    monkeypatch.setattr(ngram_join, "MANY", 3)
    monkeypatch.setattr(ngram_join, "BATCH_WORDS", 2_000)
    same(ngram_join.linked_documents(docs), brute.linked(rows), "doc_id", "n_shingles", "component_id")


def test_repeated_rows_link(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (2, "q"), (None, "r"), (None, "r")]
    same(ngram_join.linked_documents(spark.createDataFrame(rows, "doc_id long, text string")), brute.linked(rows), "doc_id", "n_shingles", "component_id")


@pytest.mark.parametrize("frequent", [0, 64, 1 << 16])
def test_removed_lines(docs, rows, monkeypatch, frequent):
    monkeypatch.setattr(line_dedup, "FREQUENT_TOKENS", frequent)
    want = brute.removed_lines(rows)
    report = line_dedup.line_report(docs).collect()
    assert {(r["doc_id"], int(i)) for r in report for i in r["removed"].split(",") if i} == want
    assert len(report) == len(rows)
    assert sum(r["n_removed"] for r in report) == len(want)


def word_set_copies(rows, percent=80):
    """{(doc_id, line)} with an earlier line of similar word sets."""
    lines, out = [], set()
    for d, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        for i, line in enumerate((text or "").split("\n")):
            own = set(brute.space_words(line.lower()))
            if any(100 * len(own & x) >= percent * len(own | x) for x in lines if own and 100 * min(len(own), len(x)) >= percent * max(len(own), len(x))):
                out.add((d, i))
            lines.append(own)
    return out


@pytest.mark.parametrize("shingle", [1, 5])
def test_removed_lines_by_words_and_by_shingles(spark, rows, monkeypatch, shingle):
    """A line of 20 words with one changed in the middle has word Jaccard 19/21, shingle Jaccard 11/21."""
    monkeypatch.setattr(line_dedup, "RANK_SLOTS", 64)
    base = [f"v{i}" for i in range(20)]
    own = rows[:40] + ODD + [(1, " ".join(base)), (2, " ".join([*base[:10], "other", *base[11:]]))]
    own = [(d, t) if d is None else (d + 100_000 * (k >= len(own) - 2), t) for k, (d, t) in enumerate(own)]
    want = word_set_copies(own) if shingle == 1 else brute.removed_lines(own, k=5)
    assert ((100_002, 0) in want) == (shingle == 1)
    report = line_dedup.line_report(spark.createDataFrame(own, "doc_id long, text string"), shingle=shingle).collect()
    assert {(r["doc_id"], int(i)) for r in report for i in r["removed"].split(",") if i} == want


def test_removed_lines_of_rows_that_share_an_id(spark):
    a, b, c = "a b c d e f g h", "the own line of a row goes on", "here is one more line of words"
    rows = [(None, f"{b} 1\n{a}"), (None, f"{c} 2 3 4\n{a}"), (7, f"x\n{c}"), (7, f"x\n{c}"), (None, "z\nz"), (3, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0, k))
    gone = brute.removed_lines([(at, rows[k][1]) for at, k in enumerate(order)])
    want = [(rows[k][0], ",".join(str(i) for d, i in sorted(gone) if d == at)) for at, k in enumerate(order)]
    assert {(None, "0,1"), (None, "1"), (None, ""), (7, "0,1"), (7, "")} <= set(want)
    same(line_dedup.line_report(docs), want, "doc_id", "removed")


def test_short_lines_are_compared_as_a_whole(spark):
    rows = [(1, "All rights reserved.\nown"), (2, "all  rights RESERVED.\n\n "), (3, "All rights\n\n"), (4, "own"), (5, None), (6, "a b c d e f"), (7, "a b c d e f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    removed = lambda **options: {(r["doc_id"], r["removed"]) for r in line_dedup.line_report(docs, **options).collect() if r["removed"]}
    assert removed(shingle=5, short=False) == {(7, "0")}
    assert removed(shingle=5) == {(2, "0"), (4, "0"), (7, "0")}
    assert removed() == {(2, "0"), (4, "0"), (7, "0")}


def test_deduplicated_documents_keep_order_and_columns(docs, rows):
    gone = brute.removed_lines(rows)
    want = []
    for d, text in rows:
        lines = (text or "").split("\n")
        left = [x for i, x in enumerate(lines) if (d, i) not in gone]
        if len(left) == len(lines):
            want.append((d, text))
        elif brute.space_words("\n".join(left)):
            want.append((d, "\n".join(left)))
    out = line_dedup.deduplicated_documents(docs)
    assert out.columns == docs.columns
    same(out, want, "doc_id", "text")


def test_contamination(spark, docs, rows):
    items = [(1, " ".join(brute.plain_words(rows[3][1])[5:40])), (2, "one two three"), (None, "c d e f g h"), (3, None), (4, ""), (2, "x y z x y z x y z x y z x y z"), (5, "漢字")]
    benchmark = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, row int")
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    want = brute.contamination(rows, items)
    same(decontaminate.contamination(decontaminate.matched_documents(docs, benchmark)), want, *columns)
    assert sum(w[2] > 0 for w in want) > 3


def test_contamination_in_blocks(spark, docs, rows, sf_dir, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 3_000)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    want = brute.contamination(rows, [tuple(r) for r in benchmark.select("item_id", "text").collect()])
    got = decontaminate.contamination(decontaminate.matched_documents(docs, benchmark))
    same(got, want, "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def test_a_benchmark_without_items_hits_nothing(spark, docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination(decontaminate.matched_documents(docs, none)).filter("n_hit > 0").count() == 0


def test_every_span_of_a_window_is_found():
    """Winnowing keeps a fingerprint of every run of 13 words."""
    rng = random.Random(5)
    for _ in range(200):
        words = [str(rng.randrange(4)) for _ in range(13)]
        block = decontaminate.build_block([(1, " ".join(words))], 13, 5)
        runs = decontaminate.WordRuns([[w.encode() for w in brute.plain_words("q r s " + " ".join(words) + " t u")]])
        ((_, starts, _),) = decontaminate._hit_windows(runs, block, 13, 5)
        assert 3 in starts.tolist()


def test_quality_counts(docs, rows):
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    same(quality.judged_documents(docs), brute.quality(rows), *columns)


def test_quality_counts_of_long_texts(docs, rows, monkeypatch):
    monkeypatch.setattr(quality, "PACKED_WORDS", 16)
    same(quality.judged_documents(docs), [(w[0], w[5]) for w in brute.quality(rows)], "doc_id", "n_repeat_words")


def test_quality_agrees_with_labels(spark, sf_dir):
    judged = quality.judged_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    found = [tuple(r) for r in judged.filter("not base_failed").join(labels, "doc_id").select("kept", "quality").collect()]
    assert found and sum(k == bool(q) for k, q in found) >= 0.9 * len(found)
    assert all(k for k, q in found if q)


def test_no_vote_against_a_document_keeps_it():
    for patterns in ([((1, 1), 5), ((-1, 1), 90)], [((0, 0), 3), ((-1, -1), 500)], [((1, 0), 1)]):
        model = quality.fit(patterns)
        assert all(model.posterior(v) >= 0.5 for v in [(1, 1), (1, 0), (0, 0)])
        assert all(bad <= 1e-9 <= good + 1e-9 for good, bad in model.weights())


def test_mixing(spark, docs, rows):
    out = mixing.mixed_documents(docs)
    got = [r.asDict() for r in out.collect()]
    sizes = collections.Counter()
    for d, text in rows:
        sizes[None if d is None else f"s{d % 5}"] += len(brute.space_words(text))
    want = brute.mix_targets(sizes)
    taken = collections.Counter()
    for r in got:
        assert r["target"] == pytest.approx(want[r["source"]])
        assert r["source_size"] == sizes[r["source"]]
        assert r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    assert len(got) == len(rows)
    assert all(abs(taken[s] - want[s]) <= 1 for s in want)
    again = mixing.mixed_documents(docs.repartition(3))
    same(again, [(r["doc_id"], r["size"], r["taken"]) for r in got], "doc_id", "size", "taken")


def test_mixing_reshares_what_is_above_the_cap(spark):
    rows = [(i, "w " * n, s) for i, (n, s) in enumerate([(2, "a"), (3, "b"), (300, None), (5, "c"), (0, "d")])]
    out = mixing.mixed_documents(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert {r["source"]: (r["target"], r["taken"]) for r in out} == {"a": (6.0, 6), "b": (9.0, 9), "c": (15.0, 15), "d": (0.0, 0), None: (280.0, 280)}


PERSONAL = [
    (1, "a@b.c_d@e.f x@y..z a@b@c.d a@@b.c .@-.-"),
    (2, "1.2.3.4.5.6.7.8 1.2.3 256.1.1.1 0255.1.1.01 1..2.3.4.5"),
    (3, "é😀 4111 1111 1111 1111 4111-1111-1111-1111  4111  1111"),
    (4, "+1 (555) 123-4567. +12 +1234567 +1-2-3-4-5-6-7-8- +++49 30 123456"),
    (5, "9" * 30_000 + " " + "a" * 30_000 + "@" + "b." * 30_000),
    *((10 + i, f"contact badge: 10.0.0.{i} ok badge: u{i}@mail.de") for i in range(4)),
    (20, "his badge: QX-99812 here"),
    (21, "the year 20241 and number 555123"),
]


def test_personal_data(spark, rows):
    both = rows + PERSONAL
    out = pii.span_report(spark.createDataFrame(both, "doc_id long, text string"))
    same(out, brute.personal(both), "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256")
    spans = {r["doc_id"]: r["spans"] for r in out.filter("n_context > 0").collect()}
    assert spans == {20: "context:11:19"}


def test_contexts_accept_what_is_unseen(spark):
    """More unseen codes than seeds, punctuation between word and code, a second round through a new
    pattern; years and numbers next to plain words are none."""
    rows = [(i, f"contact badge: u{i}@mail.de now") for i in range(4)] + [(10 + i, f"his badge: QX-99{800 + i} here") for i in range(10)]
    rows += [(30 + i, f"see ID:(10.1.2.{i}) there") for i in range(3)] + [(40 + i, f"see ID:(ZK-5{4000 + i}) there") for i in range(5)]
    rows += [(50 + i, f"pass QX-99{800 + i}") for i in range(4)] + [(54, "pass LM-77001")]
    rows += [(60 + i, f"in the year {20000 + i} and the number {555000 + i} of the plain words") for i in range(8)]
    out = pii.span_report(spark.createDataFrame(rows, "doc_id long, text string")).filter("n_context > 0").collect()
    assert {r["doc_id"] for r in out} == {*range(10, 20), *range(40, 45), *range(50, 55)}
    assert {r["spans"] for r in out if 40 <= r["doc_id"] < 45} == {"context:8:16"}


def test_license_phrases(docs, rows, spark):
    both = rows + [(1, "CC-BY-NC cc by nc by nc. under the MIT license under the mit license"), (2, "Apache License, Version 2.0")]
    report = licenses.license_report(spark.createDataFrame(both, "doc_id long, text string"))
    same(report, brute.license_base(both), "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")


def test_license_templates_survive_edits(spark):
    grant = dict(reversed(licenses.TEMPLATES))["isc"].split()
    edited = grant[:8] + ["really"] + grant[8:20] + grant[21:]
    rows = [(1, "x y " + " ".join(edited) + " z"), (2, " ".join(grant[:6])), (3, "licensed under the GNU General Public License, version 3"), (4, "clean text of some words")]
    out = licenses.license_report(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r["doc_id"]: (r["labels"], round(r["score"], 2)) for r in out.collect()}
    assert got[1][0] == "isc" and got[1][1] > 0.8
    assert (got[2], got[3], got[4]) == (("", 0.0), ("gpl-3", 1.0), ("", 0.0))


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_token_counts(docs, rows, rule):
    with open(token_counts.VOCABULARY, "rb") as file:
        encoding, _ = token_counts._encoding(file.read(), token_counts.PATTERN)
    want = []
    for d, text in rows:
        lines = (text or "").split("\n")
        lines = [x + "\n" for x in lines[:-1]] + lines[-1:]
        owner = [i for i, x in enumerate(lines) for _ in x.encode()]
        counts, crossing, at, begin = [0.0] * len(lines), [0] * len(lines), 0, 0
        for token in encoding.encode_ordinary(text or ""):
            own = owner[at : (at := at + len(encoding.decode_single_token_bytes(token)))]
            touched = sorted(set(own))
            for i in touched if len(touched) > 1 else ():
                crossing[i] += 1
            if rule == "share":
                for i in touched:
                    counts[i] += own.count(i) / len(own)
            else:
                counts[{"start": own[0], "end": own[-1], "largest": max(touched, key=lambda i: (own.count(i), -i))}[rule]] += 1
        for i, x in enumerate(lines):
            want.append((d, i, begin, begin + len(x), round(counts[i], 6), crossing[i]))
            begin += len(x)
    got = [(*tuple(r)[:4], round(r["n_tokens"], 6), r["n_crossing"]) for r in token_counts.section_tokens(docs, rule=rule).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))


PAGES = [
    (None, "x y\nz", "a"), (900, None, None), (901, "", ""), (902, "http://WWW.a.org:80/p?q=1", "é\r\n\r\nWARC/1.1"),
    (903, "http://a.org/p?q=1", "é\r\n\r\nWARC/1.1"), (904, "http://a.org/p?q=1", "other"), (904, "http://a.org/p?q=1", "other"),
]


def test_archives_round_trip(spark, sf_dir):
    given = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html").collect()]
    rows = given + PAGES + [(p and p + 5000, u, h) for p, u, h in given[::3]]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, sha int").repartition(4)
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    same(warc.archive_report(pages), brute.archived([(p, h) for p, _, h in rows]), *columns)
    root = scratch_path(spark, "warc-test")
    captures = warc.written_archives(pages, f"{root}/archives", file_bytes=20_000)
    blocks = warc.write_index(captures, f"{root}/index", block_lines=7)
    assert captures.select("path").distinct().count() > 4 and blocks.count() > 10
    payloads = {(p, h) for p, _, h in rows}
    for r in warc.read_archives(captures, with_payload=True).filter("record_type = 'response'").collect():
        assert (r["page_id"], bytes(r["payload"]).decode()) in payloads or not r["payload_bytes"]
    keys = collections.Counter(warc.url_key(u) for _, u, _ in rows)
    asked = spark.createDataFrame([(u,) for _, u, _ in rows if u] + [("http://none.org/",)], "url string").distinct()
    found = collections.Counter(r["asked"] for r in warc.lookup(spark, blocks, asked).collect())
    assert found == {r["url"]: keys[warc.url_key(r["url"])] for r in asked.collect() if warc.url_key(r["url"]) in keys}


def test_report_writes_no_index_that_nothing_reads(spark, monkeypatch):
    def unread(*_, **__):
        raise AssertionError("the report does not read an index")

    monkeypatch.setattr(warc, "write_index", unread)
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "v", "ab")], "page_id long, url string, html string")
    same(warc.archive_report(pages), [(1, "revisit", 2), (2, "response", None)], "page_id", "record_type", "refers_to")


def test_the_report_reads_what_its_index_leads_to(spark, monkeypatch, tmp_path):
    """The index of a report holds a line for each row, and a row whose line is lost is not reported."""
    monkeypatch.setattr(warc, "scratch_path", lambda *_: str(tmp_path / "report"))
    rows = PAGES + [(i, f"http://b.org/{i}", f"<p>{i % 5}</p>") for i in range(60)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    want = brute.archived([(p, h) for p, _, h in rows])
    same(warc.archive_report(pages), want, *columns)
    files = sorted((tmp_path / "report/index").glob("*.cdx.gz"))
    lines = [line for f in files for line in gzip.decompress(f.read_bytes()).decode().splitlines()]
    assert sorted(line.partition(" ")[0] for line in lines) == sorted(warc.url_key(u) for _, u, _ in rows)
    assert all((f.parent / f"{f.name}.dir").exists() for f in files)
    read, lost = warc.read_archives, warc.url_key("http://b.org/7")
    monkeypatch.setattr(warc, "scratch_path", lambda *_: str(tmp_path / "lost"))
    monkeypatch.setattr(warc, "read_archives", lambda captures: read(captures.filter(F.col("key") != lost)))
    same(warc.archive_report(pages), [w for w, r in zip(want, rows) if r[1] != "http://b.org/7"], *columns)


def test_an_index_read_back_names_all_captures(spark, tmp_path):
    pages = spark.createDataFrame(PAGES + [(i, f"u{i % 9}", "x" * i) for i in range(50)], "page_id long, url string, html string")
    captures = warc.written_archives(pages, str(tmp_path / "archives"), file_bytes=2_000)
    columns = ["key", "page_id", "record_type", "digest", "path", "offset", "length"]
    found = warc.indexed_captures(captures, str(tmp_path / "index"), block_lines=4)
    same(found, [tuple(r) for r in captures.select(*columns).collect()], *columns)
    cut = found.withColumn("length", F.col("length") - 1)
    with pytest.raises(Exception, match="no whole member"):
        warc.read_archives(cut).collect()


def test_shorter_payloads_are_all_responses(spark):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")], "page_id long, url string, html string")
    captures = warc.written_archives(pages, scratch_path(spark, "warc-short"), least_bytes=3)
    same(captures, [(1, "response"), (2, "response"), (3, "revisit"), (4, "response")], "page_id", "record_type")


LONG = "The cat of the house is in the garden and it was on a mat for the whole of that day, which is what it does at all times of the year in this town."


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""),
        ("", ""),
        ("<html><nav><a href=/>Home</a></nav><article><h1>T &amp; U</h1><p>One&nbsp; two<br>three<p>four</article><footer>f</footer>", "T & U\n\nOne two three\n\nfour"),
        (f"<div class='cookie-notice'>We use</div><header>H</header><div><p>{LONG}</p><p>Short.<p><a href=x>link only</a></div><aside>s</aside>", f"{LONG}\n\nShort."),
        ("<div><p>Only short</p></div>", ""),
        ("<article>a<script>if (x < 1) '</p>'</script>b<section class=comments><p>c</p></section>d<form>e</form><!-- f -->g", "ab\n\nd\n\ng"),
        ("<main>a < b &lt;i&gt; &amp;amp; <b>c</b> &am", "a < b <i> &amp; c &am"),
        ("<article>cut <a href=\"x", "cut"),
    ],
)
def test_main_text(page, text):
    assert main_text.main_text(page)[0] == text


@pytest.mark.parametrize(
    "page, text",
    [
        (f"<article><p>Teaser</p></article><div><p>{LONG}</p><p>{LONG}</p></div>", f"Teaser\n\n{LONG}\n\n{LONG}"),
        (f"<article><p>{LONG}</p><p>Short.</p><p><a href=x>one link</a> <a href=y>two links</a></p></article><p>Outside</p>", f"{LONG}\n\nShort."),
        (f"<article><p>{LONG}</p><p>{'Tag2024 ' * 30}</p></article>", LONG),
        (f"<article><p>{LONG}</p></article><div class='comments'><article>{LONG}</article></div><div id='sidebar-left'><article>{LONG}</article></div>", LONG),
        (f"<article><p>{'漢字' * 100}</p><p><a href=x>link</a></p></article>", "漢字" * 100),
        (f"<div class='with-sidebar'><article><p>{LONG}</p></article></div>", LONG),
        (f"<div class='sidebar'><main><p>{LONG}</p></main></div>", LONG),
    ],
)
def test_main_text_by_all_signals(page, text):
    assert main_text.main_text(page)[0] == text


def test_extracted_pages(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    got = main_text.extracted_pages(pages)
    want = [(r["page_id"], r["url"], main_text.main_text(r["html"])[0]) for r in pages.collect()]
    same(got, [(*w, len(w[2])) for w in want], "page_id", "url", "text", "n_chars")
    assert all(w[2] for w in want)


def test_empty_tables_give_empty_results(spark, empty):
    none = spark.createDataFrame([], "item_id long, text string")
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    for out in (
        ngram_join.linked_documents(empty), line_dedup.line_report(empty), line_dedup.deduplicated_documents(empty),
        decontaminate.contamination(decontaminate.matched_documents(empty, none)), quality.judged_documents(empty), mixing.mixed_documents(empty),
        pii.span_report(empty), licenses.license_report(empty), token_counts.section_tokens(empty), warc.archive_report(pages), main_text.extracted_pages(pages),
    ):
        assert out.count() == 0


def test_captures_of_urls_that_are_none_or_hold_spaces(spark):
    """Keys sort as they are stored, and a text that is no URL has one."""
    urls = [f"http://a.org/{i}{c}x" for i in range(40) for c in (" ", "", " ", "~")]
    urls += ["http://[abc", "http://]x/", "", None, "no url at all", "http://a.org/\r\n9", "http://[::1]/x"]
    rows = [(i, u, f"<p>{i % 7}</p>") for i, u in enumerate(urls)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert warc.archive_report(pages).count() == len(rows)
    root = scratch_path(spark, "test-warc")
    captures = warc.written_archives(pages, f"{root}/archives")
    blocks = warc.write_index(captures, f"{root}/index", 5)
    found = collections.Counter(r["asked"] for r in warc.lookup(spark, blocks, pages.select("url")).collect())
    keys = collections.Counter(warc.url_key(u) for u in urls)
    assert found == collections.Counter({u: keys[warc.url_key(u)] for u in urls})


def test_mixing_of_rows_that_share_an_id_does_not_follow_the_split(spark):
    rows = [(i % 3, " ".join(["w"] * (1 + i % 9)) + f" t{i}", "s") for i in range(90)] + [(5, "word " * 400, "t")]
    taken = []
    for parts in (1, 4, 7):
        df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(parts, "text")
        mixed = mixing.mixed_documents(df)
        taken.append(sorted(map(tuple, mixed.select("doc_id", "size", "source_size", "target", "taken").collect())))
    assert taken[0] == taken[1] == taken[2]
