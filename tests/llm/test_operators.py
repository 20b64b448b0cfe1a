"""Operators against plain Python and edge cases on small frames."""

import random
import re
import textwrap
import tracemalloc
from itertools import groupby
from pathlib import Path

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from offerloom.llm import (
    components,
    decontamination,
    exact_dedup,
    licences,
    near_dedup,
    passages,
    pieces,
    quality,
    queries,
    quotes,
    site_lines,
    urls,
)

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
HARD = [None, "", " \n\t ", "é", "One two three.", "x" * 5000, "the of and to in is " * 40, "a b c d e\n" * 30]


@pytest.fixture(scope="module")
def docs(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


@pytest.fixture(scope="module")
def plain(docs):
    return [(r["doc_id"], r["text"]) for r in docs.collect()]


@pytest.fixture(scope="module")
def hard(spark):
    """Nulls, empty and long texts, repeated rows, null ids, and columns with clashing names."""
    rows = [(k, t, None, None, None) for k, t in enumerate(HARD)]
    rows += [(4, "One two three.", "en", "s", 1), (None, "one TWO three.", None, None, None)]
    df = spark.createDataFrame(rows, DOCS)
    extra = "kept text_a runs items content prefix row normal id keep_id votes score component_id _row".split()
    return df.select("*", *[F.lit(1).alias(name) for name in extra])


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def items(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "item_id bigint, text string")


# decontamination


@pytest.mark.parametrize("max_windows", [decontamination.MAX_WINDOWS, 40])
def test_contamination_is_brute_force(spark, folder, docs, plain, max_windows):
    bench = spark.read.parquet(f"{folder}/benchmark.parquet")
    want = brute.contamination(plain, [(r["item_id"], r["text"]) for r in bench.collect()])
    got = decontamination.report(decontamination.contamination(docs, bench, max_windows=max_windows)).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_hit"], r["items_sha256"]) for r in got} == {
        d: (n, hit, brute.sha(",".join(own))) for d, (n, hit, own) in want.items()
    }
    assert any(r["contaminated"] for r in got)


def test_short_items_and_spans(spark, hard):
    bench = items(spark, "two THREE", None, "", "one two three", "nothing here")
    found = decontamination.contamination(hard, bench)
    row = found.filter("doc_id = 4").first()
    assert row["items"] == ["0", "3"] and [tuple(r) for r in row["runs"]] == [(0, 3)]
    clean = decontamination.remove_spans(decontamination.contamination(hard, items(spark, "two"))).filter("doc_id = 4")
    assert clean.first()["clean_text"] == "One  three."
    assert found.count() == hard.count()
    left = decontamination.drop_contaminated(hard, bench)
    assert left.columns == hard.columns and left.count() == hard.count() - 3
    assert decontamination.drop_contaminated(hard, items(spark)).count() == hard.count()


# pieces


def test_pieces_equal_the_library(docs, plain, hard):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=queries.piece_model())
    for frame, rows in ((docs, plain), (hard, [(r["doc_id"], r["text"]) for r in hard.collect()])):
        got = {r["doc_id"]: (r["ids"], r["decoded"]) for r in pieces.encode(frame, queries.piece_model()).collect()}
        for doc, text in rows:
            if doc is not None:
                ids = library.encode(text or "")
                assert got[doc] == (ids, library.decode(ids))


def test_pieces_on_random_text():
    with open(queries.piece_model(), "rb") as file:
        own = pieces.Pieces(file.read())
    rng = random.Random(3)
    letters = "ab the ing▁  \x00\n\té汉字😀́<s></s><0x41>., ​"
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 60))) for _ in range(2000)] + ["a" * 3000, " " * 3000]
    coded = own.encode(texts)
    for text, ids in zip(texts, coded):
        ids = np.frombuffer(ids, np.int32)
        assert ids.tolist() == own.library.encode(text)
        assert own.decode(ids).decode() == own.library.decode(ids.tolist())
    for _ in range(2000):
        ids = [rng.randrange(260) if rng.random() < 0.5 else rng.randrange(32000) for _ in range(rng.randint(0, 9))]
        assert own.decode(np.array(ids, np.int32)).decode() == own.library.decode(ids)


def test_pieces_refuse_another_result():
    with open(queries.piece_model(), "rb") as file:
        own = pieces.Pieces(file.read())
    with pytest.raises(ValueError, match="is not"):
        own.compare(["▁the"], {"▁the": b"\0\0\0\0"})


# exact dedup


def test_exact_is_brute_force(docs, plain):
    got = {r["doc_id"]: (r["keep_id"], r["group_size"]) for r in exact_dedup.report(docs).collect()}
    assert got == brute.exact(plain)


def test_colliding_hashes_do_not_merge(docs, plain):
    weak = exact_dedup.copies(docs, ["doc_id"], digest=lambda text: F.length(text) % 7)
    got = {r["row"]["doc_id"]: (r["keep_id"], r["group_size"]) for r in weak.collect()}
    assert got == brute.exact(plain)


def test_exact_edges(hard, none):
    kept = exact_dedup.exact_dedup(hard)
    assert kept.columns == hard.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert 0 not in ids and 1 in ids and ids.count(4) == 2 and None not in ids
    assert exact_dedup.exact_dedup(none).count() == 0


# near dedup


@pytest.mark.parametrize("size", [4, 5])
def test_near_is_brute_force(docs, plain, size):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dedup.near_classes(docs, size).collect()}
    assert got == brute.near_components(plain, size)


def test_near_copies_of_one_text(spark):
    """The hardest case for a forest: hundreds of variants, many of them just at the threshold; none is missed."""
    rng = random.Random(9)
    base = [f"w{rng.randrange(5000)}" for _ in range(150)]
    rows = []
    for k in range(300):
        words = list(base)
        for _ in range(rng.randrange(0, 6)):
            words[rng.randrange(len(words))] = f"n{k}"
        rows.append((k, " ".join(words)))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dedup.near_classes(frame, 4).collect()}
    assert got == brute.near_components(rows, 4)


def test_near_crowds_of_two_templates(spark):
    """Rows of one component do not meet; every pair of two components that sizes and places allow does, once a shingle."""
    rng = random.Random(3)
    rows = []
    for shingle in range(40):
        for i in rng.sample(range(60), rng.randrange(1, 30)):
            rows.append((shingle, i, rng.randrange(1, 12) * 9, rng.randrange(0, 5), 0 if i < 35 else i // 5))
    rows += [(99, i, 50, 0, 7) for i in range(500)]
    for percent in (80, 100):
        want = []
        for x in rows:
            for y in rows:
                room = min(x[2] - x[3], y[2] - y[3])
                if x[0] == y[0] and x[1] < y[1] and x[4] != y[4] and (100 + percent) * room >= percent * (x[2] + y[2]):
                    want.append((x[1], y[1]))
        frame = spark.createDataFrame(rows, "shingle bigint, id bigint, n int, place int, component bigint")
        got = near_dedup.meetings(frame, percent)
        assert sorted((r["a"], r["b"]) for r in got.collect()) == sorted(want) and want


def test_near_range_ends(spark):
    """Pairs found do not depend on how many ranges the orders are cut into."""
    rng = random.Random(8)
    rows = []
    for k in range(60):
        words = [f"w{rng.randrange(10**6)}" for _ in range(40)]
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(words[:-1] + ["end"]))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    classes = near_dedup.sketches(docs, 4).withColumnRenamed("doc_id", "id").cache()
    shared = near_dedup.shared_prefixes(classes)
    found, before = [], {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        for parts in ("1", "97"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            found.append(sorted(map(tuple, near_dedup.candidates(classes, shared).collect())))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert found[0] == found[1] and len(found[0]) == 60


def test_near_id_types(spark):
    text = " ".join(f"w{k}" for k in range(50))
    for kind in ("int", "smallint"):
        found = near_dedup.near_classes(spark.createDataFrame([(5, text), (3, text + " x"), (9, "y")], f"doc_id {kind}, text string"), 4)
        assert found.schema["component_id"].dataType.simpleString() == kind
        assert {(r["doc_id"], r["component_id"]) for r in found.collect()} == {(5, 3), (3, 3), (9, 9)}
    with pytest.raises(TypeError):
        near_dedup.near_classes(spark.createDataFrame([("a", text)], "doc_id string, text string"), 4)


def test_near_edges(hard, none):
    rows = near_dedup.report(near_dedup.near_classes(hard, 4)).collect()
    assert len(rows) == hard.count()
    by = {r["doc_id"]: r for r in rows}
    assert by[0]["component_id"] == 0 and by[0]["n_shingles"] == 0 and by[2]["component_id"] == 2
    assert by[4]["component_id"] == 4 and by[None]["component_id"] is None and by[None]["kept"]
    assert near_dedup.near_dedup(hard).columns == hard.columns
    assert near_dedup.near_dedup(none).count() == 0


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(100, 180)] + [(rng.randrange(90), rng.randrange(90)) for _ in range(60)]
    edges += [(7, 7), (1, None), (300, 301), (301, 300)]
    got = {r["id"]: r["component"] for r in components.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if b is not None and a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    assert got == {x: find(x) for x in root}


# passages


def test_compact_windows_stand_for_all_subsequences():
    rng = np.random.default_rng(5)
    order = rng.integers(0, 2**64, 60, dtype=np.uint64)
    left, centre, right = passages.compact_windows(order, np.array([0, 25, 60]), 8)
    for first, end in ((0, 25), (25, 60)):
        for x in range(first, end):
            for y in range(x + 7, end):
                own = [(a, c, b) for a, c, b in zip(left, centre, right) if a <= x and y <= b and x <= c <= y]
                assert [c for _, c, _ in own] == [x + int(np.argmin(order[x : y + 1]))]


def test_repeated_passages(spark, hard, none):
    rng = random.Random(2)

    def prose(n):
        return [f"w{rng.randrange(10**6)}" for _ in range(n)]

    shared, edited = prose(60), prose(80)
    changed = list(edited)
    changed[40] = "other"
    short = prose(30)
    rows = [
        (1, prose(100) + shared + prose(50)),
        (2, shared + prose(20)),
        (3, prose(40) + edited),
        (4, changed + prose(5)),
        (5, prose(90) + short),
        (6, short + prose(90)),
        (7, prose(300)),
    ]
    frame = spark.createDataFrame([(k, " ".join(w)) for k, w in rows], "doc_id bigint, text string")
    found = passages.repeats(frame).collect()
    assert {(r["doc_id"], r["other_id"]) for r in found} == {(2, 1), (4, 3)}
    exact = next(r for r in found if r["doc_id"] == 2)
    assert (exact["first_word"], exact["last_word"], exact["other_first"], exact["similarity"]) == (0, 59, 100, 1.0)
    assert passages.repeats(none).count() == 0
    passages.repeats(hard).count()


def test_a_passage_cut_between_many_ranges_keeps_one_head(spark):
    rng = random.Random(8)
    shared = [f"s{rng.randrange(10**6)}" for _ in range(60)]
    rows = []
    for k in range(300):
        own = [f"w{rng.randrange(10**6)}" for _ in range(60)]
        rows.append((k, " ".join(own + shared if k % 3 == 0 else own)))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    settings = {"spark.sql.shuffle.partitions": "150", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        found = passages.repeats(frame).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert {(r["doc_id"], r["other_id"]) for r in found} == {(k, 0) for k in range(3, 300, 3)}


def test_exact_passages_with_hot_phrases_meet_behind_a_failed_head(spark):
    rng = random.Random(9)

    def prose(n):
        return [f"w{rng.randrange(10**6)}" for _ in range(n)]

    hot = [prose(19) for _ in range(40)]
    rows = [(k, prose(30) + hot[k] + prose(30)) for k in range(40)]
    pairs = set()
    for k in range(0, 40, 2):
        shared = prose(3) + hot[k] + prose(6) + hot[k + 1] + prose(3)
        pairs.add((100 + k, 101 + k))
        rows += [(100 + k, prose(70) + shared + prose(70)), (101 + k, shared + prose(20))]
    frame = spark.createDataFrame([(k, " ".join(w)) for k, w in rows], "doc_id bigint, text string")
    found = passages.repeats(frame).collect()
    assert {(r["other_id"], r["doc_id"]) for r in found} == pairs
    assert all(r["last_word"] - r["first_word"] == 49 and r["similarity"] == 1.0 for r in found)


# quality


def test_scorer_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    judged = quality.classify(docs).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").collect()
    right = sum(r["kept"] == (r["quality"] == 1) for r in judged) / len(judged)
    clean = [r["kept"] for r in judged if r["quality"] == 1]
    assert right > 0.95 and sum(clean) / len(clean) > 0.97


def test_estimate_finds_the_labellers():
    rng = random.Random(4)
    n = len(quality.LABELLERS)
    right = [0.95, 0.9, 0.85, 0.8, 0.9] + [0.7] * (n - 5)
    counts, truth = {}, {}
    for _ in range(20000):
        good = rng.random() < 0.8
        votes = "".join("jg"[good] if rng.random() < p else "gj"[good] for p in right)
        counts[votes] = counts.get(votes, 0) + 1
        truth[votes] = truth.get(votes, 0) + good
    posterior, behaviour = quality.estimate(counts)
    agree = sum(truth[v] if posterior[v] > 0.5 else counts[v] - truth[v] for v in counts) / 20000
    assert agree > 0.97
    assert all(abs(b["right_on_good"] - p) < 0.05 for b, p in zip(behaviour, right))


def test_a_bounded_sample_with_a_repeated_id(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    hot = docs.filter("doc_id = 3").withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(500)))).drop("copy")
    judged = quality.classify(docs.unionByName(hot), max_train=300).groupBy("doc_id").agg(
        F.count("*").alias("n"), F.countDistinct("score").alias("scores"), F.max("kept").alias("kept")
    )
    rows = {r["doc_id"]: r for r in judged.collect()}
    assert len(rows) == docs.count() and rows[3]["n"] == 501
    assert all(r["scores"] == 1 for r in rows.values())
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()
    assert sum(rows[r["doc_id"]]["kept"] == (r["quality"] == 1) for r in labels) / len(labels) > 0.9


def test_quality_edges(hard, none):
    rows = {r["doc_id"]: r for r in quality.classify(hard).collect()}
    assert rows[0]["score"] == 0.0 and not rows[0]["kept"]
    assert quality.keep_good(hard).columns == hard.columns
    assert quality.classify(none).count() == 0


# licences


def test_licence_spellings(spark, hard):
    rows = [
        (1, "Copyright (c) 2020 Somebody\n  released UNDER the mit licence"),
        (2, "text\nLicensed under the Apache License -- version 2.0\nThis work is licensed under the GNU General Public Licence, v. 3"),
        (3, "Released under the MIT License. Not."),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r["doc_id"]: (r["licences"], r["whole"]) for r in licences.scan(docs, licences.known_licences(spark)).collect()}
    assert got == {1: (["MIT"], "MIT"), 2: (["Apache-2.0", "GPL-3.0-only"], None), 3: ([], None)}
    assert licences.scan(hard, licences.known_licences(spark)).count() == hard.count()


def test_entire_wrapped_licences(spark):
    mine = "Copyright (c) 2020 Somebody"
    rows = [(n, f"{(*titles, '')[0]}\n\n{mine}\n\n{text}\n") for n, titles, text in licences.TEXTS]
    rows += [(n, f"{mine}\n{' '.join(text.split())}") for n, _, text in licences.TEXTS]
    docs = spark.createDataFrame([(k, text) for k, (_, text) in enumerate(rows)], "doc_id bigint, text string")
    got = {r["doc_id"]: r["whole"] for r in licences.scan(docs, licences.known_licences(spark)).collect()}
    assert got == {k: n for k, (n, _) in enumerate(rows)}


def wrapped(text, width):
    """Paragraphs filled to a width; copyright lines stay lines of their own."""
    out = []
    for paragraph in re.split(r"\n[ \t]*\n", text):
        for own, lines in groupby(paragraph.split("\n"), lambda x: bool(re.match(r"(?i)\W*(copyright|copr\.)\W*(\(c\)|[0-9]|yyyy|year)", x))):
            flow = " ".join(" ".join(lines).split())
            out.append(flow if own else textwrap.fill(flow, width, break_long_words=False, break_on_hyphens=False))
        out.append("")
    return "\n".join(out)


def test_entire_licences_of_any_width(spark):
    """All texts of the registry, and the long ones where the system has them, at widths from 50 to 100."""
    files = {"Apache-2.0": "Apache-2.0", "GPL-2.0-only": "GPL-2", "GPL-3.0-only": "GPL-3", "MPL-2.0": "MPL-2.0"}
    texts = [(n, text) for n, _, text in licences.TEXTS]
    for name, file in files.items():
        path = Path("/usr/share/common-licenses") / file
        if path.exists():
            texts.append((name, path.read_text()))
    rows = [(n, f"Copyright 2021 A. Author\n\n{wrapped(text, width)}") for n, text in texts for width in range(50, 101, 5)]
    docs = spark.createDataFrame([(k, text) for k, (_, text) in enumerate(rows)], "doc_id bigint, text string")
    got = {r["doc_id"]: r["whole"] for r in licences.scan(docs, licences.known_licences(spark)).collect()}
    assert got == {k: n for k, (n, _) in enumerate(rows)}


def test_licence_edges(spark, none):
    known = licences.known_licences(spark)
    assert licences.scan(none, known).count() == 0
    mit = "Released under the MIT License."
    rows = [(1, mit), (1, "text\nLicensed under CC BY 4.0."), (None, mit), (2, None), (3, "Copyright 2020 Me"), (4, "copyright holders\n" + mit)]
    got = licences.scan(spark.createDataFrame(rows, "doc_id bigint, text string"), known).collect()
    assert sorted((r["doc_id"] or 0, r["licences"], r["whole"]) for r in got) == [
        (0, [], None),
        (1, ["CC-BY-4.0", "MIT"], "MIT"),
        (1, ["CC-BY-4.0", "MIT"], "MIT"),
        (2, [], None),
        (3, [], None),
        (4, ["MIT"], None),
    ]


# quotes


def test_quotations(spark):
    rows = [
        (1, 0, "user", "Hello there.\nHow are you?"),
        (1, 1, "assistant", "> hello THERE\n> How are you?\nFine."),
        (1, 2, "user", "On Monday X wrote:\n> > Hello there.\n> Fine.\nGood."),
        (1, 3, "user", "No quote."),
        (1, 4, "user", ">> how are you\nStill."),
        (2, 0, "user", "> Fine.\nx"),
        (2, None, None, None),
        (None, 0, "user", "> x"),
    ]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = {(r["conv_id"], r["turn"]): tuple(r)[3:] for r in quotes.link_conversations(frame).collect()}
    assert got == {
        (1, 0): (None, 0, 0, "Hello there.\nHow are you?"),
        (1, 1): (0, 0, 1, "Fine."),
        (1, 2): (1, 0, 2, "Good."),
        (1, 3): (None, 3, 0, "No quote."),
        (1, 4): (0, 0, 1, "Still."),
        (2, 0): (None, 0, 0, "x"),
        (2, None): (None, None, 0, ""),
        (None, 0): (None, None, 0, ""),
    }
    assert quotes.link_conversations(frame.limit(0)).count() == 0


# lines and urls


@pytest.mark.parametrize("pages", [1, 4, 5, 9, 10, 11, 20, 21, 40])
def test_site_lines_of_small_hosts(spark, pages):
    """At the production ratio: single lines stay, a line of every page goes from five pages on, one of two pages by the ratio."""
    html = ["<p>menu</p>" + ("<p>pair</p>" if k < 2 else "") + f"<p>only {k}</p><p>and {k}</p>" for k in range(pages)]
    frame = spark.createDataFrame([(k, "http://h.org/x", h) for k, h in enumerate(html)], "page_id bigint, url string, html string")
    for row in site_lines.site_dedup(frame).collect():
        k = row["page_id"]
        want = [] if pages >= 5 else ["menu"]
        if k < 2 and not (pages >= 5 and 2 > 0.1 * pages):
            want.append("pair")
        assert row["text"].split("\n") == [*want, f"only {k}", f"and {k}"]


def test_site_lines_edges(spark):
    """Nulls, empty and long texts, clashing columns, repeated rows."""
    long = "<p>" + "word " * 50_000 + "</p>"
    rows = [(1, None, None), (None, "http://h.org", ""), (2, "http://h.org", long)]
    rows += [(3, "http://h.org", "<p>a</p>")] * 6
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    extra = frame.select("*", *[F.lit(1).alias(c) for c in "host lines common own kept pages line count n_lines text".split()])
    got = site_lines.report(site_lines.site_dedup(extra)).collect()
    assert len(got) == 9 and {r["page_id"] for r in got} == {1, 2, 3, None}
    # 6 of 8 pages say "a", and each repeated row loses it
    assert [r["n_dropped"] for r in got if r["page_id"] == 3] == [1] * 6
    assert [r["n_dropped"] for r in got if r["page_id"] != 3] == [0] * 3


def test_site_lines(spark):
    rows = [(k, "http://A.com/x", f"<p>menu</p><p>text {k}</p><script>menu</script>") for k in range(6)]
    rows += [(10, "http://b.com", "<p>menu</p>"), (11, None, None), (12, "nothing", "<b>a</b>b")]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = {r["page_id"]: tuple(r)[1:] for r in site_lines.site_dedup(frame, ratio=0.5).collect()}
    assert got[0] == ("a.com", 2, 1, "text 0") and got[10] == ("b.com", 1, 0, "menu")
    assert got[11] == ("", 0, 0, "") and got[12] == ("", 1, 0, "ab")
    assert site_lines.site_dedup(frame.limit(0)).count() == 0


def test_alias_of_a_blocked_url(spark):
    link = '<html><link rel="canonical" href="{}"></html>'
    rows = [
        (1, "http://x.example.com/en/a", None),
        (2, "http://alias.org/1?q=2#top", link.format("http://x.example.com/en/a")),
        (3, "https://third.org/", '<meta http-equiv="refresh" content="0; url=//ALIAS.org/1?q=2">'),
        (4, "http://good.com/", link.format("http://alias.org/1?q=2")),
        (5, "http://lone.org/", link.format("next")),
        (6, "no scheme", None),
        (7, None, link.format("http://x.example.com/en/a")),
        (8, "http://WWW.example.com/en/b?x", None),
        (9, "http://away.org", None),
    ]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    moved = spark.createDataFrame([("http://away.org", "http://s.net/es/1")], "url string, to_url string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in urls.filter_urls(frame, redirects=moved).collect()}
    assert got == {
        1: ("x.example.com", "/en/a", "example.com/en/", "block"),
        2: ("alias.org", "/1", None, "block"),
        3: ("third.org", "/", None, "block"),
        4: ("good.com", "/", "com/", "allow"),
        5: ("lone.org", "/", None, "allow"),
        6: ("", "", None, "allow"),
        7: ("", "", None, "allow"),
        8: ("www.example.com", "/en/b", "www.example.com/en/", "allow"),
        9: ("away.org", "", None, "block"),
    }


# pipeline


def test_pipeline_stage_by_stage(spark, folder, docs):
    """Each stage against plain Python on its own input."""
    kept = docs
    bench = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = [(r["doc_id"], r["text"]) for r in kept.collect()]
        kept = stage(spark, kept, folder).cache()
        assert kept.columns == docs.columns
        after = sorted(r["doc_id"] for r in kept.collect())
        if name.startswith("exact"):
            assert after == sorted({k for k, _ in brute.exact(before).values()})
        if name.startswith("minhash"):
            assert after == sorted({c for _, c in brute.near_components(before, 5).values()})
        if name.startswith("benchmark"):
            assert after == sorted(d for d, (_, hit, _) in brute.contamination(before, bench).items() if not hit)
    coded = corpus_pipeline.STAGES[-1][1](spark, kept, folder)
    assert coded.count() == kept.count()


def test_training_rows_reach_the_driver_packed_and_are_held_once():
    rng = np.random.default_rng(5)
    rows = ((rng.random((600, quality.BUCKETS)) < 0.05) * rng.random((600, quality.BUCKETS))).astype(np.float32)
    names, votes = [f"d{k}" for k in range(600)], ["-" * len(quality.LABELLERS)] * 600
    batch = pa.record_batch([names, votes, pa.array([r.tobytes() for r in rows], pa.binary())], ["doc_id", "votes", "x"])
    held = pa.Table.from_batches(list(quality._packed([batch])))
    assert held.nbytes < rows.nbytes / 5
    dense = quality._dense(held["cells"], held["counts"])
    assert np.array_equal(dense, rows)
    target = (rng.random(600) < 0.7).astype(np.float32)
    wanted = ((rows - rows.mean(axis=0)) / (rows.std(axis=0) + np.float32(0.01))).astype(np.float32)
    tracemalloc.start()
    scorer = quality.train(dense, target, steps=5)
    extra = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert np.array_equal(dense, wanted) and np.isfinite(scorer.weights).all()
    assert extra < rows.nbytes / 2  # no second copy of the rows
