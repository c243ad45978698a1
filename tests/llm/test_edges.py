"""Nulls in every column, empty and very long texts, ties, repeated rows, empty tables and clashing names, for each operator."""

from __future__ import annotations

import gzip
import json
from collections import Counter

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tempoframe.llm import archives, chat, decontaminate, embedding_dedup, licenses, line_dedup, mixing, near_dup, quality, shards

LONG = "\n".join(" ".join(f"w{i * 7 + k}" for k in range(12)) for i in range(9_000)) + "\nReleased under the MIT License.\nOne, two three four FIVE six seven eight nine ten eleven twelve.\n"
DOCS = [
    (1, "a plain text of a few words that is here twice", "en", "web"),
    (1, "a plain text of a few words that is here twice", "en", "web"),
    (2, "a plain text of a few words that is here twice", None, None),
    (None, "a plain text of a few words that is here twice", "en", "web"),
    (3, None, None, None), (4, "", "en", None), (5, " \t\n\n ", "en", "web"), (6, LONG, "en", "web"), (7, LONG, "de", "web"), (8, "x", None, "web"), (None, None, None, None),
]
SCHEMA = "doc_id long, text string, lang string, source string"
#: Names that operators use inside, or return.
CLASHES = (
    "tokens", "topic", "line", "size", "key", "kept", "score", "shard", "n", "u", "v", "id", "h", "seed", "law", "rule", "license", "component", "y", "found", "copies", "q", "w", "at", "head", "rep",
)
LABELS = [(1, 1, 0), (2, 0, 0), (None, 1, None), (3, None, 0), (1, 1, 0)]
BENCH = [(1, "one two three four five six seven eight nine ten eleven twelve"), (None, "x"), (2, None), (3, "")]


def labels(spark):
    return spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")


def bench(spark):
    return spark.createDataFrame(BENCH, "item_id long, text string")


ON_DOCS = {
    "lines": lambda s, d: line_dedup.line_classes(d),
    "repeats": lambda s, d: line_dedup.without_repeats(d, line_dedup.line_classes(d)).select("doc_id", "text"),
    "decontamination": lambda s, d: decontaminate.contaminated(d, bench(s)),
    "licenses": lambda s, d: licenses.scan_licenses(d),
    "shards": lambda s, d: shards.shard_documents(d, 3),
    "mixing": lambda s, d: mixing.mixed(d),
    "sampled": lambda s, d: mixing.sampled(d, keep=0.5).select("doc_id", "text"),
    "quality": lambda s, d: quality.classify(d, labels(s)),
    "accepted": lambda s, d: quality.accepted(d, quality.fit_quality(d, labels(s))).select("doc_id", "text"),
    "near duplicates": lambda s, d: near_dup.near_duplicates(d),
}


def rows_of(df):
    return Counter(json.dumps(r.asDict(), sort_keys=True, default=str) for r in df.collect())


@pytest.mark.parametrize("name", ON_DOCS)
def test_documents(spark, name):
    docs = spark.createDataFrame(DOCS, SCHEMA)
    got = rows_of(ON_DOCS[name](spark, docs))
    one = json.loads(next(iter(got)))
    if name in ("shards", "mixing", "quality", "near duplicates"):
        assert got.total() == len(DOCS)  # one row per input row
    clashing = docs.withColumns({c: F.lit("clash") for c in CLASHES}).select(*CLASHES, *docs.columns)
    assert rows_of(ON_DOCS[name](spark, clashing)) == got
    assert ON_DOCS[name](spark, docs.limit(0)).count() == 0
    ids = Counter(json.loads(r).get("doc_id") for r in got.elements())
    if name == "near duplicates":
        kept = {json.loads(r)["doc_id"]: json.loads(r) for r in got}
        assert [kept[i]["component_id"] for i in (1, 2, 6, 7, 8)] == [1, 1, 6, 6, 8] and all(kept[i]["kept"] for i in (3, 4, 5))
    if name == "licenses":
        assert ids == {6: 1, 7: 1}
    if name == "lines":
        assert one.keys() >= {"line_md5", "class_md5", "kept"}
        twice = next(json.loads(r) for r in got if json.loads(r)["n_chars"] == len(DOCS[0][1]))
        assert (twice["n_copies"], twice["first_doc_id"]) == (4, 1)
    if name == "repeats":
        texts = Counter((json.loads(r)["doc_id"], json.loads(r)["text"]) for r in got.elements())
        assert texts[(1, DOCS[0][1])] == 1 and texts[(1, "")] == 1 and texts[(2, "")] == 1 and texts[(None, DOCS[0][1])] == 1
        assert texts[(6, LONG)] == 1 and texts[(3, None)] == 1 and texts[(4, "")] == 1 and texts[(5, " \t\n\n ")] == 1
    if name == "decontamination":
        assert ids == {6: 1, 7: 1}


def test_ties_are_the_same_whatever_the_order(spark):
    docs = spark.createDataFrame(DOCS, SCHEMA)
    for name in ("shards", "mixing", "near duplicates", "lines"):
        assert rows_of(ON_DOCS[name](spark, docs.repartition(1))) == rows_of(ON_DOCS[name](spark, docs.repartition(5, "text")))


def test_embeddings(spark):
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [2.0, 0.0]), (None, [1.0, 0.0]), (3, []), (4, None), (5, [1.0, 0.0, 0.0]), (6, [None, 1.0])]
    df = spark.createDataFrame([(*r, 7, "k") for r in rows], "vec_id long, embedding array<double>, copies int, rep string")
    got = [(r.vec_id, r.n_links, r.component_id, r.kept) for r in embedding_dedup.near_vectors(df).collect()]
    assert sorted(got, key=lambda r: (r[0] is None, r)) == [
        (1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (3, 0, 3, True), (4, 0, 4, True), (5, 0, 5, True), (6, 0, 6, True), (None, 0, None, True),
    ]
    assert embedding_dedup.near_vectors(df.limit(0)).count() == 0
    wide = spark.createDataFrame([(i, [float(i % 3 == k) for k in range(3000)]) for i in range(6)], "vec_id long, embedding array<double>")
    assert all(r.n_links == 1 for r in embedding_dedup.near_vectors(wide).collect())


def test_pages(spark):
    long_page = "<p>é" * 400_000
    rows = [(1, "u", long_page), (1, "u", long_page), (None, "u", long_page), (2, None, None), (3, "", ""), (None, None, None)]
    df = spark.createDataFrame([(*r, 5, "x") for r in rows], "page_id long, url string, html string, size int, digest string")
    got = Counter((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in archives.convert_pages(df).collect())
    size = len(long_page.encode())
    assert got == {
        (1, size, "response", None): 1, (1, size, "revisit", 1): 1, (None, size, "revisit", 1): 1, (2, 0, "response", None): 1, (3, 0, "response", None): 1, (None, 0, "response", None): 1,
    }


def test_conversations(spark):
    long_text = "word </turn> ### " * 50_000
    rows = [(1, 0, "user", long_text), (1, 1, "assistant", "ok"), (1, 1, "assistant", "ok"), (2, None, None, None), (None, 0, "user", "x")]
    df = spark.createDataFrame([(*r, "c") for r in rows], "conv_id long, turn long, role string, text string, said string")
    got = {r.conv_id: r for r in chat.format_conversations(df, chat.marked_turns).collect()}
    assert set(got) == {1, 2, None} and chat.parse_marked(got[None].formatted) == [("user", "x")] and chat.parse_marked(got[1].formatted) == [("user", long_text), ("assistant", "ok"), ("assistant", "ok")]
    assert len(got[1].loss_spans) == 2
    assert chat.format_conversations(df.limit(0), chat.marked_turns).count() == 0


def test_wide_ids_beside_null_ones(spark):
    rows = [(2**60 + 1, 0, "user", "a"), (None, 0, "user", "b")]
    got = chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").coalesce(1), chat.marked_turns)
    assert {r.conv_id for r in got.collect()} == {2**60 + 1, None}


def test_addresses_of_pages(spark):
    """Addresses that look like version blocks, and white space beyond ASCII, come back."""
    urls = ["filedesc://a.arc", "filedesc://a.arc 0.0.0.0 x", "http://x/a\u2003b", "http://x/a b\tc", "http://x/\u00e9"]
    df = spark.createDataFrame([(i, u, f"<p>{i}") for i, u in enumerate(urls)], "page_id long, url string, html string")
    got = {r.page_id: r.url for r in archives.convert_pages(df).collect()}
    assert got == {0: urls[0], 1: "filedesc://a.arc%200.0.0.0%20x", 2: "http://x/a%E2%80%83b", 3: "http://x/a%20b%09c", 4: urls[4]}


def test_a_damaged_record_among_good_ones(spark, tmp_path):
    pages = pd.DataFrame({"page_id": ["1", "2", "3"], "url": ["u1", "u2", "u3"], "html": ["a" * 500, "b" * 500, "c" * 500]})
    records = list(archives.arc_records(pages, "1", "f"))
    members = [gzip.compress(r) for r in (archives.arc_start("1", "f"), *records)]
    cut = members[2][:40] + b"\x00\x01" + members[2][42:]
    (tmp_path / "part-1.arc.gz").write_bytes(b"".join([*members[:2], cut, members[3]]))
    short = gzip.compress(records[1][:-200])
    (tmp_path / "part-2.arc.gz").write_bytes(b"".join([*members[:2], short, members[3]]))
    (tmp_path / "part-3.arc").write_bytes(b"".join([archives.arc_start("1", "f"), *records])[:-300])
    rows = archives.read_arc(spark, str(tmp_path), salvage=True).collect()
    for name, pages_read in (("part-1.arc.gz", [1, 3]), ("part-2.arc.gz", [1, 3]), ("part-3.arc", [1, 2])):
        mine = [r for r in rows if r.file == name]
        assert sorted(r.page_id for r in mine if r.kind == "http") == pages_read and sum(r.kind == "damaged" for r in mine) == 1
    out = f"file://{tmp_path}/out"
    archives.convert(spark, str(tmp_path), out, salvage=True)
    assert sorted(r.page_id for r in archives.read_warc(spark, out).collect()) == [1, 1, 1, 2, 3, 3]
    with pytest.raises(Exception, match="record|CRC|decompress|declares|invalid|stored"):
        archives.read_arc(spark, str(tmp_path)).collect()


def test_targets_that_contradict_one_another(spark):
    rows = spark.createDataFrame([(1, "a b", "en", "x"), (2, "a b", "de", "y")], SCHEMA)
    with pytest.raises(ValueError, match="contradict"):
        mixing.mixed(rows, targets={"source": {"x": 0.9, "y": 0.1}, "lang": {"en": 0.1, "de": 0.9}})


def test_one_text_of_an_id_teaches(spark):
    docs = spark.createDataFrame([(1, "good words here")] * 50 + [(2, "BAD!! BAD!!")], "doc_id long, text string")
    forest = quality.fit_quality(docs, labels(spark))
    one = quality.fit_quality(docs.distinct(), labels(spark))
    assert forest.base == one.base


def test_a_phrase_that_repeats_through_a_long_text(spark):
    """Twenty thousand words of one phrase against items of it: every window is counted, none is a row."""
    phrase = "alpha beta gamma delta epsilon"
    docs = spark.createDataFrame([(1, " ".join([phrase] * 4000)), (2, " ".join([phrase] * 40))], "doc_id long, text string")
    items = spark.createDataFrame([(7, " ".join([phrase] * 12))], "item_id long, text string")
    got = {r.doc_id: (r.n_windows, r.first_token, r.end_token, r.substitutions) for r in decontaminate.contaminated(docs, items).collect()}

    def windows(n, m):
        return sum(1 for a in range(n - 11) for b in range(m - 11) if (a - b) % 5 == 0)

    assert got == {1: (windows(20_000, 60), 0, 20_000, 0), 2: (windows(200, 60), 0, 200, 0)}


def test_a_reserved_name_is_refused(spark):
    import corpus_pipeline

    with pytest.raises(ValueError, match="_row"):
        corpus_pipeline.near_duplicate_stage(spark, spark.createDataFrame(DOCS, SCHEMA).withColumn("_row", F.lit(1)), "")


def test_the_pipeline_on_long_texts_and_clashing_columns(spark, tmp_path):
    """Every stage keeps all columns, whatever their names, and takes whole texts, nulls and rows without an id."""
    import corpus_pipeline

    good = " ".join(f"A sentence of some words number {i} ends here." for i in range(60))
    rows = [*DOCS, *((100 + i, f"{good} Page {i} of the book, {i * 31}.", ("en", "de")[i % 2], ("web", "news")[i % 2]) for i in range(40))]
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("clash") for c in CLASHES})
    docs.write.parquet(f"file://{tmp_path}/documents.parquet")
    spark.createDataFrame([(100 + i, 1, 0) for i in range(40)] + [(8, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"file://{tmp_path}/labels.parquet")
    bench(spark).write.parquet(f"file://{tmp_path}/benchmark.parquet")
    kept = spark.read.parquet(f"file://{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, kept, f"file://{tmp_path}")
        assert after.columns == docs.columns and after.exceptAll(kept).isEmpty(), name
        path = f"file://{tmp_path}/{name}"
        after.write.parquet(path)
        kept = spark.read.parquet(path)
    last = corpus_pipeline.STAGES[-1][1](spark, kept, f"file://{tmp_path}")
    assert last.count() == kept.count() and {"shard", "slot"} <= set(last.columns)
    assert not kept.where("text like '%nine ten eleven twelve%'").count()  # the long texts hold a benchmark passage
