"""Embeddings, archives, chats, components and the pipeline."""

from __future__ import annotations

import gzip
import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from tempoframe.llm import archives, chat, decontaminate, embedding_dedup, near_dup, quality, workspace
from tempoframe.llm.graph import connected_components

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("hot", [1000, 2])
def test_components(spark, monkeypatch, hot):
    monkeypatch.setattr(workspace, "HOT_ROWS", hot)
    rng = random.Random(0)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(30)] + [(300, 200 + i) for i in range(40)] + [(400, 401 + i) for i in range(40)]
    label = {n: n for e in edges for n in e}
    for _ in range(200):
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {n: c for n, c in label.items() if any(n in e and e[0] != e[1] for e in edges)}
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_joins_with_common_keys(spark, monkeypatch):
    monkeypatch.setattr(workspace, "HOT_ROWS", 3)
    rows = spark.createDataFrame([(k, i) for k, n in (("a", 50), ("b", 2), ("c", 1), ("d", 9)) for i in range(n)], "k string, i int")
    keyed = spark.createDataFrame([("a", 50, 1), ("b", 2, 2), ("d", 9, 4)], "k string, copies long, v int")
    for total in (None, 61):
        got = Counter((r.k, r.v) for r in workspace.join_counted(rows, keyed, ["k"], total=total).collect())
        assert got == {("a", 1): 50, ("b", 2): 2, ("d", 4): 9}
    assert workspace.join_counted(rows.limit(0), keyed.limit(0), ["k"]).count() == 0


def test_embeddings_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "CELL", 40)
    monkeypatch.setattr(embedding_dedup, "HOME_BLOCK", 16)
    monkeypatch.setattr(embedding_dedup, "GUEST_BLOCK", 48)
    rng = np.random.default_rng(1)
    base = rng.normal(size=(30, 8))
    x = np.concatenate([base + 0.12 * rng.normal(size=base.shape) for _ in range(8)]).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(500, x[3].tolist()), (501, x[3].tolist()), (600, None), (601, [0.0] * 8), (602, [float("nan")] * 8), (603, [None] * 8)]
    got = {r.vec_id: r for r in embedding_dedup.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()}
    good = [(i, np.array(v, np.float64)) for i, v in rows if v and None not in v and np.isfinite(v).all() and np.any(v)]
    unit = np.stack([v / np.linalg.norm(v) for _, v in good])
    near = unit @ unit.T >= 0.95
    ids = [i for i, _ in good]
    for k, i in enumerate(ids):
        assert got[i].n_links == near[k].sum() - 1
        for j in np.flatnonzero(near[k]):
            assert got[ids[j]].component_id == got[i].component_id <= i
    assert all(got[i].n_links == 0 and got[i].kept and got[i].component_id == i for i in (600, 601, 602, 603))


def test_vectors_of_any_magnitude(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "CELL", 8)
    rng = np.random.default_rng(2)
    near = [(i, (np.ones(4) + 0.01 * rng.normal(size=4)).tolist()) for i in range(29)]
    wild = [(100, [1e-200, 0.0, 0.0, 0.0]), (101, [2e-200, 0.0, 0.0, 0.0]), (102, [1e200, 0.0, 0.0, 0.0]), (103, [5e-324, 0.0, 0.0, 0.0]), (104, [0.0, -1e308, 0.0, 0.0])]
    df = spark.createDataFrame(near + wild, "vec_id long, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.near_vectors(df).collect()}
    assert all(got[i] == (28, 0) for i in range(29))
    assert all(got[i] == (3, 100) for i in range(100, 104)) and got[104] == (0, 104)


@pytest.mark.parametrize("file_bytes", [600, 10**9])
def test_archives_round_trip(spark, file_bytes):
    long_page = "<p>é\r\n\r\nWARC/1.1\n</p>" * 20
    rows = [(5, "http://a/ b", long_page), (2, "http://c", long_page), (9, None, None), (4, "", "short"), (3, "http://d", "short"), (11, "http://e", "x\n\n"), (12, "http://f", long_page + "z")]
    got = {r.page_id: r for r in archives.convert_pages(spark.createDataFrame(rows, "page_id long, url string, html string"), file_bytes).collect()}
    for i, _, html in rows:
        body = (html or "").encode()
        assert (got[i].payload_bytes, got[i].payload_digest) == (len(body), hashlib.sha256(body).hexdigest())
    assert {i: (r.record_type, r.refers_to) for i, r in got.items() if r.record_type == "revisit"} == {5: ("revisit", 2)}
    assert len({r.record_id for r in got.values()}) == len(rows)
    assert archives.convert_pages(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_gzip_members_of_any_length():
    for size in (0, 1, 100, 1 << 24, (1 << 24) + 5):
        packed = archives.member(b"x" * size) + b"\0"
        assert gzip.decompress(packed) == b"x" * size
        assert gzip.decompress(packed + packed) == b"x" * (2 * size)


def arc_record(line, block):
    return b"%s %d\n%s\n\n" % (line, len(block), block)


FOREIGN = b"".join([
    arc_record(b"filedesc://old.arc 0.0.0.0 19990101000000 text/plain", b"1 0 Some Crawler\nURL IP-address Archive-date Content-type Archive-length\n"),
    arc_record(b"dns:example.org 1.2.3.4 19990101000001 text/dns", b"19990101 ip"),
    arc_record(b"http://example.org/a b 1.2.3.4 199901010000 text/html", b"HTTP/1.0 200 OK\nServer: x\n\nbinary \xff\xfe text!"),
    arc_record(b"http://example.org/none 1.2.3.4 19990101000003 text/html", b"HTTP/1.0 404 No\n"),
    arc_record(b"ftp://example.org/f 1.2.3.4 19990101000004 text/plain", b"file"),
])


def test_archives_of_others(spark, tmp_path):
    """Plain and gzipped ARC files without page numbers: names resolved, other protocols, payloads that are no text."""
    for name, content in (("part-a", FOREIGN), ("part-b", gzip.compress(FOREIGN))):
        (tmp_path / name).write_bytes(content)
    rows = archives.read_arc(spark, f"file://{tmp_path}", payloads=True).collect()
    assert Counter(r.kind for r in rows) == {"http": 4, "other": 4} and all(r.page_id is None for r in rows)
    page = next(r for r in rows if r.file == "part-a" and "/a b" in r.url)
    assert bytes(page.payload) == b"binary \xff\xfe text!" and page.stamp == "19990101000000"
    out = f"file://{tmp_path}/warc"
    archives.convert(spark, f"file://{tmp_path}", out)
    back = archives.read_warc(spark, out).collect()
    assert Counter(r.record_type for r in back) == {"response": 4, "resource": 4} and len({r.record_id for r in back}) == 8
    kinds = [f["WARC-Type"] for p in (tmp_path / "warc").glob("part-*") for f in archives.parse_warc(p.read_bytes())]
    assert kinds.count("warcinfo") == 2
    assert {(r.payload_digest, r.payload_bytes) for r in back} == {(r.digest, r.size) for r in rows}


def test_arc_versions_and_damage():
    import pandas as pd

    pages = pd.DataFrame({"page_id": ["1"], "url": ["http://x"], "html": ["body"]})
    for version in "12":
        raw = b"".join([archives.arc_start(version, "n"), *archives.arc_records(pages, version, "n")])
        start, record = archives.parse_arc(raw)
        assert start["kind"] == "version" and record["payload"] == b"body" and record["arc_version"] == version
    for damaged in (raw[:-4], raw[100:], raw.replace(b"2 0 tempoframe", b"7 0 tempoframe")):
        with pytest.raises(ValueError):
            list(archives.parse_arc(damaged))


HARD = ["\\### Assistant: </turn> ok", "\\", "", "</turn>\n### user: x", "####", "\\\\</turn>", "日本\n"]


def test_chat_reads_back():
    turns = [("user" if i % 2 else "assistant", t) for i, t in enumerate(HARD)] + [("a:b\\", "x")]
    text, spans, rewrites = chat.locate(chat.marked_turns, turns)
    assert chat.parse_marked(text) == turns and rewrites == []
    assert [chat.unescape(text[s[2] : s[3]]) for s in spans] == [t for _, t in turns]
    assert [(a, b) for a, b, _, _ in spans] == list(zip([0, *(s[1] for s in spans[:-1])], (s[1] for s in spans), strict=True))


def test_probes_that_a_conversation_holds():
    turns = [("user", chat.PROBE.format("")), ("assistant", "hello"), ("user", chat.PROBE.format(".")), ("assistant", "bye")]
    text, spans, rewrites = chat.locate(chat.marked_turns, turns)
    assert rewrites == [] and [text[s[2] : s[3]] for s in spans] == [t for _, t in turns]


def test_templates_that_rewrite_history():
    def forgetful(turns):
        return "".join(f"[{r}]{t if i >= len(turns) - 2 else '...'}" for i, (r, t) in enumerate(turns))

    turns = [("user", "one"), ("assistant", "two"), ("user", "three")]
    text, spans, rewrites = chat.locate(forgetful, turns)
    assert rewrites == [2] and text == "[user]...[assistant]two[user]three"
    assert spans[0][2:] == (-1, -1) and text[spans[1][2] : spans[1][3]] == "two"


def test_conversations(spark):
    rows = [(1, 2, "assistant", "b"), (1, 1, "user", "a"), (1, 1, "user", "a"), (2, None, None, None), (None, 1, "user", "lost")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in chat.format_conversations(df, chat.marked_turns).collect()}
    assert got[1].formatted == "### user: a</turn>\n### user: a</turn>\n### assistant: b</turn>\n" and len(got[1].loss_spans) == 1
    assert got[2].formatted == "### : </turn>\n" and set(got) == {1, 2, None} and got[None].formatted == "### user: lost</turn>\n"


def test_pipeline_by_hand(spark):
    """All five stages of the pipeline in plain Python, over the fitted forest."""
    from tests.llm.test_near_dup import brute
    from tests.llm.test_text_operators import mixed_by_hand, walked

    out = corpus_pipeline.run(spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    forest = quality.fit_quality(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    rows = docs.collect()
    x = quality.text_features(pa.array([r.text for r in rows]))
    rows = {r.doc_id: r for r, f in zip(rows, x, strict=True) if walked(forest, f) >= quality.CUT}
    groups = brute([(i, r.text) for i, r in rows.items()], 5, 80)
    rows = {i: r for i, r in rows.items() if groups[i][2]}
    leaks = contaminated_by_hand(rows, spark.read.parquet(f"{SF}/benchmark.parquet").collect())
    rows = {i: r for i, r in rows.items() if i not in leaks}
    kept = mixed_by_hand(rows.values(), corpus_pipeline.UNMET)
    assert {r.doc_id for r in out} == kept and len(kept) > 30
    assert all((r.size, r.text_crc32) == (len(rows[r.doc_id].text.encode()) + 1, zlib.crc32(rows[r.doc_id].text.encode())) for r in out)
    slots = {}
    for r in out:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(8))


def test_stages_decide_row_by_row(spark, tmp_path):
    """Null and repeated ids neither lose clean rows nor hide copies and passages."""
    rng = random.Random(9)
    text = lambda n: " ".join(f"t{rng.randrange(10**6)}" for _ in range(n))
    a, b, passage = text(40), text(40), text(20)
    rows = [(1, a), (1, a), (1, b), (None, a), (None, b), (None, text(30)), (2, None), (2, ""), (5, text(10) + " " + passage), (5, text(30)), (None, passage)]
    docs = spark.createDataFrame([(*r, "en", "s", len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars int")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    left = corpus_pipeline.near_duplicate_stage(spark, docs, str(tmp_path)).collect()
    assert Counter((r.doc_id, r.text) for r in left) == Counter({(1, a): 1, (1, b): 1} | {r: 1 for r in rows[5:]})
    assert left[0].__fields__ == docs.columns
    clean = corpus_pipeline.decontamination_stage(spark, docs, str(tmp_path)).collect()
    assert Counter((r.doc_id, r.text) for r in clean) == Counter(rows) - Counter([rows[8], rows[10]])
    for stage in (corpus_pipeline.near_duplicate_stage, corpus_pipeline.decontamination_stage, corpus_pipeline.mixing_stage, corpus_pipeline.sharding_stage):
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0


def contaminated_by_hand(rows, items):
    import re

    def tokens(text):
        return re.sub(r"[\W_]+", " ", (text or "").lower()).split()

    windows = [w[i : i + 12] for w in (tokens(r.text) for r in items) for i in range(len(w) - 11)]
    first = {}
    for w in windows:
        for k in (0, 3, 6, 9):
            first.setdefault((k, *w[k : k + 3]), []).append(w)
    found = set()
    for i, r in rows.items():
        w = tokens(r.text)
        for a in range(len(w) - 11):
            part = w[a : a + 12]
            if any(sum(x != y for x, y in zip(part, b, strict=True)) <= 2 for k in (0, 3, 6, 9) for b in first.get((k, *part[k : k + 3]), ())):
                found.add(i)
                break
    return found


def test_registered_names(spark):
    import __spark_entry__

    names = set(__spark_entry__.queries())
    assert {f"op{n}" for n in range(1, 11)} <= {n.split("_")[0] for n in names} and "pipeline" in names
    assert set(__spark_entry__.oracle_sql()) <= names
    assert near_dup.ORACLE and decontaminate.ORACLE
