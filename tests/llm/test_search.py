"""Hard negatives, lexical search and quality rules against brute force, with edge cases."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tempoframe.llm import hard_negatives as hard
from tempoframe.llm import lexical, quality_rules

VECTORS = "vec_id long, embedding array<float>, label int"


def mined(rows, positives=5, negatives=3):
    """Hard negatives by comparing every anchor with all rows."""
    rows = [(i, [math.floor(256 * float(np.float32(x))) for x in v], lab) for i, v, lab in rows]
    out = []
    for a, v, lab in rows:
        if a % 50:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w, strict=True)), b, other) for b, w, other in rows if b != a and len(w) == len(v))
        for p, b, _ in [s for s in scored if s[2] == lab][:positives]:
            window = [s for s in scored if s[2] != lab and 50 * -p <= 100 * -s[0] <= 95 * -p][:negatives]
            out += [(a, b, k, n, -p, -s) for k, (s, n, _) in enumerate(window, 1)]
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("block,portion", [(1 << 18, 1 << 22), (6 * 40, 6 * 3)])
def test_hard_negatives_match_brute_force(spark, monkeypatch, block, portion):
    monkeypatch.setattr(hard, "BLOCK_CELLS", block)
    monkeypatch.setattr(hard, "ANCHOR_CELLS", portion)
    rng = np.random.default_rng(3)
    base = rng.normal(size=(9, 6))
    rows = []
    for i in range(600):
        v = base[rng.integers(9)] + 0.3 * rng.normal(size=6) if i % 3 else rng.normal(size=6)
        rows.append((i - 100, [float(x) for x in np.round(v * 4) / 4], int(rng.integers(4))))  # coarse values tie
    rows += [(1000 + i, rows[7][1], rows[7][2] if i % 2 else 9) for i in range(60)]  # copies
    rows += [(5000, [1.0, 2.0], 1), (5001, [1.0, 1.5], 1), (5002, [0.5, 1.0], 2), (5050, [0.0] * 6, 1), (5100, [], 1), (5101, [], 2)]
    df = spark.createDataFrame(rows, VECTORS)
    want = mined(rows)
    assert len(want) > 50 and {r[0] for r in want} >= {5000, 5050} - {5050}
    assert rows_of(hard.hard_negatives(df, F.col("vec_id") % 50 == 0)) == want


def test_hard_negatives_at_the_edges(spark):
    rows = [(0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.75, 0.0], 2), (3, [0.75, 0.0], 2), (4, [0.0, 1.0], 2)]
    bad = [(50, None, 1), (100, [1.0, None], 1), (150, [float("nan"), 0.0], 1), (200, [float("inf"), 0.0], 1), (250, [1.0, 0.0], None), (None, [1.0, 0.0], 1)]
    df = spark.createDataFrame(rows + rows[:1] + bad, VECTORS)
    anchors = F.col("vec_id") % 50 == 0
    want = [(0, 1, 1, 2, 65536, 49152), (0, 1, 2, 3, 65536, 49152)]
    assert rows_of(hard.hard_negatives(df, anchors)) == want
    clashing = df.select(*(F.lit("clash").alias(c) for c in ("q", "size", "rank", "score", "d", "n", "_part", "anchor_id")), "*")
    assert rows_of(hard.hard_negatives(clashing, anchors)) == want
    assert hard.hard_negatives(df.limit(0), anchors).count() == 0 == hard.hard_negatives(df, F.col("vec_id") > 10**6).count()
    twice = spark.createDataFrame([(0, [1.0, 0.0], 2), (0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.75, 0.0], 2)], VECTORS)
    assert rows_of(hard.hard_negatives(twice, anchors)) == [(0, 1, 1, 2, 65536, 49152)]  # of two rows of one id that of the smaller label
    large = spark.createDataFrame([(0, [1e30, 0.0], 1), (1, [1.0, 0.0], 1)], VECTORS)
    with pytest.raises(ValueError):
        hard.hard_negatives(large, anchors)
    wide = spark.createDataFrame([(i, [float((i + k) % 5) * 1e5 for k in range(50)], i % 2) for i in range(60)], VECTORS)  # whole numbers beyond doubles
    assert rows_of(hard.hard_negatives(wide, anchors)) == mined([(i, [float((i + k) % 5) * 1e5 for k in range(50)], i % 2) for i in range(60)])


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def ranked(docs, items, k=10):
    """Every document scored for every item."""
    bags = [(d, Counter(terms_of(t))) for d, t in docs]
    bags = [(d, b) for d, b in bags if b]
    n, length = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    asked = {}
    for i, t in items:
        if i is not None:
            asked.setdefault(i, Counter()).update(terms_of(t))
    out = []
    for i, want in asked.items():
        scored = []
        for d, b in bags:
            m = 100 - 75 + (75 * sum(b.values()) * n) // length
            s = sum(c * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1000000000 * b[t]) // (1000 * b[t] + 8 * m)) for t, c in want.items() if t in b)
            if s > 0 and d is not None:
                scored.append((-s, d))
        out += [(i, r, d, -s) for r, (s, d) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


def corpus(rng, n):
    words = [f"w{i}" for i in range(60)] + ["Ä", "é9", "Ünder", "日本"]
    docs = [(i, " ".join(rng.choices(words, [1 / (k + 1) for k in range(len(words))], k=rng.randrange(1, 60)))) for i in range(n)]
    docs += [(1000 + i, docs[5][1]) for i in range(40)]  # copies tie
    return docs + [(7, docs[7][1]), (None, docs[8][1]), (2000, None), (2001, ""), (2002, " .,;\n\t"), (2003, "W1-w2_W3" * 30_000)], words


@pytest.mark.parametrize("postings,portion", [(1 << 19, 1 << 20), (150, 20)])
def test_ranked_search_matches_brute_force(spark, monkeypatch, postings, portion):
    monkeypatch.setattr(lexical, "SEGMENT_POSTINGS", postings)
    monkeypatch.setattr(lexical, "PORTION_TERMS", portion)
    rng = random.Random(5)
    docs, words = corpus(rng, 300)
    items = [(i, " ".join(rng.choices(words, k=rng.randrange(1, 12)))) for i in range(25)] + [(3, "w3 w3 W3"), (None, "w1"), (90, None), (91, "absent"), (92, docs[5][1])]
    df, asked = spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string")
    want = ranked(docs, items)
    assert len(want) > 200
    assert rows_of(lexical.ranked_documents(df, asked)) == want
    clash = [F.lit("clash").alias(c) for c in ("n", "terms", "times", "score", "rank", "_part")]
    assert rows_of(lexical.ranked_documents(df.select(*clash, "*"), asked.select(*clash, "*"))) == want
    assert lexical.ranked_documents(df.limit(0), asked).count() == 0 == lexical.ranked_documents(df, asked.limit(0)).count()


def test_intervals_are_split_until_none_can_hold_a_better_document():
    rng = np.random.default_rng(0)
    for width, leaf in ((40, 0), (400, 0), (3000, 64)):
        sizes = rng.integers(0, 9, width)
        terms = np.concatenate([rng.choice(30, s, replace=False) for s in sizes]).astype(np.int64)
        impacts = rng.integers(1, 50, len(terms)) * (1 + 40 * (terms == 3))
        ids = rng.permutation(width) * 3
        seg = lexical._Segment(ids, np.concatenate(([0], np.cumsum(sizes))), terms, impacts)
        for _ in range(20):
            asked = np.sort(rng.choice(40, 6, replace=False))
            times = rng.integers(1, 3, 6)
            first = lexical._First(10)
            scored = lexical._search(seg, asked, times, first, split=4, leaf=leaf)
            weight = dict(zip(asked.tolist(), times.tolist(), strict=True))
            total = np.zeros(width, np.int64)
            np.add.at(total, np.repeat(np.arange(width), sizes), impacts * np.array([weight.get(int(t), 0) for t in terms]))
            want = sorted((-int(s), int(i)) for s, i in zip(total, ids, strict=True) if s > 0)[:10]
            assert list(zip((-first.scores).tolist(), first.ids.tolist(), strict=True)) == want
            assert scored <= np.count_nonzero(total) or leaf
    assert scored < width  # not every document was looked at


def test_lengths_beyond_64_bits():
    n, each = np.array([10**9]), lexical.impacts_of(np.array([0]), np.array([5]), np.array([10**9]), np.array([7]), 10**11, 10**14)
    m = 25 + (75 * 10**9 * 10**11) // 10**14
    assert each[0] == 7 * (5 * 10**9 // (5000 + 8 * m)) and n[0] == 10**9


def judged(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    repeated = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    failed = len(words) < 50 or 100 * len(repeated) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated), failed


def test_quality_counts_match_brute_force(spark):
    rng = random.Random(2)
    words = ["a", "b", "ab", "é", "日本", "#x", "<b>", "A", "😀"]
    texts = [rng.choice(["", " ", "\n"]).join(rng.choice(words) + rng.choice([" ", "\n", "\t", "  ", "\n\n", "\r\n", " ", "\x0b"]) for _ in range(rng.randrange(90))) for _ in range(150)]
    texts += [None, "", " \n ", "x", "a a a", "a a a a", "same line\n" * 40, "\n".join(f"w{i} w{i + 1} w{i + 2}" for i in range(60_000)), "y" * 3_000_000 + " z", " ".join(f"q{i}" for i in range(50))]
    rows = [(i if i % 7 else None, t) for i, t in enumerate(texts)] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string")
    trusted = spark.createDataFrame([(3,), (3,), (None,), (10**9,)], "doc_id long")
    out = quality_rules.quality_rules(df, trusted)
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in out.collect())
    assert got == Counter((i, *judged(t)) for i, t in rows)
    assert out.where("base_failed and kept or kept is null").count() == 0
    clash = df.select(*(F.lit("clash").alias(c) for c in ("trusted", "total", "grams", "kept", "bucket", "n_words")), "*")
    assert rows_key(quality_rules.quality_rules(clash, trusted)) == rows_key(out)
    assert quality_rules.quality_rules(df.limit(0), trusted).count() == 0
    # Nothing trusted: no text is less likely than another.
    assert quality_rules.quality_rules(df, trusted.limit(0)).where(F.col("kept") == F.col("base_failed")).count() == 0


def rows_key(df):
    return Counter(tuple(r) for r in df.collect())


def test_verdicts_on_labels_that_were_not_seen(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    unseen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    out = quality_rules.quality_rules(docs, labels.where(~unseen & (F.col("quality") == 1)))
    held = out.where(~F.col("base_failed")).join(labels.where(unseen), "doc_id")
    share = {r.quality: r.share for r in held.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("share")).collect()}
    assert share[1] > 0.97 and share[0] < 0.1
