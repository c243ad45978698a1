"""Near duplicates against brute force, in small and large buckets, and edge cases."""

from __future__ import annotations

import random
import re

import pytest

from tempoframe.llm import near_dup


def shingles(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return set()
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else {tuple(words)}


def brute(rows, k, percent):
    sets = {i: shingles(t, k) for i, t in rows}
    label = {i: i for i in sets}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return {i: (len(s), label[i], label[i] == i) for i, s in sets.items()}


def family(rng, n, base_words, edits):
    base = [f"w{rng.randrange(10**6)}" for _ in range(base_words)]
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randrange(edits)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
        yield " ".join(words)


def run(spark, rows, **kwargs):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dup.near_duplicates(docs, **kwargs).collect()}


@pytest.mark.parametrize("small", [32, 3])
def test_families_match_brute_force(spark, monkeypatch, small):
    monkeypatch.setattr(near_dup, "SMALL_BUCKET", small)
    monkeypatch.setattr(near_dup, "BLOCK", 16)
    rng = random.Random(5)
    texts = [*family(rng, 60, 120, 10), *family(rng, 10, 40, 3), *family(rng, 5, 7, 2), "a b", "A  B", "a", "", None, " \t "]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    assert run(spark, rows, words=4) == brute(rows, 4, 80)


def test_edges(spark):
    long_text = " ".join(f"t{i}" for i in range(60_000))
    rows = [(7, long_text), (3, long_text), (4, None), (5, "")]
    assert run(spark, rows, words=5) == {7: (59_996, 3, False), 3: (59_996, 3, True), 4: (0, 4, True), 5: (0, 5, True)}
    assert run(spark, [], words=5) == {}


def test_other_columns_and_repeated_rows(spark):
    docs = spark.createDataFrame(
        [(1, "a b c d e f", 9, "x"), (1, "a b c d e f", 9, "x"), (2, "a b c d e f", 9, "y"), (None, "a b c d e f", 9, "z")],
        "doc_id long, text string, component_id int, key string",
    )
    got = sorted(near_dup.near_duplicates(docs).collect(), key=lambda r: (r.doc_id is None, r.doc_id))
    assert [(r.doc_id, r.component_id, r.kept) for r in got] == [(1, 1, True), (1, 1, True), (2, 1, False), (None, None, True)]
