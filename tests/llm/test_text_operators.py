"""Line dedup, decontamination, licences, mixing, sharding and quality on small inputs."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tempoframe.llm import decontaminate, licenses, line_dedup, mixing, quality, shards


SCHEMA = "doc_id long, text string, lang string, source string"


def docs_of(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def mutated(rng, line, n):
    chars = list(line)
    for _ in range(n):
        at = rng.randrange(len(chars))
        kind = rng.randrange(3)
        if kind == 0:
            chars[at] = rng.choice("abcé")
        elif kind == 1:
            chars.insert(at, rng.choice("abcé"))
        else:
            del chars[at]
    return "".join(chars)


@pytest.mark.parametrize("limit", [1, 2, 3])
def test_edit_distance(spark, limit):
    rng = random.Random(limit)
    rows = []
    for _ in range(300):
        a = "".join(rng.choice("abé") for _ in range(rng.randrange(25)))
        b = mutated(rng, a, rng.randrange(5)) if len(a) > 5 else "".join(rng.choice("abé") for _ in range(rng.randrange(6)))
        rows.append((a, b))
    got = line_dedup.edit_distance(spark.createDataFrame(rows, "a string, b string"), "a", "b", limit).collect()
    assert all(min(r.distance, limit + 1) == min(edits(r.a, r.b), limit + 1) for r in got)


@pytest.mark.parametrize("steps", [(9, 24), (8, 12), (5,)])
def test_line_links_match_brute_force(spark, steps):
    rng = random.Random(3)
    base = ["".join(rng.choice("entriaso bcd") for _ in range(rng.randrange(5, 50))).strip() + "x" for _ in range(30)]
    lines = base + [mutated(rng, rng.choice(base), rng.randrange(1, 4)) for _ in range(80)]
    texts = ["\n".join(lines[i : i + 5]) for i in range(0, len(lines), 5)] + ["\n\n", None, "", lines[0]]
    got = {r.line_md5: r for r in line_dedup.line_classes(docs_of(spark, texts), steps).collect()}
    different = sorted({x for t in texts if t for x in t.split("\n") if x.strip()})
    name = {x: hashlib.md5(x.encode()).hexdigest() for x in different}
    assert set(got) == set(name.values())

    def linked(a, b):
        allowed = sum(min(len(a), len(b)) >= least for least in steps)
        return a != b and allowed > 0 and edits(a, b) <= allowed

    near = {a: [b for b in different if linked(a, b)] for a in different}
    assert sum(map(len, near.values())) > 40
    for a in different:
        assert got[name[a]].n_links == len(near[a])
        assert all(got[name[b]].class_md5 == got[name[a]].class_md5 for b in near[a])
        assert got[name[a]].class_md5 <= name[a]


def test_code_of_line_steps_is_short_enough_to_be_compiled(spark, monkeypatch):
    found, staged = {}, line_dedup.staged

    def seen(df, name):
        code = spark.sparkContext._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "codegen")
        found[name] = max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", code)), default=0)
        return staged(df, name)

    monkeypatch.setattr(line_dedup, "staged", seen)
    plain = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}  # else plans are known only after they ran
    before = {k: spark.conf.get(k) for k in plain}
    try:
        for k, v in plain.items():
            spark.conf.set(k, v)
        line_dedup.line_classes(docs_of(spark, ["one line that is long enough", "one line that is long enough!"])).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert found["lines"] > 0 and found["pairs"] > 0
    assert all(size < 8000 for size in found.values()), found  # the JVM interprets longer methods


def test_sketches_count_letters_modulo_16(spark):
    rng = random.Random(8)
    texts = ["", "é", "e" * 23, "e" * 8, "x" * 300, *("".join(rng.choice("entriashdlcoug xyzéß") for _ in range(rng.randrange(400))) for _ in range(30))]
    sketches = line_dedup.with_sketch(spark.createDataFrame([(x,) for x in texts], "line string"))
    a, b = (sketches.select(F.col("line").alias(c), F.col("sketch").alias(f"s{c}")) for c in "ab")
    got = a.crossJoin(b).select("a", "b", line_dedup.sketches_apart(F.col("sa"), F.col("sb")).alias("apart")).collect()
    counts = {x: [*(x.count(c) for c in line_dedup.LETTERS), sum(c not in line_dedup.LETTERS for c in x)] for x in texts}
    want = lambda a, b: sum(min((p - q) % 16, (q - p) % 16) for p, q in zip(counts[a], counts[b]))
    assert len(got) == len(texts) ** 2 and all(r.apart == want(r.a, r.b) for r in got)


def test_lines_are_removed_but_the_first(spark):
    docs = docs_of(spark, ["one line that is long enough\nshort", "one line that is long enough!\n\nother text here", None, ""])
    out = {r.doc_id: r.text for r in line_dedup.without_repeats(docs, line_dedup.line_classes(docs)).collect()}
    assert Counter(x for t in out.values() if t for x in t.split("\n"))["short"] == 1
    assert sum("long enough" in (t or "") for t in out.values()) == 1
    assert out[2] is None and out[3] == ""


def test_rows_that_share_an_id_keep_their_own_lines(spark):
    rows = [(1, "alpha line of some length\nshared line of some length\n"), (1, "beta words that nobody else has\n\nshared line of some length"), (None, "shared line of some length"), (3, "shared line of some length!")]
    docs = spark.createDataFrame([(*r, f"x{i}") for i, r in enumerate(rows)], "doc_id long, text string, line string")
    classes = line_dedup.line_classes(docs)
    out = {r.line: r.text for r in line_dedup.without_repeats(docs, classes).collect()}
    kept = classes.where("n_links = 1 and kept").collect()
    assert len(kept) == 1
    assert out["x2"] == rows[2][1]
    if kept[0].line_md5 == hashlib.md5(b"shared line of some length").hexdigest():
        assert (out["x0"], out["x1"], out["x3"]) == (rows[0][1], "beta words that nobody else has\n", "")
    else:
        assert (out["x0"], out["x1"], out["x3"]) == ("alpha line of some length\n", "beta words that nobody else has\n", rows[3][1])


def test_contaminated_with_substitutions(spark):
    rng = random.Random(11)
    item = [f"q{rng.randrange(9999)}" for _ in range(20)]
    other = [f"z{rng.randrange(9999)}" for _ in range(40)]
    two, three = list(item[:12]), list(item[:12])
    for k, at in enumerate((1, 10)):
        two[at] = f"sub{k}"
    for k, at in enumerate((1, 5, 10)):
        three[at] = f"sub{k}"
    docs = docs_of(spark, [" ".join(x) for x in (other, other + item + other, other + two, other + three)] + [None, "", "q " * 11])
    bench = spark.createDataFrame([(5, ", ".join(item).upper()), (4, " ".join(item)), (6, None), (7, "too short")], "item_id long, text string")
    got = {r.doc_id: r for r in decontaminate.contaminated(docs, bench).collect()}
    assert sorted(got) == [1, 2]
    assert (got[1].item_id, got[1].n_windows, got[1].first_token, got[1].end_token, got[1].substitutions) == (4, 9, 40, 60, 0)
    assert got[2].substitutions == 2
    assert decontaminate.contaminated(docs.limit(0), bench).count() == 0
    assert decontaminate.contaminated(docs, bench.limit(0)).count() == 0


def test_licence_rules(spark):
    mit = "\n".join(licenses.SENTENCES[k] + "." for k in ("mt1", "mt3", "mt4", "mt5"))
    wrapped = licenses.SENTENCES["ap0"].replace("License, ", "License,\n") + ". More."
    out_of_order = "\n".join(licenses.SENTENCES[k] + "." for k in ("mt5", "mt4", "mt3"))
    docs = docs_of(spark, [mit, wrapped, out_of_order, "Text.\nReleased under the MIT License.\nText", None, "", "no licence"])
    got = {(r.doc_id, r.license): r.rule for r in licenses.scan_licenses(docs).collect()}
    assert got == {(0, "MIT"): "mit-full", (1, "Apache-2.0"): "apache-2.0-notice", (3, "MIT"): "mit-notice"}


def test_every_licence_rule_in_any_layout(spark):
    """Each rule's sentences wrapped at every word, with doubled blanks, and behind marks of comments."""
    texts, want = [], []
    for name, (spdx, ids) in licenses.RULES.items():
        plain = " ".join(licenses.SENTENCES[i] + "." for i in ids)
        lines = [licenses.SENTENCES[i] + "." for i in ids]
        for text in (plain, plain.replace(" ", "\n"), plain.replace(" ", "  "), "# Head\n#\n# " + "\n# ".join(" ".join(lines).split(" ")), "\r\n".join(lines)):
            texts.append(text)
            want.append((spdx, name))
    got = {}
    for r in licenses.scan_licenses(docs_of(spark, texts)).collect():
        got.setdefault(r.doc_id, set()).add((r.license, r.rule))
    assert [i for i, w in enumerate(want) if w not in got.get(i, ())] == []
    anchored = [any(w in licenses.SENTENCES[i].lower() for w in licenses.ANCHORS for i in ids) for _, ids in licenses.RULES.values()]
    assert all(anchored)


def test_mixing_meets_the_marginals(spark):
    rng = random.Random(2)
    rows = [(i, "w " * rng.randrange(1, 40), rng.choice(["en", "de", None]), rng.choice(["a", "a", "a", "b"])) for i in range(400)]
    docs = spark.createDataFrame(rows + [(900, None, "en", "a"), (None, "w", "en", "b")], "doc_id long, text string, lang string, source string")
    got = mixing.mixed(docs, keep=0.4).collect()
    assert len(got) == 402
    total = sum(r.tokens for r in got)
    assert sum(r.tokens * r.probability for r in got) == pytest.approx(0.4 * total, rel=1e-6)
    source = {i: s for i, _, _, s in rows}
    share = defaultdict(float)
    for r in got:
        if r.doc_id in source:
            share[source[r.doc_id]] += r.tokens * r.probability * r.weight
    tokens = Counter()
    for r in got:
        if r.doc_id in source:
            tokens[source[r.doc_id]] += r.tokens
    want = {s: n**0.5 for s, n in tokens.items()}
    assert share["a"] / share["b"] == pytest.approx(want["a"] / want["b"], rel=0.05)
    frames = mixing.mixed(docs, keep=0.4, max_cells=0).collect()
    assert sorted((r.doc_id or -1, round(r.probability, 6), r.kept) for r in frames) == sorted((r.doc_id or -1, round(r.probability, 6), r.kept) for r in got)
    assert mixing.mixed(docs.limit(0)).count() == 0


def marginals(rows, dims=("source", "lang", "topic")):
    total = sum(r["tokens"] for r in rows)
    return {d: {c: sum(r["tokens"] for r in rows if r[d] == c) / total for c in {r[d] for r in rows}} for d in dims}


def mixed_by_hand(docs, unmet):
    """The ids that mixing keeps, by dictionaries: raking, the largest share with little unmet weight, draws by md5."""
    rows = []
    for r in docs:
        words, low = re.findall(r"[^\x20\x09-\x0D]+", r.text or ""), (r.text or "").lower()
        kind = "legal" if "license" in low else "contact" if "@" in low else "web" if "http" in low else "long" if len(words) >= 1000 else "prose"
        rows.append({"id": r.doc_id, "tokens": len(words), "source": r.source or "(none)", "lang": r.lang or "(none)", "topic": kind})
    dims = ("source", "lang", "topic")
    cells = Counter()
    for r in rows:
        cells[tuple(r[d] for d in dims)] += r["tokens"]
    share = {c: n / sum(cells.values()) for c, n in cells.items() if n}
    sums = lambda w, k: {x: sum(v for c, v in w.items() if c[k] == x) for x in {c[k] for c in w}}
    goals = []
    for k, d in enumerate(dims):
        raised = {x: v ** mixing.TEMPER[d] for x, v in sums(share, k).items()}
        goals.append({x: v / sum(raised.values()) for x, v in raised.items()})
    w = dict(share)
    for _ in range(60):
        for k, goal in enumerate(goals):
            now = sums(w, k)
            w = {c: v * goal[c[k]] / now[c[k]] for c, v in w.items()}
    low, high = 0.0, max(share[c] / w[c] for c in w)
    for _ in range(60):
        f = (low + high) / 2
        low, high = (f, high) if sum(min(share[c], f * w[c]) for c in w) >= f * (1 - unmet) else (low, f)
    kept = set()
    for r in rows:
        c = tuple(r[d] for d in dims)
        p = min(1, low * w[c] / share[c]) if c in w else 1
        if int(hashlib.md5(str(r["id"]).encode()).hexdigest()[:8], 16) / 2**32 < p:
            kept.add(r["id"])
    return kept


def test_kept_documents_have_the_target_mix(spark):
    """What is kept, not only its probabilities, meets given and tempered targets within the error of sampling."""
    rng = random.Random(7)
    texts = ["plain words here " * 3, "a license note of words " * 2, "write to me@x " * 4, "see http here now " * 2]
    rows = [(i, rng.choice(texts), rng.choices(["en", "de", "fr"], [8, 3, 1])[0], rng.choices("abc", [10, 4, 1])[0]) for i in range(30_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").cache()
    targets = {"source": {"a": 2.0, "b": 1.0, "c": 1.0}, "lang": {"en": 0.5, "de": 0.3, "fr": 0.2}}
    for given in (targets, None):
        made = mixing.mixed(docs, keep=None, unmet=0.02, targets=given).join(docs.select("doc_id", "source", "lang"), "doc_id").collect()
        kept = marginals([r.asDict() for r in made if r.kept])
        before = marginals([r.asDict() for r in made])
        assert sum(r.kept for r in made) > 3_000
        for d in ("source", "lang", "topic"):
            goal = (given or {}).get(d) or {c: v ** mixing.TEMPER[d] for c, v in before[d].items()}
            off = sum(abs(kept[d].get(c, 0) - goal[c] / sum(goal.values())) for c in goal) / 2
            assert off < 0.02 + 0.015
    same = {r.doc_id for r in mixing.sampled(docs, unmet=0.02, targets=targets).collect()}
    assert same == {r.doc_id for r in mixing.mixed(docs, keep=None, unmet=0.02, targets=targets).collect() if r.kept}
    frames = {r.doc_id for r in mixing.sampled(docs, unmet=0.02, targets=targets, max_cells=0).collect()}
    assert len(frames ^ same) <= 3  # both searches end within rounding of one another
    with pytest.raises(ValueError, match="none of the target"):
        mixing.mixed(docs, targets={"source": {"z": 1.0}})


def test_a_topic_of_the_callers_own(spark):
    docs = spark.createDataFrame([(i, "x " * (i % 5 + 1), "en", "s") for i in range(50)], SCHEMA)
    got = mixing.mixed(docs, topic_of=lambda text, tokens: (tokens % 2).cast("string")).collect()
    assert {r.topic for r in got} == {"0", "1"}


def test_room_tree_and_best_fit():
    rng = random.Random(1)
    sizes = sorted((rng.randrange(1, 60) for _ in range(400)), reverse=True)
    plain, out = [], []
    for s in sizes:
        fits = [(room, k) for k, room in enumerate(plain) if room >= s]
        if fits:
            _, k = min(fits)
            plain[k] -= s
        else:
            k = len(plain)
            plain.append(100 - s)
        out.append(k)
    assert shards.best_fit(sizes, 100) == out


def test_shards(spark):
    rng = random.Random(4)
    texts = ["x" * rng.randrange(400) for _ in range(600)] + ["same text"] * 50 + [None, None, ""]
    got = shards.shard_documents(docs_of(spark, texts)).collect()
    assert len(got) == len(texts)
    where, load, slots = {}, Counter(), defaultdict(list)
    for r in got:
        assert where.setdefault(texts[r.doc_id], r.shard) == r.shard
        assert r.size == len(texts[r.doc_id] or "") + 1
        load[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert set(load) == set(range(8)) and max(load.values()) - min(load.values()) < 0.02 * sum(load.values()) / 8
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert shards.shard_documents(docs_of(spark, texts).limit(0)).count() == 0
    big = shards.shard_documents(docs_of(spark, ["a" * 10_000] * 20 + ["b"] * 10)).collect()
    assert len({r.shard for r in big if r.size > 10}) == 1


def test_shards_of_a_fixed_capacity(spark, monkeypatch):
    """Over one block and over many: no shard exceeds the capacity but by one group, and few more shards than plain best fit."""
    rng = random.Random(6)
    texts = [f"{i} " + "y" * rng.randrange(1, 900) for i in range(900)] + ["z" * 30_000] * 2
    sizes = Counter()
    for t in texts:
        sizes[t] += len(t) + 1
    plain = max(shards.best_fit(sorted(sizes.values(), reverse=True), 20_000)) + 1
    for block in (50_000, 200):
        monkeypatch.setattr(shards, "GROUPS_A_BLOCK", block)
        load, groups = Counter(), defaultdict(set)
        for r in shards.shard_documents(docs_of(spark, texts), capacity=20_000).collect():
            load[r.shard] += r.size
            groups[r.shard].add(texts[r.doc_id])
        assert all(n <= 20_000 or len(groups[s]) == 1 for s, n in load.items())
        assert plain <= len(load) <= plain + 2 and sum(load.values()) == sum(sizes.values())


def walked(forest, row):
    """The score of one row, a tree and a node at a time."""
    raw = forest.base
    for k in forest.roots:
        while forest.left[k] != k:
            k = forest.right[k] if row[forest.feature[k]] > forest.threshold[k] else forest.left[k]
        raw += forest.value[k]
    return 1 / (1 + np.exp(-raw))


def test_forest_against_single_steps():
    rng = np.random.default_rng(3)
    x, y = rng.integers(0, 9, (300, 3)).astype(float), rng.integers(0, 2, 300).astype(float)
    forest = quality.fit_forest(x, y, trees=12, depth=3)
    assert forest.scores(x) == pytest.approx([walked(forest, r) for r in x])


def test_first_split_against_all_splits():
    rng = np.random.default_rng(4)
    x = rng.integers(0, 12, (400, 3)).astype(float)
    y = ((x[:, 1] > 6) ^ (rng.random(400) < 0.2)).astype(float)
    forest = quality.fit_forest(x, y, trees=1, depth=1, rate=1.0, least=4.0, ridge=1.0)
    p = 1 / (1 + np.exp(-forest.base))
    g, h = p - y, np.full(400, p * (1 - p))
    best = (-1.0,)
    for f in range(3):
        for cut in np.unique(x[:, f])[:-1]:
            left = x[:, f] <= cut
            if min(h[left].sum(), h[~left].sum()) >= 4:
                gain = sum(g[m].sum() ** 2 / (h[m].sum() + 1) for m in (left, ~left)) - g.sum() ** 2 / (h.sum() + 1)
                if gain > best[0] + 1e-12:
                    best = (gain, f, cut, -g[left].sum() / (h[left].sum() + 1), -g[~left].sum() / (h[~left].sum() + 1))
    root = forest.roots[0]
    assert (forest.feature[root], forest.threshold[root]) == best[1:3]
    assert (forest.value[forest.left[root]], forest.value[forest.right[root]]) == pytest.approx(best[3:])


def test_statistics_of_texts_by_hand():
    texts = ["The CAT sat,\nthe cat sat!\nthe", "", None, "é1$ x", "w " * 3000]
    got = quality.text_features(pa.array(texts))
    for row, text in zip(got, texts, strict=True):
        raw = (text or "").encode()
        words = re.findall(rb"[^\x20\x09-\x0D]+", raw.lower())
        upper, lower = sum(65 <= b <= 90 for b in raw), sum(97 <= b <= 122 for b in raw)
        wide = sum(b >= 128 for b in raw)
        named = dict(zip(quality.FEATURES, row, strict=True))
        assert named["log_words"] == pytest.approx(np.log1p(len(words))) and named["log_bytes"] == pytest.approx(np.log1p(len(raw)))
        assert named["upper_share"] == pytest.approx(upper / max(upper + lower, 1)) and named["wide_share"] == pytest.approx(wide / max(len(raw), 1))
        assert named["distinct_words"] == pytest.approx(len(set(words)) / max(len(words), 1))
        assert named["top_word"] == pytest.approx(max(Counter(words).values(), default=0) / max(len(words), 1))
        assert named["distinct_lines"] == pytest.approx(len(set(raw.split(b"\n"))) / len(raw.split(b"\n")))


def test_forest_learns_and_scores():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, 4))
    y = ((x[:, 0] > 0) & (x[:, 2] < 0.5)).astype(float)
    forest = quality.fit_forest(x[:400], y[:400], trees=40)
    assert ((forest.scores(x[400:]) > 0.5) == y[400:]).mean() > 0.95
    assert quality.fit_forest(x[:0], y[:0]).scores(x[:2]).tolist() == [0.5, 0.5]


def test_quality_by_text(spark):
    rng = random.Random(8)
    good = [" ".join(rng.choice(["the", "tree", "house", "runs", "over", "blue"]) for _ in range(60)) + "." for _ in range(80)]
    bad = [" ".join(rng.choice(["BUY", "NOW!!", "$$$", "%%%"]) for _ in range(60)) for _ in range(80)]
    docs = docs_of(spark, good + bad + ["", None])
    labels = spark.createDataFrame([(i, int(i < 80)) for i in range(160)] + [(3, None), (None, 1)], "doc_id long, quality int")
    got = {r.doc_id: r for r in quality.classify(docs, labels).collect()}
    assert len(got) == 162 and all(got[i].predicted == int(i < 80) for i in range(160))
    assert 0 <= got[160].score <= 1 and got[160].score == got[161].score
    assert quality.classify(docs, labels.limit(0)).where("score <> 0.5").count() == 0
    assert quality.accepted(docs, quality.fit_quality(docs, labels)).where("doc_id between 80 and 159").count() == 0
