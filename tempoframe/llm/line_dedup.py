"""Line dedup: a segment-partition edit join over distinct lines, verified by banded bit-parallel edit distance."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tempoframe.llm.graph import connected_components
from tempoframe.llm.workspace import join_counted, staged, table, width

#: Characters from which lines are compared within one edit, and within two; the shorter line of a pair decides. At one edit
#: in eight characters and fewer, lines are duplicates only if equal.
STEPS = (9, 24)
#: Frequent letters; their counts tell most lines apart before a pair is made.
LETTERS = "entriashdlcoug"
#: Lines in candidate pairs up to this many are found by a broadcast of their ids (16 MB), more by shuffling.
#: What a line that is not blank holds.
NOT_BLANK = r"[^ \t\x0B\f\r]"
BROADCAST_IDS = 1_000_000


def _probes(edits: int, d: int) -> list[tuple[int, int, int, int]]:
    """Segment, number of segments, ``d`` and shift of the substrings that can equal a segment of a line that is ``d`` shorter and may have ``edits`` edits.

    Of segment i at start p a match that must be considered begins within i of p (no more edits lie to its left) and
    within ``edits - i`` of p + d (no more to its right).
    """
    return [(i, edits + 1, d, shift) for i in range(edits + 1) for shift in range(max(-i, d - (edits - i)), min(i, d + edits - i) + 1)]


def _allowed(length: int, steps: tuple[int, ...]) -> int:
    return sum(length >= least for least in steps)


def own_places(length: int, steps: tuple[int, ...]) -> list[tuple[int, int, int, int]]:
    """Places of the keys by which a line of a length is found: its own segments, one more than its edits."""
    edits = _allowed(length, steps)
    return [(i, edits + 1, 0, 0) for i in range(edits + 1)]


def probe_places(length: int, steps: tuple[int, ...]) -> list[tuple[int, int, int, int]]:
    """Places of the keys that find lines as long, or shorter by as many edits as those may have."""
    found = [(_allowed(length - d, steps), d) for d in range(len(steps) + 1)]
    return [place for edits, d in found if edits >= max(d, 1) for place in _probes(edits, d)]


def with_keys(lines: DataFrame, places: Callable[[int, tuple[int, ...]], list[tuple[int, int, int, int]]], steps: tuple[int, ...], name: str) -> DataFrame:
    """A row for each of the ``places`` of a line of ``steps[0]`` characters or more, with the hash of what stands there in ``name``.

    The segments of a line are even; the last ones take what is over. Places are constants and their keys are made row by row: as
    an array of all its keys a line's code was longer than the JVM compiles. Lines of single bytes are cut without counting characters.
    """
    struct = lambda place: F.struct(*(F.lit(x).alias(c) for x, c in zip(place, ("_i", "_parts", "_less", "_shift"))))
    by_length = [(n, places(n, steps)) for n in range(steps[0], steps[-1] + len(steps) + 1)]  # longer lines are like the last
    chosen = F.lit(None)
    for k, (n, found) in enumerate(reversed(by_length)):
        if k == 0:
            chosen = F.array(*map(struct, found))
        elif found != by_length[-k][1]:
            chosen = F.when(F.col("n") <= n, F.array(*map(struct, found))).otherwise(chosen)
    i, parts, length = F.col("_i"), F.col("_parts"), F.col("n") - F.col("_less")
    base, over = F.floor(length / parts).cast("int"), length % parts
    start = i * base + F.greatest(F.lit(0), over - (parts - i)) + F.col("_shift") + 1
    size = base + F.when(over >= parts - i, 1).otherwise(0)
    cut = lambda text: F.xxhash64(i, length, F.substring(text, start, size))
    key = F.when(F.octet_length("line") == F.col("n"), cut(F.col("line").cast("binary"))).otherwise(cut(F.col("line")))
    return lines.where(F.col("n") >= steps[0]).select(*lines.columns, F.inline(chosen)).select(*lines.columns, key.alias(name))


def with_sketch(lines: DataFrame) -> DataFrame:
    """``lines`` with ``sketch``: length, the count of characters beside fourteen frequent letters and the counts of these, each modulo 16, in a long.

    What is counted is taken out, so that less is left to search; each step is a column, as a nested expression would repeat the steps below.
    """
    names, found = ["line", *(f"_{letter}" for letter in LETTERS)], lines
    for letter, before, after in zip(LETTERS, names, names[1:]):
        found = found.withColumn(after, F.replace(F.col(before), F.lit(letter), F.lit("")))
    others = F.char_length("line") - F.octet_length("line") + F.octet_length(names[-1])
    times = [F.char_length("line"), others, *(F.octet_length(before) - F.octet_length(after) for before, after in zip(names, names[1:]))]
    packed = F.lit(0).cast("long")
    for k, count in enumerate(times):
        packed = packed.bitwiseOR(F.shiftleft(count.cast("long").bitwiseAND(F.lit(15)), 4 * k))
    return found.select(*lines.columns, packed.alias("sketch"))


def sketches_apart(a: Column, b: Column) -> Column:
    """Least sum of differences in the counts of the letters and of all other characters; an edit changes it by two at most.

    Every other count is subtracted at once, each in a byte of its own, where 16 more keeps it from borrowing. A difference d of 8 or
    more counts as 16 - d; the sum of the bytes of a number is the number modulo 255.
    """
    ones, total = 0x0101010101010101, F.lit(0).cast("long")
    for start, mask in ((0, ones * 15 - 15), (4, ones * 15)):  # the length is left out
        x, y = (F.shiftrightunsigned(c, start).bitwiseAND(F.lit(mask)) for c in (a, b))
        d = (x + F.lit(ones * 16) - y).bitwiseAND(F.lit(ones * 15))
        high = F.shiftrightunsigned(d, 3).bitwiseAND(F.lit(ones))
        total = total + d.bitwiseXOR(high * 15) + high
    return total % 255


def _chars(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def edit_distance(df: DataFrame, a: str, b: str, edits: int, name: str = "distance") -> DataFrame:
    """``df`` with the edit distance of columns ``a`` and ``b``: exact up to ``edits``, larger than that beyond.

    Banded and bit-parallel: the cells of a column within ``edits`` of the diagonal are bits of a word, bit t of column j
    for row j - edits + t of the longer string. Of each column only the rises and falls between its cells are
    kept, as two words; a few word operations take them to the next column, and the distance is read along the
    diagonal that ends in the last cell. Common starts and ends are taken off first. Null strings have a null distance.
    """
    width = 2 * edits + 1
    full, top = (1 << width) - 1, 1 << (width - 1)
    bits = " | ".join(f"if(get(l, j - {1 + edits - t}) = get(s, j - 1), {1 << t}, 0)" for t in range(width))
    rise, fall = f"(shiftright(x.rise, 1) | {top})", "shiftright(x.fall, 1)"
    zero = f"((((m & {rise}) + {rise}) ^ {rise} | m | {fall}) & {full})"
    right = f"((shiftleft({fall} | (~({zero} | {rise}) & {full}), 1) | 1) & {full})"
    left = f"(shiftleft({zero} & {rise}, 1) & {full})"
    start = f"named_struct('rise', {full >> (edits + 1) << (edits + 1)}, 'fall', {(1 << (edits + 1)) - 1}, 'score', gap)"
    step = (
        f"named_struct('rise', {left} | (~({zero} | {right}) & {full}), 'fall', {zero} & {right},"
        f" 'score', x.score + 1 - (shiftright({zero}, gap + {edits}) & 1))"
    )
    longer = F.char_length(a) >= F.char_length(b)
    pair = F.struct(
        _chars(F.when(longer, F.col(a)).otherwise(F.col(b))).alias("l"),
        _chars(F.when(longer, F.col(b)).otherwise(F.col(a))).alias("s"),
        F.abs(F.char_length(a) - F.char_length(b)).alias("gap"),
    )
    cols = [c for c in df.columns]
    chars = df.select(*cols, F.inline_outer(F.array(pair)))
    for _ in range(2):  # what the strings share at their start, and then, turned round, at their end
        apart = F.array_position(F.zip_with(F.slice("l", 1, F.size("s")), "s", lambda x, y: x == y), F.lit(False)).cast("int")
        skip = F.when(apart > 0, apart).otherwise(F.size("s") + 1)
        cut = [F.reverse(F.slice(c, F.col("skip"), F.greatest(F.size(c) - F.col("skip") + 1, F.lit(0)))).alias(c) for c in ("l", "s")]
        chars = chars.select(*cols, "l", "s", "gap", F.inline_outer(F.array(F.struct(skip.alias("skip"))))).select(*cols, F.inline_outer(F.array(F.struct(*cut, "gap"))))
    masks = F.expr(f"if(size(s) > 0, transform(sequence(1, size(s)), j -> {bits}), array())")
    masked = chars.select(*cols, "gap", F.inline_outer(F.array(F.struct(masks.alias("masks")))))
    score = F.expr(f"if(gap > {edits}, {edits + 1}, aggregate(masks, {start}, (x, m) -> {step}, x -> x.score))")
    return masked.select(*cols, score.alias(name))


def distinct_lines(docs: DataFrame) -> DataFrame:
    """Every different line that is not blank, with the number of its copies, its first document, an id and a sketch."""
    lines = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.explode(F.split("text", "\n")).alias("line"))
    found = lines.where(F.col("line").rlike(NOT_BLANK)).groupBy("line").agg(F.count("*").alias("n_copies"), F.min("doc_id").alias("first_doc_id"))
    return staged(with_sketch(found.withColumn("id", F.monotonically_increasing_id())), "lines")  # ids hold once they are written


def near_lines(lines: DataFrame, steps: tuple[int, ...] = STEPS) -> DataFrame:
    """Pairs (u, v) of ids of different lines within the edits that the shorter one's length allows.

    Lines of ``steps[0]`` characters or more may be one edit apart, of ``steps[1]`` or more two, and so on. A common segment is
    one key of the join; adaptive execution splits it where it holds much of the table.
    """
    if any(least <= 2 * edits for edits, least in enumerate(steps, 1)) or list(steps) != sorted(steps):
        raise ValueError("compared lines need more than twice as many characters as edits")
    n, edits = F.char_length("line"), len(steps)
    allowed = lambda c: sum((F.when(c >= least, 1).otherwise(0) for least in steps), F.lit(0))
    sized = lines.where(n >= steps[0]).select("id", "line", n.alias("n"), "sketch")
    keyed = lambda places, key: with_keys(sized, places, steps, key)
    index = keyed(own_places, "key").select(F.col("id").alias("v"), F.col("sketch").alias("sv"), "key")
    probes = keyed(probe_places, "pkey").select(F.col("id").alias("u"), F.col("sketch").alias("su"), "pkey")
    # Lines of one length probe each other: one direction is enough. (Lengths differ by less than 16.)
    length = lambda sketch: F.col(sketch).bitwiseAND(F.lit(15))
    once = (length("su") != length("sv")) | (F.col("u") > F.col("v"))
    alike = (F.col("pkey") == F.col("key")) & once & (sketches_apart(F.col("su"), F.col("sv")) <= 2 * edits)
    pairs = probes.join(index, alike).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    pairs = staged(pairs.distinct(), "pairs")
    ends = [pairs.select(F.col(c).alias("id")).distinct() for c in ("u", "v")]
    ids = staged(ends[0].unionAll(ends[1]).distinct(), "ids")
    few = ids.count() <= BROADCAST_IDS
    texts = staged(sized.join(F.broadcast(ids) if few else ids, "id", "left_semi").select("id", "line"), "texts")
    both = pairs.join(texts.select(F.col("id").alias("u"), F.col("line").alias("a")), "u").join(
        texts.select(F.col("id").alias("v"), F.col("line").alias("b")), "v"
    )
    both = both.repartition(width(lines.sparkSession), "u", "v")  # the work is in the comparisons, not in the bytes
    short = F.least(F.char_length("a"), F.char_length("b"))
    return edit_distance(both, "a", "b", edits).where(F.col("distance") <= allowed(short)).select("u", "v")


def line_classes(docs: DataFrame, steps: tuple[int, ...] = STEPS) -> DataFrame:
    """Classes of equal and near-equal lines of all documents.

    Returns one row per different line: ``line_md5``, ``n_chars``, ``n_copies``, ``first_doc_id`` (smallest doc_id that has the
    line), ``n_links`` (different lines within the edits that ``steps`` allows the shorter of both), ``class_md5``
    (smallest line_md5 reachable by links) and ``kept`` (``line_md5 = class_md5``). Lines end at line feeds; blank lines and
    null texts have no row; lines of fewer than ``steps[0]`` characters link with nothing. Copies within and across
    documents count alike, so repeated rows only raise ``n_copies``; rows without a doc_id count too, ``first_doc_id`` is
    null where there is no other. Other columns are ignored; an empty table gives no rows.

    A line within k edits of another keeps one of its k + 1 segments: each line is indexed by its segments and probes
    with the few substrings that can be such a segment of a line at most k shorter. Equal lines are one row from the
    start; keys are hashes, so that texts move only for candidate pairs. Pairs whose letter counts are too far apart
    are not made: of a family of lines that differ in whole words, few pairs are left.
    """
    lines = distinct_lines(docs)
    links = staged(near_lines(lines, steps), "links")
    ends = [links.groupBy(F.col(c).alias("id")).agg(F.count("*").alias("n")) for c in ("u", "v")]
    degree = ends[0].unionAll(ends[1]).groupBy("id").agg(F.sum("n").alias("n_links"))
    named = lines.select(
        "id", F.md5(F.col("line").cast("binary")).alias("line_md5"), F.char_length("line").cast("long").alias("n_chars"), "n_copies", "first_doc_id"
    )
    parts = staged(connected_components(links).withColumnRenamed("node", "id").join(degree, "id"), "parts")
    linked = staged(named.join(parts, "id"), "linked")  # lines with links alone: the others have no component to be joined by
    heads = linked.groupBy("component").agg(F.min("line_md5").alias("class_md5"), F.count("*").alias("copies"))
    cols = ["line_md5", "n_chars", "n_copies", "first_doc_id", "n_links", "class_md5"]
    found = join_counted(linked, staged(heads, "heads"), ["component"]).select(*cols)
    alone = named.join(parts.select("id"), "id", "left_anti").withColumns({"n_links": F.lit(0).cast("long"), "class_md5": F.col("line_md5")})
    return found.unionAll(alone.select(*cols)).withColumn("kept", F.col("line_md5") == F.col("class_md5"))


def without_repeats(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """``docs`` with ``text`` rid of every line whose class has a kept line elsewhere.

    Of a class the kept line stays, in the first place (of rows, then lines, in order) of its first document; blank lines stay
    everywhere. Rows without a doc_id and null texts are returned as they are, an empty text stays empty. Rows are told apart
    by a number of their own, so rows that share a doc_id keep their own lines. All columns of ``docs`` are returned; a
    column named ``_row`` is not allowed. An empty table gives no rows.
    """
    numbered = staged(docs.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    rows = numbered.where("doc_id is not null and text is not null")
    lines = rows.select("_row", F.col("doc_id").alias("_doc"), F.posexplode(F.split("text", "\n")).alias("_at", "_line"))
    lines = staged(lines.withColumn("line_md5", F.md5(F.col("_line").cast("binary"))), "lines")
    known = classes.where("n_copies > 1 or not kept").select("line_md5", F.col("first_doc_id").alias("_first"), F.col("kept").alias("_stays"))
    blank = ~F.col("_line").rlike(NOT_BLANK)
    counted = lines.where(~blank).groupBy("line_md5").agg(F.count("*").alias("copies"))
    known = staged(counted.join(known, "line_md5"), "known")
    judged = join_counted(lines.where(~blank), known, ["line_md5"])
    place = judged.where("_stays and _doc = _first").groupBy("line_md5").agg(F.min(F.struct("_row", "_at")).alias("p"))
    judged_out = judged.select("_row", "_at").join(place.select("p._row", "p._at"), ["_row", "_at"], "left_anti")
    left = lines.join(staged(judged_out, "gone"), ["_row", "_at"], "left_anti")
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_at", "_line"))), lambda x: x["_line"]), "\n")
    kept = left.groupBy("_row").agg(text.alias("_text"))
    rest = F.when(F.col("doc_id").isNull() | F.col("text").isNull(), F.col("text")).otherwise(F.coalesce("_text", F.lit("")))
    return numbered.join(kept, "_row", "left").withColumn("text", rest).select(*docs.columns)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of the lines of all documents, one or two edits apart by length."""
    return line_classes(table(spark, sf_dir, "documents"))


#: DuckDB counts edits in bytes: letters of two bytes are taken to control characters first.
_BYTES = "translate({0}, 'éèêçàâôûùëäöüßáíóúñÉÈÊÇÀÄÖÜÁÍÓÚ', " + " || ".join(f"chr({i})" for i in (*range(1, 10), *range(11, 32), 127)) + ")"

ORACLE = {
    "op1_line_dedup": f"""
WITH RECURSIVE s AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents WHERE text IS NOT NULL),
d AS MATERIALIZED (
  SELECT line, md5(line) AS h, length(line) AS n, count(*) AS n_copies, min(doc_id) AS first_doc_id
  FROM s WHERE trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) <> '' GROUP BY line),
p AS (SELECT line, h, n, t, n // t AS k, unnest(range(0, t)) AS part FROM (SELECT *, CASE WHEN n >= {STEPS[1]} THEN 3 ELSE 2 END AS t FROM d WHERE n >= {STEPS[0]})),
q AS (SELECT h, n, part, substr(line, part * k + 1, k) AS seg FROM p),
g AS (SELECT line, h, m, CASE WHEN m >= {STEPS[1]} THEN 3 ELSE 2 END AS t FROM (SELECT *, unnest(range(n - 2, n + 3)) AS m FROM d WHERE n >= {STEPS[0]}) WHERE m >= {STEPS[0]}),
w AS (
  SELECT line, h, m, t, part, unnest(range(part * (m // t) - 1, part * (m // t) + 4)) AS at0
  FROM (SELECT *, unnest(range(0, t)) AS part FROM g)),
c AS (
  SELECT DISTINCT w.h AS u, q.h AS v FROM w JOIN q
  ON q.n = w.m AND q.part = w.part AND q.seg = substr(w.line, w.at0, w.m // w.t) AND q.h <> w.h WHERE w.at0 > 0),
e AS MATERIALIZED (
  SELECT u, v FROM c JOIN d a ON a.h = c.u JOIN d b ON b.h = c.v
  WHERE levenshtein({_BYTES.format('a.line')}, {_BYTES.format('b.line')}) <= CASE WHEN least(a.n, b.n) >= {STEPS[1]} THEN 2 ELSE 1 END),
r AS (SELECT u, u AS c FROM e UNION SELECT e.v, r.c FROM r JOIN e ON e.u = r.u)
SELECT d.h AS line_md5, d.n AS n_chars, d.n_copies, d.first_doc_id, coalesce(x.k, 0) AS n_links,
       coalesce(m.c, d.h) AS class_md5, coalesce(m.c, d.h) = d.h AS kept
FROM d LEFT JOIN (SELECT u, count(*) AS k FROM e GROUP BY u) x ON x.u = d.h
LEFT JOIN (SELECT u, min(c) AS c FROM r GROUP BY u) m ON m.u = d.h
"""
}
