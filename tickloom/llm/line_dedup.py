"""Near-duplicate lines by a segment-partition edit join, in DataFrame expressions only.

A line of length l is cut into tau + 1 even segments. If an edit distance is tau or less, one segment of the shorter line
occurs unchanged in the longer one, at a place that the edits left and right of it allow; those places are probed by hash.
Pairs that meet are verified with a bit-parallel edit distance over a band of 2 tau + 1 diagonals. Up to tau = TAU edits are
allowed, and no more than one in EACH code points of the shorter line.

Lines none of whose segments occurs in another line have no near line and are left out first, by the least and the greatest line of
each key. The others are put into blocks of lines that share a segment, and blocks meet blocks: symbols that occur an odd number of
times and letter counts tell within them which lines may be near, whose distance is then found in place, so only links become rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.session import cut

TAU = 2  # edits between lines that are near duplicates
EACH = 10  # code points for an edit
LETTERS = "entrai"  # counted to tell pairs apart before their edit distance is found
SYMBOLS = "abcdefghijklmnopqrstuvwxyz0123456789"  # of which is known whether they occur an odd number of times
BLOCK = 256  # lines of a block of a key, about


def lines(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, line_no, line, line_id) of all lines that are not blank, trimmed of white space; line_no starts at 0."""
    each = docs.select(F.col("doc_id").cast("bigint"), F.xxhash64("text").alias("text_hash"), F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    trimmed = each.withColumn("line", F.btrim("line", F.lit(" \t\n\x0b\x0c\r"))).where("line <> ''")
    return trimmed.withColumn("line_id", F.xxhash64("line"))


def _segment(length: Column, i: Column, tau: int) -> tuple[Column, Column]:
    """(start from 0, size) of segment i of a line: the last ones are one longer if the length doesn't divide evenly."""
    base, short = F.floor(length / (tau + 1)).cast("int"), (tau + 1) - length % (tau + 1)
    return base * i + F.greatest(i - short, F.lit(0)), base + F.when(i >= short, 1).otherwise(0)


def _places(tau: int) -> list[tuple[int, int, int]]:
    """(shorter, segment, shift) of all places at which a line may hold a segment of one that is `shorter` by 0 to `tau`.

    Edits before the segment move it by its number at most, edits behind it by the number of segments that follow.
    """
    return [
        (shorter, i, shift)
        for shorter in range(tau + 1)
        for i in range(tau + 1)
        for shift in range(max(-i, shorter - (tau - i)), min(i, shorter + (tau - i)) + 1)
    ]


def _keys(sized: DataFrame, places: list[tuple[int, int, int]], tau: int, name: str, lengths: tuple[int, int | None]) -> DataFrame:
    """(name, key, further columns) of every line of (line_id, line, length, further columns) and place that lies within it, for shorter
    lines of these lengths.

    A row for each place, whose key is found afterwards: one expression for all places is too long for the JIT compiler.
    """
    names = ("shorter", "i", "shift")
    each = F.explode(F.array(*[F.struct(*[F.lit(v).alias(k) for k, v in zip(names, p, strict=True)]) for p in places]))
    placed = sized.withColumn("p", each)
    shorter = F.col("length") - F.col("p.shorter")
    placed = placed.where(shorter >= lengths[0]) if lengths[1] is None else placed.where(shorter.between(*lengths))
    start, size = _segment(F.col("length") - F.col("p.shorter"), F.col("p.i"), tau)
    placed = placed.withColumns({"at": start + F.col("p.shift"), "size": size}).where("at >= 0 and at + size <= length")
    key = F.xxhash64(F.substring(F.col("line"), F.col("at") + 1, F.col("size")), "p.i", F.col("length") - F.col("p.shorter"))
    return placed.select(F.col("line_id").alias(name), key.alias("key"), *[c for c in sized.columns if c not in ("line_id", "line", "length")])


def _bound(values: dict[str, Column], body: Callable[[Column], Column]) -> Column:
    """`body` of a struct of `values`, found once: what a lambda takes from outside is evaluated again at every step."""
    return F.transform(F.array(F.struct(*[v.alias(k) for k, v in values.items()])), body)[0]


def _common(most: Column, same: Callable[[Column, Column], Column]) -> Column:
    """The largest count up to `most` that can be reached by steps for which `same(count, step)`, from large steps to small."""
    longer = lambda n, step: F.when((n + step <= most) & same(n, step), n + step).otherwise(n)
    return F.aggregate(F.array(*[F.lit(1 << k) for k in range(30, -1, -1)]), F.lit(0), longer)


def within(a: Column, b: Column, tau: int) -> Column:
    """Whether the edit distance of strings is at most `tau`, `b` being as long as `a` or up to `tau` longer.

    A common start and a common end don't change the distance and are taken off first.
    """

    def without_start(s: Column) -> Column:
        same = lambda n, step: F.substring(s["a"], n + 1, step) == F.substring(s["b"], n + 1, step)
        start = _common(F.least(s["m"], s["n"]), same)
        rest = lambda h: {
            "a": F.substring(s["a"], h["start"] + 1, s["m"]), "b": F.substring(s["b"], h["start"] + 1, s["n"]),
            "m": s["m"] - h["start"], "n": s["n"] - h["start"],
        }
        return _bound({"start": start}, lambda h: _bound(rest(h), without_end))

    def without_end(s: Column) -> Column:
        end = lambda text, size, n, step: F.substring(text, size - n - step + 1, step)
        same = lambda n, step: end(s["a"], s["m"], n, step) == end(s["b"], s["n"], n, step)
        middle = lambda t: {
            "x": F.concat(F.array_repeat(F.lit(None).cast("string"), tau), F.split(F.substring(s["a"], F.lit(1), s["m"] - t["end"]), "")),
            "y": F.split(F.substring(s["b"], F.lit(1), s["n"] - t["end"]), ""),
            "m": s["m"] - t["end"], "n": s["n"] - t["end"],
        }
        return _bound({"end": _common(F.least(s["m"], s["n"]), same)}, lambda t: _bound(middle(t), judged))

    def judged(s: Column) -> Column:
        return F.when(s["m"] == 0, s["n"] <= tau).otherwise(_distance(s["x"], s["y"], s["m"], s["n"], tau) <= tau)

    return _bound({"a": a, "b": b, "m": F.char_length(a), "n": F.char_length(b)}, without_start)


def _distance(x: Column, y: Column, m: Column, n: Column, tau: int) -> Column:
    """Edit distance of m letters, which follow `tau` NULLs in `x`, and the n of `y`; some number over `tau` where it is over.

    Bit k of a column stands for row j - tau + k of the distance matrix: VP and VN mark the rows that are one more or one
    less than the row above. The distance is followed down the main diagonal and, behind the end of `x`, along its last row.
    """
    width, full = 2 * tau + 1, (1 << (2 * tau + 1)) - 1
    lit = lambda v: F.lit(v).cast("bigint")
    flip = lambda v: v.bitwiseXOR(lit(full))

    def step(s: Column, j: Column) -> Column:
        letter = F.element_at(y, j)
        equal = lit(0)
        for k in range(width):
            equal = equal.bitwiseOR(F.when(F.get(x, j - 1 + k) == letter, lit(1 << k)).otherwise(lit(0)))
        moved = _bound({"vp": s["vp"], "vn": s["vn"], "d": s["d"], "pm": equal}, advance(j))
        # The distance never falls along the diagonal, and by tau at most along the last row.
        return F.when(s["d"] > 2 * tau, s).otherwise(moved)

    def advance(j: Column) -> Callable[[Column], Column]:
        def inner(s: Column) -> Column:
            vp, vn, pm = s["vp"], s["vn"], s["pm"]
            d0 = (pm.bitwiseAND(vp) + vp).bitwiseXOR(vp).bitwiseOR(pm).bitwiseOR(vn).bitwiseAND(lit(full))
            return _bound({"vp": vp, "vn": vn, "d0": d0, "d": s["d"]}, close(j))

        return inner

    def close(j: Column) -> Callable[[Column], Column]:
        def inner(s: Column) -> Column:
            vp, vn, d0 = s["vp"], s["vn"], s["d0"]
            hp = vn.bitwiseOR(flip(d0.bitwiseOR(vp)))
            hn = d0.bitwiseAND(vp)
            down = F.shiftright(d0, 1)
            # The last row of `x` is bit m - j + tau of column j.
            edge = (m - j + tau).cast("int")
            on_row = F.when(F.getbit(hp, edge) == 1, 1).when(F.getbit(hn, edge) == 1, -1).otherwise(0)
            on_diagonal = 1 - F.getbit(d0, F.lit(tau)).cast("int")
            moved = s["d"] + F.when(j <= m, on_diagonal).otherwise(on_row)
            return F.struct(hn.bitwiseOR(flip(down.bitwiseOR(hp))).alias("vp"), down.bitwiseAND(hp).alias("vn"), moved.alias("d"))

        return inner

    first = F.struct(lit(full & ~((1 << tau) - 1)).alias("vp"), lit(0).alias("vn"), F.lit(0).alias("d"))
    return F.aggregate(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), first, step, lambda s: s["d"])


def _letters(text: Column) -> Column:
    """The counts of some letters (one byte each) modulo 32, in one number of five bits for each."""
    count = lambda k, x: F.shiftleft((F.octet_length(text) - F.octet_length(F.replace(text, F.lit(x), F.lit("")))).bitwiseAND(F.lit(31)), 5 * k)
    return sum((count(k, x) for k, x in enumerate(LETTERS[1:], 1)), count(0, LETTERS[0])).cast("int")


def _odd(text: Column) -> Column:
    """A bit for each of SYMBOLS (one byte each) that occurs an odd number of times; an edit changes two bits at most."""
    bit = lambda k, x: F.shiftleft((F.octet_length(text) - F.octet_length(F.replace(text, F.lit(x), F.lit("")))).bitwiseAND(F.lit(1)).cast("bigint"), k)
    return sum((bit(k, x) for k, x in enumerate(SYMBOLS[1:], 1)), bit(0, SYMBOLS[0]))


def _may_be_near(a: Column, b: Column, tau: int) -> Column:
    """False only for letter counts of strings more than `tau` edits apart: an edit changes two counts by one at most.

    Counts are compared around the circle of 32, where they are never further apart than they are.
    """
    count = lambda c, k: F.shiftright(c, 5 * k).bitwiseAND(F.lit(31))
    apart = lambda k: 16 - F.abs(F.abs(count(a, k) - count(b, k)) - 16)
    return sum((apart(k) for k in range(1, len(LETTERS))), apart(0)) <= 2 * tau


def _hits(index: DataFrame, probe: DataFrame) -> DataFrame:
    """(b, key, least, n) of the rows of `probe` (b, key) whose key some other line of `index` (a, key) has; `least` of its n lines.

    A line of the index probes its own keys as well, so it is found there if its key has another line of the index; if it has none, it is
    the least of its key. So every line with a common key is a b or a least, and no probe gives more than one row.
    """
    ends = index.groupBy("key").agg(F.min("a").alias("least"), F.max("a").alias("most"), F.count("*").alias("n"))
    found = probe.join(ends.hint("shuffle_hash"), "key").where("least <> b or most <> b")
    return found.select("b", "key", "least", "n")


def _met(index: DataFrame, probe: DataFrame, tau: int) -> DataFrame:
    """(a, b) of the lines of `index` (a, key) and `probe` (b, key) with a common key that are within `tau` edits; both also have the
    text, letters, odd and, of their key, the number of rows of the index, n, and of the probe, m.

    Both sides of a key are dealt to blocks, which meet as a whole: only links become rows.
    """

    def blocks(side: DataFrame, name: str, rows: str, into: str) -> DataFrame:
        place = F.pmod(F.xxhash64(name, F.lit(1)), F.ceil(F.col(rows) / BLOCK).cast("bigint"))
        return side.groupBy("key", place.alias("block")).agg(F.collect_list(F.struct(name, "letters", "odd", "text")).alias(into)).drop("block")

    def near(x: Column, y: Column) -> Column:
        odd = F.bit_count(x["odd"].bitwiseXOR(y["odd"])) <= 2 * tau
        return (x["a"] != y["b"]) & odd & _may_be_near(x["letters"], y["letters"], tau) & within(x["text"], y["text"], tau)

    pairs = lambda y: F.transform(F.filter("lines", lambda x: near(x, y)), lambda x: F.struct(x["a"].alias("a"), y["b"].alias("b")))
    both = blocks(probe, "b", "m", "probes").join(blocks(index, "a", "n", "lines"), "key")
    found = both.select(F.flatten(F.transform("probes", pairs)).alias("found")).where("size(found) > 0")
    return found.select(F.explode("found").alias("pair")).select("pair.*").distinct()


def near_lines(classes: DataFrame, tau: int = TAU, each: int = EACH) -> DataFrame:
    """(a, b) of all pairs of different lines within `tau` edits, and one edit for `each` code points of the shorter, a < b.

    `classes` has (line_id, line), a row for each different line.
    """
    table = classes.select("line_id", "line", F.char_length("line").cast("int").alias("length")).where(F.col("length") >= max(each, 2))
    found = []
    for edits in range(1, tau + 1):
        # Lines of fewer code points than edits + 1 have no segments.
        first, last = max(each * edits, edits + 1), each * (edits + 1) - 1 if edits < tau else None
        if last is not None and last < first:
            continue
        sized = table.where(F.col("length") >= first) if last is None else table.where(F.col("length").between(first, last + edits))
        anchors = [(0, i, 0) for i in range(edits + 1)]
        hits = cut(_hits(_keys(sized, anchors, edits, "a", (first, last)), _keys(sized, _places(edits), edits, "b", (first, last))), "hits")
        shared = hits.select(F.explode(F.array("b", "least")).alias("line_id")).distinct()
        sharing = sized.join(shared.hint("shuffle_hash"), "line_id", "left_semi")  # never sent whole to all tasks, as lines that share grow with the input
        sharing = cut(sharing.withColumns({"text": F.col("line"), "letters": _letters(F.col("line")), "odd": _odd(F.col("line"))}), "sharing")
        keys = hits.groupBy("key").agg(F.first("n").alias("n"), F.count("*").alias("m"))
        index = _keys(sharing, anchors, edits, "a", (first, last)).join(keys, "key")
        probe = hits.select(F.col("b").alias("line_id"), "key").join(keys, "key").join(sharing.drop("line", "length"), "line_id")
        near = _met(index, probe.withColumnRenamed("line_id", "b"), edits)
        found.append(near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))
    out = found[0] if found else table.select(F.col("line_id").alias("a"), F.col("line_id").alias("b")).limit(0)
    for more in found[1:]:
        out = out.unionByName(more)
    return out.distinct()


def _place() -> Column:
    """Order in which lines come: by doc_id (NULL last), by a hash of the text where rows share a doc_id, by line_no."""
    return F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "text_hash", "line_no")


def find_duplicates(docs: DataFrame, tau: int = TAU, each: int = EACH) -> tuple[DataFrame, DataFrame]:
    """(lines, links). `lines`: (doc_id, text_hash, line_no, line_id, equal, near) of all lines; `links`: pairs of near_lines().

    `equal`: the same line came before, in the order of _place(). `near`: it is no such repeat, but near a line that came before. Rows with the
    same doc_id and text are one document, whose lines are judged alike.
    """
    all_ = lines(docs)
    classes = cut(all_.groupBy("line_id").agg(F.min("line").alias("line"), F.min(_place()).alias("first"), F.count("*").alias("n")), "line-classes")
    links = cut(near_lines(classes, tau, each), "line-links")
    seen = classes.select("line_id", "first")
    firsts = links.join(seen.toDF("a", "first_a"), "a").join(seen.toDF("b", "first_b"), "b")
    late = firsts.select(F.when(F.col("first_a") < F.col("first_b"), F.col("b")).when(F.col("first_b") < F.col("first_a"), F.col("a")).alias("line_id"))
    late = late.where("line_id is not null").distinct().withColumn("late", F.lit(True))
    judged = classes.where("n > 1").select("line_id", "first").join(late, "line_id", "full")
    found = all_.drop("line").join(judged, "line_id", "left")
    equal = F.coalesce(_place() > F.col("first"), F.lit(False))
    marked = found.withColumn("equal", equal).withColumn("near", ~F.col("equal") & F.coalesce("late", F.lit(False)))
    return marked.select("doc_id", "text_hash", "line_no", "line_id", "equal", "near"), links


def _removed() -> Column:
    return F.array_sort(F.collect_set(F.when(F.col("equal") | F.col("near"), F.col("line_no"))))


def report(docs: DataFrame, tau: int = TAU, each: int = EACH) -> DataFrame:
    """(doc_id, n_lines, n_equal, n_near, removed) of each doc_id that has a line: removed are the line_no of duplicates.

    NULL, empty and blank texts have no line and no row; rows of one doc_id are counted together, and rows of equal text each.
    Lines too short for an edit (fewer than `each` code points) are duplicates only if equal. A line is known by a 64-bit hash
    of its text. An empty table gives no rows.
    """
    found, _ = find_duplicates(docs, tau, each)
    return found.groupBy("doc_id").agg(
        F.count("*").alias("n_lines"), F.count_if("equal").alias("n_equal"), F.count_if("near").alias("n_near"), _removed().alias("removed")
    )


def without_duplicates(docs: DataFrame, tau: int = TAU, each: int = EACH) -> DataFrame:
    """`docs`, all columns, without duplicate lines in `text`.

    Each row loses its own duplicates, also where rows share a doc_id. Rows with a NULL doc_id, or without lines, stay as they are.
    """
    found, _ = find_duplicates(docs, tau, each)
    gone = found.where("equal or near").groupBy("doc_id", "text_hash").agg(_removed().alias("removed"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_hash"))
    joined = rows.join(gone, ["doc_id", "text_hash"], "left")
    kept = F.filter(F.split("doc.text", "\n"), lambda x, i: ~F.array_contains("removed", i))
    text = F.when(F.col("removed").isNull(), F.col("doc.text")).otherwise(F.array_join(kept, "\n"))
    return joined.withColumn("doc", F.col("doc").withField("text", text)).select("doc.*")


#: report(documents) with its defaults and `removed` joined by commas, for DuckDB, whose edit distance counts bytes: other letters become control codes.
SQL = r"""
WITH each AS (
  SELECT doc_id, (i - 1)::INT AS line_no, trim(parts[i], chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS line
  FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents), unnest(range(1, len(parts) + 1)) AS t(i)),
full_lines AS (SELECT * FROM each WHERE line <> ''),
classes AS (SELECT line, min((doc_id IS NULL, doc_id, line_no)) AS first FROM full_lines GROUP BY line),
letters AS (SELECT string_agg(c, '' ORDER BY c) AS s, count(*) AS n FROM (SELECT DISTINCT unnest(string_split(line, '')) AS c FROM classes) WHERE ord(c) > 126),
codes AS (SELECT string_agg(chr((CASE WHEN k < 9 THEN k ELSE k + 5 END)::INT), '' ORDER BY k) AS t FROM letters, unnest(range(1, n + 1)) AS x(k)),
flat AS (SELECT line, first, length(line) AS l, translate(line, s, t) AS flat FROM classes, letters, codes WHERE length(line) >= 10),
late AS (
  SELECT DISTINCT CASE WHEN a.first < b.first THEN b.line ELSE a.line END AS line
  FROM flat a JOIN flat b ON b.l BETWEEN a.l AND a.l + 2 AND a.line <> b.line
  WHERE levenshtein(a.flat, b.flat) <= CASE WHEN a.l < 20 THEN 1 ELSE 2 END),
marked AS (
  SELECT f.doc_id, f.line_no, (f.doc_id IS NULL, f.doc_id, f.line_no) > c.first AS equal, late.line IS NOT NULL AS late
  FROM full_lines f JOIN classes c USING (line) LEFT JOIN late USING (line))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (equal) AS n_equal, count(*) FILTER (late AND NOT equal) AS n_near,
  coalesce(string_agg(line_no::VARCHAR, ',' ORDER BY line_no) FILTER (equal OR late), '') AS removed
FROM marked GROUP BY doc_id
"""
