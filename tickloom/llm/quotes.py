"""Quotation linking: messages of a conversation in reply order, without the quotes, in DataFrame expressions only.

Lines that begin with `>` are quotes, as many levels deep as they have marks. Runs of lines of one level are passages. A
passage, and each of its paragraphs, lines and sentences, is hashed in a normal form and looked up among the whole texts,
paragraphs, lines and sentences of earlier messages of the conversation; a passage of which nothing is found, by windows of
its words among all windows of those messages. The message it comes from is the one replied to.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.session import cut

MARK = r"^[ \t]*(?:>[ \t]?)+"
# Endings of the line that introduces a quote, in English, German, French and Spanish.
INTRO = r"(?m)^[^\n>]*\b(?:wrote|writes|schrieb|a écrit|escribió)[ \t]*:[ \t]*\n(?:[ \t]*\n)?(?=[ \t]*>)"
SENTENCE = r"(?<=[.!?…][\"')\]»”]{0,2})\s+|(?<=[。！？])"
WINDOW = 8  # words of a window, or all words of a shorter passage
SALTS = 64  # tasks that the messages of one conversation are dealt to for their windows, at least
BUCKET = 1000  # turns of a conversation that are put in order together


def normal(text: Column) -> Column:
    """Lower-case letters and digits with single spaces, so that wrapping, marks and punctuation don't matter."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def unquoted(text: Column) -> Column:
    """A message without quotes and the lines that introduce them, blank lines at its ends removed."""
    kept = F.filter(F.split(F.regexp_replace(text, INTRO, ""), "\n"), lambda x: ~x.rlike(MARK))
    return F.regexp_replace(F.array_join(kept, "\n"), r"^(?:[ \t]*\n)+|(?:\n[ \t]*)+$", "")


def _messages(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, body, n): n numbers repeated turns."""
    plain = conversations.select(F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), "role", F.coalesce("text", F.lit("")).alias("text"))
    counted = plain.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("rows"))
    rivals = Window.partitionBy("conv_id", "turn").orderBy("role", F.xxhash64("text"), "text")
    placed = counted.withColumn("before", F.coalesce(F.sum("rows").over(rivals.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    each = placed.select("conv_id", "turn", "role", "text", F.explode(F.sequence(F.lit(1), F.col("rows"))).alias("k"), "before")
    return each.select("conv_id", "turn", "role", "text", (F.col("before") + F.col("k")).alias("n"), unquoted(F.col("text")).alias("body"))


def _units(lines: Column) -> Column:
    """Text made of an array of lines, its paragraphs, lines and the sentences of both, some of them repeated."""
    whole = F.array_join(lines, "\n")
    parts = F.concat(F.split(whole, r"\n(?:[ \t]*\n)+"), lines)
    return F.concat(F.array(whole), parts, F.flatten(F.transform(parts, lambda x: F.split(x, SENTENCE))))


def passages(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, n, level, run, unit, whole, counts) of quoted passages and their parts in normal form, the empty ones left out.

    run numbers the passages of a message; `whole` is true of the passage, `counts` of the passage and its lines.
    """
    quoting = messages.where(F.col("text").rlike("(?m)" + MARK))
    each = quoting.select("conv_id", "turn", "n", F.posexplode(F.split("text", "\n")).alias("at", "line"))
    marks = F.regexp_extract("line", f"({MARK})", 1)
    each = each.select("conv_id", "turn", "n", "at", F.length(F.regexp_replace(marks, "[^>]", "")).alias("level"), F.regexp_replace("line", MARK, "").alias("line"))
    message = Window.partitionBy("conv_id", "turn", "n").orderBy("at")
    border = (F.col("level") != F.lag("level", 1, -1).over(message)).cast("int")
    runs = each.withColumn("border", border).withColumn("run", F.sum("border").over(message)).where("level > 0")
    key = ("conv_id", "turn", "n", "level", "run")
    lines = runs.groupBy(*key).agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "line"))), lambda x: x["line"]).alias("lines"))
    units = lines.select(*key, F.transform("lines", normal).alias("each"), normal(F.array_join("lines", " ")).alias("all"), F.explode(_units(F.col("lines"))).alias("unit"))
    units = units.select(*key, normal(F.col("unit")).alias("unit"), "all", "each").where("unit <> ''")
    whole = F.col("unit") == F.col("all")
    return units.select(*key, "unit", whole.alias("whole"), (whole | F.array_contains("each", F.col("unit"))).alias("counts")).distinct()


def _latest(known: DataFrame, wanted: DataFrame) -> DataFrame:
    """(conv_id, turn, ask, hash, parent): for each row of `wanted` the last earlier turn of `known` with its hash, if any."""
    known = known.join(wanted.select("conv_id", "hash").distinct(), ["conv_id", "hash"], "left_semi").distinct()
    # The last earlier turn that has the passage: a running maximum over both kinds of row, not a join of all of them.
    both = known.withColumn("ask", F.lit(None).cast(wanted.schema["ask"].dataType)).unionByName(wanted)
    earlier = Window.partitionBy("conv_id", "hash").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    found = both.withColumn("parent", F.max(F.when(F.col("ask").isNull(), F.col("turn"))).over(earlier))
    return found.where("ask is not null and parent is not null")


def _windows(unit: Column, size: Column) -> Column:
    """Hashes of all windows of `size` words of a text in normal form, none if it has fewer."""
    words = F.split(unit, " ")
    starts = F.when(F.size(words) >= size, F.sequence(F.lit(1), F.size(words) - size + 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda k: F.xxhash64(F.array_join(F.slice(words, k, size), " ")))


def _links(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, n, parent, quoted): the turn that a message quotes, and how many of its passages were found."""
    wanted = cut(passages(messages).withColumns({"hash": F.xxhash64("unit"), "size": F.length("unit")}), "quotes")
    key = ("conv_id", "turn", "n", "level", "run")
    known = messages.select("conv_id", "turn", F.explode(F.array_distinct(_units(F.split("body", "\n")))).alias("unit"))
    known = known.select("conv_id", "turn", F.xxhash64(normal(F.col("unit"))).alias("hash"))
    asked = wanted.select("conv_id", "hash", "turn", F.struct("n", "level", "run", "size", "counts").alias("ask"))
    found = cut(_latest(known, asked).select("conv_id", "turn", "ask.*", "hash", "parent"), "found")
    # What is left: passages of which no part was found.
    left = wanted.where("whole").join(found.select(*key).distinct(), list(key), "left_anti")
    left = left.withColumn("words", F.least(F.size(F.split("unit", " ")), F.lit(WINDOW)))
    left = cut(left.select(*key, "size", "words", F.size(_windows(F.col("unit"), F.col("words"))).alias("all"), F.explode(F.array_distinct(_windows(F.col("unit"), F.col("words")))).alias("hash")), "left")
    lengths = left.select("conv_id", "words").distinct().withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    bodies = messages.select("conv_id", "turn", normal(F.col("body")).alias("unit"), F.pmod(F.xxhash64("turn", "n"), F.lit(SALTS)).cast("int").alias("salt"))
    shown = bodies.join(lengths, ["conv_id", "salt"]).select("conv_id", "turn", F.explode(F.array_distinct(_windows(F.col("unit"), F.col("words")))).alias("hash"))
    asked = left.select("conv_id", "hash", "turn", F.struct("n", "level", "run", "size", "all").alias("ask"))
    seen = _latest(shown, asked).groupBy("conv_id", "turn", "ask", "parent").agg(F.count("*").alias("met"))
    seen = seen.select("conv_id", "turn", "ask.n", "ask.level", "ask.run", F.floor(F.col("ask.size") * F.col("met") / F.col("ask.all")).cast("int").alias("size"), "parent")
    # A passage that was found in parts only counts once.
    parts = found.unionByName(seen.withColumns({"counts": F.lit(False), "hash": F.lit(None).cast("bigint")}))
    whole = parts.groupBy(*key).agg(F.max(F.struct("size", "parent")).alias("best"), F.collect_set(F.when(F.col("counts"), F.col("hash"))).alias("hashes"))
    best = F.max_by("best.parent", F.struct(-F.col("level"), "best.size", "best.parent"))
    by_hash = F.transform("hashes", lambda h: F.concat_ws(":", F.lit("hash"), "level", h))
    names = F.when(F.size("hashes") > 0, by_hash).otherwise(F.array(F.concat_ws(":", F.lit("run"), "level", "run")))
    quoted = F.size(F.array_distinct(F.flatten(F.collect_list("names")))).cast("bigint")
    return whole.withColumn("names", names).groupBy("conv_id", "turn", "n").agg(best.alias("parent"), quoted.alias("quoted"))


def _previous(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, previous): the next smaller turn of the conversation, in bounded groups of turns."""
    turns = messages.select("conv_id", "turn").distinct().withColumn("bucket", F.floor(F.col("turn") / BUCKET))
    last = turns.groupBy("conv_id", "bucket").agg(F.max("turn").alias("last"))
    before = last.select("conv_id", "bucket", F.lag("last").over(Window.partitionBy("conv_id").orderBy("bucket")).alias("carried"))
    inside = turns.withColumn("within", F.lag("turn").over(Window.partitionBy("conv_id", "bucket").orderBy("turn")))
    same = inside["conv_id"].eqNullSafe(before["conv_id"]) & (inside["bucket"] == before["bucket"])
    return inside.join(before, same).select(inside["conv_id"], "turn", F.coalesce("within", "carried").alias("previous"))


def reply_order(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, reply_to, quoted, depth, reply_path) of each row of (conv_id, turn, role, text).

    text has no quotes. reply_to is the turn of the message that is quoted: of the passages, or their paragraphs, lines and
    sentences, found in an earlier turn of the conversation those of the lowest level count, of these the longest, of equal
    ones the latest. A passage of which none is found counts where windows of WINDOW words (all, if it has fewer) are found,
    by its share of them. Without any it is the previous turn, and NULL for the first. quoted is the number of different
    passages and lines found, a passage found in other parts only being one; depth the number of times that a message on the way from the first one quotes a turn other than the previous one.

    reply_path puts a conversation in reply order (sort by conv_id, reply_path): a message comes behind the one it replies
    to, the direct continuation first. Rows are dealt and sorted by both, so a long conversation spreads over partitions.

    NULL and empty texts are empty messages. Rows with a NULL conv_id or turn have no reply_to and an empty path. Repeated
    rows and equal turns all stay, in order of role and text; the conversation goes on from the turn as a whole.
    """
    messages = cut(_messages(conversations), "messages")
    known = messages.where("conv_id is not null and turn is not null")
    links = cut(_links(known), "links")
    linked = known.select("conv_id", "turn", "n").join(_previous(known), ["conv_id", "turn"]).join(links, ["conv_id", "turn", "n"], "left")
    branch = F.col("parent").isNotNull() & ~F.col("parent").eqNullSafe(F.col("previous"))
    nodes = cut(
        linked.select("conv_id", "turn", "n", F.coalesce("parent", "previous").alias("reply_to"), F.coalesce("quoted", F.lit(0)).alias("quoted"), branch.alias("branch")),
        "replies",
    )
    # A run is a turn that quotes out of order and what directly goes on from it; it hangs on the quoted turn's run.
    starts = nodes.where("branch").groupBy("conv_id", "turn").agg(F.min("reply_to").alias("anchor"))
    runs = cut(_run_of(nodes, starts), "runs")
    hung = starts.join(runs.select("conv_id", F.col("turn").alias("anchor"), F.col("run").alias("above")), ["conv_id", "anchor"])
    # Within a run, replies to later turns come first.
    step = F.concat(_digits(F.lit(10**18) - F.col("anchor")), F.lit("."), _digits(F.col("turn")))
    paths = hung.select("conv_id", F.col("turn").alias("run"), "above", step.alias("path"), F.lit(1).alias("depth"))
    paths = cut(paths, "paths")
    # Pointer doubling: every round joins a path with that of the run it has come to.
    while not paths.where("above is not null").isEmpty():
        up = paths.select("conv_id", F.col("run").alias("above"), F.col("above").alias("next"), F.col("path").alias("head"), F.col("depth").alias("more"))
        paths = cut(
            paths.join(up, ["conv_id", "above"], "left").select(
                "conv_id", "run", F.col("next").alias("above"), F.concat_ws("/", "head", "path").alias("path"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth")
            ),
            "paths",
        )
    own = F.concat(F.lit("."), _digits(F.col("turn")), F.lit("."), F.lpad(F.col("n").cast("string"), 6, "0"))
    ordered = (
        nodes.join(runs, ["conv_id", "turn"])
        .join(paths.select("conv_id", "run", "path", "depth"), ["conv_id", "run"], "left")
        .select("conv_id", "turn", "n", "reply_to", "quoted", F.coalesce("depth", F.lit(0)).alias("depth"), F.concat(F.coalesce(F.concat("path", F.lit("/")), F.lit("")), own).alias("reply_path"))
    )
    texts = messages.select("conv_id", "turn", "n", "role", F.col("body").alias("text"))
    out = texts.join(ordered, ["conv_id", "turn", "n"], "left")
    out = out.select("conv_id", "turn", "role", "text", "reply_to", F.coalesce("quoted", F.lit(0)).alias("quoted"), F.coalesce("depth", F.lit(0)).alias("depth"), F.coalesce("reply_path", F.lit("")).alias("reply_path"))
    return out.repartitionByRange("conv_id", "reply_path").sortWithinPartitions("conv_id", "reply_path")


def _digits(number: Column) -> Column:
    """A number as text that sorts like it."""
    return F.lpad((number + 10**18).cast("string"), 19, "0")


def _run_of(nodes: DataFrame, starts: DataFrame) -> DataFrame:
    """(conv_id, turn, run): the last turn up to this one that starts a run, NULL before the first; in bounded groups."""
    turns = nodes.select("conv_id", "turn").distinct().join(starts.select("conv_id", "turn", F.col("turn").alias("start")), ["conv_id", "turn"], "left")
    turns = turns.withColumn("bucket", F.floor(F.col("turn") / BUCKET))
    last = turns.groupBy("conv_id", "bucket").agg(F.max("start").alias("last"))
    before = Window.partitionBy("conv_id").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select("conv_id", "bucket", F.max("last").over(before).alias("carried"))
    inside = Window.partitionBy("conv_id", "bucket").orderBy("turn").rowsBetween(Window.unboundedPreceding, 0)
    placed = turns.withColumn("within", F.max("start").over(inside)).join(carried, ["conv_id", "bucket"])
    return placed.select("conv_id", "turn", F.coalesce("within", "carried").alias("run"))
