"""Line deduplication by a segment-partition edit join.

Of two lines within k edits, cut the shorter into k + 1 segments: one of them occurs
unchanged in the longer, at a place that its index and the difference in length
narrow to a few. So every line indexes its own segments under its length, and
looks up the substrings at those places under each length it may be compared with.

Lines that meet have the shared segment replaced by one mark, and what is left of
them is joined in the same way within their group, until the rests are short and
the groups small. Only then are pairs formed, and verified by a banded
bit-parallel edit distance. A group of many lines that share most of their text is
thus divided by what differs, and never expanded into all its pairs: at one edit, rests
that cannot be cut any more are linked by what is left without one character, and
each such group by links to its least line.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.components import components
from daybook.llm.text import or_empty
from daybook.scratch import stored

MAX_EDITS = 1
#: A line needs so many characters for an edit to be a small change; shorter ones are repetitions only if equal.
CHARS_PER_EDIT = 20
#: Rests up to this length are compared pair by pair in groups up to SMALL_GROUP.
SHORT_REST = 24
SMALL_GROUP = 12
#: Ids or positions up to this number are broadcast (about 80 bytes each); beyond it both sides are shuffled.
BROADCAST_ROWS = 2_000_000

#: Stands for a shared segment that has been taken out; NUL in a line counts as U+FFFD.
_MARK = "\x00"


def within_edits(a: Column, b: Column, k: int) -> Column:
    """Whether two texts differ by at most ``k`` insertions, deletions and substitutions.

    State e is a bit mask over the 2k + 1 diagonals of the band: those that reach the
    current character of ``b`` with at most e edits. One step per character shifts and
    joins the masks.
    """
    band = (1 << 2 * k + 1) - 1
    padded = F.concat(F.lit("\x00" * k), a)
    start = F.array(*[F.lit(((1 << e + 1) - 1) << k) for e in range(k + 1)])

    def step(reached: Column, j: Column) -> Column:
        char = F.substring(b, j, F.lit(1))
        bits = [
            F.when(F.substring(padded, j + t, F.lit(1)) == char, F.lit(1 << t)).otherwise(0)
            for t in range(2 * k + 1)
        ]
        equal = reduce(lambda x, y: x.bitwiseOR(y), bits)
        masks: list[Column] = []
        for e in range(k + 1):
            mask = reached[e].bitwiseAND(equal)
            if e:
                fewer = reached[e - 1]
                edited = fewer.bitwiseOR(F.shiftright(fewer, 1)).bitwiseOR(F.shiftleft(masks[-1], 1))
                mask = mask.bitwiseOR(edited).bitwiseAND(F.lit(band))
            masks.append(mask)
        return F.array(*masks)

    columns = F.when(F.length(b) > 0, F.sequence(F.lit(1), F.length(b))).otherwise(F.array().cast("array<int>"))
    end = F.length(a) - F.length(b)
    last = F.aggregate(columns, start, step)[k]
    return (F.abs(end) <= k) & (F.expr("1").bitwiseAND(F.call_function("shiftright", last, end + k)) == 1)


def _variants(k: int, context: Column, text: Column) -> list[tuple[Column, bool, Column, int]]:
    """(key, own, rest, shorter): the segments a text indexes (own) and the substrings it looks up.

    Text is compared with texts that are shorter by 0 to k characters, so that each
    pair is found once, from the longer side. Segment i of a shorter text may be shifted
    by d: at most i edits lie before it, and at most k - i behind it.
    """
    found = []
    for shorter in range(k + 1):
        size = F.length(text) - shorter
        for i in range(k + 1):
            first = F.floor(size * i / (k + 1)).cast("int")
            width = F.floor(size * (i + 1) / (k + 1)).cast("int") - first
            for d in range(-i, i + 1):
                if abs(d - shorter) <= k - i:
                    start = first + d
                    segment = F.substring(text, start + 1, width)
                    fits = (size > k) & (start >= 0) & (start + width <= F.length(text))
                    rest = F.concat(F.substring(text, F.lit(1), start), F.lit(_MARK), F.substring(text, start + width + 1, F.length(text)))
                    key = F.when(fits, F.xxhash64(context, size, F.lit(i), segment))
                    found.append((key, shorter == 0 and d == 0, rest, shorter))
    return found


def _keys(rows: DataFrame, k: int) -> DataFrame:
    """``rows`` (id, context, text) times their variants: id, key, own, rest and base.

    base is the length of the rest of the shorter text, the same in all rows of a key.
    """
    parts = []
    for key, own, rest, shorter in _variants(k, F.col("context"), F.col("text")):
        base = (F.length(rest) - shorter).alias("base")
        parts.append(F.struct(key.alias("key"), F.lit(int(own)).alias("own"), rest.alias("rest"), base))
    return rows.select("id", F.inline(F.array(*parts))).where("key IS NOT NULL")


def _stored_keys(rows: DataFrame, k: int) -> DataFrame:
    """id, key, own and the number of the variant; the texts are cut once, though the keys are read twice."""
    variants = _variants(k, F.col("context"), F.col("text"))
    hashed = stored(rows.select("id", F.array(*[key for key, *_ in variants]).alias("keys")))
    own = F.col("variant").isin([v for v, (_, own, *_) in enumerate(variants) if own]).cast("int")
    keys = hashed.select("id", F.posexplode("keys").alias("variant", "key")).where("key IS NOT NULL")
    return keys.withColumn("own", own)


def _met(keys: DataFrame) -> DataFrame:
    """The keys that at least two rows share, one of them as its own segment, with their number n."""
    shared = keys.groupBy("key").agg(F.sum("own").alias("owned"), F.count(F.lit(1)).alias("n"))
    return keys.join(shared.where("owned > 0 AND n > 1").select("key", "n"), "key")


def edit_links(lines: DataFrame, k: int = MAX_EDITS) -> DataFrame:
    """Links (a, b) between ids of ``lines`` (id, line; lines distinct) within ``k`` edits.

    The links span the same components as all pairs within ``k`` edits; up to short groups they are all pairs.
    """
    text = F.translate("line", _MARK, "\ufffd")
    rows = lines.select("id", F.lit(0).cast("long").alias("context"), text.alias("text"))
    met = stored(_met(_stored_keys(rows, k)).select("id", "key", "variant", "n"))
    rests = F.array(
        *[F.struct(rest.alias("rest"), (F.length(rest) - shorter).alias("base"))
          for _, _, rest, shorter in _variants(k, F.col("context"), F.col("text"))]
    )
    ids = met.select("id", "key", "variant", "n")
    if ids.count() <= BROADCAST_ROWS:
        ids = F.broadcast(ids)
    fetched = rows.join(ids, "id").withColumn("chosen", F.element_at(rests, F.col("variant") + 1))
    rows = stored(fetched.select("id", "key", "n", "chosen.rest", "chosen.base"))
    links = []
    while not rows.isEmpty():
        short = (F.col("base") <= SHORT_REST) & (F.col("n") <= SMALL_GROUP) | (F.col("base") <= 2 * k + 1)
        crowded = (F.col("base") <= 2 * k + 1) & (F.col("n") > SMALL_GROUP)
        if k == 1 and not rows.where(crowded).isEmpty():
            links.append(_uncut_links(rows.where(crowded)))
            links.append(_verified(rows.where(short & ~crowded), k))
        else:
            links.append(_verified(rows.where(short), k))
        deeper = rows.where(~short).select("id", F.col("key").alias("context"), F.col("rest").alias("text"))
        rows = stored(_met(_keys(deeper.distinct(), k)).select("id", "key", "n", "rest", "base"))
    if not links:
        return rows.select(F.col("id").alias("a"), F.col("id").alias("b"))
    return reduce(DataFrame.union, links).distinct()


def _uncut_links(rows: DataFrame) -> DataFrame:
    """Links that span what one edit links among short rests; their number grows with the rows, not with pairs.

    Rests that differ in one character are equal but for a hole in its place, and so are all
    that share the hole: each is linked to the least. A rest that lacks one character of
    another is linked to it.
    """
    rows = rows.select("key", "id", "rest").distinct()
    place = F.when(F.length("rest") > 0, F.sequence(F.lit(1), F.length("rest"))).otherwise(F.array().cast("array<int>"))
    holes = rows.withColumn("i", F.explode(place)).select(
        "key",
        "id",
        "i",
        F.substring("rest", F.lit(1), F.col("i") - 1).alias("before"),
        F.expr("substring(rest, i + 1)").alias("after"),
    )
    least = holes.groupBy("key", "i", "before", "after").agg(F.min("id").alias("a"), F.count(F.lit(1)).alias("n"))
    same = holes.join(least.where("n > 1"), ["key", "i", "before", "after"]).where("id <> a").select("a", F.col("id").alias("b"))
    without = holes.select("key", F.col("id").alias("b"), F.concat("before", "after").alias("rest"))
    lacks = without.join(rows.withColumnRenamed("id", "a"), ["key", "rest"]).where("a <> b")
    return same.unionByName(lacks.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))


def _verified(rows: DataFrame, k: int) -> DataFrame:
    left = rows.select("key", F.col("id").alias("a"), F.col("rest").alias("rest_a"))
    right = rows.select("key", F.col("id").alias("b"), F.col("rest").alias("rest_b"))
    close = (F.col("a") < F.col("b")) & (F.abs(F.length("rest_a") - F.length("rest_b")) <= k)
    linked = close & within_edits(F.col("rest_a"), F.col("rest_b"), k)
    return left.join(right, (left["key"] == right["key"]) & linked).select("a", "b")


def _occurrences(docs: DataFrame) -> DataFrame:
    """Lines that are not blank with their place, and 128 bits of hash that stand for the line."""
    placed = docs.select(
        "doc_id",
        F.xxhash64("text").alias("text_hash"),
        F.posexplode(F.split(or_empty(F.col("text")), "\n")).alias("pos", "line"),
    )
    return placed.where(F.col("line").rlike("\\S")).select(
        F.struct("doc_id", "text_hash", "pos").alias("place"),
        F.xxhash64("line").alias("h1"),
        F.xxhash64(F.lit(7), "line").alias("h2"),
        "line",
    )


def repeated_lines(docs: DataFrame, k: int = MAX_EDITS) -> DataFrame:
    """(doc_id, text_hash, dropped, copies_of) of the documents that repeat a line.

    Lines of CHARS_PER_EDIT characters or more link within ``k`` edits; linked lines form classes, and
    a shorter line is a class with its copies. Blank lines are no lines, and stay. The first line of a class
    by doc_id (null first), text hash and position stays, all others are in
    ``dropped``, sorted positions from 0; ``copies_of`` are the distinct doc_ids of what stays (null left out).
    Rows of equal doc_id and text are one document that is listed once.
    """
    occurrences = _occurrences(docs)
    distinct = occurrences.groupBy("h1", "h2").agg(
        F.min("place").alias("first"), F.count(F.lit(1)).alias("n"), F.first("line").alias("line")
    )
    known = stored(distinct.withColumn("id", F.monotonically_increasing_id()), compression="zstd")
    long_enough = known.where(F.length("line") >= CHARS_PER_EDIT).select("id", "line")
    roots = components(edit_links(long_enough, k)).withColumnRenamed("node", "id")
    classes = (
        known.select("id", "h1", "h2", "first", "n")
        .join(roots, "id", "left")
        .where("root IS NOT NULL OR n > 1")
        .withColumn("root", F.coalesce("root", "id"))
    )
    kept = classes.groupBy("root").agg(F.min("first").alias("kept"))
    again = stored(classes.join(kept, "root").select("h1", "h2", "kept"))
    drops = occurrences.drop("line").join(again, ["h1", "h2"]).where("place <> kept")
    per_document = drops.groupBy("place.doc_id", "place.text_hash").agg(
        F.sort_array(F.collect_set("place.pos")).alias("dropped"),
        F.sort_array(F.collect_set("kept.doc_id")).alias("copies_of"),
    )
    return stored(per_document)


def drop_repeated_lines(docs: DataFrame, k: int = MAX_EDITS) -> DataFrame:
    """All rows and columns of ``docs``, without the repeated lines in ``text``.

    Adds n_lines (of the text as it was, at least 1), n_dropped and copies_of (see
    ``repeated_lines``; empty where nothing was dropped); columns of these names are
    replaced. A text without repeated lines, null included, stays as it is; one of
    nothing else becomes empty. Rows that are equal in doc_id and text are treated alike.
    """
    names = ("n_lines", "n_dropped", "copies_of")
    columns = [c for c in docs.columns if c not in names]
    own = "_" * max(len(c) for c in docs.columns)  # longer than any column's name with what follows
    doc_id, text_hash, dropped, places = (own + x for x in ("doc_id", "text_hash", "dropped", "lines"))
    found = repeated_lines(docs, k).toDF(doc_id, text_hash, dropped, "copies_of")
    size = found.agg(F.coalesce(F.sum(F.size(dropped) + F.size("copies_of")), F.lit(0))).first()[0]
    if size <= BROADCAST_ROWS:
        found = F.broadcast(found)
    same = F.xxhash64("text").eqNullSafe(F.col(text_hash)) & docs["doc_id"].eqNullSafe(F.col(doc_id))
    lines = F.split(or_empty(F.col("text")), "\n")
    runs = F.transform(
        F.sequence(F.lit(0), F.size(dropped)),
        lambda i: F.slice(
            places,
            F.coalesce(F.get(dropped, i - 1), F.lit(-1)) + 2,
            F.coalesce(F.get(dropped, i), F.size(places)) - F.coalesce(F.get(dropped, i - 1), F.lit(-1)) - 1,
        ),
    )
    rest = F.array_join(F.flatten(runs), "\n")
    joined = docs.select(*columns).join(found, same, "left").withColumn(places, lines)
    new_text = F.when(F.col(dropped).isNotNull(), rest).otherwise(F.col("text"))
    return joined.select(
        *[new_text.alias("text") if c == "text" else F.col(c) for c in columns],
        F.size(places).cast("long").alias("n_lines"),
        F.coalesce(F.size(dropped), F.lit(0)).cast("long").alias("n_dropped"),
        F.coalesce("copies_of", F.array().cast(found.schema["copies_of"].dataType)).alias("copies_of"),
    )
