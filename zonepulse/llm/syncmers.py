"""Document fingerprints from closed syncmers, in DataFrame functions only.

A text is cut into words (longer ones into pieces).  Of all runs of four words, those are anchors
whose least inner pair of words, by hash, lies at the run's left or right edge.  Whether a run is
an anchor hangs on its own four words alone, so an edit elsewhere neither adds nor removes it, and
equal passages carry equal anchors at equal distances wherever they stand.  A fingerprint is the
sorted list of the least anchor hashes, from which the overlap of two anchor sets is estimated.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RUN_WORDS = 4
INNER_WORDS = 2
WORD_CHARS = 16
SKETCH_SIZE = 128

# Documents per bucket of neighbouring ids, and the number of id ranges whose density is measured.
BUCKET_DOCS = 32
RANGES = 128


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), 0)


def words_of(text: Column) -> Column:
    """Lower-case words; those over 16 characters in pieces, so that no text is one long word."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))),
                                F.lit(r"\S{1,%d}" % WORD_CHARS), F.lit(0))


def anchors(text: Column) -> Column:
    """``array<struct<pos: int, hash: long>>``: the closed syncmers of a text by word position.

    A text of words without any closed syncmer (all of one to three words, some of four) has one
    anchor, all of it; one without words has none.
    """
    inner = RUN_WORDS - INNER_WORDS + 1
    # Inner pairs that cover all words of a run, to hash the run from.
    cover = [*range(0, inner - 1, INNER_WORDS), inner - 1]

    def closed(h: Column) -> Column:
        def at(i: Column) -> Column:
            window = [F.get(h, i + j) for j in range(inner)]
            least = F.least(*window)
            return F.when((window[0] == least) | (window[-1] == least), F.struct(
                i.alias("pos"), F.xxhash64(*[window[j] for j in cover]).alias("hash")))
        return F.filter(F.transform(F.sequence(F.lit(0), F.size(h) - inner), at),
                        lambda a: a.isNotNull())

    def of(words: Column) -> Column:
        n = F.size(words)
        pairs = F.zip_with(F.slice(words, 1, n - 1), F.slice(words, 2, n - 1),
                           lambda a, b: F.xxhash64(a, b))
        whole = F.array(F.struct(F.lit(0).alias("pos"), F.xxhash64(words).alias("hash")))
        none = F.array().cast("array<struct<pos:int,hash:bigint>>")
        some = let(let(pairs, closed), lambda a: F.when(F.size(a) > 0, a).otherwise(whole))
        return F.when(n >= RUN_WORDS, some).when(n > 0, whole).otherwise(none)

    return let(words_of(text), of)


def sketch(found: Column) -> Column:
    """The least 32-bit anchor hashes, sorted, as ``array<int>``."""
    short = F.transform(found, lambda a: F.shiftright(a["hash"], 32).cast("int"))
    return F.slice(F.sort_array(F.array_distinct(short)), 1, SKETCH_SIZE)


def as_text(values: Column) -> Column:
    """A sketch as text, eight hex digits per hash; empty for a text without words."""
    return F.array_join(F.transform(values, lambda x: F.lpad(
        F.lower(F.hex(x.cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))), 8, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Estimated share of common anchors of two sketches, 0 to 1; two empty ones are alike.

    Of the least hashes of both together, the share that both have.
    """
    def of(union: Column) -> Column:
        return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(
            F.size(F.array_intersect(union, F.array_intersect(a, b))) / F.size(union))

    return let(F.slice(F.sort_array(F.array_union(a, b)), 1, SKETCH_SIZE), of)


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``anchors`` and ``fingerprint`` of every row; a null text counts as empty."""
    return docs.select("doc_id", anchors(F.col("text").cast("string")).alias("anchors")).select(
        "doc_id", "anchors", as_text(sketch(F.col("anchors"))).alias("fingerprint"))


def shared_passages(left: DataFrame, right: DataFrame) -> DataFrame:
    """Positional matches: ``left_id, right_id, shift, n_anchors``.

    Anchors found in both texts, counted by how far apart they stand; one shift with many anchors
    is a common passage.  Both inputs come from ``fingerprints`` and should be few candidates:
    an anchor that many texts share is matched with all of them.
    """
    def rows(df: DataFrame, side: str) -> DataFrame:
        return df.select(F.col("doc_id").alias(f"{side}_id"), F.explode("anchors").alias("a")).select(
            f"{side}_id", F.col("a.pos").alias(f"{side}_pos"), F.col("a.hash").alias("hash"))

    return (rows(left, "left").join(rows(right, "right"), "hash")
            .groupBy("left_id", "right_id", (F.col("right_pos") - F.col("left_pos")).alias("shift"))
            .agg(F.count(F.lit(1)).alias("n_anchors")))


def _bucketed(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``docs`` with a ``bucket`` of neighbouring ids, and each bucket with its ``previous`` one.

    Buckets follow the order of ids.  Their width is chosen per range of ids from its density, so
    gaps and clusters do no harm.  Only the bounds of ranges and the first bucket of each (129
    numbers) reach the driver.  Null ids come before all others, in buckets by text.
    """
    step = [i / RANGES for i in range(RANGES + 1)]
    n, bounds = docs.agg(F.count("doc_id"), F.percentile_approx("doc_id", step, 10_000)).first()
    bounds = sorted(set(bounds or [0]))
    per_range = max(1.0, n / RANGES)
    widths = [max(1, int((high - low) * BUCKET_DOCS / per_range))
              for low, high in zip(bounds, [*bounds[1:], bounds[-1] + 1], strict=True)]
    edges = F.array(*[F.lit(b).cast("long") for b in bounds])
    sizes = F.array(*[F.lit(w).cast("long") for w in widths])
    # The first bound may be approximate; ids below it belong to the first range.
    part = F.greatest(F.lit(1), F.size(F.filter(edges, lambda b: b <= F.col("doc_id"))))
    inside = F.floor((F.col("doc_id") - F.element_at(edges, part)) / F.element_at(sizes, part))
    by_text = -(1 + F.pmod(F.xxhash64("text"), F.lit(1 << 20)))
    bucket = F.when(F.col("doc_id").isNull(), by_text).otherwise(
        F.shiftleft(part.cast("long"), 44) + inside)
    rows = docs.withColumn("bucket", bucket.cast("long"))
    part_of = F.shiftright("bucket", 44)
    buckets = rows.select("bucket").distinct().withColumn("part", part_of)
    lasts = {r.part: r.last for r in buckets.groupBy("part").agg(
        F.max("bucket").alias("last")).collect()}
    order = sorted(lasts)
    before = {p: lasts[order[i - 1]] for i, p in enumerate(order)}
    fallback = F.lit(None).cast("long")
    for p, last in before.items():
        fallback = F.when(F.col("part") == p, F.lit(last)).otherwise(fallback)
    within = Window.partitionBy("part").orderBy("bucket")
    chain = buckets.select("bucket", F.coalesce(F.lag("bucket").over(within), fallback)
                           .alias("previous"))
    return rows, chain


def with_next(docs: DataFrame) -> DataFrame:
    """``doc_id, text, sketch`` and the next document's ``next_text, next_sketch``.

    Next is by ascending id, after the last the first.  Texts move once, dealt out by buckets of
    neighbouring ids; only the first row of a bucket goes to the bucket before it.  Rows with equal
    ids follow each other in the order of their texts.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows, chain = _bucketed(docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                                        text.alias("text")))
    rows = rows.withColumn("sketch", sketch(anchors(F.col("text"))))
    order = Window.partitionBy("bucket").orderBy("doc_id", "text")
    after = F.struct("text", "sketch")
    placed = rows.withColumn("after", F.lead(after).over(order)).withColumn(
        "place", F.row_number().over(order))
    firsts = (placed.filter("place = 1").select("bucket", after.alias("first"))
              .join(chain, "bucket").select(F.col("previous").alias("at"), "first"))
    both = placed.join(firsts, F.col("bucket") == F.col("at"), "left").withColumn(
        "next", F.coalesce("after", "first"))
    return both.select("doc_id", "text", "sketch", F.col("next.text").alias("next_text"),
                       F.col("next.sketch").alias("next_sketch"))


def edited_pairs(docs: DataFrame) -> DataFrame:
    """Fingerprints of every whole text and of its edited text.

    The edited text has its last ``floor(n_chars / 4)`` characters replaced by as many of the
    first characters of the next document (all, if it has fewer).  A null text counts as empty, a
    single document is its own next one, repeated rows give a row each, an empty table gives no
    rows, and columns other than ``doc_id`` and ``text`` are not looked at.
    """
    n = F.length("text")
    m = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - m),
                      F.substring(F.col("next_text"), F.lit(1), m))
    pairs = with_next(docs).select(
        "doc_id", n.cast("long").alias("n_chars"), "sketch", "next_sketch", edited.alias("edited"))
    made = pairs.select(
        "doc_id", "n_chars", "sketch", "next_sketch", F.sha2("edited", 256).alias("edited_sha256"),
        sketch(anchors(F.col("edited"))).alias("edited_sketch"))
    return made.select(
        "doc_id", "n_chars", "edited_sha256", as_text(F.col("sketch")).alias("fingerprint"),
        as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"))
