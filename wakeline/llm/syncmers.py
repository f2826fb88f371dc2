"""Document fingerprints from closed syncmers, with built-in functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wakeline.llm.common import whole_text

K = 5
"""Words of a k-mer."""
S = 2
"""Words of the inner substrings."""


def _bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once for a row."""
    return F.transform(F.array(value), body)[0]


#: Thai, kana and Han, which are written without spaces: each character is a word.
_UNSPACED = r"\u0E00-\u0E7F\u3040-\u30FF\u3400-\u9FFF"


def _tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(rf"[^\x20\x09-\x0D{_UNSPACED}]+|[{_UNSPACED}]"), F.lit(0))


def _closed(text: Column, take: Callable[[Column, Column], Column]) -> Column:
    """``take(inner hashes, position)`` of every closed syncmer: the k-mers of words whose smallest inner substring (a pair of words, by hash)
    lies at one of their edges. Ties count as lying at the edge. A text of fewer than K words, or without a closed syncmer, is one k-mer."""

    def inner(h: Column) -> Column:
        pairs = F.transform(F.sequence(F.lit(0), F.size(h) - S), lambda i: h[i].bitwiseXOR(F.shiftleft(h[i + 1], 1)))
        return _bind(pairs, picked)

    def picked(z: Column) -> Column:
        last = K - S
        positions = F.sequence(F.lit(0), F.size(z) - 1 - last)
        closed = F.filter(positions, lambda i: F.least(*(z[i + j] for j in range(1, last))) >= F.least(z[i], z[i + last]))
        return F.transform(closed, lambda i: take(z, i))

    def chosen(w: Column) -> Column:
        hashed = F.transform(w, lambda x: F.xxhash64(x))
        whole = F.array(F.xxhash64(F.concat_ws(" ", w)), F.lit(0).cast("long"), F.lit(0).cast("long"), F.lit(0).cast("long"))
        short = F.when(F.size(w) == 0, F.array_remove(F.array(take(whole, F.lit(0))), take(whole, F.lit(0)))).otherwise(F.array(take(whole, F.lit(0))))
        return F.when(F.size(w) >= K, _bind(_bind(hashed, inner), lambda found: F.when(F.size(found) > 0, found).otherwise(short))).otherwise(short)

    return _bind(_tokens(text), chosen)


def _anchor(z: Column, i: Column) -> Column:
    """A hash of all words of the k-mer at i, from 0 to 2^32 - 1."""
    return F.shiftrightunsigned(F.xxhash64(z[i], z[i + 1], z[i + K - S]), 32)


def anchors(text: Column) -> Column:
    """Array of ``(position, anchor)``: word position and hash of every closed syncmer, in order.

    Whether a k-mer is chosen depends on its own words alone, so a shared passage gives the same anchors at shifted positions in both texts.
    """
    return _closed(text, lambda z, i: F.struct(i.cast("int").alias("position"), _anchor(z, i).alias("anchor")))


def sketch(text: Column) -> Column:
    """All distinct anchors of the whole text, ascending. Without words: empty."""
    return F.sort_array(F.array_distinct(_closed(text, _anchor)))


def fingerprint(anchor_sketch: Column) -> Column:
    """Eight hex digits for each anchor of the sketch."""
    return F.array_join(F.transform(anchor_sketch, lambda x: F.lpad(F.lower(F.hex(x)), 8, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of the anchors of two sketches. Two empty sketches: 1."""
    value = _bind(F.size(F.array_intersect(a, b)), lambda n: n / (F.size(a) + F.size(b) - n).cast("double"))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(value)


def _borders(docs: DataFrame) -> list[int]:
    """Ids that cut the documents into buckets of like size: four a shuffle partition. The last is the largest id."""
    count = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = F.array(*(F.lit(i / count) for i in range(1, count + 1)))
    found = docs.agg(F.percentile_approx("doc_id", shares, F.lit(10 * count)).alias("at"), F.max("doc_id").alias("top")).first()
    return sorted({*(found["at"] or []), *([] if found["top"] is None else [found["top"]])})


def _bucket(doc_id: Column, borders: list[int]) -> Column:
    """How many borders are smaller than the id: first by blocks of borders, then within the block."""
    if not borders:
        return F.lit(0)
    step = max(1, round(len(borders) ** 0.5))
    literal = lambda values: F.array(*(F.lit(x) for x in values))
    below = lambda array: F.size(F.filter(array, lambda s: s < doc_id))
    blocks = below(literal(borders[step - 1 :: step]))
    rest = _bind(blocks, lambda c: c * step + below(F.slice(literal(borders), c * step + 1, step)))
    return F.coalesce(F.when(doc_id.isNotNull(), rest), F.lit(0))


def with_next(docs: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Each row with columns of the next row in descending doc_id (after the last: the first); ``columns`` maps a column to its new name.

    Rows are cut into buckets by id, at ids that occur, and ordered in each bucket. The largest id of a bucket is also sent to the bucket
    above, as a guest that only its last row sees; the largest of all goes to the lowest bucket. So all rows move once, none in one
    task, and the borders are as many as the shuffle partitions need. Equal ids are ordered by text; null ids come last.
    """
    borders = _borders(docs)
    bucket = _bucket(F.col("doc_id"), borders)
    ends = F.coalesce(F.col("doc_id").isin(borders) if borders else F.lit(False), F.lit(False))
    above = (F.col("__bucket") + 1) % max(1, len(borders))
    placed = docs.withColumn("__bucket", bucket).withColumn("__to", F.when(ends, F.array("__bucket", above)).otherwise(F.array("__bucket")))
    placed = placed.select(*docs.columns, F.posexplode("__to").alias("__guest", "__at"))
    order = Window.partitionBy("__at").orderBy("__guest", F.col("doc_id").desc_nulls_last(), F.col("text"))
    every = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    follow = {new: F.when(F.lead(F.lit(1)).over(order).isNotNull(), F.lead(old).over(order)).otherwise(F.first(old).over(every)) for old, new in columns.items()}
    return placed.withColumns(follow).where("__guest = 0").drop("__guest", "__at")


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every whole text, of its edited text and how they compare.

    The edited text ends in the first floor(n_chars / 3) code points (or all) of the next document, in descending doc_id, instead of its own
    last ones. Returns ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``. Null texts are
    empty: no anchors, an empty fingerprint. Two empty fingerprints have likeness 1, one empty 0. A single document is its own next one.
    Repeated rows stay; no rows give no rows. Other columns are not read.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text(F.col("text")).alias("text")).withColumn("sketch", sketch(F.col("text")))
    rows = with_next(base, {"text": "next_text", "sketch": "next_sketch"}).withColumn("n_chars", F.length("text").cast("long"))
    moved = F.floor(F.col("n_chars") / 3).cast("int")
    kept = (F.col("n_chars") - moved).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), kept), F.substring(F.col("next_text"), F.lit(1), moved))
    rows = rows.withColumn("edited", edited).select("doc_id", "n_chars", "sketch", "next_sketch", F.sha2("edited", 256).alias("edited_sha256"), sketch(F.col("edited")).alias("edited_sketch"))
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", fingerprint(F.col("sketch")).alias("fingerprint"), fingerprint(F.col("edited_sketch")).alias("edited_fingerprint"),
        likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"), likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
    )
