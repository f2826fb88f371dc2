"""How ordered groups (trips, routes, score lists) are laid out over tasks.

Ordered operators need all earlier rows of a group. A window per group does that as long as
a group fits one task. When one group holds a large share of the table it does not, so a
``Layout`` cuts such groups into order-contiguous chunks and the operators in ``scan.py``
work per chunk and pass carries between chunks. Groups below ``chunk_rows`` rows stay
whole; if there is no large group at all, the plan is the plain one-shuffle window plan.

Detection runs one column-pruned, map-side-combined count. Large groups are cut at sampled rows: the borders are whole
order keys, of any types and with all their tie-breaking columns, so rows with equal times, or a text order, are cut like any others. The
sample is taken by a hash of the row's key and stored, so a task that is run again after a lost executor cuts its rows at the same places.
Borders stay a table. Rows find their chunk in two equi-joins with short sorted lists, of every FAN-th border of the group and of those
between two such, by binary search; nothing of it passes through the driver, and there is no limit to groups or chunks.

Rows without a key belong to no group: they stay in the table and take no group values.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wakeline.session import stored

CHUNK = "_chunk"
CHUNK_ROWS = 1_000_000
FAN = 256
"""Borders in one list, and lists of borders in the list above."""
SAMPLES = 16
"""Sampled rows a chunk; chunks vary by about a quarter."""
BROADCAST_LISTS = 2_000
"""Border lists of up to FAN keys, some 10 kB each, that may be broadcast: some 20 MB."""


@dataclass(frozen=True)
class Layout:
    """Groups by ``keys``, ordered by ``order``; ``hot`` lists the groups that are cut.

    ``hot`` has the key columns and ``_chunks``, the group's number of chunks. ``coarse`` has ``_upper``, the sorted list of every FAN-th border of the
    group; ``fine`` has ``_bin`` and ``_lower``, the borders between two of those. Chunk numbers start at 1 in each cut group and rise with the order;
    rows of uncut groups have chunk 0. ``most`` is the largest number of chunks. ``cut_by`` are the
    order columns the borders are made of: those at hand when they were looked for, to which ``order`` may add more.
    """

    keys: tuple[str, ...]
    order: tuple[str, ...]
    hot: DataFrame | None = None
    coarse: DataFrame | None = None
    fine: DataFrame | None = None
    most: int = 0
    few: bool = True
    few_coarse: bool = True
    chunk_rows: int = CHUNK_ROWS
    cut_by: tuple[str, ...] = ()

    @property
    def partition(self) -> list[str]:
        return [*self.keys, CHUNK] if self.hot is not None else list(self.keys)

    def pin(self, df: DataFrame) -> DataFrame:
        """Before several scans in a row: with cut groups each scan reads its input twice, so write
        the input once. Plain windows read it once and need nothing."""
        return df if self.hot is None else stored(df, "pinned")

    def order_key(self) -> Column:
        return F.struct(*[F.col(c) for c in self.order])

    def mark(self, df: DataFrame) -> DataFrame:
        """Add the chunk column."""
        if self.hot is None or CHUNK in df.columns:
            return df
        key = F.struct(*self.cut_by)
        if self.most <= FAN:  # then no group has an upper list
            found = join_nullsafe(df, _small(self.fine, self.few), self.keys, "left")
        else:
            # Where the upper lists are no broadcast, the adaptive skew join splits a hot group.
            binned = join_nullsafe(df, _small(self.coarse, self.few_coarse), self.keys, "left").withColumn("_bin", _passed("_upper", key, self.most // FAN))
            found = join_nullsafe(binned, _small(self.fine, self.few), [*self.keys, "_bin"], "left")
        inside = F.coalesce(_passed("_lower", key, FAN), F.lit(0))
        chunk = F.when(F.col("_bin").isNull(), 0).otherwise(1 + F.col("_bin") * FAN + inside)
        return found.withColumn(CHUNK, chunk.cast("int")).drop("_upper", "_bin", "_lower")

    def mark_once(self, df: DataFrame) -> DataFrame:
        """Add the chunk column for a scan, which reads its rows twice; written once where finding the chunk takes two joins and a long search."""
        marked = self.mark(df)
        return self.pin(marked) if self.most > FAN else marked


def _small(lists: DataFrame, few: bool) -> DataFrame:
    return F.broadcast(lists) if few else lists


def _passed(borders: str, value: Column, most: int) -> Column:
    """How many entries of a sorted list of ``most`` at most are not above ``value``, by binary search (nulls first); null without a list."""
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(most.bit_length()))])  # constant; behind the end of a list no entry is found
    found = F.aggregate(steps, F.lit(0), lambda low, s: F.when(F.get(F.col(borders), low + s - 1) <= value, low + s).otherwise(low))
    return F.when(F.col(borders).isNotNull(), found)


def join_nullsafe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Equi-join where null keys match each other; keeps the left key columns."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    condition = F.lit(True)
    for k in keys:
        condition = condition & left[k].eqNullSafe(renamed[f"_r_{k}"])
    return left.join(renamed, condition, how).drop(*[f"_r_{k}" for k in keys])


def join_values(df: DataFrame, values: DataFrame, layout: Layout) -> DataFrame:
    """Join one row of ``values`` per group to all rows of the group.

    For a cut group the values are copied to each chunk and joined on (group, chunk): the rows are
    already spread that way, so they are neither moved nor gathered. These are plain equi-joins on
    the columns the windows partition by.
    """
    if layout.hot is None:
        return df.join(values, list(layout.keys), "left")
    owned = CHUNK not in df.columns
    marked = layout.mark(df)
    sized = join_nullsafe(values, layout.hot, layout.keys, "left")
    chunks = F.when(F.col("_chunks").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(1), F.col("_chunks")))
    spread = sized.withColumn(CHUNK, F.explode(chunks)).drop("_chunks")
    out = marked.join(spread, [*layout.keys, CHUNK], "left")
    return out.drop(CHUNK) if owned else out


# Group statistics are rows of a few numbers, at most about 2 kB: 20,000 groups are some 40 MB.
BROADCAST_GROUPS = 20_000


def join_group_values(df: DataFrame, values: DataFrame, keys: Sequence[str], source: DataFrame | None = None, how: str = "left") -> DataFrame:
    """Join one row of ``values`` per group onto the rows of ``df``.

    Broadcast only after a count of the distinct keys (of ``source``, where a cheaper plan with the
    same keys is at hand) proves the groups few. Otherwise a shuffle join, whose hot groups the
    adaptive skew join splits.
    """
    groups = (source if source is not None else df).select(*keys).distinct()
    if groups.limit(BROADCAST_GROUPS + 1).count() <= BROADCAST_GROUPS:
        values = F.broadcast(values)
    return df.join(values, list(keys), how)


def detect(df: DataFrame, keys: Sequence[str], order: Sequence[str], chunk_rows: int = CHUNK_ROWS) -> Layout:
    """Find the groups larger than ``chunk_rows``, and where to cut them. Rows that agree in the whole order are never parted."""
    keys, order = tuple(keys), tuple(order)
    plain = Layout(keys, order, chunk_rows=chunk_rows)
    large = stored(df.groupBy(*keys).agg(F.count("*").alias("_rows")).filter(F.col("_rows") > chunk_rows), "large")
    drawn = F.least(F.col("_rows"), SAMPLES * F.ceil(F.col("_rows") / chunk_rows))
    most = large.agg(F.max(drawn)).first()[0]
    if most is None:
        return plain
    slim = df.select(*keys, F.struct(*order).alias("_key"))
    share = F.least(F.lit(1.0), SAMPLES * F.ceil(F.col("_rows") / chunk_rows) / F.col("_rows"))
    draw = F.shiftrightunsigned(F.xxhash64("_key"), 11) / float(1 << 53)
    sample = join_nullsafe(slim, large, keys, "inner").where(draw < share)
    # A small group is sampled whole: then every chunk_rows-th row is a border, else every SAMPLES-th of the sample.
    step = F.when(share >= 1, chunk_rows).otherwise(SAMPLES)
    placed = _numbered(sample, keys, "_at", most)
    picked = placed.where(F.col("_at") % step == 0).select(*keys, "_key").distinct()
    borders = stored(_numbered(picked, keys, "_n", most // min(SAMPLES, chunk_rows)), "borders")
    lists = F.array_sort(F.collect_list("_key"))
    hot = stored(borders.groupBy(*keys).agg((F.max("_n") + 1).alias("_chunks")), "hot")
    if hot.isEmpty():
        return plain
    upper = F.array_sort(F.collect_list(F.when(F.col("_n") % FAN == 0, F.col("_key"))))
    coarse = stored(borders.groupBy(*keys).agg(upper.alias("_upper")), "coarse")
    between = borders.where(F.col("_n") % FAN != 0)
    fine = stored(between.groupBy(*keys, F.floor(F.col("_n") / FAN).cast("int").alias("_bin")).agg(lists.alias("_lower")), "fine")
    numbers = hot.agg(F.max("_chunks").alias("most"), F.sum(F.col("_chunks") / FAN + 2).alias("lists"), F.sum(F.col("_chunks") / FAN + FAN / 16).alias("keys")).first()
    few, few_coarse = numbers["lists"] <= BROADCAST_LISTS, numbers["keys"] <= BROADCAST_LISTS * FAN
    return Layout(keys, order, hot, coarse, fine, numbers["most"], few, few_coarse, chunk_rows, order)


def _numbered(df: DataFrame, keys: Sequence[str], name: str, most: int) -> DataFrame:
    """``name``: position of each row in its group, by ``_key``. Groups that may have over CHUNK_ROWS of ``most`` rows are cut for it, so that none is sorted by one task."""
    if most <= CHUNK_ROWS:
        return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy("_key")))
    df = stored(df, "sample")
    layout = detect(df, keys, ["_key"], chunk_rows=CHUNK_ROWS)
    if layout.hot is None:
        return _numbered(df, keys, name, CHUNK_ROWS)
    chunked = stored(layout.mark(df), "sample")
    by = Window.partitionBy(*keys, CHUNK).orderBy("_key")
    sizes = chunked.groupBy(*keys, CHUNK).agg(F.count("*").alias("_rows_of"))
    before = F.sum("_rows_of").over(Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1))
    ahead = sizes.select(*keys, CHUNK, F.coalesce(before, F.lit(0)).alias("_ahead"))
    numbered = chunked.withColumn(name, F.row_number().over(by))
    return join_nullsafe(numbered, ahead, [*keys, CHUNK], "left").withColumn(name, F.col(name) + F.col("_ahead")).drop("_ahead", CHUNK)
