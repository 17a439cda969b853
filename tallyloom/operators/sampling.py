"""Balancing, capping, splitting and subsetting by hash rank.

Rows are ranked by an md5 over seed, purpose and row key, so a draw is uniform, repeatable and
independent of partitioning. Each operator hashes with its own purpose: ranking the survivors of
one draw by the same hash again would favour the classes that were thinned most.

No class is ever sorted in one task because the table happens to be small, and none has to be: every cut
comes from one *edge* row per class, and the wide rows are then filtered against the edges, without a
shuffle as long as the table of edges is small enough to broadcast. Key columns and hashes are read once for the
edges, the wide rows once for the result.

A cap of at most ``TOP_ROWS`` rows keeps the first rows of every one of ``PARTS`` parts of a class and then
the first of the class, both with a literal limit that map tasks apply as well. Other cuts depend on the class
size: sizes are counted, large classes cut into buckets of their hash range, about as many as they have bucket
loads of rows; the running sum of the bucket counts tells in which bucket a wanted rank falls, and only the
rows of that sliver go on to the next round, until slivers are small enough to be ranked.

``key`` must identify a row: a real id, or source file and row ordinal.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyloom.constants import (
    MAX_CLASS_ROWS,
    MAX_TRAIN_ROWS,
    MIN_CLASS_ROWS,
    SEED,
    TEST_FRACTION,
    VALIDATION_FRACTION,
)
from tallyloom.functions.text import class_name
from tallyloom.sources.workspace import stage

# Rows of a class that are ranked together, and the most buckets that classes are cut into.
BUCKET_ROWS = 100_000
MOST_BUCKETS = 100_000
# Rows of a range of the order in which the n-th row is looked for.
RANGE_ROWS = 1_000_000
# Rounds in which buckets are cut again; two suffice for 10**12 rows.
ROUNDS = 4
# Largest cap that is found by keeping the first rows of every part of a class.
TOP_ROWS, PARTS = 10_000, 64
# A class that is proven to have no more rows than this is ranked whole.
BOUND_ROWS = 100_000


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def sample_hash(key: str | Sequence[str], seed: int | str = SEED, purpose: str = "") -> Column:
    """Hexadecimal md5 of seed, purpose and row key."""
    parts = [F.lit(str(seed)), F.lit(purpose)] if purpose else [F.lit(str(seed))]
    return F.md5(F.concat_ws("|", *parts, *[F.col(name).cast("string") for name in _keys(key)]))


def _position(key: list[str]) -> Column:
    return F.struct(F.col("_hash"), *[F.col(name) for name in key])


def _edges(hashed: DataFrame, by: str, key: list[str], cuts: Mapping[str, Callable[[Column], Column]]) -> DataFrame:
    """Per class: its size ``_n`` and, for each cut, the position of the row at that rank.

    A cut maps the class size to a rank. Ranks of zero, and ranks that take in the whole class,
    need no edge and leave it null. Rows without a class are left out. The result is staged.
    """
    narrow = stage(hashed.where(F.col(by).isNotNull()).select(by, *key, "_hash"), "sample-keys")
    sizes = stage(narrow.groupBy(by).agg(F.count(F.lit(1)).alias("_n")), "class-sizes")
    size, marks = F.col("_n"), {name: f"_at_{name}" for name in cuts}
    wanted = {name: rank(size).cast("bigint") for name, rank in cuts.items()}
    open_at = [F.when((at > 0) & (at < size), at).alias(marks[name]) for name, at in wanted.items()]

    def hits(rows: DataFrame, groups: DataFrame) -> DataFrame:
        """The rows at a marked rank of their group, as one column per cut."""
        ranked = rows.join(groups, [by, "_path"]).withColumn("_rank", _ranks([by, "_path"], key))
        at = {name: F.coalesce(F.col("_rank") == F.col(mark), F.lit(False)) for name, mark in marks.items()}
        return ranked.where(reduce(or_, at.values())).select(
            by, *[F.when(hit, _position(key)).alias(f"_edge_{name}") for name, hit in at.items()]
        )

    # A group is a class or a sliver of one; ``_front`` is a row's place in its group's hash range, in 2**-32.
    groups = sizes.select(by, F.lit("").alias("_path"), size.alias("_rows"), *open_at)
    groups = groups.where(F.coalesce(*marks.values()).isNotNull())
    front = F.conv(F.substring("_hash", 1, 8), 16, 10).cast("bigint")
    rows, found = narrow.withColumns({"_path": F.lit(""), "_front": front}), []
    for left in reversed(range(ROUNDS)):
        total, largest = groups.agg(F.sum("_rows"), F.max("_rows")).first()
        # Fewer than MOST_BUCKETS groups can exceed this size, which bounds every broadcast below.
        per_bucket = max(BUCKET_ROWS, -(-(total or 0) // MOST_BUCKETS))
        if not left or (largest or 0) <= per_bucket:
            found.append(hits(rows, groups))
            break
        found.append(hits(rows, groups.where(F.col("_rows") <= per_bucket)))
        groups, rows = _slivers(rows, by, key, groups.where(F.col("_rows") > per_bucket), list(marks.values()), per_bucket)
    edges = reduce(DataFrame.unionByName, found).groupBy(by).agg(*[F.max(f"_edge_{name}").alias(f"_edge_{name}") for name in cuts])
    return stage(sizes.join(edges, by, "left"), "edges")


def _slivers(
    rows: DataFrame, by: str, key: list[str], large: DataFrame, marks: list[str], per_bucket: int
) -> tuple[DataFrame, DataFrame]:
    """The buckets of large groups in which a cut falls, with its rank inside the bucket, and their rows."""
    parts = large.withColumn("_buckets", F.ceil(F.col("_rows") / per_bucket).cast("bigint"))
    scaled = F.col("_front") * F.col("_buckets")
    placed = rows.join(F.broadcast(parts.select(by, "_path", "_buckets")), [by, "_path"])
    placed = placed.withColumns({"_bucket": F.shiftright(scaled, 32), "_front": scaled.bitwiseAND(F.lit((1 << 32) - 1))})
    counts = placed.groupBy(by, "_path", "_bucket").agg(F.count(F.lit(1)).alias("_held"))
    so_far = Window.partitionBy(by, "_path").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    spans = counts.withColumn("_upto", F.sum("_held").over(so_far)).join(F.broadcast(parts.drop("_rows")), [by, "_path"])
    before = F.col("_upto") - F.col("_held")
    here = [F.when((F.col(mark) > before) & (F.col(mark) <= F.col("_upto")), F.col(mark) - before) for mark in marks]
    within = F.concat_ws(".", "_path", F.col("_bucket").cast("string"))
    slivers = spans.select(
        by, F.col("_path").alias("_outer"), "_bucket", within.alias("_path"), F.col("_held").alias("_rows"),
        *[rank.alias(mark) for mark, rank in zip(marks, here)],
    )
    slivers = stage(slivers.where(F.coalesce(*marks).isNotNull()), "slivers")
    kept = placed.withColumnRenamed("_path", "_outer").join(
        F.broadcast(slivers.select(by, "_outer", "_bucket", "_path")), [by, "_outer", "_bucket"]
    )
    kept = stage(kept.select(by, *key, "_hash", "_path", "_front"), "sliver-rows")
    return slivers.select(by, "_path", "_rows", *marks), kept


def _cap_edges(hashed: DataFrame, by: str, key: list[str], min_rows: int, max_rows: int) -> DataFrame:
    """Per class the position of its last row: of the whole class up to ``min_rows`` rows, else of the first ``max_rows``. Staged."""
    most = max(min_rows + 1, max_rows)
    # The end of a hash says nothing about its place in the order.
    part = F.pmod(F.conv(F.substring("_hash", 29, 4), 16, 10).cast("int"), F.lit(PARTS))
    narrow = hashed.where(F.col(by).isNotNull()).select(by, *key, "_hash", part.alias("_part"))
    first = narrow.withColumn("_rank", _ranks([by, "_part"], key)).where(F.col("_rank") <= most)
    first = first.withColumn("_rank", _ranks([by], key)).where(F.col("_rank") <= most)
    ends = first.groupBy(by).agg(
        F.count(F.lit(1)).alias("_n"),
        F.max(_position(key)).alias("_last"),
        F.max(F.when(F.col("_rank") <= max_rows, _position(key))).alias("_capped"),
    )
    edge = F.when(F.col("_n") <= min_rows, F.col("_last")).otherwise(F.col("_capped"))
    return stage(ends.select(by, edge.alias("_edge_cap")), "edges")


def _ranks(by: Sequence[str], key: list[str]) -> Column:
    return F.row_number().over(Window.partitionBy(*by).orderBy("_hash", *key))


def _placed(
    df: DataFrame,
    target: str,
    key: list[str],
    seed: int | str,
    purpose: str,
    cuts: Mapping[str, Callable[[Column], Column]],
    class_bound: int | None = None,
    edges: DataFrame | None = None,
) -> DataFrame:
    """Rows with a class, plus its size ``_n`` and, per cut, ``_in_<cut>``: ranks at or before it."""
    hashed = df.where(F.col(target).isNotNull()).withColumn("_hash", sample_hash(key, seed, purpose))
    size = F.col("_n")
    if class_bound is not None and class_bound <= BOUND_ROWS:
        counted = hashed.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(target)))
        placed = counted.withColumn("_rank", _ranks([target], key))
        inside = {name: F.col("_rank") <= rank(size) for name, rank in cuts.items()}
    else:
        placed = hashed.join(_edges(hashed, target, key, cuts) if edges is None else edges, target)
        inside = {
            name: F.when(rank(size) >= size, F.lit(True)).otherwise(
                F.coalesce(_position(key) <= F.col(f"_edge_{name}"), F.lit(False))
            )
            for name, rank in cuts.items()
        }
    return placed.select(*df.columns, "_n", *[met.alias(f"_in_{name}") for name, met in inside.items()])


def balance_classes(
    df: DataFrame,
    target: str,
    key: str | Sequence[str],
    min_rows: int = MIN_CLASS_ROWS,
    max_rows: int = MAX_CLASS_ROWS,
    seed: int | str = SEED,
    top_rows: int = TOP_ROWS,
) -> DataFrame:
    """B1 + B2: clean class names; keep classes of up to ``min_rows`` whole, cap the others.

    Up to ``top_rows`` kept rows of a class, the cut is found among the first rows of its parts, beyond by counting.
    """
    key = _keys(key)
    named = df.withColumn(target, class_name(target))
    if max(min_rows + 1, max_rows) <= top_rows:
        hashed = named.withColumn("_hash", sample_hash(key, seed, "balance"))
        kept = hashed.join(_cap_edges(hashed, target, key, min_rows, max_rows), target)
        return kept.where(_position(key) <= F.col("_edge_cap")).select(*df.columns)

    def rank(size: Column) -> Column:
        return F.when(size <= min_rows, size).otherwise(F.least(size, F.lit(max_rows)))

    placed = _placed(named, target, key, seed, "balance", {"cap": rank})
    return placed.where(F.col("_in_cap")).select(*df.columns)


def cap_rows(
    df: DataFrame, n: int, key: str | Sequence[str], seed: int | str = SEED, purpose: str = "cap"
) -> DataFrame:
    """``n`` rows chosen uniformly, whatever their class; all of them when there are no more.

    The row at rank ``n`` is found by counting ranges of the hash, narrower ones round by round. Rows
    are then filtered where they are: nothing is sorted or shuffled for the result, which keeps its partitions.
    """
    key = _keys(key)
    if n <= 0:
        return df.limit(0)
    hashed = df.withColumn("_hash", sample_hash(key, seed, purpose))
    one = hashed.withColumn("_all", F.lit(0))
    found = _edges(one, "_all", key, {"cap": lambda size: F.lit(n)}).select("_edge_cap").first()
    if found is None or found["_edge_cap"] is None:
        return df
    types = {name: hashed.schema[name].dataType for name in ["_hash", *key]}
    last = F.struct(*[F.lit(value).cast(types[name]).alias(name) for name, value in found["_edge_cap"].asDict().items()])
    return hashed.where(_position(key) <= last).select(*df.columns)


def sample_rows(df: DataFrame, n: int, key: str | Sequence[str], seed: int | str = SEED) -> DataFrame:
    """A uniform sample of ``n`` rows, or all rows when there are fewer."""
    return cap_rows(df, n, key, seed, "sample")


def total_cap(
    train_rows: int = MAX_TRAIN_ROWS,
    val_fraction: float = VALIDATION_FRACTION,
    test_fraction: float = TEST_FRACTION,
) -> int:
    """Rows to select so that the train split ends near ``train_rows``."""
    return int(train_rows / (1.0 - val_fraction - test_fraction))


def _ladder(size: Column, val_fraction: float, test_fraction: float) -> tuple[Column, Column]:
    """Numbers of validation and test rows in a class of ``size`` rows (for sizes from 3 on)."""

    def share(fraction: float) -> Column:
        # Half-even rounding, at least one row.
        return F.greatest(F.lit(1), F.bround(size * F.lit(float(fraction)), 0).cast("bigint"))

    val, test = share(val_fraction), share(test_fraction)
    crowded = val + test >= size
    less_val = F.greatest(F.lit(1), F.floor((size - 1) / 2).cast("bigint"))
    less_test = F.greatest(F.lit(1), size - 1 - less_val)
    few = size <= 5
    return (
        F.when(few, F.lit(1)).when(crowded, less_val).otherwise(val).cast("bigint"),
        F.when(few, F.lit(1)).when(crowded, less_test).otherwise(test).cast("bigint"),
    )


def stratified_split(
    df: DataFrame,
    target: str,
    key: str | Sequence[str],
    val_fraction: float = VALIDATION_FRACTION,
    test_fraction: float = TEST_FRACTION,
    seed: int | str = SEED,
    class_bound: int | None = None,
) -> DataFrame:
    """Add ``split``. Rows without a class are left out.

    One row goes to train; of two, the first goes to train and the second to val; from three on
    the first go to val, the next to test and the rest to train.

    ``class_bound`` states a proven upper bound on the rows of a class (after
    :func:`balance_classes`, its cap): up to ``BOUND_ROWS`` such classes are ranked in one shuffle.
    """

    def first_cut(size: Column) -> Column:
        return F.when(size == 2, F.lit(1)).otherwise(_ladder(size, val_fraction, test_fraction)[0])

    def second_cut(size: Column) -> Column:
        val, test = _ladder(size, val_fraction, test_fraction)
        return F.when(size == 2, F.lit(1)).otherwise(val + test)

    cuts = {"first": first_cut, "second": second_cut}
    placed = _placed(df, target, _keys(key), seed, "split", cuts, class_bound)
    size, in_first, in_second = F.col("_n"), F.col("_in_first"), F.col("_in_second")
    split = (
        F.when(size == 1, "train")
        .when(size == 2, F.when(in_first, "train").otherwise("val"))
        .when(in_first, "val")
        .when(in_second, "test")
        .otherwise("train")
    )
    return placed.select(*df.columns, split.alias("split"))


def with_shuffle_key(df: DataFrame, key: str | Sequence[str], seed: int | str = SEED) -> DataFrame:
    """A column whose order is a uniform shuffle. Sort by it only where a file needs order."""
    return df.withColumn("shuffle_key", sample_hash(key, seed, "shuffle"))


def proportional_subset(
    df: DataFrame,
    n: int | None,
    key: str | Sequence[str],
    target: str | None = None,
    seed: int | str = SEED,
) -> DataFrame:
    """About ``n`` rows with the class shares of the whole, at least one row per class.

    Tables of up to ``n`` rows pass unchanged; a sum above ``n`` is trimmed uniformly. The result
    may end below ``n``. Rows without a class count towards the total but are never chosen.
    ``target=None`` takes the first column.
    """
    if not n:
        return df
    key, target = _keys(key), target or df.columns[0]
    total = df.count()
    if total <= n:
        return df

    def rank(size: Column) -> Column:
        share = F.bround(size / F.lit(total) * F.lit(n), 0).cast("bigint")
        return F.least(size, F.greatest(F.lit(1), share))

    cuts = {"share": rank}
    edges = _edges(df.withColumn("_hash", sample_hash(key, seed, "subset")), target, key, cuts)
    placed = _placed(df, target, key, seed, "subset", cuts, edges=edges)
    kept = placed.where(F.col("_in_share")).select(*df.columns)
    if (edges.agg(F.sum(rank(F.col("_n")))).first()[0] or 0) <= n:
        return kept
    return cap_rows(kept, n, key, seed, "trim")


def first_rows_in_order(
    df: DataFrame,
    n: int | None,
    key: str | Sequence[str],
    shuffle_key: str | None = None,
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """The first ``n`` rows by ``shuffle_key`` (then ``key``), or by ``key``; 0 or None is all.

    The order columns alone are dealt into ranges of their order, whatever their type. Counts tell
    which range holds the n-th row, only that range is ranked, and rows are filtered in place
    against the row found. The ranges need not be even for the cut to be exact.
    """
    if not n:
        return df
    order = list(dict.fromkeys([*([shuffle_key] if shuffle_key else []), *_keys(key)]))
    total = df.count()
    if n >= total:
        return df
    ranged = df.select(*order).repartitionByRange(total // range_rows + 1, *order)
    ranged = stage(ranged.withColumn("_range", F.spark_partition_id()), "ranges")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # One row per range.
    counts = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_rows"))
    counts = counts.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
    here = counts.where((F.col("_before") < n) & (F.col("_before") + F.col("_rows") >= n)).first()
    rank = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    inside = ranged.where(F.col("_range") == here["_range"]).withColumn("_rank", rank)
    edge = inside.where(F.col("_rank") == n - here["_before"]).select(*order).first()
    cut = F.struct(*[F.lit(edge[name]).cast(df.schema[name].dataType).alias(name) for name in order])
    return df.where(F.struct(*order) <= cut)
