"""Exact duplicates by a sort of the texts themselves.

**Sort.** Rows are dealt into ranges of the order of their normalised texts; Spark samples the splitters. A splitter holds the
beginning of a text (``HEAD`` characters) and its hash, not the whole text, so what the sample brings to the driver stays
small however long texts are; texts that begin alike are still split, by the hash. Inside a range an external sort
puts equal texts next to each other, and a row joins the group before it only if the *whole* normalised texts are equal. The
smallest identifier leads its group. Texts move once, with all their columns.

**Heavy texts.** One text may be a third of all rows. Bytes per text hash are summed first, combined on the map side;
texts heavier than a cell are dealt into cells, which are sorted like texts of their own. One row per cell is
then merged by whole texts, and its answer goes back to the rows of the cell. A cell is the larger of ``CELL_BYTES`` and
one ``MOST_HEAVY``-th of all bytes, so there are at most ``MOST_HEAVY`` heavy texts and twice as many cells: lists of
a few megabytes, whatever the data.

Null counts as the empty text. A row without an identifier leads only a group in which no row has one. Rows that repeat an
identifier stay rows; exactly one row of a group is kept. An empty table gives no rows. Columns that are named like the results give way to them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.sources.workspace import stage

SPACE = r"[\x20\x09-\x0D]+"
HEAD = 64
CELL_BYTES, ROW_BYTES, MOST_HEAVY = 8 << 20, 1024, 200_000


def normalised(text: str) -> Column:
    """The whole text with each run of white space as one space; null as the empty text."""
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), SPACE, " ")


def _heavy(rows: DataFrame, text: str, cell_bytes: int) -> DataFrame:
    """``print, cells`` of the text hashes that are heavier than a cell. At most ``MOST_HEAVY`` rows, written."""
    weight = F.sum(F.octet_length(F.coalesce(F.col(text), F.lit(""))) + ROW_BYTES)
    weights = stage(rows.groupBy(F.xxhash64(normalised(text)).alias("__sort_print")).agg(weight.alias("weight")), "text-weights")
    total = weights.agg(F.sum("weight")).first()[0] or 0
    cell = max(cell_bytes, -(-total // MOST_HEAVY))
    cells = F.ceil(F.col("weight") / cell).cast("long").alias("__sort_cells")
    return stage(weights.where(F.col("weight") > cell).select("__sort_print", cells), "heavy-texts", compact=True)


def deduplicate(
    rows: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    keep: str = "keep_id",
    size: str = "group_size",
    kept: str = "kept",
    cell_bytes: int = CELL_BYTES,
) -> DataFrame:
    """``rows`` with the identifier of the row that stays, the size of the group, and whether this is that row."""
    rows = rows.drop(keep, size, kept)
    heavy = _heavy(rows, text, cell_bytes)
    print_, salt = F.xxhash64(normalised(text)), F.pmod(F.monotonically_increasing_id(), F.coalesce("__sort_cells", F.lit(1)))
    marked = rows.withColumns({"__sort_head": F.substring(normalised(text), 1, HEAD), "__sort_print": print_})
    marked = marked.join(F.broadcast(heavy), "__sort_print", "left").withColumn("__sort_salt", salt)
    ranged = marked.repartitionByRange("__sort_head", "__sort_print", "__sort_salt")
    ranged = ranged.withColumns({"__sort_text": normalised(text), "__sort_row": F.monotonically_increasing_id()})
    # The ranges already hold whole groups of these columns: the window sorts in place and compares neighbours.
    cell = Window.partitionBy("__sort_head", "__sort_print", "__sort_salt", "__sort_text")
    order = cell.orderBy(F.col(key).asc_nulls_last(), F.xxhash64(text), "__sort_row")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    found = ranged.select(
        *rows.columns,
        "__sort_print",
        "__sort_cells",
        F.first(key).over(whole).alias("__sort_keep"),
        F.first("__sort_row").over(whole).alias("__sort_cell"),
        F.count(F.lit(1)).over(whole).alias("__sort_size"),
        (F.row_number().over(order) == 1).alias("__sort_first"),
    )
    if heavy.isEmpty():
        return found.select(
            *rows.columns, F.col("__sort_keep").alias(keep), F.col("__sort_size").alias(size), F.col("__sort_first").alias(kept)
        )
    found = stage(found, "content-sort")
    merged = stage(_merged_cells(found, text, key), "merged-cells", compact=True)
    leads = F.col("__sort_first") & F.coalesce("__sort_lead", F.lit(True))
    return found.join(F.broadcast(merged), "__sort_cell", "left").select(
        *rows.columns,
        F.when(F.col("__sort_total").isNull(), F.col("__sort_keep")).otherwise(F.col("__sort_best")).alias(keep),
        F.coalesce("__sort_total", "__sort_size").alias(size),
        leads.alias(kept),
    )


def _merged_cells(found: DataFrame, text: str, key: str) -> DataFrame:
    """Per cell of a heavy text: the text's identifier and size, and whether the cell holds its leading row."""
    order = F.struct(F.col("__sort_keep").isNull().alias("missing"), F.col("__sort_keep").alias("key"), F.xxhash64(text).alias("print"), "__sort_cell")
    heads = found.where("__sort_first and __sort_cells is not null")
    heads = heads.select("__sort_print", normalised(text).alias("__sort_text"), "__sort_cell", "__sort_size", order.alias("order"))
    texts = heads.groupBy("__sort_print", "__sort_text").agg(F.min("order").alias("least"), F.sum("__sort_size").alias("__sort_total"))
    return heads.join(texts, ["__sort_print", "__sort_text"]).select(
        "__sort_cell",
        F.col("least.key").alias("__sort_best"),
        "__sort_total",
        (F.col("least.__sort_cell") == F.col("__sort_cell")).alias("__sort_lead"),
    )
