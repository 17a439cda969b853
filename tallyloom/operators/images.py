"""From manifest rows to image payloads (D3-D5). Joins replace per-row file access."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tallyloom.constants import FILE_COLUMN, ORDINAL_COLUMN
from tallyloom.functions.payload import payload_of_struct
from tallyloom.functions.text import as_column
from tallyloom.sources.shards import list_files, parquet_reader
from tallyloom.sources.workspace import new_folder, stage, write_once

# Up to this many files, the scan is told which ones to open.
LISTED_FILES = 1000
# Pointers up to this size are broadcast to the scan.
POINTER_BYTES = 64 * 1024 * 1024
# Files that one pass of cell_passes names, and what a broadcast row weighs beyond its text.
PASS_FILES, ROW_BYTES = 10_000, 64


def plain_path(path: Column | str) -> Column:
    """Local paths without the URI scheme; other paths as they are."""
    return F.regexp_replace(as_column(path), "^file:/+", "/")


def plain_root(folder: str) -> str:
    """A folder as :func:`plain_path` writes what lies in it."""
    return re.sub("^file:/+", "/", folder).rstrip("/")


def tried_paths(ref: Column | str, data_dir: str | None = None) -> list[Column]:
    """The paths a reference may stand for, in the order of D5; some may be null."""
    plain = plain_path(ref)
    tried = [F.when(plain.startswith("/"), plain)]
    if data_dir is not None:
        root = plain_root(data_dir)
        base = F.substring_index(plain, "/", -1)
        tried += [
            F.when(plain.startswith("/"), plain).otherwise(F.concat(F.lit(root + "/"), plain)),
            F.concat(F.lit(root + "/"), base),
        ]
    return [*tried, plain]


def paths_below(ref: Column | str, roots: Sequence[str], data_dir: str | None = None) -> Column:
    """The paths a reference may stand for that lie below one of ``roots``, as an array in the order of D5."""

    def below(path: Column) -> Column:
        inside = F.lit(False)
        for root in roots:
            inside = inside | path.startswith(plain_root(root) + "/")
        return path.isNotNull() & inside & ~path.contains("/../")

    return F.array_distinct(F.filter(F.array(*tried_paths(ref, data_dir)), below))


def resolve_paths(
    refs: DataFrame, ref: str, listing: DataFrame, data_dir: str | None = None, path: str = "path"
) -> DataFrame:
    """Distinct references with the listed path they stand for.

    Tried in order: the reference when absolute, under ``data_dir``, its base name under
    ``data_dir``, the reference as given. Without a match ``resolved`` is the reference and
    ``found`` is false. One join over all candidates.
    """
    tried = tried_paths(ref, data_dir)
    distinct = refs.select(ref).where(F.col(ref).isNotNull()).distinct()
    candidates = distinct.select(ref, F.posexplode(F.array(*tried)).alias("_place", "_path")).where(
        F.col("_path").isNotNull()
    )
    listed = listing.select(plain_path(path).alias("_path")).distinct()
    hits = candidates.join(listed, "_path").groupBy(ref).agg(F.min(F.struct("_place", "_path")).alias("_hit"))
    return distinct.join(hits, ref, "left").select(
        ref,
        F.coalesce(F.col("_hit._path"), F.col(ref)).alias("resolved"),
        F.col("_hit").isNotNull().alias("found"),
    )


def resolve_pointers(
    manifest: DataFrame, listing: DataFrame, data_dir: str | None = None, path: str = "path"
) -> DataFrame:
    """The manifest with each file reference replaced by the listed path it stands for (D5), ready for D4.

    References without a match stay as they are. One row per distinct reference joins back.
    """
    found = resolve_paths(manifest, FILE_COLUMN, listing, data_dir, path)
    placed = manifest.join(found.select(FILE_COLUMN, F.col("resolved").alias("_resolved")), FILE_COLUMN, "left")
    return placed.withColumn(FILE_COLUMN, F.col("_resolved")).select(*manifest.columns)


def _source_cells(
    spark: SparkSession,
    paths: str | Sequence[str],
    column: str,
    schema: StructType | str | None = None,
    skip_broken: bool = False,
) -> DataFrame:
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    if skip_broken:
        # The columns come from all footers, because the first file may be the broken one.
        reader = parquet_reader(spark, schema).option("ignoreCorruptFiles", True).option("ignoreMissingFiles", True)
    return (
        reader.parquet(*([paths] if isinstance(paths, str) else paths))
        .select(
            F.col(column),
            F.col("_metadata.file_path").alias(FILE_COLUMN),
            F.col("_metadata.row_index").alias(ORDINAL_COLUMN),
        )
    )


def fetch_cells(
    spark: SparkSession,
    manifest: DataFrame,
    paths: str | Sequence[str],
    column: str = "image",
    listed_files: int = LISTED_FILES,
    pointer_bytes: int = POINTER_BYTES,
) -> DataFrame:
    """The manifest with the cell its pointer names; null where there is none.

    Files may be named by path or by URI: local ones are compared without their scheme. Reads ``column`` alone. When the manifest touches few files, they are named in a filter that
    keeps the scan from opening the others. Pointers are then written as 8-byte hashes; when they
    take no more than ``pointer_bytes`` they are broadcast to drop unwanted cells during the scan,
    so that only wanted cells can meet a shuffle. The join proper compares file and ordinal,
    a unique pair without hot keys. Beyond that the join shuffles cells; :func:`cell_passes` does not.
    """
    source = _source_cells(spark, paths, column)
    file = plain_path(FILE_COLUMN)
    if listed_files:
        files = manifest.select(file).distinct().limit(listed_files + 1).collect()
        if len(files) <= listed_files:
            source = source.where(file.isin([row[0] for row in files if row[0] is not None]))
    pointer = F.xxhash64(file, F.col(ORDINAL_COLUMN).cast("bigint")).alias("_pointer")
    written = write_once(manifest.select(pointer).distinct(), "pointers")
    size = list_files(spark, written, "*.parquet").agg(F.sum("n_bytes")).first()[0] or 0
    if size <= pointer_bytes:
        wanted = spark.read.schema("_pointer bigint").parquet(written)
        source = source.withColumn("_pointer", pointer).join(F.broadcast(wanted), "_pointer", "left_semi")
        source = source.drop("_pointer")
    source = source.withColumn(FILE_COLUMN, file).withColumnRenamed(FILE_COLUMN, "_file")
    others = [name for name in manifest.columns if name not in (FILE_COLUMN, ORDINAL_COLUMN)]
    joined = manifest.withColumn("_file", file).join(source, ["_file", ORDINAL_COLUMN], "left")
    return joined.select(FILE_COLUMN, ORDINAL_COLUMN, *others, column)


def cell_passes(
    manifest: DataFrame,
    paths: str | Sequence[str],
    column: str = "image",
    listed_files: int = PASS_FILES,
    pointer_bytes: int = POINTER_BYTES,
    schema: StructType | str | None = None,
) -> Iterator[DataFrame]:
    """D4 for manifests of any size: the rows with their cells, pass by pass; cells meet no shuffle.

    Files are dealt into passes by hash. A pass names its files to the scan, which opens no others, and broadcasts its rows,
    whose bytes are counted before. Where a pass holds more than ``pointer_bytes`` (one file may hold most
    rows), its rows are dealt into parts, and its files are read once per part. Use each pass up, by writing it, before the
    next one, so that one broadcast lives at a time.

    Rows whose cell is not found are in no pass: no pointer, a file that is gone, a row that is not there, or the rest of a file from where it
    is broken. Find them by an anti join.
    """
    spark = manifest.sparkSession
    source = _source_cells(spark, paths, column, schema, skip_broken=True)
    source = source.withColumn("_file", plain_path(FILE_COLUMN)).drop(FILE_COLUMN).withColumnRenamed(ORDINAL_COLUMN, "_at")
    weight = F.octet_length(F.to_json(F.struct(*manifest.columns))) + ROW_BYTES
    pointed = manifest.where(F.col(FILE_COLUMN).isNotNull() & F.col(ORDINAL_COLUMN).isNotNull())
    rows = stage(
        pointed.withColumns(
            {"_file": plain_path(FILE_COLUMN), "_weight": weight.cast("bigint"), "_row": F.monotonically_increasing_id()}
        ),
        "pointers",
    )
    per_file = rows.groupBy("_file").agg(F.sum("_weight").alias("n"))
    n_files, n_bytes = per_file.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    # Half full on average, so that few passes overflow.
    passes = max(1, -(-2 * n_files // listed_files), -(-2 * n_bytes // pointer_bytes))
    number = F.pmod(F.xxhash64("_file"), F.lit(passes)).cast("int").alias("_pass")
    folder = new_folder(spark, "passes")
    rows.select("*", number).hint("rebalance", "_pass").write.partitionBy("_pass").parquet(folder)
    dealt = spark.read.schema(StructType([*rows.schema.fields, StructField("_pass", IntegerType())])).parquet(folder)
    sizes = dealt.groupBy("_pass").agg(F.sum("_weight").alias("n")).collect()
    for at, size in sorted(tuple(row) for row in sizes):
        whole = dealt.where(F.col("_pass") == at)
        parts = 1 if size <= pointer_bytes else -(-2 * size // pointer_bytes)
        for part in range(parts):
            wanted = whole.where(F.pmod(F.xxhash64("_row"), F.lit(parts)) == part) if parts > 1 else whole
            heavy = size if parts == 1 else wanted.agg(F.sum("_weight")).first()[0] or 0
            files = [row[0] for row in wanted.select("_file").distinct().collect()]
            # A single row may outweigh the limit; then the planner chooses.
            sent = F.broadcast(wanted) if heavy <= pointer_bytes else wanted
            hits = source.where(F.col("_file").isin(files)).join(
                sent.select(*manifest.columns, F.col("_file").alias("_name")),
                (F.col("_file") == F.col("_name")) & (F.col("_at") == F.col(ORDINAL_COLUMN)),
            )
            if files:
                yield hits.select(*manifest.columns, column)


def source_kind(
    image_path: Column | str | None = None,
    path_exists: Column | str | None = None,
    image: Column | str | None = None,
    shard: Column | str | None = None,
    shard_exists: Column | str | None = None,
) -> Column:
    """D3: ``image_path``, ``image``, ``shard`` or ``none``; the first that is available.

    The choice is final: when the chosen source turns out broken, the next is not tried.
    """

    def there(name: Column | str | None, exists: Column | str | None) -> Column:
        if name is None or exists is None:
            return F.lit(False)
        return F.coalesce((as_column(name) != "") & as_column(exists), F.lit(False))

    inline = F.lit(False) if image is None else as_column(image).isNotNull()
    return (
        F.when(there(image_path, path_exists), F.lit("image_path"))
        .when(inline, F.lit("image"))
        .when(there(shard, shard_exists), F.lit("shard"))
        .otherwise(F.lit("none"))
    )


def resolve_images(
    chosen: DataFrame,
    files: DataFrame | None = None,
    cells: DataFrame | None = None,
    image: Column | None = None,
    kind: str = "source_kind",
    stand_in: bytes | None = None,
) -> DataFrame:
    """D3: add ``payload`` and ``error`` by source kind.

    ``files`` holds (path, content), ``cells`` holds the pointer columns and ``cell`` (a D1
    struct), and ``image`` is the D1 struct of the inline cell. Each kind is its own branch, so no
    join sees the rows of another kind as null keys. Rows with an error get ``stand_in``.
    """
    columns = [F.col(name) for name in chosen.columns]

    def branch(rows: DataFrame, cell: Column, missing: str) -> DataFrame:
        return rows.select(
            *columns,
            cell["payload"].alias("payload"),
            F.when(
                cell["payload"].isNull(), F.coalesce(cell["error"], F.lit(missing))
            ).alias("error"),
        )

    def none_of(kinds: list[str]) -> Column:
        return ~F.col(kind).isin(kinds)

    branches, served = [], []
    if files is not None:
        rows = chosen.where(F.col(kind) == "image_path").join(
            files.select(plain_path("path").alias("_path"), F.col("content").alias("_content")),
            plain_path("image_path") == F.col("_path"),
            "left",
        )
        opened = F.struct(F.col("_content").alias("payload"), F.lit(None).cast("string").alias("error"))
        branches.append(branch(rows, opened, "cannot open preprocessed image"))
        served.append("image_path")
    if image is not None:
        branches.append(branch(chosen.where(F.col(kind) == "image"), image, "cannot read inline image"))
        served.append("image")
    if cells is not None:
        rows = chosen.where(F.col(kind) == "shard").join(
            cells.select(FILE_COLUMN, ORDINAL_COLUMN, F.col("cell").alias("_cell")),
            [FILE_COLUMN, ORDINAL_COLUMN],
            "left",
        )
        branches.append(branch(rows, F.col("_cell"), "cannot read source row"))
        served.append("shard")
    nothing = F.struct(F.lit(None).cast("binary").alias("payload"), F.lit(None).cast("string").alias("error"))
    branches.append(branch(chosen.where(none_of(served)), nothing, "no image source in row"))
    resolved = branches[0]
    for more in branches[1:]:
        resolved = resolved.unionByName(more)
    if stand_in is not None:
        resolved = resolved.withColumn("payload", F.coalesce("payload", F.lit(bytearray(stand_in))))
    return resolved


def struct_cells(cells: DataFrame, column: str = "image") -> DataFrame:
    """Fetched ``struct<bytes,path>`` cells in the form :func:`resolve_images` takes."""
    return cells.select(FILE_COLUMN, ORDINAL_COLUMN, payload_of_struct(column).alias("cell"))
