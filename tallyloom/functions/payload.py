"""Image cells: where the bytes come from (D1) and what their header says."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tallyloom.functions.text import as_column

# A longer string is taken for base64, as is one with this prefix.
BASE64_LENGTH = 256
BASE64_PREFIX = "data:image"

SIZE_TYPE = StructType([StructField("width", LongType()), StructField("height", LongType())])


def _payload(kind: str, payload: Column | None = None, path: Column | None = None, error: Column | None = None) -> Column:
    def or_null(value: Column | None, kind_of: str) -> Column:
        return (F.lit(None) if value is None else value).cast(kind_of)

    return F.struct(
        F.lit(kind).alias("kind"),
        or_null(payload, "binary").alias("payload"),
        or_null(path, "string").alias("path"),
        or_null(error, "string").alias("error"),
    )


def _refused(message: str | Column) -> Column:
    return _payload("error", error=F.lit(message) if isinstance(message, str) else message)


def payload_of_struct(cell: Column | str) -> Column:
    """D1 for ``struct<bytes,path>``: the bytes, else the path, else an error."""
    cell = as_column(cell)
    return (
        F.when(cell.isNull(), _refused("image is null"))
        .when(cell["bytes"].isNotNull(), _payload("bytes", payload=cell["bytes"]))
        .when(cell["path"].isNotNull(), _payload("path", path=cell["path"]))
        .otherwise(_refused("image struct holds neither bytes nor path"))
    )


def payload_of_binary(cell: Column | str) -> Column:
    """D1 for raw bytes."""
    cell = as_column(cell)
    return F.when(cell.isNull(), _refused("image is null")).otherwise(_payload("bytes", payload=cell))


def payload_of_string(cell: Column | str, exists: Column | str | None = None) -> Column:
    """D1 for text: an existing path, else base64, else an error.

    ``exists`` says whether the text names an existing file (join a listing to get it); the
    default takes no text for a path.
    """
    cell = as_column(cell)
    exists = F.lit(False) if exists is None else F.coalesce(as_column(exists), F.lit(False))
    looks_encoded = cell.startswith(BASE64_PREFIX) | (F.length(cell) > BASE64_LENGTH)
    body = F.when(
        cell.startswith(BASE64_PREFIX), F.regexp_replace(cell, f"^{BASE64_PREFIX}/.+;base64,", "")
    ).otherwise(cell)
    # Line breaks and other characters outside the alphabet are skipped, as lenient decoders do.
    letters = F.regexp_replace(body, "[^A-Za-z0-9+/=]+", "")
    decoded = F.when(looks_encoded & ~exists, F.try_to_binary(letters, F.lit("base64")))

    # A long text is no path but a payload that does not decode: only its size and hash are reported.
    named = F.when(F.length(cell) <= BASE64_LENGTH, cell).otherwise(
        F.concat(F.lit("text of "), F.length(cell).cast("string"), F.lit(" characters, md5 "), F.md5(cell))
    )

    def resolved(data: Column) -> Column:
        return (
            F.when(cell.isNull(), _refused("image is null"))
            .when(exists, _payload("path", path=cell))
            .when(F.octet_length(data) > 0, _payload("base64", payload=data))
            .otherwise(_refused(F.concat(F.lit("no such image path: "), named)))
        )

    # The one-element array binds the decoded bytes, so that long texts are decoded once.
    return F.get(F.transform(F.array(decoded), resolved), F.lit(0))


def _number(data: Column, at: int, width: int, little_endian: bool = False) -> Column:
    """Unsigned integer of ``width`` bytes that starts at byte ``at`` (from 1)."""
    places = range(width - 1, -1, -1) if little_endian else range(width)
    digits = F.concat(*[F.hex(F.substring(data, at + place, 1)) for place in places])
    return F.conv(digits, 16, 10).cast("bigint")


def _frame_sizes(cells: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    """Walk the JPEG segments to the frame header. Segment lengths chain, so SQL cannot do it."""

    def size(data: bytes | None) -> tuple[int | None, int | None]:
        at = 2
        while data is not None and at + 9 <= len(data) and data[at] == 0xFF:
            code = data[at + 1]
            if code == 0xFF:  # fill byte
                at += 1
            elif 0xC0 <= code <= 0xCF and code not in (0xC4, 0xC8, 0xCC):
                return int.from_bytes(data[at + 7 : at + 9], "big"), int.from_bytes(data[at + 5 : at + 7], "big")
            elif code == 0x01 or 0xD0 <= code <= 0xD8:  # no length field
                at += 2
            else:
                at += 2 + int.from_bytes(data[at + 2 : at + 4], "big")
        return None, None

    for series in cells:
        yield pd.DataFrame([size(data) for data in series], columns=["width", "height"]).astype("Int64")


def image_format(data: Column | str) -> Column:
    """``jpeg``, ``png`` or ``webp`` by signature, else null."""
    data = as_column(data)
    return (
        F.when(F.hex(F.substring(data, 1, 3)) == "FFD8FF", F.lit("jpeg"))
        .when(F.hex(F.substring(data, 1, 8)) == "89504E470D0A1A0A", F.lit("png"))
        .when(
            (F.hex(F.substring(data, 1, 4)) == "52494646") & (F.hex(F.substring(data, 9, 4)) == "57454250"),
            F.lit("webp"),
        )
    )


def fixed_header_size(data: Column | str) -> Column:
    """D2 for formats with sizes at a fixed offset (PNG, WEBP): ``struct<width,height>`` or null."""
    data = as_column(data)
    chunk = F.hex(F.substring(data, 13, 4))
    packed = _number(data, 22, 4, little_endian=True)

    def pair(width: Column, height: Column) -> Column:
        return F.struct(width.cast("bigint").alias("width"), height.cast("bigint").alias("height"))

    png = pair(_number(data, 17, 4), _number(data, 21, 4))
    lossy = pair(
        _number(data, 27, 2, True).bitwiseAND(F.lit(0x3FFF)), _number(data, 29, 2, True).bitwiseAND(F.lit(0x3FFF))
    )
    lossless = pair(
        packed.bitwiseAND(F.lit(0x3FFF)) + 1, F.shiftright(packed, 14).bitwiseAND(F.lit(0x3FFF)) + 1
    )
    extended = pair(_number(data, 25, 3, True) + 1, _number(data, 28, 3, True) + 1)
    size = F.octet_length(data)
    return (
        F.when((image_format(data) == "png") & (size >= 24), png)
        .when((image_format(data) == "webp") & (chunk == "56503820") & (size >= 30), lossy)
        .when((image_format(data) == "webp") & (chunk == "5650384C") & (size >= 25), lossless)
        .when((image_format(data) == "webp") & (chunk == "56503858") & (size >= 30), extended)
    )


def jpeg_size(data: Column | str) -> Column:
    """D2 for JPEG: ``struct<width,height>``. Runs in an Arrow-fed Python worker.

    Other formats are passed as null, so only JPEG bytes travel to Python.
    """
    data = as_column(data)
    sizes = F.pandas_udf(_frame_sizes, SIZE_TYPE)
    return sizes(F.when(image_format(data) == "jpeg", data))


def header_check(kind: Column | str, width: Column | str, height: Column | str) -> Column:
    """Error text for a payload whose header gave no usable size; null when it is fine."""
    kind, width, height = as_column(kind), as_column(width), as_column(height)
    return F.when(kind.isNull(), F.lit("unknown image format")).when(
        width.isNull() | height.isNull() | (width <= 0) | (height <= 0), F.lit("truncated image header")
    )
