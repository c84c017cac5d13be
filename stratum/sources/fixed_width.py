"""Fixed-width binary records (mainframe files) decoded by column expressions.

Hadoop's fixed-length input splits the files at record borders, so one large file is read by many
tasks. The records stay in the JVM: no Python worker is involved.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.sources.listing import plain_path

_RECORD = "value"


@dataclass(frozen=True)
class Field:
    """A field at byte ``start`` (from 0). ``scale`` is the number of implied decimals.

    ``kind``: ``text``; ``zoned`` (one digit per byte, sign in the last zone); ``packed`` (two digits
    per byte, sign in the last half byte); ``binary`` (big-endian integer).
    """

    name: str
    start: int
    length: int
    kind: str = "text"
    scale: int = 0


def scan_fixed_width(spark: SparkSession, paths: Sequence[str], layout: Sequence[Field],
                     record_length: int | None = None, code_page: str = "cp037",
                     trim: bool = True, path_column: str = "") -> DataFrame:
    """Rows of the layout's fields plus ``file_name``, and the file's path if a column is named for it."""
    if not layout:
        raise ValueError("a fixed-width scan needs a layout")
    length = int(record_length or max(f.start + f.length for f in layout))
    context = spark.sparkContext._jsc.sc()
    inputs = ",".join(_as_pattern(p) for p in paths)
    records = context.binaryRecords(inputs, length, spark._jsparkSession.sessionState().newHadoopConf())
    encoder = spark.sparkContext._jvm.org.apache.spark.sql.Encoders.BINARY()
    raw = DataFrame(spark._jsparkSession.createDataset(records, encoder).toDF(), spark)
    columns = [decoded(f, code_page, trim).alias(f.name) for f in layout]
    name = F.element_at(F.split(F.input_file_name(), "/"), -1)
    path = F.regexp_replace(plain_path(F.input_file_name()), "^file:///", "file:/")
    return raw.select(*columns, name.alias("file_name"), *([path.alias(path_column)] if path_column else []))


def _as_pattern(path: str) -> str:
    """The Hadoop path pattern that matches just this path: pattern characters escaped, and commas,
    which separate paths outside braces, put into braces."""
    special = {c: "\\" + c for c in "*?[]{}\\"} | {",": "{\\,}"}
    return "".join(special.get(c, c) for c in path)


def decoded(field: Field, code_page: str = "cp037", trim: bool = True) -> Column:
    raw = F.substring(F.col(_RECORD), field.start + 1, field.length)
    if field.kind == "text":
        text = as_text(raw, code_page)
        return F.rtrim(text) if trim else text
    if field.kind == "binary":
        return _scaled(_integer(raw, field.length).cast("string"), field.scale, 19)
    # Both number kinds in hexadecimal: each byte is two half bytes, digits are 0-9, the sign D or B is minus.
    halves = F.hex(raw)
    if field.kind == "packed":
        digits, most = F.substring(halves, 1, 2 * field.length - 1), 2 * field.length - 1
        sign = F.substring(halves, 2 * field.length, 1)
        valid = "^[0-9]*[A-F]$"
    elif field.kind == "zoned":
        digits, most = F.regexp_replace(halves, "[0-9A-F]([0-9A-F])", "$1"), field.length
        sign = F.substring(halves, 2 * field.length - 1, 1)
        valid = "^(F[0-9])*[A-F][0-9]$"
    else:
        raise ValueError(f"unknown field kind: {field.kind}")
    signed = F.concat(F.when(sign.isin("B", "D"), F.lit("-")).otherwise(F.lit("")), digits)
    # A field of blanks or other bytes holds no number.
    return _scaled(F.when(halves.rlike(valid), signed), field.scale, most)


def as_text(raw: Column, code_page: str) -> Column:
    """Decode a single-byte code page: Latin-1 keeps byte values as characters, translate maps them."""
    return F.translate(F.decode(raw, "ISO-8859-1"), *_translation(code_page))


def as_bytes(text: Column, code_page: str) -> Column:
    """Encode text in a single-byte code page; the inverse of ``as_text``."""
    plain, coded = _translation(code_page)
    return F.encode(F.translate(text, coded, plain), "ISO-8859-1")


def _translation(code_page: str) -> tuple[str, str]:
    every_byte = bytes(range(256))
    pairs = [(a, b) for a, b in zip(every_byte.decode("latin-1"), every_byte.decode(code_page)) if a != b]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


def _integer(raw: Column, length: int) -> Column:
    value = F.conv(F.hex(raw), 16, 10).cast("decimal(20,0)")
    half = 1 << (8 * length - 1)
    return F.when(value >= F.lit(half).cast("decimal(20,0)"), value - F.lit(2 * half).cast("decimal(21,0)")).otherwise(value)


def _scaled(number: Column, scale: int, most: int) -> Column:
    """Signed digits as text to a number with ``scale`` decimals, exactly: the point is put into the text.

    Numbers of up to 18 digits without decimals are bigints, all others decimals of 38 digits.
    """
    if max(most, scale) > 38:
        raise ValueError(f"a number of {max(most, scale)} digits does not fit a decimal; read the field as text")
    if scale == 0:
        return number.cast("bigint" if most <= 19 else "decimal(38,0)")
    sign = F.when(number.startswith("-"), F.lit("-")).otherwise(F.lit(""))
    digits = F.ltrim(number, F.lit("-"))
    digits = F.lpad(digits, F.greatest(F.length(digits), F.lit(scale + 1)), F.lit("0"))
    whole = F.substring(digits, F.lit(1), F.length(digits) - scale)
    return F.concat(sign, whole, F.lit("."), F.right(digits, F.lit(scale))).cast(f"decimal(38,{scale})")
