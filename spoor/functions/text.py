"""Small text expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def trim_control(text: Column) -> Column:
    """Trim blanks and control characters up to U+0020 on both sides."""
    left = F.regexp_replace(text, r"^[\x00-\x20]+", "")
    return F.regexp_replace(left, r"[\x00-\x20]+$", "")


def clean_entries(text: Column, separator: str = ",") -> Column:
    """Split, trim every entry, drop the empty ones."""
    entries = F.transform(F.split(text, "[" + separator + "]"), trim_control)
    cleaned = F.filter(entries, lambda entry: entry != "")
    return F.coalesce(cleaned, F.array().cast("array<string>"))


def strip_expression_ids(text: Column) -> Column:
    """Drop the plan's column ids (``Amount#11L``), which change on every run."""
    return F.regexp_replace(text, r"#\d+L?", "")


def base64_text(data: Column) -> Column:
    """Base64 without the line breaks Spark puts in."""
    return F.replace(F.base64(data), F.lit("\r\n"), F.lit(""))


def utf16_length(text: Column) -> Column:
    """Length in UTF-16 units, the unit of a JVM string length."""
    return (F.octet_length(F.encode(text, "UTF-16BE")) / 2).cast("int")


def chunks(text: Column, size: int) -> Column:
    """Cut single-byte text into consecutive pieces of at most ``size``; one at least."""
    count = F.ceil(F.octet_length(text) / F.lit(size)).cast("int")
    # Bytes are cut without counting characters from the start for every piece.
    data = text.cast("binary")
    return F.transform(
        F.sequence(F.lit(0), F.greatest(count, F.lit(1)) - 1),
        lambda i: F.substring(data, i * size + 1, F.lit(size)).cast("string"),
    )
