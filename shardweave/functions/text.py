"""Scalar text and byte expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Marks that the caption decoder puts around a caption.
START_MARK = "<start_of_text>"
END_MARK = "<end_of_text>"

# Complete base64 also has whole groups of four. (A pattern with a repeated group of four would
# recurse once per group and overflow the stack on large images.)
_BASE64 = r"^[A-Za-z0-9+/]*={0,2}\z"


def clean_caption(text: Column) -> Column:
    """Text between the marks, up to its first full stop, without trailing blanks."""
    before_end = F.substring_index(text, END_MARK, 1)
    after_start = F.substring_index(before_end, START_MARK, -1)
    sentence = F.substring_index(after_start, ".", 1)
    return F.regexp_replace(sentence, r"(?U)\s+$", "")


def image_bytes(image: Column, kind: str) -> Column:
    """Image payload as BINARY: null when the text is not base64, empty when there is no image.

    ``kind`` is the column's Spark type: ``binary`` values are kept, ``string`` values are decoded
    strictly, any other type holds no image.
    """
    if kind == "binary":
        return F.coalesce(image, F.lit(b""))
    if kind == "string":
        strict = (F.pmod(F.length(image), F.lit(4)) == 0) & image.rlike(_BASE64)
        decoded = F.when(strict, F.try_to_binary(image, F.lit("base64")))
        return F.when(image.isNull(), F.lit(b"")).otherwise(decoded)
    return F.lit(b"")


def raw_file_type(path: Column) -> Column:
    """Format of a shard, judged by its path."""

    def ends(*suffixes: str) -> Column:
        found = path.endswith(suffixes[0])
        for suffix in suffixes[1:]:
            found = found | path.endswith(suffix)
        return found

    # Suffixes by format.
    return (
        F.when(ends(".jsonl", ".json"), "jsonl")
        .when(ends(".jsonl.zst", "json.zst", "jsonl.zstd", "json.zstd"), "jsonl_zstd")
        .when(ends(".jsonl.gz", ".json.gz"), "jsonl_gzip")
        .when(ends(".tar"), "tar")
        .when(path.contains(".tfrecord"), "tfrecord")
        .otherwise("unknown")
    )


def basename(path: Column) -> Column:
    """Part of a path after its last slash."""
    return F.element_at(F.split(path, "/"), -1)


def canonical_path(path: Column, encoded: bool = False) -> Column:
    """One spelling per file: local paths without a scheme, ``encoded`` URIs decoded."""
    if encoded:
        path = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(path, "^file:/+", "/")


def base64_text(data: Column) -> Column:
    """Base64 without the line breaks that Spark's function may insert."""
    return F.replace(F.base64(data), F.lit("\r\n"), F.lit(""))
