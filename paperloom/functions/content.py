"""Stored bytes: stable form, hash, storage keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from paperloom.functions.formats import extension_of
from paperloom.functions.text import storage_name

LANDING_BUCKET = "landing-zone"
TRANSFORMED_BUCKET = "transformed"

COMMENT = r"(?s)<!--.*?-->"


def without_comments(content: Column) -> Column:
    """HTML bytes without comments.

    Latin-1 maps each byte to one character and back, so bytes that are not
    valid UTF-8 pass through unharmed.
    """
    text = F.decode(content, "ISO-8859-1")
    return F.encode(F.regexp_replace(text, COMMENT, ""), "ISO-8859-1")


def stable_content(content: Column, doc_type: Column) -> Column:
    """The bytes to store: comments are volatile in HTML, other types stay."""
    return F.when(doc_type == "html", without_comments(content)).otherwise(content)


def content_hash(content: Column) -> Column:
    return F.sha2(content, 256)


def landing_key(section: Column, partition_date: Column, identifier: Column,
                version: Column, doc_type: Column) -> Column:
    name = F.concat(F.lit("v"), version.cast("string"), F.lit("."), extension_of(doc_type))
    return F.concat_ws("/", section, partition_date.cast("string"), storage_name(identifier), name)


def transformed_key(section: Column, partition_date: Column, canonical: Column,
                    version: Column, doc_type: Column) -> Column:
    folder = F.concat(F.lit("v"), version.cast("string"))
    name = F.concat(storage_name(canonical), F.lit("."), extension_of(doc_type))
    return F.concat_ws("/", section, partition_date.cast("string"), folder, name)


def path_in(bucket: str, key: Column) -> Column:
    return F.concat(F.lit(bucket + "/"), key)


def bucket_of(path: Column) -> Column:
    return F.substring_index(path, "/", 1)


def key_of(path: Column) -> Column:
    return F.regexp_extract(path, r"^[^/]*/(.*)$", 1)
