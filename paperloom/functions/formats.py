"""Document types, their file extensions and media types."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The document types the landing zone knows.
EXTENSION_OF_TYPE = {"html": "html", "pdf": "pdf", "doc": "doc", "docx": "docx"}
MEDIA_TYPE_OF_TYPE = {
    "html": "text/html",
    "pdf": "application/pdf",
    "doc": "application/msword",
    "docx": "application/vnd.openxmlformats-officedocument.wordprocessingml.document",
}
TYPE_OF_EXTENSION = {"html": "html", "htm": "html", "pdf": "pdf", "doc": "doc", "docx": "docx"}
DEFAULT_EXTENSION = "bin"
DEFAULT_MEDIA_TYPE = "application/octet-stream"


def _lookup(table: dict[str, str], key: Column) -> Column:
    pairs = [F.lit(part) for pair in table.items() for part in pair]
    return F.try_element_at(F.create_map(*pairs), key)


def extension_of(doc_type: Column) -> Column:
    return F.coalesce(_lookup(EXTENSION_OF_TYPE, doc_type), F.lit(DEFAULT_EXTENSION))


def media_type_of(doc_type: Column) -> Column:
    return F.coalesce(_lookup(MEDIA_TYPE_OF_TYPE, doc_type), F.lit(DEFAULT_MEDIA_TYPE))


def type_from_url(url: Column) -> Column:
    """Known extension of the last path segment, else null."""
    path = F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)", 1)
    extension = F.lower(F.regexp_extract(path, r"\.([^./]+)$", 1))
    return _lookup(TYPE_OF_EXTENSION, extension)


def type_from_media_type(content_type: Column) -> Column:
    """Document type of a Content-Type header, parameters ignored, else null."""
    name = F.lower(F.trim(F.substring_index(content_type, ";", 1)))
    table = {media: doc_type for doc_type, media in MEDIA_TYPE_OF_TYPE.items()}
    return _lookup(table, name)


def document_type(url: Column, content_type: Column | None = None) -> Column:
    if content_type is None:
        return type_from_url(url)
    return F.coalesce(type_from_url(url), type_from_media_type(content_type))
