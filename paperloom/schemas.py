"""Table schemas. Reads name them; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

ERROR = T.StructType([
    T.StructField("stage", T.StringType()),
    T.StructField("reason", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("status_code", T.IntegerType()),
])


def _fields(spec: str) -> list[T.StructField]:
    """``name type`` pairs; a trailing ``!`` marks a required column."""
    kinds = {"string": T.StringType(), "int": T.IntegerType(), "long": T.LongType(),
             "date": T.DateType(), "timestamp": T.TimestampType(), "double": T.DoubleType(),
             "binary": T.BinaryType(), "boolean": T.BooleanType(), "error": ERROR}
    out = []
    for item in spec.split(","):
        name, kind = item.split()
        out.append(T.StructField(name, kinds[kind.rstrip("!")], not kind.endswith("!")))
    return out


# One row per stored version or per failure.
LANDING = T.StructType(_fields(
    "identifier string!, version int!, source_id string!, section_id string!, title string!,"
    "description string!, published_date date, partition_date date!, source_url string!,"
    "doc_link string!, doc_type string!, file_path string, file_hash string, etag string,"
    "proxy string, status string!, error error, scraped_at timestamp!, run_id string!"
))

# Which batch wrote a row. A batch that is run again replaces only its own rows.
BATCH = T.StructField("ingest_batch", T.StringType())

# A landing row on its way in: arrival order and bytes instead of version and path.
ITEM = T.StructType(_fields("seq long!") + [
    field for field in LANDING if field.name not in ("version", "file_path", "file_hash")
] + _fields("content binary"))

CONTENT = T.StructType(_fields(
    "file_path string!, content binary!, content_type string!, section_id string!, partition_date date!"
))

# What change detection and numbering need of every landing row, in buckets of the identifier.
LANDING_KEYS = T.StructType(_fields(
    "identifier string!, file_hash string, version int!, status string!, landed_in string!, bucket int!"
))

TRANSFORMED = T.StructType(_fields(
    "identifier string!, version int!, source_id string!, section_id string!, title string!,"
    "description string!, published_date date, partition_date date!, source_url string!,"
    "doc_link string!, doc_type string!, source_file_path string!, source_file_hash string!,"
    "file_path string!, file_hash string!, transformed_at timestamp!, run_id string!"
))

ATTEMPT = T.StructType(_fields(
    "run_id string!, source_id string!, section_id string!, partition_date date!,"
    "window_start date!, window_end date!, finish_reason string!, fatal string,"
    "started_at timestamp!, finished_at timestamp!, duration_seconds double!,"
    "found long!, scraped long!, failed long!, skipped_unchanged long!, recorded_at timestamp!"
))

# An archived response: what a crawl kept of one request.
FETCH = T.StructType(_fields(
    "url string!, status int, content_type string, etag string, proxy string,"
    "body binary, failure string, fetched_at timestamp"
))
