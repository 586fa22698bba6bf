"""Row types shared by the jobs. Column order of PAPER is part of the lake contract."""

from __future__ import annotations

from pyspark.sql import types as T

# The two delivery formats, as they appear in landing paths and request parameters.
FORMATS = ("arXiv", "arXivRaw")
METADATA, VERSIONS = FORMATS


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


TEXT = T.StringType()
AUTHORS_TYPE = T.ArrayType(struct(last_name=TEXT, first_name=TEXT))
VERSIONS_TYPE = T.ArrayType(struct(version=TEXT, created=TEXT))

PAPER = struct(
    paper_id=TEXT,
    is_published=T.BooleanType(),
    title=TEXT,
    abstract=TEXT,
    doi=TEXT,
    journal_ref=TEXT,
    institution=TEXT,
    categories=T.ArrayType(TEXT),
    primary_category=TEXT,
    submitted_date=T.DateType(),
    published_date=T.DateType(),
    update_date=T.DateType(),
    authors=AUTHORS_TYPE,
    versions=VERSIONS_TYPE,
    version_count=T.IntegerType(),
    update_frequency=T.DoubleType(),
    submission_to_publication=T.DoubleType(),
    upload_db_time=T.TimestampType(),
)
PAPER_COLUMNS = PAPER.fieldNames()

PARTITION_COLUMNS = ["year", "month", "day"]
LAKE = T.StructType(PAPER.fields + struct(year=TEXT, month=TEXT, day=TEXT).fields)
STATE = T.StructType(
    PAPER.fields + struct(last_processed=T.TimestampType(), bucket=T.IntegerType()).fields
)

# One snapshot record after typing. ``problem`` names the first type error that makes the record
# unusable; ``categories`` is null for a present value that is not text; ``authors`` is null when
# no author list was delivered; ``versions`` is null when the key is absent.
RECORD = struct(
    id=TEXT,
    title=TEXT,
    abstract=TEXT,
    doi=TEXT,
    categories=TEXT,
    journal_ref=TEXT,
    authors=AUTHORS_TYPE,
    submitter=TEXT,
    versions=VERSIONS_TYPE,
    update_date=TEXT,
    problem=TEXT,
)
RECORD_COLUMNS = RECORD.fieldNames()
