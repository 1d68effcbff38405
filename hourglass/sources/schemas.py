"""One explicit schema per layer; nothing is inferred."""

from pyspark.sql.types import (
    BooleanType,
    DateType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
)

CORRUPT_COLUMN = "_corrupt_record"

# A commit as landed from the REST API.  Only the fields that are used are
# declared: JSON column pruning stops at top-level fields, so an undeclared
# nested field is never parsed.  Both committer objects are maps rather than
# structs because the rules depend on key presence: an empty ``committer``
# object means "unknown user" (-1) while an object without ``id`` means NULL,
# and a missing ``commit.committer`` key is an error while an explicit JSON
# null is a NULL value.  String map values accept any JSON value (numbers,
# booleans, nested objects arrive as their JSON text).
_STR_MAP = MapType(StringType(), StringType(), valueContainsNull=True)

BRONZE_COMMIT = StructType([
    StructField("sha", StringType()),
    StructField("committer", _STR_MAP),
    StructField("commit", StructType([StructField("committer", _STR_MAP)])),
])

# Flattened commit: silver JSON rows, gold Parquet rows and the staging table.
STAGING_COLUMNS = ("commit_sha", "committer_id", "committer_name",
                   "committer_email", "committer_date", "dt")
STAGING = StructType([
    StructField("commit_sha", StringType()),
    StructField("committer_id", LongType()),
    StructField("committer_name", StringType()),
    StructField("committer_email", StringType()),
    StructField("committer_date", StringType()),   # raw UTC text, as received
    StructField("dt", DateType()),                 # business (GMT+7) day
])

D_DATE = StructType([
    StructField("d_date_id", LongType()),
    StructField("date_str", StringType()),
    StructField("weekday", StringType()),
    StructField("weekday_number", LongType()),
    StructField("dt", DateType()),
])

D_TIME = StructType([
    StructField("d_time_id", LongType()),
    StructField("hour_range_str", StringType()),
])

F_COMMITS_HOURLY = StructType([
    StructField("d_date_id", LongType()),
    StructField("d_time_id", LongType()),
    StructField("committer_id", LongType()),
    StructField("committer_email", StringType()),
    StructField("commit_count", LongType()),
    StructField("dt", DateType()),
])

# A committer's summary of one month (operators.streak_months); dt is its first day.
STREAK_MONTH = StructType([
    StructField("committer_email", StringType()),
    StructField("first_month", IntegerType()),
    StructField("last_month", IntegerType()),
    StructField("head", LongType()),
    StructField("tail", LongType()),
    StructField("best", LongType()),
    StructField("whole", BooleanType()),
    StructField("dt", DateType()),
])

# Merge key of the fact (what the upsert matches on).  The declared primary
# key (committer_email, d_date_id) is coarser than the table's hourly grain, so
# checks use this key instead.
FACT_MERGE_KEY = ("committer_email", "d_time_id", "d_date_id")


def with_field(schema: StructType, field: StructField) -> StructType:
    return StructType(list(schema.fields) + [field])
