"""Table schemas (K12). Declared once; no reader infers a schema."""

from pyspark.sql import types as T

RAW_SALES = T.StructType([
    T.StructField("order_id", T.LongType()),
    T.StructField("customer_id", T.LongType()),
    T.StructField("product", T.StringType()),
    T.StructField("quantity", T.LongType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("total_amount", T.DoubleType()),
    T.StructField("order_date", T.DateType()),
    T.StructField("region", T.StringType()),
    T.StructField("channel", T.StringType()),
])

RAW_SALES_TABLE = T.StructType(RAW_SALES.fields + [
    T.StructField("created_at", T.TimestampType()),
])

TRANSFORMED_SALES = T.StructType(RAW_SALES.fields + [
    T.StructField("order_category", T.StringType()),
    T.StructField("product_category", T.StringType()),
    T.StructField("day_of_week", T.LongType()),
    T.StructField("month", T.LongType()),
    T.StructField("quarter", T.LongType()),
    T.StructField("customer_order_sequence", T.LongType()),
    T.StructField("revenue", T.DoubleType()),
    T.StructField("estimated_profit", T.DoubleType()),
    T.StructField("has_data_quality_issues", T.BooleanType()),
    T.StructField("processed_at", T.TimestampType()),
])

DAILY_SUMMARY = T.StructType([
    T.StructField("summary_date", T.DateType()),
    T.StructField("total_orders", T.LongType()),
    T.StructField("total_revenue", T.DoubleType()),
    T.StructField("average_order_value", T.DoubleType()),
    T.StructField("unique_customers", T.LongType()),
    T.StructField("north_region_revenue", T.DoubleType()),
    T.StructField("south_region_revenue", T.DoubleType()),
    T.StructField("east_region_revenue", T.DoubleType()),
    T.StructField("west_region_revenue", T.DoubleType()),
    T.StructField("online_revenue", T.DoubleType()),
    T.StructField("retail_revenue", T.DoubleType()),
    T.StructField("mobile_revenue", T.DoubleType()),
    T.StructField("widgets_revenue", T.DoubleType()),
    T.StructField("gadgets_revenue", T.DoubleType()),
    T.StructField("other_revenue", T.DoubleType()),
    T.StructField("data_quality_issues_count", T.LongType()),
])

DAILY_SUMMARY_TABLE = T.StructType(DAILY_SUMMARY.fields + [
    T.StructField("processing_timestamp", T.TimestampType()),
])

# The CSV job's frame: six columns in, two derived.
CSV_SALES = T.StructType([
    T.StructField("order_id", T.LongType()),
    T.StructField("customer_id", T.LongType()),
    T.StructField("product", T.StringType()),
    T.StructField("quantity", T.LongType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("order_date", T.DateType()),
])

# Nested user document and the flat keyed table it lands in.
USER_DOC = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("personalInfo", T.StructType([
        T.StructField("firstName", T.StringType()),
        T.StructField("lastName", T.StringType()),
        T.StructField("email", T.StringType()),
    ])),
])

USERS = T.StructType([
    T.StructField("id", T.IntegerType(), nullable=False),
    T.StructField("firstName", T.StringType()),
    T.StructField("lastName", T.StringType()),
    T.StructField("email", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
])

_STREET = T.StructType([
    T.StructField("number", T.LongType()),
    T.StructField("name", T.StringType()),
])

LOCATION = T.StructType([
    T.StructField("street", _STREET),
    T.StructField("city", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("country", T.StringType()),
    # A number in some documents, text in others: always read as text.
    T.StructField("postcode", T.StringType()),
    T.StructField("coordinates", T.StructType([
        T.StructField("latitude", T.StringType()),
        T.StructField("longitude", T.StringType()),
    ])),
    T.StructField("timezone", T.StructType([
        T.StructField("offset", T.StringType()),
        T.StructField("description", T.StringType()),
    ])),
])

LOGIN = T.StructType([
    T.StructField("uuid", T.StringType()),
    T.StructField("username", T.StringType()),
    T.StructField("password", T.StringType()),
    T.StructField("salt", T.StringType()),
    T.StructField("md5", T.StringType()),
    T.StructField("sha1", T.StringType()),
    T.StructField("sha256", T.StringType()),
])

_DATED_AGE = T.StructType([
    T.StructField("date", T.StringType()),
    T.StructField("age", T.LongType()),
])

SNAPSHOT_RESULT = T.StructType([
    T.StructField("gender", T.StringType()),
    T.StructField("name", T.StructType([
        T.StructField("title", T.StringType()),
        T.StructField("first", T.StringType()),
        T.StructField("last", T.StringType()),
    ])),
    T.StructField("location", LOCATION),
    T.StructField("email", T.StringType()),
    T.StructField("login", LOGIN),
    T.StructField("dob", _DATED_AGE),
    T.StructField("registered", _DATED_AGE),
    T.StructField("phone", T.StringType()),
    T.StructField("cell", T.StringType()),
    T.StructField("id", T.StructType([
        T.StructField("name", T.StringType()),
        T.StructField("value", T.StringType()),
    ])),
    T.StructField("picture", T.StructType([
        T.StructField("large", T.StringType()),
        T.StructField("medium", T.StringType()),
        T.StructField("thumbnail", T.StringType()),
    ])),
    T.StructField("nat", T.StringType()),
])

SNAPSHOT_DOC = T.StructType([
    T.StructField("results", T.ArrayType(SNAPSHOT_RESULT)),
    T.StructField("info", T.StructType([
        T.StructField("seed", T.StringType()),
        T.StructField("results", T.LongType()),
        T.StructField("page", T.LongType()),
        T.StructField("version", T.StringType()),
    ])),
])

RUN_STATUS = T.StructType([
    T.StructField("status", T.StringType()),
    T.StructField("execution_date", T.StringType()),
    T.StructField("records_processed", T.LongType()),
    T.StructField("total_revenue", T.DoubleType()),
    T.StructField("message", T.StringType()),
    T.StructField("error", T.StringType()),
    T.StructField("quality_checks", T.StringType()),  # JSON
])

# The columns that default to the time of the insert.
INSERT_TIME_COLUMNS = ("created_at", "processing_timestamp")


def ddl(table: str, schema: T.StructType, path: str, partition_by: str | None = None) -> str:
    """CREATE TABLE statement for a parquet table at ``path``; insert-time
    columns default to current_timestamp()."""
    def column(f) -> str:
        default = " DEFAULT current_timestamp()" if f.name in INSERT_TIME_COLUMNS else ""
        return f"`{f.name}` {f.dataType.simpleString()}{default}"

    cols = ", ".join(map(column, schema.fields))
    part = f" PARTITIONED BY ({partition_by})" if partition_by else ""
    return f"CREATE TABLE IF NOT EXISTS {table} ({cols}) USING parquet{part} LOCATION '{path}'"
