"""Declared schemas of the tables and documents the operators exchange."""

from pyspark.sql import types as T

COUNTRIES = T.StructType(
    [
        T.StructField("doc_id", T.StringType(), False),
        T.StructField("country_name", T.StringType(), False),
        T.StructField("country_url", T.StringType(), False),
        T.StructField("language", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("last_scraped_at", T.TimestampType()),
    ]
)

SECTIONS = T.StructType(
    [
        T.StructField("section_url", T.StringType(), False),
        T.StructField("country_doc_id", T.StringType(), False),
        T.StructField("section_title", T.StringType(), False),
        T.StructField("text_content", T.StringType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("language", T.StringType()),
        T.StructField("scraped_at", T.TimestampType()),
    ]
)

SECTION_BODY = T.StructType(
    [
        T.StructField("content", T.ArrayType(T.StringType())),
        T.StructField("url", T.StringType()),
    ]
)

# ``sections`` must be declared: its keys are data, inference would make them fields.
STRUCTURED_DOCUMENT = T.StructType(
    [
        T.StructField("country_name", T.StringType()),
        T.StructField("sections", T.MapType(T.StringType(), SECTION_BODY)),
    ]
)

UNSTRUCTURED_DOCUMENT = T.StructType(
    [
        T.StructField("country_slug", T.StringType()),
        T.StructField("country_name", T.StringType()),
        T.StructField("content", T.ArrayType(T.StringType())),
        T.StructField("urls", T.MapType(T.StringType(), T.StringType())),
        T.StructField("timestamp", T.StringType()),
        T.StructField("version", T.StringType()),
    ]
)

PREDICTION = T.StructType(
    [
        T.StructField("yes_no", T.StringType()),
        T.StructField("explanation", T.StringType()),
        T.StructField("year", T.ArrayType(T.StringType())),
        T.StructField("sectors", T.ArrayType(T.StringType())),
        T.StructField("quote", T.StringType()),
        T.StructField("confidence", T.DoubleType()),
        T.StructField("source_url", T.StringType()),
    ]
)

# Only ``yes_no`` is ever read from the truth file; its other fields vary in type.
TRUTH = T.StructType([T.StructField("yes_no", T.StringType())])


def nested(leaf: T.DataType) -> T.MapType:
    """country -> label -> leaf, the shape of prediction and truth files."""
    return T.MapType(T.StringType(), T.MapType(T.StringType(), leaf))
