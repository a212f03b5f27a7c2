"""Explicit schemas. Nothing in the package relies on schema inference."""

from pyspark.sql import types as T

ENTRY = T.StructType(
    [
        T.StructField("rank", T.IntegerType()),
        T.StructField("title", T.StringType()),
        T.StructField("artist", T.StringType()),
        T.StructField("weeks_on_chart", T.IntegerType()),
        T.StructField("peak_pos", T.IntegerType()),
        T.StructField("last_pos", T.IntegerType()),
    ]
)

SNAPSHOT = T.StructType(
    [
        T.StructField("chart_date", T.DateType()),
        T.StructField("entries", T.ArrayType(ENTRY)),
    ]
)

ARTIST_METADATA = T.StructType(
    [
        T.StructField("artist", T.StringType()),
        T.StructField("primary_artist_used", T.StringType()),
        T.StructField("mbid", T.StringType()),
        T.StructField("tags", T.ArrayType(T.StringType())),
        T.StructField("found", T.BooleanType()),
        T.StructField("error", T.StringType()),
    ]
)

CHART_HISTORY = T.StructType(
    [
        T.StructField("chart_date", T.DateType()),
        T.StructField("rank", T.IntegerType()),
        T.StructField("title", T.StringType()),
        T.StructField("artist", T.StringType()),
        T.StructField("primary_artist_used", T.StringType()),
        T.StructField("weeks_on_chart", T.IntegerType()),
        T.StructField("peak_pos", T.IntegerType()),
        T.StructField("last_pos", T.IntegerType()),
        T.StructField("is_debut", T.BooleanType()),
        T.StructField("is_reentry_anomaly", T.BooleanType()),
        T.StructField("is_release_week_bulk_entry", T.BooleanType()),
        T.StructField("mbid", T.StringType()),
        T.StructField("genre_tags", T.ArrayType(T.StringType())),
    ]
)

MANIFEST = T.StructType([T.StructField("chart_date", T.DateType())])
