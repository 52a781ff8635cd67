"""The canonical ``messages`` table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TRANSLATION = T.StructType(
    [
        T.StructField("text", T.StringType()),
        T.StructField("from_lang", T.StringType()),
        T.StructField("to_lang", T.StringType()),
    ]
)
CLASSIFICATION = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("agent", T.StringType()),
    ]
)
LOCATION = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("latitude", T.DoubleType()),
    ]
)
COORDINATES = T.StructType(
    [T.StructField("lon", T.DoubleType()), T.StructField("lat", T.DoubleType())]
)
INFO = T.StructType(
    [
        T.StructField("group_members", T.LongType()),
        T.StructField("coordinates", COORDINATES),
        T.StructField("locations", T.ArrayType(LOCATION)),
        T.StructField("extra", T.MapType(T.StringType(), T.StringType())),
    ]
)
MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("id_", T.StringType()),
        T.StructField("datetime_", T.TimestampNTZType()),
        T.StructField("datetime_scraped_", T.TimestampNTZType()),
        T.StructField("country", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("group", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("reply", T.BooleanType()),
        T.StructField("reply_to", T.StringType()),
        T.StructField("translations", T.ArrayType(TRANSLATION)),
        T.StructField("info", INFO),
        T.StructField("classifications", T.ArrayType(CLASSIFICATION)),
    ]
)
MESSAGE_COLUMNS = MESSAGE_SCHEMA.fieldNames()
MANDATORY_COLUMNS = ["id_", "datetime_", "datetime_scraped_", "country", "source", "text"]

# The two datetime text forms.
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"
SQL_FORMAT = "yyyy-MM-dd HH:mm:ss"


def parse_datetime(value: Column) -> Column:
    """A zone-free timestamp from either text form; a zone is dropped, other text gives null."""
    return value.cast("string").try_cast("timestamp_ntz")


def not_nan(value: Column) -> Column:
    """A floating value; null where it is not a number, as tools without nulls write what is absent."""
    return F.when(~F.isnan(value), value)


def info_struct(
    group_members: Column | None = None,
    lon: Column | None = None,
    lat: Column | None = None,
    extra: Column | None = None,
) -> Column:
    """An ``info`` value; ``coordinates`` is null unless both are numbers."""
    coordinates = F.lit(None).cast(COORDINATES)
    if lon is not None and lat is not None:
        lon, lat = (not_nan(x.cast("double")) for x in (lon, lat))
        coordinates = F.when(lon.isNotNull() & lat.isNotNull(), F.struct(lon.alias("lon"), lat.alias("lat")))
    members = F.lit(None) if group_members is None else group_members
    return F.struct(
        members.cast("bigint").alias("group_members"),
        coordinates.alias("coordinates"),
        F.lit(None).cast(T.ArrayType(LOCATION)).alias("locations"),
        (F.lit(None) if extra is None else extra)
        .cast(T.MapType(T.StringType(), T.StringType()))
        .alias("extra"),
    )


def to_messages(df: DataFrame) -> DataFrame:
    """Project any frame with the mandatory columns onto ``MESSAGE_SCHEMA``.

    Absent optional columns become their defaults; datetimes given as text are
    parsed; ids become strings; floating values that are no numbers are absent.
    """
    missing = [name for name in MANDATORY_COLUMNS if name not in df.columns]
    if missing:
        raise ValueError(f"mandatory fields of message missing: {', '.join(missing)}")
    types = dict(df.dtypes)
    out = []
    for field in MESSAGE_SCHEMA:
        name = field.name
        if name not in df.columns:
            value = F.lit(None)
        elif isinstance(field.dataType, T.TimestampNTZType) and types[name] == "string":
            value = parse_datetime(F.col(name))
        else:
            value = F.col(f"`{name}`")
            if types[name] in ("float", "double"):
                value = not_nan(value)
        if name in ("translations", "classifications"):
            value = F.coalesce(value.cast(field.dataType), F.array().cast(field.dataType))
        elif name == "info":
            value = F.coalesce(value.cast(INFO), info_struct())
        elif name == "reply":
            value = F.coalesce(value.cast("boolean"), F.lit(False))
        out.append(value.cast(field.dataType).alias(name))
    return df.select(*out)


def id_number(name: str = "id_") -> Column:
    """Numeric order of a string id; null when it is not a whole number."""
    return F.col(name).try_cast("bigint")
