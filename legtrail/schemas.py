"""Row contracts of the four datasets."""

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DateType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)


def _schema(**types) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in types.items()])


# Names of the four datasets and of their columns.
DEPARTURES = "bl_dep"
ARRIVALS = "bl_arr"
DEPARTURE_POINTS = "bl_dep_SV"
ARRIVAL_POINTS = "bl_arr_SV"
FAMILIES = (DEPARTURES, ARRIVALS, DEPARTURE_POINTS, ARRIVAL_POINTS)

FLIGHTS = _schema(
    ICAO24=StringType(),
    call_sign=StringType(),
    departure_time=TimestampNTZType(),
    departure_date=DateType(),
    arrival_time=TimestampNTZType(),
    arrival_date=DateType(),
    departure_airport_ICAO=StringType(),
    destination_airport_ICAO=StringType(),
    id=StringType(),
)

STATE_VECTORS = _schema(
    ICAO24=StringType(),
    longitude=DoubleType(),
    latitude=DoubleType(),
    requested_time=DoubleType(),
    geo_altitude=DoubleType(),
    velocity=DoubleType(),
    special_purpose_indicator=BooleanType(),
    origin_country=StringType(),
    id=StringType(),
    arrival_date=DateType(),
    departure_date=DateType(),
)

#: State vectors as the store holds them: ``copies`` says how often the point is there.
STORED_POINTS = StructType([*STATE_VECTORS.fields, StructField("copies", LongType(), False)])

#: The part of a state vector that comes from the aircraft.
STATE_FIELDS = (
    "longitude",
    "latitude",
    "geo_altitude",
    "velocity",
    "special_purpose_indicator",
    "origin_country",
)

SERIES = ArrayType(
    StructType(
        [StructField("requested_time", DoubleType())]
        + [STATE_VECTORS[name] for name in STATE_FIELDS]
    )
)

RAW_FLIGHT = _schema(
    ICAO24=StringType(),
    call_sign=StringType(),
    departure_time=TimestampNTZType(),
    arrival_time=TimestampNTZType(),
    origin_airport=StringType(),
    destination_airport=StringType(),
    state_vectors=SERIES,
)


def family_schema(family: str) -> StructType:
    return FLIGHTS if family in (DEPARTURES, ARRIVALS) else STATE_VECTORS


def stored_schema(family: str) -> StructType:
    """Rows of a family in an ingest store."""
    return FLIGHTS if family in (DEPARTURES, ARRIVALS) else STORED_POINTS
