"""Declared schemas: nothing is inferred on any path."""

from pyspark.sql import types as T

_S = T.StringType()


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, _S) for n in names]


#: Daily ping files. ``pid`` is a double there and is made uniform later.
PINGS = T.StructType(
    [
        T.StructField("vid", T.LongType()),
        T.StructField("tmstmp", _S),
        T.StructField("lat", T.DoubleType()),
        T.StructField("lon", T.DoubleType()),
        T.StructField("hdg", T.LongType()),
        T.StructField("pid", T.DoubleType()),
        *_strings("rt", "des", "pdist"),
        T.StructField("dly", T.BooleanType()),
        *_strings(
            "tatripid", "origtatripno", "tablockid", "zone", "scrape_file", "data_time", "data_hour",
            "data_date",
        ),
    ]
)

_VEHICLE = T.StructType(
    _strings(
        "vid", "tmstmp", "lat", "lon", "hdg", "pid", "rt", "des", "pdist", "dly", "tatripid",
        "origtatripno", "tablockid", "zone",
    )
)
_ERROR = T.StructType(_strings("rt", "msg"))
_RESPONSE = T.StructType(
    [T.StructField("vehicle", T.ArrayType(_VEHICLE)), T.StructField("error", T.ArrayType(_ERROR))]
)
#: One poll: chunk name to response.
SNAPSHOT = T.MapType(_S, T.StructType([T.StructField("bustime-response", _RESPONSE)]))

PATTERN_POINTS = T.StructType(
    [
        T.StructField("pid", _S),
        T.StructField("seq", T.IntegerType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("lon", T.DoubleType()),
        *_strings("typ", "stpid", "stpnm"),
        T.StructField("pdist", T.DoubleType()),
    ]
)

#: GTFS text tables by name, all strings.
GTFS = {
    "shapes": T.StructType(
        _strings("shape_id", "shape_pt_lat", "shape_pt_lon", "shape_pt_sequence", "shape_dist_traveled")
    ),
    "stops": T.StructType(
        _strings(
            "stop_id", "stop_name", "stop_lat", "stop_lon", "location_type", "parent_station", "stop_desc"
        )
    ),
    "trips": T.StructType(_strings("route_id", "service_id", "trip_id", "shape_id", "schd_trip_id")),
    "stop_times": T.StructType(
        _strings("trip_id", "stop_id", "stop_sequence", "arrival_time", "departure_time")
    ),
    "routes": T.StructType(_strings("route_id", "route_short_name")),
    "calendar": T.StructType(
        _strings(
            "service_id", "monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday",
            "start_date", "end_date",
        )
    ),
    "calendar_dates": T.StructType(_strings("service_id", "date", "exception_type")),
}

#: Catalogue of published feed versions.
FEED_VERSIONS = T.StructType(
    [
        T.StructField(
            "feed_versions",
            T.ArrayType(T.StructType(_strings("sha1", "fetched_at", "earliest_calendar_date", "url"))),
        )
    ]
)

#: Boundary polygons.
GEOJSON = T.StructType(
    [
        T.StructField(
            "features",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("properties", T.MapType(_S, _S)),
                        T.StructField(
                            "geometry",
                            T.StructType([T.StructField("type", _S), T.StructField("coordinates", _S)]),
                        ),
                    ]
                )
            ),
        )
    ]
)
