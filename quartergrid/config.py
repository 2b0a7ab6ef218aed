"""Parameters of the engine: places, time window, feature names."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class City:
    """A named latitude/longitude box with its time zone and state code."""

    name: str
    lat_min: float
    lat_max: float
    lng_min: float
    lng_max: float
    zone: str
    state: str


# City boxes, time zones and state codes.
CITIES = (
    City("LosAngeles", 33.700615, 34.353627, -118.683511, -118.074559, "US/Pacific", "CA"),
    City("Houston", 29.497907, 30.129003, -95.797178, -94.988191, "US/Central", "TX"),
    City("Austin", 30.079327, 30.596764, -97.968881, -97.504838, "US/Central", "TX"),
    City("Dallas", 32.559567, 33.083278, -97.036586, -96.428928, "US/Central", "TX"),
    City("Charlotte", 34.970168, 35.423667, -81.060925, -80.622687, "US/Eastern", "NC"),
    City("Atlanta", 33.612410, 33.916999, -84.575600, -84.231911, "US/Eastern", "GA"),
)

def city_table(spark: SparkSession, cities: tuple[City, ...] = CITIES) -> DataFrame:
    """The cities as a table; ``city_order`` is the position in the list.

    Made from Arrow, so that Spark knows its size and picks the join by it.
    """
    places = [pa.field(c, pa.float64()) for c in ("lat_min", "lat_max", "lng_min", "lng_max")]
    schema = pa.schema([
        pa.field("city", pa.string()), pa.field("city_order", pa.int32()), *places,
        pa.field("zone", pa.string()), pa.field("state", pa.string()),
    ])
    rows = [
        dict(zip(schema.names, (c.name, i, c.lat_min, c.lat_max, c.lng_min, c.lng_max, c.zone, c.state)))
        for i, c in enumerate(cities)
    ]
    return spark.createDataFrame(pa.Table.from_pylist(rows, schema=schema))


@dataclass(frozen=True)
class GridWindow:
    """A closed local wall-clock window cut into equal steps.

    ``total_steps`` steps are emitted. When the window ends one second before
    a step boundary there is one more slot than steps: events of that slot
    register their cell but give no grid row.
    """

    begin: datetime
    end: datetime
    step_seconds: int = 900
    block_steps: int = 96

    @property
    def total_steps(self) -> int:
        return int((self.end - self.begin).total_seconds() // self.step_seconds)

    @property
    def begin_text(self) -> str:
        return self.begin.strftime("%Y-%m-%d %H:%M:%S")

    @property
    def end_text(self) -> str:
        return self.end.strftime("%Y-%m-%d %H:%M:%S")


# The periods of the published pipeline.
GRID_WINDOW = GridWindow(datetime(2018, 6, 1), datetime(2018, 8, 31, 23, 59, 59))
GRID_EXTRACT = (datetime(2018, 6, 1), datetime(2018, 9, 2))
TEXT_EXTRACT = (datetime(2017, 5, 1), datetime(2018, 5, 31))

PRECISION = 5
LOOKBACK = 8
HOUR_CLASSES = 5
KEEP_SHARE = 0.02
TRAIN_SHARE = (5, 6)
TEXT_DIMS = 100

# Event classes with an indicator column, and the renamed types.
EVENT_CLASSES = {
    "Accident": "t_accident",
    "BrokenVehicle": "t_broken_vehicle",
    "Congestion": "t_congestion",
    "Construction": "t_construction",
    "Event": "t_event",
    "FlowIncident": "t_flow_incident",
    "RoadBlocked": "t_road_blocked",
}
OTHER_CLASS = "Other"
EVENT_RENAMES = {
    "Broken-Vehicle": "BrokenVehicle",
    "Flow-Incident": "FlowIncident",
    "Lane-Blocked": "RoadBlocked",
}

# Feature columns in grid order.
TRAFFIC_COLUMNS = (
    "t_accident", "t_broken_vehicle", "t_congestion", "t_construction",
    "t_event", "t_flow_incident", "t_other", "t_road_blocked",
)
WEATHER_MEASURES = (
    "humidity", "precipitation", "pressure", "temperature", "visibility", "wind_speed",
)
WEATHER_COLUMNS = tuple(f"w_{m}" for m in WEATHER_MEASURES)
FLAG_COLUMNS = ("w_rain", "w_snow", "w_fog", "w_hail")
SCALED_COLUMNS = TRAFFIC_COLUMNS[1:] + WEATHER_COLUMNS + FLAG_COLUMNS
HOUR_COLUMNS = tuple(f"hod_en{i}" for i in range(HOUR_CLASSES))
STEP_FEATURES = ("dow_cat", "t_accident", "daylight") + SCALED_COLUMNS + HOUR_COLUMNS

RAW_GRID_COLUMNS = (
    ("cell", "step", "dow", "hod", "daylight")
    + TRAFFIC_COLUMNS + WEATHER_COLUMNS + FLAG_COLUMNS
)
CLEAN_GRID_COLUMNS = (
    ("step", "predicted_accident", "cell", "cell_code", "hod_cat", "dow_cat",
     "t_accident", "daylight") + SCALED_COLUMNS
)

POI_FIELDS = (
    "Amenity", "Bump", "Crossing", "Give_Way", "Junction", "Noexit", "Railway",
    "Roundabout", "Station", "Stop", "Traffic_Calming", "Traffic_Signal",
    "Turning_Circle", "Turning_Loop",
)

# Published column headers of the grid files.
PUBLISHED_NAMES = {
    "cell": "Geohash", "step": "TimeStep", "dow": "DOW", "hod": "HOD",
    "daylight": "DayLight", "dow_cat": "DOW_cat", "hod_cat": "HOD_cat",
    "cell_code": "geohash_code",
    "t_accident": "T-Accident", "t_broken_vehicle": "T-BrokenVehicle",
    "t_congestion": "T-Congestion", "t_construction": "T-Construction",
    "t_event": "T-Event", "t_flow_incident": "T-FlowIncident",
    "t_other": "T-Other", "t_road_blocked": "T-RoadBlocked",
    "w_humidity": "W-Humidity", "w_precipitation": "W-Precipitation",
    "w_pressure": "W-Pressure", "w_temperature": "W-Temperature",
    "w_visibility": "W-Visibility", "w_wind_speed": "W-WindSpeed",
    "w_rain": "W-Rain", "w_snow": "W-Snow", "w_fog": "W-Fog", "w_hail": "W-Hail",
}
