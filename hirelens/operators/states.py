"""States of free-text job locations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import captured, ladder, matches

# State code, name, latitude and longitude of the centre.
STATES: list[tuple[str, str, float, float]] = [
    ("AL", "Alabama", 32.8067, -86.7911), ("AK", "Alaska", 61.3707, -152.4044), ("AZ", "Arizona", 33.7298, -111.4312),
    ("AR", "Arkansas", 34.9697, -92.3731), ("CA", "California", 36.1162, -119.6816), ("CO", "Colorado", 39.0598, -105.3111),
    ("CT", "Connecticut", 41.5978, -72.7554), ("DE", "Delaware", 39.3185, -75.5071), ("DC", "District of Columbia", 38.8974, -77.0268),
    ("FL", "Florida", 27.7663, -81.6868), ("GA", "Georgia", 33.0406, -83.6431), ("HI", "Hawaii", 21.0943, -157.4983),
    ("ID", "Idaho", 44.2405, -114.4788), ("IL", "Illinois", 40.3495, -88.9861), ("IN", "Indiana", 39.8494, -86.2583),
    ("IA", "Iowa", 42.0115, -93.2105), ("KS", "Kansas", 38.5266, -96.7265), ("KY", "Kentucky", 37.6681, -84.6701),
    ("LA", "Louisiana", 31.1695, -91.8678), ("ME", "Maine", 44.6939, -69.3819), ("MD", "Maryland", 39.0639, -76.8021),
    ("MA", "Massachusetts", 42.2302, -71.5301), ("MI", "Michigan", 43.3266, -84.5361), ("MN", "Minnesota", 45.6945, -93.9002),
    ("MS", "Mississippi", 32.7416, -89.6787), ("MO", "Missouri", 38.4561, -92.2884), ("MT", "Montana", 46.9219, -110.4544),
    ("NE", "Nebraska", 41.1254, -98.2681), ("NV", "Nevada", 38.3135, -117.0554), ("NH", "New Hampshire", 43.4525, -71.5639),
    ("NJ", "New Jersey", 40.2989, -74.5210), ("NM", "New Mexico", 34.8405, -106.2485), ("NY", "New York", 42.1657, -74.9481),
    ("NC", "North Carolina", 35.6301, -79.8064), ("ND", "North Dakota", 47.5289, -99.7840), ("OH", "Ohio", 40.3888, -82.7649),
    ("OK", "Oklahoma", 35.5653, -96.9289), ("OR", "Oregon", 44.5720, -122.0709), ("PA", "Pennsylvania", 40.5908, -77.2098),
    ("RI", "Rhode Island", 41.6809, -71.5118), ("SC", "South Carolina", 33.8569, -80.9450), ("SD", "South Dakota", 44.2998, -99.4388),
    ("TN", "Tennessee", 35.7478, -86.6923), ("TX", "Texas", 31.0545, -97.5635), ("UT", "Utah", 40.1500, -111.8624),
    ("VT", "Vermont", 44.0459, -72.7107), ("VA", "Virginia", 37.7693, -78.1700), ("WA", "Washington", 47.4009, -121.4905),
    ("WV", "West Virginia", 38.4912, -80.9545), ("WI", "Wisconsin", 44.2685, -89.6165), ("WY", "Wyoming", 42.7560, -107.3025),
]
#: The District has several names; a name that holds another one is tried first.
DC_NAMES = r"DISTRICT OF COLUMBIA|WASHINGTON DC|WASHINGTON D\.C\."
BEFORE = {"VA": "WV"}


def centers(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(STATES, "state_abbr string, state_name string, lat double, long double")


def state_code(location: Column | str) -> Column:
    """The code after a comma, or the first state named; null for remote places and unknown ones."""
    location = F.col(location) if isinstance(location, str) else location
    text = F.upper(F.coalesce(location, F.lit("")))
    code = captured(text, r",\s*([A-Z]{2})(?:\s|,|$)")
    names = {abbr: DC_NAMES if abbr == "DC" else name.upper() for abbr, name, *_ in STATES}
    order = [a for a in names if a not in BEFORE.values()]
    for late, early in BEFORE.items():
        order.insert(order.index(late), early)
    known = [(matches(text, names[a]), a) for a in order]
    return F.when(matches(text, r"\bREMOTE\b"), None).when(code.isin(*names), code).otherwise(ladder(known))


def with_state(jobs: DataFrame) -> DataFrame:
    """jobs with state_abbr, state_name, lat and long."""
    return jobs.withColumn("state_abbr", state_code("job_location")).join(F.broadcast(centers(jobs.sparkSession)), "state_abbr", "left")
