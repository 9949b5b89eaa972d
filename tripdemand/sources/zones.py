"""Zone and operator dimensions.

Both are small lookup tables with a fixed, known size (55 zones, 4 operators),
so they are always safe to broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripdemand.functions import literal_frame

# --- fixed values (must equal the reference's) -------------------------------
# Pickup/dropoff zones kept by the cleaners: the 55 Manhattan "Yellow Zone"
# ids of the public taxi zone lookup, ascending.
ZONE_IDS = (
    4, 12, 13, 24, 43, 45, 48, 50, 68, 79,
    87, 88, 90, 100, 103, 104, 105, 107, 113, 114,
    125, 137, 140, 141, 142, 143, 144, 148, 151, 158,
    161, 162, 163, 164, 170, 186, 194, 209, 211, 224,
    229, 230, 231, 232, 233, 234, 236, 237, 238, 239,
    246, 249, 261, 262, 263,
)

# (location_id, zone_name, borough, service_zone) for those ids, from the
# public taxi zone lookup. 103, 104 and 105 share one name.
ZONE_ROWS = (
    (4, "Alphabet City", "Manhattan", "Yellow Zone"),
    (12, "Battery Park", "Manhattan", "Yellow Zone"),
    (13, "Battery Park City", "Manhattan", "Yellow Zone"),
    (24, "Bloomingdale", "Manhattan", "Yellow Zone"),
    (43, "Central Park", "Manhattan", "Yellow Zone"),
    (45, "Chinatown", "Manhattan", "Yellow Zone"),
    (48, "Clinton East", "Manhattan", "Yellow Zone"),
    (50, "Clinton West", "Manhattan", "Yellow Zone"),
    (68, "East Chelsea", "Manhattan", "Yellow Zone"),
    (79, "East Village", "Manhattan", "Yellow Zone"),
    (87, "Financial District North", "Manhattan", "Yellow Zone"),
    (88, "Financial District South", "Manhattan", "Yellow Zone"),
    (90, "Flatiron", "Manhattan", "Yellow Zone"),
    (100, "Garment District", "Manhattan", "Yellow Zone"),
    (103, "Governor's Island/Ellis Island/Liberty Island", "Manhattan", "Yellow Zone"),
    (104, "Governor's Island/Ellis Island/Liberty Island", "Manhattan", "Yellow Zone"),
    (105, "Governor's Island/Ellis Island/Liberty Island", "Manhattan", "Yellow Zone"),
    (107, "Gramercy", "Manhattan", "Yellow Zone"),
    (113, "Greenwich Village North", "Manhattan", "Yellow Zone"),
    (114, "Greenwich Village South", "Manhattan", "Yellow Zone"),
    (125, "Hudson Sq", "Manhattan", "Yellow Zone"),
    (137, "Kips Bay", "Manhattan", "Yellow Zone"),
    (140, "Lenox Hill East", "Manhattan", "Yellow Zone"),
    (141, "Lenox Hill West", "Manhattan", "Yellow Zone"),
    (142, "Lincoln Square East", "Manhattan", "Yellow Zone"),
    (143, "Lincoln Square West", "Manhattan", "Yellow Zone"),
    (144, "Little Italy/NoLiTa", "Manhattan", "Yellow Zone"),
    (148, "Lower East Side", "Manhattan", "Yellow Zone"),
    (151, "Manhattan Valley", "Manhattan", "Yellow Zone"),
    (158, "Meatpacking/West Village West", "Manhattan", "Yellow Zone"),
    (161, "Midtown Center", "Manhattan", "Yellow Zone"),
    (162, "Midtown East", "Manhattan", "Yellow Zone"),
    (163, "Midtown North", "Manhattan", "Yellow Zone"),
    (164, "Midtown South", "Manhattan", "Yellow Zone"),
    (170, "Murray Hill", "Manhattan", "Yellow Zone"),
    (186, "Penn Station/Madison Sq West", "Manhattan", "Yellow Zone"),
    (194, "Randalls Island", "Manhattan", "Yellow Zone"),
    (209, "Seaport", "Manhattan", "Yellow Zone"),
    (211, "SoHo", "Manhattan", "Yellow Zone"),
    (224, "Stuy Town/Peter Cooper Village", "Manhattan", "Yellow Zone"),
    (229, "Sutton Place/Turtle Bay North", "Manhattan", "Yellow Zone"),
    (230, "Times Sq/Theatre District", "Manhattan", "Yellow Zone"),
    (231, "TriBeCa/Civic Center", "Manhattan", "Yellow Zone"),
    (232, "Two Bridges/Seward Park", "Manhattan", "Yellow Zone"),
    (233, "UN/Turtle Bay South", "Manhattan", "Yellow Zone"),
    (234, "Union Sq", "Manhattan", "Yellow Zone"),
    (236, "Upper East Side North", "Manhattan", "Yellow Zone"),
    (237, "Upper East Side South", "Manhattan", "Yellow Zone"),
    (238, "Upper West Side North", "Manhattan", "Yellow Zone"),
    (239, "Upper West Side South", "Manhattan", "Yellow Zone"),
    (246, "West Chelsea/Hudson Yards", "Manhattan", "Yellow Zone"),
    (249, "West Village", "Manhattan", "Yellow Zone"),
    (261, "World Trade Center", "Manhattan", "Yellow Zone"),
    (262, "Yorkville East", "Manhattan", "Yellow Zone"),
    (263, "Yorkville West", "Manhattan", "Yellow Zone"),
)

# Operator dimension: (operator_id, operator_code, operator_name, taxi_type, category)
OPERATOR_ROWS = (
    (1, "1", "Creative Mobile Tech", "yellow", "Konvensional"),
    (2, "2", "VeriFone", "yellow", "Konvensional"),
    (3, "HV0003", "Uber", "fhvhv", "Modern"),
    (4, "HV0005", "Lyft", "fhvhv", "Modern"),
)
# Operator codes counted per service by the loader.
SERVICE_CODES = {"yellow": ("1", "2"), "fhvhv": ("HV0003", "HV0005")}
# ------------------------------------------------------------------------------

ZONE_LOOKUP_SCHEMA = T.StructType([
    T.StructField("LocationID", T.IntegerType()),
    T.StructField("Borough", T.StringType()),
    T.StructField("Zone", T.StringType()),
    T.StructField("service_zone", T.StringType()),
])

DIM_LOCATION_SCHEMA = T.StructType([
    T.StructField("location_id", T.IntegerType()),
    T.StructField("zone_name", T.StringType()),
    T.StructField("borough", T.StringType()),
    T.StructField("service_zone", T.StringType()),
])

DIM_OPERATOR_SCHEMA = T.StructType([
    T.StructField("operator_id", T.IntegerType()),
    T.StructField("operator_code", T.StringType()),
    T.StructField("operator_name", T.StringType()),
    T.StructField("taxi_type", T.StringType()),
    T.StructField("category", T.StringType()),
])


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    """Typed read of the zone lookup CSV; ``N/A`` cells become null."""
    return (spark.read.schema(ZONE_LOOKUP_SCHEMA)
            .option("header", True).option("nullValue", "N/A").csv(path))


def dim_location(zone_lookup: DataFrame, zone_ids=ZONE_IDS) -> DataFrame:
    """Zone lookup restricted to the kept ids, renamed to the warehouse names."""
    ids = ", ".join(str(int(i)) for i in zone_ids)
    return (zone_lookup.filter(F.expr(f"LocationID IN ({ids})"))
            .select(F.col("LocationID").cast("int").alias("location_id"),
                    F.col("Zone").alias("zone_name"),
                    F.col("Borough").alias("borough"),
                    "service_zone"))


def builtin_dim_location(spark: SparkSession) -> DataFrame:
    """The 55-row location dimension from the fixed values above."""
    return literal_frame(spark, ZONE_ROWS, DIM_LOCATION_SCHEMA)


def dim_operator(spark: SparkSession) -> DataFrame:
    """Literal 4-row operator dimension."""
    return literal_frame(spark, OPERATOR_ROWS, DIM_OPERATOR_SCHEMA)
