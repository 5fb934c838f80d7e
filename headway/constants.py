"""Fixed values shared by the operators.

These are domain constants: changing one changes results, so they live in one
place and every operator that uses one also takes it as a keyword argument.
"""

# Geometry.
CORRIDOR_M = 50.0            # a ping within this distance of a leg is on it
MIN_TRIP_BOX_M2 = 20.0       # trips whose ping box is smaller never moved
STANDSTILL_M = 5.0           # leading steps shorter than this are a standstill
SHAPE_STOP_M = 5.0           # a shape point this close to a stop is that stop
FEET_PER_METRE = 3.280839895
MILE_M = 1609.34
BLOCK_M = MILE_M / 8         # one city block

# Speeds. The two mile lengths differ in the published method.
SPEED_MILE_M = 1609.0
MPH_PER_MPS = 2.23694
MIN_SPEED_MPH = 1.0
MAX_SPEED_MPH = 115.0
MIN_STEP_M = 1.0
ZERO_GAP_SECONDS = 1e-9

# Calendar.
DAY_FIRST_HOUR = 6
DAY_LAST_HOUR = 20

# Quality checks.
QC_MAX_SPEED_MPH = 150.0
QC_MAX_TRIP_HOURS = 8
QC_EXAMPLES = 5

# Reach.
REACH_BUDGETS_MIN = (5, 10, 15, 30, 60, 90, 120)
REACH_LABELS = (
    (5, "5 minutes"),
    (10, "10 minutes"),
    (15, "15 minutes"),
    (30, "30 minutes"),
    (60, "1 hour"),
    (90, "1 hour 30 minutes"),
    (120, "2 hours"),
)

# GTFS tables a feed must hold to be usable for patterns.
REQUIRED_FEED_TABLES = ("shapes", "stops", "trips")

# EPSG:26971 (transverse Mercator on GRS80, metres).
GRS80_A = 6378137.0
GRS80_INV_F = 298.257222101
TM_LAT0_DEG = 36.0 + 40.0 / 60.0
TM_LON0_DEG = -(88.0 + 20.0 / 60.0)
TM_K0 = 0.999975
TM_FALSE_EASTING = 300000.0
TM_FALSE_NORTHING = 0.0
