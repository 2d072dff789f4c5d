"""Names, thresholds and model settings that results depend on."""

# Time slots in ordinal order 0..3.
TIME_SLOTS = ("Morning", "Afternoon", "Evening", "Night")

# Stands in for a coordinate that is missing or not a number.
MISSING_COORDINATE = -80.0

# Bucket bounds; the last bucket is open ended.
INFINITY = float("inf")
DISTANCE_SPLITS = [float(x) for x in range(0, 3000, 200)] + [INFINITY]
AVERAGE_DELAY_SPLITS = [float(x) for x in range(-1, 17, 3)] + [INFINITY]
TAXI_OUT_SPLITS = [float(x) for x in range(0, 30, 5)] + [INFINITY]

# Order of the model's features.
FEATURE_ORDER = (
    "AirlineIndex",
    "AverageAirlineDelayBucketed",
    "OriginStateIndex",
    "DestinationStateIndex",
    "TimeSlotIndex",
    "Month",
    "DayOfWeek",
    "DistanceBucketed",
    "OriginLatitudeArea",
    "OriginLongitudeArea",
    "OriginAirportIndex",
    "AverageTaxiOutBucketed",
    "DestinationLatitudeArea",
    "DestinationLongitudeArea",
)

# Model settings.
TREE_MAX_DEPTH = 10
TREE_MIN_BINS = 322
LOGISTIC_MAX_ITER = 10
SAMPLE_PERCENT = 20
TRAIN_PERCENT = 70
SPLIT_SEED = 1
