"""Code lists, levels and constants that results depend on."""

# Days, in service-calendar order.
DAYS = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")

# Transport codes of recorded arrivals, by mode.
TRAIN_CODES = ("IR", "IC", "RE", "S", "SN", "R", "RB", "ICE", "TGV", "EC", "NJ", "TER", "IRE", "RJX", "EXT", "ATZ",
               "PE", "ZUG", "FLX", "RJ", "MAT", "D", "AG")
BUS_CODES = ("B", "BN", "BUS", "CAR", "EV", "EXB", "KB", "RUB", "BP", "EV1", "EV2", "EV3", "LG40")
TRAM_CODES = ("T", "TN")
METRO_CODES = ("M",)
BOAT_CODES = ("BAT",)
RACK_CODES = ("CC",)
TAXI_CODES = ("TAXI",)

# Mode names by route type range (inclusive).
MODE_RANGES = (
    ("Zug", 100, 199),
    ("Bus", 700, 799),
    ("Tram", 900, 999),
    ("Schiff", 1000, 1099),
    ("Zahnradbahn", 1300, 1499),
    ("Metro", 401, 401),
    ("Taxi", 1500, 1500),
)

# Vehicle words by route type.
VEHICLE_TYPES = (
    ("bus", (201, 202, 700, 702, 705, 710, 715)),
    ("metro", (401,)),
    ("tram", (900,)),
    ("train", (100, 101, 102, 103, 104, 105, 106, 107, 109, 116, 117)),
    ("boat", (1000,)),
    ("airplane", (1100,)),
    ("lift", (1300, 1303)),
    ("funicular", (1400,)),
    ("taxi", (1500,)),
)

# Delay distribution grid and lognormal shift (minutes).
QUANTILES = (0.05, 0.10, 0.25, 0.50, 0.75, 0.90, 0.95, 0.99)
QUANTILE_PERCENTS = (5, 10, 25, 50, 75, 90, 95, 99)
QUANTILE_COLS = ("q05", "q10", "q25", "q50", "q75", "q90", "q95", "q99")
LN_OFFSET = 10.0
MIN_VARIANCE_RATIO = 1.0 + 1e-9
MIN_OBSERVATIONS = 30
TRIM_MIN_MINUTES = -10.0
TRIM_MAX_MINUTES = 60.0

# Delay levels, most specific first.
LEVELS = ("bpuic_hour_dow", "bpuic_hour", "bpuic", "line_hour_dow", "line", "prod_hour_dow", "prod", "global")

# Geography and walking.
EARTH_RADIUS_M = 6371000.0
WALK_M_PER_SEC = 50 / 60
PLAUSIBLE_M_PER_MIN = 333.0

# Thresholds of the Brier score (minutes).
BRIER_MINUTES = (0, 2, 5, 10)

# Acklam's rational approximation of the inverse normal CDF.
PPF_A = (-3.969683028665376e+01, 2.209460984245205e+02, -2.759285104469687e+02, 1.383577518672690e+02,
         -3.066479806614716e+01, 2.506628277459239e+00)
PPF_B = (-5.447609879822406e+01, 1.615858368580409e+02, -1.556989798598866e+02, 6.680131188771972e+01,
         -1.328068155288572e+01)
PPF_C = (-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e+00, -2.549732539343734e+00,
         4.374664141464968e+00, 2.938163982698783e+00)
PPF_D = (7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e+00, 3.754408661907416e+00)
PPF_LOW = 0.02425

# Hart's double-precision rational form of the normal tail (West, 2005).
CDF_TOP = (3.52624965998911e-02, 0.700383064443688, 6.37396220353165, 33.912866078383, 112.079291497871,
           221.213596169931, 220.206867912376)
CDF_BOTTOM = (8.83883476483184e-02, 1.75566716318264, 16.064177579207, 86.7807322029461, 296.564248779674,
              637.333633378831, 793.826512519948, 440.413735824752)
