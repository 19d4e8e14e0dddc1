"""Breakpoints, weights, names and cut points that results must equal."""

# Segments (concentration low, high, index low, high) of the index table.
# pm2_5 and pm10 in ug/m3 (24 h mean), o3 in ppb (8 h mean / 1 h), co in ppm (8 h mean),
# so2 and no2 in ppb (1 h).
BREAKPOINTS = {
    "pm2_5": [
        (0.0, 12.0, 0, 50),
        (12.1, 35.4, 51, 100),
        (35.5, 55.4, 101, 150),
        (55.5, 150.4, 151, 200),
        (150.5, 250.4, 201, 300),
        (250.5, 350.4, 301, 400),
        (350.5, 500.4, 401, 500),
    ],
    "pm10": [
        (0, 54, 0, 50),
        (55, 154, 51, 100),
        (155, 254, 101, 150),
        (255, 354, 151, 200),
        (355, 424, 201, 300),
        (425, 504, 301, 400),
        (505, 604, 401, 500),
    ],
    "o3_8h": [
        (0, 54, 0, 50),
        (55, 70, 51, 100),
        (71, 85, 101, 150),
        (86, 105, 151, 200),
        (106, 200, 201, 300),
    ],
    "o3_1h": [
        (125, 164, 101, 150),
        (165, 204, 151, 200),
        (205, 404, 201, 300),
        (405, 504, 301, 400),
        (505, 604, 401, 500),
    ],
    "co": [
        (0.0, 4.4, 0, 50),
        (4.5, 9.4, 51, 100),
        (9.5, 12.4, 101, 150),
        (12.5, 15.4, 151, 200),
        (15.5, 30.4, 201, 300),
        (30.5, 40.4, 301, 400),
        (40.5, 50.4, 401, 500),
    ],
    "so2": [
        (0, 35, 0, 50),
        (36, 75, 51, 100),
        (76, 185, 101, 150),
        (186, 304, 151, 200),
        (305, 604, 201, 300),
        (605, 804, 301, 400),
        (805, 1004, 401, 500),
    ],
    "no2": [
        (0, 53, 0, 50),
        (54, 100, 51, 100),
        (101, 360, 101, 150),
        (361, 649, 151, 200),
        (650, 1249, 201, 300),
        (1250, 1649, 301, 400),
        (1650, 2049, 401, 500),
    ],
}
TENTHS = ("pm2_5", "co")  # truncated to 0.1; every other pollutant to 1
OZONE_HOURLY_FLOOR = 125

# Gas constants for ug/m3 -> ppb / ppm at 25 C and 1 atm.
MOLAR_VOLUME = 24.45
MOLAR_MASS = {"o3": 48.00, "no2": 46.01, "so2": 64.07, "co": 28.01}

# Order decides ties of the dominant pollutant.
DOMINANCE_ORDER = ("pm2_5", "pm10", "o3", "co", "so2", "no2")

POLLUTANTS = ("co", "no", "no2", "o3", "so2", "pm2_5", "pm10", "nh3")
MODELLED = ("pm2_5", "pm10", "o3", "co", "no2", "so2")
INTERPOLATED = ("temperature", "tmin", "tmax", "dew_point", "relative_humidity")
MEDIAN_FILLED = ("wind_speed", "pressure")
TARGETS = ("target_aqi_24h", "target_aqi_48h", "target_aqi_72h")
HORIZONS = (24, 48, 72)

# Feature window lengths, in rows.
LAGS = (1, 3, 6, 12, 18, 24, 36, 48, 72)
WINDOWS = (6, 12, 18, 24, 36, 48, 60, 72)
CHANGES = (1, 3, 6, 12, 18, 24, 36, 48)
MOMENTA = (6, 12, 18, 24, 36, 48)

# Columns that would carry the index itself into the features.
LEAKAGE_COLUMNS = (
    [f"aqi_lag_{k}h" for k in (1, 2, 3, 6, 12, 24, 48, 72)]
    + [f"aqi_{n}h_{s}" for n in (24, 48, 72) for s in ("mean", "std", "min", "max", "range")]
    + ["aqi_change_1h", "aqi_change_6h", "aqi_change_24h", "aqi_acceleration"]
    + ["aqi_momentum_6h", "aqi_momentum_24h", "aqi_momentum_72h"]
    + ["numerical_aqi_24h", "numerical_aqi_48h", "numerical_aqi_72h"]
    + ["pm2_5_24h_avg", "pm10_24h_avg", "o3_8h_avg", "o3_1h_avg", "co_8h_avg"]
    + ["no2_1h_avg", "so2_1h_avg", "primary_pollutant"]
    + ["aqi_category", "aqi_level", "aqi_description"]
)
FORBIDDEN_NAME_PARTS = ("target", "aqi", "future", "ahead", "next", "forward")

# Index category and colour: upper cut, label, hex.
CATEGORIES = [
    (100, "Good", "#00E400"),
    (120, "Moderate", "#FFA500"),
    (140, "Unhealthy for Sensitive Groups", "#FF7E00"),
    (155, "Unhealthy", "#FF0000"),
]
CATEGORY_ABOVE = ("Very Unhealthy", "#8B0000")
COLOR_MISSING = "#808080"

# Right-closed PM2.5 bins.
PM25_BIN_EDGES = (0, 12, 35.4, 55.4, 150.4, 250.4, 500)
PM25_BIN_LABELS = ("Good", "Moderate", "Unhealthy SG", "Unhealthy", "Very Unhealthy", "Hazardous")

# Regional index: knots (concentration, index) of two piecewise lines.
REGIONAL_PM25 = ((0.0, 90.0), (15.0, 110.0), (25.0, 130.0), (35.0, 145.0), (45.0, 155.0))
REGIONAL_PM10 = ((0.0, 90.0), (60.0, 110.0), (100.0, 130.0), (150.0, 145.0), (200.0, 155.0))
REGIONAL_WEIGHTS = (0.7, 0.3)
REGIONAL_RANGE = (90.0, 155.0)
REGIONAL_DEFAULT = 120.0

# Source column names -> own names.
HOURLY_NAMES = {
    "time": "timestamp",
    "temp": "temperature",
    "dwpt": "dew_point",
    "rhum": "relative_humidity",
    "prcp": "precipitation",
    "wdir": "wind_direction",
    "wspd": "wind_speed",
    "pres": "pressure",
}
DAILY_NAMES = {
    "time": "timestamp",
    "tavg": "temperature",
    "prcp": "precipitation",
    "wdir": "wind_direction",
    "wspd": "wind_speed",
    "pres": "pressure",
}
TIME_COLUMN_NAMES = ("timestamp", "date", "time", "datetime")

# Exceedance limits: pollutant, authority, limit.
EXCEEDANCE_LIMITS = [
    ("pm2_5", "WHO", 10),
    ("pm10", "WHO", 20),
    ("pm2_5", "EPA", 12),
    ("pm10", "EPA", 54),
]
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
SEASON_MONTHS = {"Winter": (12, 1, 2), "Spring": (3, 4, 5), "Summer": (6, 7, 8), "Fall": (9, 10, 11)}
