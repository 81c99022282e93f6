"""Category names, codes and column lists that results depend on."""

# Month name -> season.
SEASONS = {
    "January": "Winter",
    "February": "Winter",
    "March": "Spring",
    "April": "Spring",
    "May": "Spring",
    "June": "Summer",
    "July": "Summer",
    "August": "Summer",
    "September": "Autumn",
    "October": "Autumn",
    "November": "Autumn",
    "December": "Winter",
}

# Tariff band -> rank.
TARIFF_RANK = {"Low": 0, "Normal": 1, "High": 2}

# Demographic group -> lifestyle, housing type, tenure, household income in thousands.
ACORN_PROFILE = {
    "ACORN-A": ("Luxury Lifestyles", "Detached house", "Homeowner", "100"),
    "ACORN-B": ("Luxury Lifestyles", "Flat / apartment", "Homeowner", "75"),
    "ACORN-C": ("Luxury Lifestyles", "Detached house", "Homeowner", "75"),
    "ACORN-D": ("Established Affluence", "Detached house", "Homeowner", "69"),
    "ACORN-E": ("Established Affluence", "Semi, terrace or flat", "Homeowner", "70"),
    "ACORN-F": ("Thriving Neighbourhoods", "Detached house", "Homeowner", "57"),
    "ACORN-G": ("Thriving Neighbourhoods", "Semi-detached house", "Homeowner", "57"),
    "ACORN-H": ("Thriving Neighbourhoods", "Semi-detached or terraced house", "Privately renting", "59"),
    "ACORN-I": ("Thriving Neighbourhoods", "Flat", "Privately renting", "58"),
    "ACORN-J": ("Thriving Neighbourhoods", "Terraced house", "Homeowner", "58"),
    "ACORN-K": ("Steadfast Communities", "Detached house", "Homeowner", "47"),
    "ACORN-L": ("Steadfast Communities", "Semi-detached house", "Homeowner", "47"),
    "ACORN-M": ("Steadfast Communities", "Terraced house", "Social renting", "47"),
    "ACORN-N": ("Steadfast Communities", "Terraced house", "Privately renting", "44"),
    "ACORN-O": ("Steadfast Communities", "House", "Homeowner", "41"),
    "ACORN-P": ("Stretched Society", "Flat", "Privately renting", "43"),
    "ACORN-Q": ("Stretched Society", "Semi-detached house", "Social renting", "36"),
    "ACORN-R": ("Stretched Society", "Terraced house", "Social renting", "37"),
    "ACORN-S": ("Low Income Living", "Terraced house", "Social renting", "29"),
    "ACORN-T": ("Low Income Living", "Flat or bungalow", "Social renting", "24"),
    "ACORN-U": ("Low Income Living", "Flat", "Social renting", "22"),
}

# Household income in thousands -> band. The figures 59 and 43 have no band.
INCOME_BANDS = {
    "100": "High Income",
    "75": "High Income",
    "70": "Middle Income",
    "69": "Middle Income",
    "58": "Middle Income",
    "57": "Middle Income",
    "47": "Lower Middle Income",
    "44": "Lower Middle Income",
    "41": "Lower Middle Income",
    "37": "Low Income",
    "36": "Low Income",
    "29": "Low Income",
    "24": "Low Income",
    "22": "Low Income",
}

LIFESTYLES = {code: row[0] for code, row in ACORN_PROFILE.items()}
HOUSING_TYPES = {code: row[1] for code, row in ACORN_PROFILE.items()}
TENURES = {code: row[2] for code, row in ACORN_PROFILE.items()}
INCOMES = {code: row[3] for code, row in ACORN_PROFILE.items()}

WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]

# Features of the consumption model, present in the history and in the forecast.
FORECAST_FEATURES = [
    "is_weekend",
    "temp_daylight_interaction",
    "is_holiday",
    "temperatureMax",
    "apparentTemperatureMax",
    "pressure",
    "apparentTemperatureMin",
    "apparentTemperatureHigh",
    "temperatureHigh",
    "daylight_duration",
]

# Text columns that feature screening turns into codes.
SCREENING_CATEGORIES = ["precipType", "Type", "day_of_week", "month", "season"]

# Household features of the boosted-tree model.
SERIES_FEATURES = [
    "day_of_week",
    "is_weekend",
    "month",
    "hour",
    "lag_1_day",
    "lag_2_day",
    "lag_7_day",
    "rolling_energy_3d",
    "rolling_energy_7d",
    "rolling_energy_14d",
    "rolling_energy_30d",
    "rolling_energy_mean_14d",
    "rolling_energy_std_14d",
    "energy_trend_3d",
    "energy_trend_7d",
    "daily_energy_change",
    "temperature_variability",
    "humidity_temp_interaction",
    "cloud_temp_interaction",
]

# Weather column sets compared against each other.
FEATURE_SETS = {
    "features1": [
        "temperatureMax", "temperatureMin", "temperatureHigh", "temperatureLow",
        "apparentTemperatureHigh", "apparentTemperatureLow", "apparentTemperatureMin",
        "apparentTemperatureMax", "pressure", "humidity", "cloudCover", "windSpeed", "windBearing",
        "precipType",
    ],
    "features2": [
        "temperatureMax", "temperatureMin", "temperatureHigh", "temperatureLow",
        "apparentTemperatureHigh", "apparentTemperatureLow", "apparentTemperatureMin",
        "apparentTemperatureMax", "humidity", "cloudCover",
    ],
    "features3": [
        "temperatureMax", "temperatureMin", "temperatureHigh", "temperatureLow", "humidity",
        "cloudCover", "precipType",
    ],
    "features4": [
        "apparentTemperatureHigh", "apparentTemperatureLow", "apparentTemperatureMin",
        "apparentTemperatureMax", "humidity", "cloudCover", "precipType",
    ],
    "features5": [
        "pressure", "humidity", "cloudCover", "windSpeed", "windBearing", "precipType",
    ],
}
