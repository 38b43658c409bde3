"""Fixed values that must equal the reference application's for equal results.

Everything here is data, stated once, in the order the application lists it.
Small lookup tables become broadcast DataFrames (their size is fixed by this file).
"""

# ---------------------------------------------------------------------------
# FIXED VALUES: heat index (Rothfusz regression) coefficients c1..c9
# HI = c1 + c2*T + c3*H + c4*T*H + c5*T^2 + c6*H^2 + c7*T^2*H + c8*T*H^2 + c9*T^2*H^2
# ---------------------------------------------------------------------------
HEAT_INDEX_COEFFS = (
    -42.379, 2.04901523, 10.14333127, -0.22475541, -0.00683783,
    -0.05481717, 0.00122874, 0.00085282, -0.00000199,
)

# FIXED VALUES: wind chill  WC = 35.74 + 0.6215*T - 35.75*V^0.16 + 0.4275*T*V^0.16
WIND_CHILL_COEFFS = (35.74, 0.6215, 35.75, 0.4275, 0.16)

# FIXED VALUES: source tag written on every fact row, and the quality fallback
SOURCE_TAG = "openweathermap"
QUALITY_FALLBACK = "PASSED"

# FIXED VALUES: unit conversions
METERS_PER_MILE = 1609.34

# ---------------------------------------------------------------------------
# FIXED VALUES: Silver A null defaults (applied after range flagging)
# ---------------------------------------------------------------------------
SILVER_A_FILL = {
    "humidity_percent": -1.0,
    "wind_speed_mph": -1.0,
    "wind_direction_degrees": -1.0,
    "precipitation_mm": 0.0,
    "visibility_miles": -1.0,
    "cloud_cover_percent": -1.0,
    "weather_condition": "Unknown",
    "weather_description": "unknown",
    "state": "Unknown",
    "country": "Unknown",
    "continent": "Unknown",
    "region": "Unknown",
}

# ---------------------------------------------------------------------------
# FIXED VALUES: weather-type dimension seeded by the warehouse DDL
# (condition, category, severity, description), keys 1..21 in this order
# ---------------------------------------------------------------------------
WEATHER_TYPES_DDL = [
    ("Clear", "Fair", "Normal", "Clear skies"),
    ("Partly Cloudy", "Fair", "Normal", "Partially cloudy skies"),
    ("Cloudy", "Overcast", "Normal", "Fully overcast"),
    ("Clouds", "Overcast", "Normal", "Cloudy skies"),
    ("Rain", "Precipitation", "Moderate", "Rainfall"),
    ("Heavy Rain", "Precipitation", "Severe", "Heavy rainfall with flooding risk"),
    ("Thunderstorm", "Storm", "Severe", "Thunder and lightning with rain"),
    ("Snow", "Precipitation", "Moderate", "Snowfall"),
    ("Blizzard", "Storm", "Extreme", "Heavy snow with strong winds"),
    ("Fog", "Visibility", "Moderate", "Reduced visibility due to fog"),
    ("Mist", "Visibility", "Normal", "Light mist"),
    ("Haze", "Visibility", "Normal", "Light haze"),
    ("Smoke", "Visibility", "Moderate", "Smoke reducing visibility"),
    ("Dust", "Visibility", "Moderate", "Dust in air"),
    ("Sand", "Visibility", "Moderate", "Sand storm"),
    ("Drizzle", "Precipitation", "Normal", "Light rain"),
    ("Windy", "Wind", "Moderate", "Strong winds"),
    ("Squall", "Wind", "Severe", "Sudden strong wind"),
    ("Tornado", "Storm", "Extreme", "Tornado conditions"),
    ("Hurricane", "Storm", "Extreme", "Hurricane conditions"),
    ("Unknown", "Unknown", "Normal", "Condition not determined"),
]

# FIXED VALUES: category of a condition first seen in the data (else "Other")
CONDITION_CATEGORY = {
    "Clear": "Fair", "Clouds": "Overcast", "Rain": "Precipitation",
    "Drizzle": "Precipitation", "Snow": "Precipitation", "Mist": "Visibility",
    "Fog": "Visibility", "Haze": "Visibility", "Thunderstorm": "Storm",
    "Smoke": "Visibility", "Dust": "Visibility", "Sand": "Visibility",
    "Squall": "Wind", "Tornado": "Storm",
}

# ---------------------------------------------------------------------------
# FIXED VALUES: US serving regions by city name (else "Other")
# ---------------------------------------------------------------------------
US_REGION_BY_CITY = {
    "New York": "Northeast", "Boston": "Northeast",
    "Miami": "Southeast", "Atlanta": "Southeast", "New Orleans": "Southeast",
    "Houston": "South", "Dallas": "South", "Nashville": "South",
    "Chicago": "Midwest", "Detroit": "Midwest", "Minneapolis": "Midwest",
    "Denver": "West", "Phoenix": "West", "Las Vegas": "West",
    "Los Angeles": "West", "San Francisco": "West", "Seattle": "Northwest",
    "Portland": "Northwest", "Honolulu": "Pacific", "Anchorage": "Alaska",
}

# FIXED VALUES: dashboard map coordinates by city name (else (0, 0))
MAP_COORDS_BY_CITY = {
    "New York": (40.71, -74.01), "Los Angeles": (34.05, -118.24),
    "Chicago": (41.88, -87.63), "Houston": (29.76, -95.37),
    "Phoenix": (33.45, -112.07), "Miami": (25.76, -80.19),
    "Seattle": (47.61, -122.33), "Denver": (39.74, -104.99),
    "Atlanta": (33.75, -84.39), "Boston": (42.36, -71.06),
    "Dallas": (32.78, -96.80), "San Francisco": (37.77, -122.42),
    "Las Vegas": (36.17, -115.14), "Portland": (45.52, -122.68),
    "Minneapolis": (44.98, -93.27), "Detroit": (42.33, -83.05),
    "Nashville": (36.16, -86.78), "New Orleans": (29.95, -90.07),
    "Honolulu": (21.31, -157.86), "Anchorage": (61.22, -149.90),
}

# ---------------------------------------------------------------------------
# FIXED VALUES: question routing keyword groups, checked in this order
# (first group with a keyword contained in lower(trim(question)) wins; else "rag")
# ---------------------------------------------------------------------------
ROUTE_KEYWORDS_SHORT = [
    ("anomaly", ["anomaly", "anomalies", "unusual", "strange", "why is", "explain why",
                 "outlier", "spike"]),
    ("report", ["report", "forecast", "summary", "brief", "overview", "conditions in",
                "weather in", "status"]),
    ("rag", ["which city has", "hottest", "coldest", "warmest", "coolest", "windiest",
             "most humid"]),
    ("sql", ["average", "avg", "count", "how many", "total", "list all", "show me all",
             "per city", "each city", "compare", "top 5", "top 10", "above", "below"]),
]
ROUTE_KEYWORDS_LONG = [
    ("anomaly", ["anomaly", "anomalies", "unusual", "strange", "weird", "abnormal",
                 "why is", "explain why", "what's wrong", "outlier", "spike", "unexpected"]),
    ("report", ["report", "forecast", "summary", "brief", "overview", "conditions in",
                "weather in", "what's the weather", "tell me about", "update for", "status"]),
    ("rag", ["which city has", "what city has", "hottest", "coldest",
             "warmest", "coolest", "most humid", "windiest"]),
    ("sql", ["average", "avg", "count", "how many", "total", "sum",
             "list all", "show me all", "group by", "per city", "each city",
             "compare", "percentage", "rank", "top 5", "top 10", "top 3",
             "above", "below", "between", "greater", "less than",
             "per continent", "each continent", "per country", "by region"]),
]

# FIXED VALUES: direct-answer keyword groups. API order: hottest, coldest, extreme,
# humid, windy. Chat-app order: hottest, coldest, humid, windy, extreme, heatwave, cold.
DIRECT_KEYWORDS_API = [
    ("hottest", ["hottest", "highest temp", "warmest", "highest temperature"]),
    ("coldest", ["coldest", "lowest temp", "coolest", "lowest temperature"]),
    ("extreme", ["extreme weather", "extreme events", "how many extreme"]),
    ("humid", ["most humid", "highest humidity"]),
    ("windy", ["windiest", "most windy", "strongest wind"]),
]
DIRECT_KEYWORDS_APP = [
    ("hottest", ["hottest", "highest temp", "warmest", "highest temperature"]),
    ("coldest", ["coldest", "lowest temp", "coolest", "lowest temperature", "freezing"]),
    ("humid", ["most humid", "highest humidity"]),
    ("windy", ["windiest", "most windy", "highest wind", "strongest wind"]),
    ("extreme", ["extreme weather", "extreme events", "how many extreme"]),
    ("heatwave", ["heatwave", "heat wave"]),
    ("cold", ["extreme cold", "freezing cold"]),
]

# FIXED VALUES: demo questions shipped with the application (text-to-SQL, retrieval, chat buttons)
DEMO_QUESTIONS = [
    "What is the average temperature for each city?",
    "Which cities have extreme weather conditions?",
    "What is the hottest city in the dataset?",
    "How many weather readings do we have in total?",
    "Show me cities with humidity above 80%",
    "What is the average wind speed by region?",
    "Which city has the highest temperature?",
    "Are there any extreme weather conditions?",
    "What is the weather like in Tokyo?",
    "Which cities have high humidity?",
    "Tell me about weather conditions in London",
    "Compare weather in Dubai and Anchorage",
    "Which city has the highest temperature right now?",
    "Which city has the lowest temperature?",
    "How many extreme weather events and which cities?",
    "Generate a comprehensive weather report for all cities",
    "Detect and explain weather anomalies across all cities",
]

# ---------------------------------------------------------------------------
# FIXED VALUES: the 80-city catalogue (city, country, continent, region, lat, lon)
# ---------------------------------------------------------------------------
CITY_CATALOGUE = [
    ("New York", "US", "North America", "Northeast US", 40.71, -74.01),
    ("Los Angeles", "US", "North America", "West US", 34.05, -118.24),
    ("Chicago", "US", "North America", "Midwest US", 41.88, -87.63),
    ("Houston", "US", "North America", "South US", 29.76, -95.37),
    ("Miami", "US", "North America", "Southeast US", 25.76, -80.19),
    ("Seattle", "US", "North America", "Northwest US", 47.61, -122.33),
    ("Denver", "US", "North America", "West US", 39.74, -104.99),
    ("Phoenix", "US", "North America", "West US", 33.45, -112.07),
    ("Boston", "US", "North America", "Northeast US", 42.36, -71.06),
    ("San Francisco", "US", "North America", "West US", 37.77, -122.42),
    ("Toronto", "CA", "North America", "Canada", 43.65, -79.38),
    ("Mexico City", "MX", "North America", "Mexico", 19.43, -99.13),
    ("Vancouver", "CA", "North America", "Canada", 49.28, -123.12),
    ("Montreal", "CA", "North America", "Canada", 45.50, -73.57),
    ("Havana", "CU", "North America", "Caribbean", 23.11, -82.37),
    ("São Paulo", "BR", "South America", "South America East", -23.55, -46.63),
    ("Buenos Aires", "AR", "South America", "South America South", -34.60, -58.38),
    ("Rio de Janeiro", "BR", "South America", "South America East", -22.91, -43.17),
    ("Lima", "PE", "South America", "South America West", -12.05, -77.04),
    ("Bogota", "CO", "South America", "South America North", 4.71, -74.07),
    ("Santiago", "CL", "South America", "South America South", -33.45, -70.67),
    ("Caracas", "VE", "South America", "South America North", 10.49, -66.88),
    ("Quito", "EC", "South America", "South America West", -0.18, -78.47),
    ("London", "GB", "Europe", "Western Europe", 51.51, -0.13),
    ("Paris", "FR", "Europe", "Western Europe", 48.86, 2.35),
    ("Berlin", "DE", "Europe", "Central Europe", 52.52, 13.41),
    ("Madrid", "ES", "Europe", "Southern Europe", 40.42, -3.70),
    ("Rome", "IT", "Europe", "Southern Europe", 41.90, 12.50),
    ("Amsterdam", "NL", "Europe", "Western Europe", 52.37, 4.90),
    ("Moscow", "RU", "Europe", "Eastern Europe", 55.76, 37.62),
    ("Stockholm", "SE", "Europe", "Northern Europe", 59.33, 18.07),
    ("Vienna", "AT", "Europe", "Central Europe", 48.21, 16.37),
    ("Zurich", "CH", "Europe", "Central Europe", 47.38, 8.54),
    ("Istanbul", "TR", "Europe", "Eastern Europe", 41.01, 28.98),
    ("Athens", "GR", "Europe", "Southern Europe", 37.98, 23.73),
    ("Warsaw", "PL", "Europe", "Central Europe", 52.23, 21.01),
    ("Dublin", "IE", "Europe", "Western Europe", 53.35, -6.26),
    ("Lisbon", "PT", "Europe", "Southern Europe", 38.72, -9.14),
    ("Oslo", "NO", "Europe", "Northern Europe", 59.91, 10.75),
    ("Helsinki", "FI", "Europe", "Northern Europe", 60.17, 24.94),
    ("Prague", "CZ", "Europe", "Central Europe", 50.08, 14.44),
    ("Tokyo", "JP", "Asia", "East Asia", 35.68, 139.69),
    ("Beijing", "CN", "Asia", "East Asia", 39.90, 116.41),
    ("Shanghai", "CN", "Asia", "East Asia", 31.23, 121.47),
    ("Mumbai", "IN", "Asia", "South Asia", 19.08, 72.88),
    ("Delhi", "IN", "Asia", "South Asia", 28.61, 77.21),
    ("Bangkok", "TH", "Asia", "Southeast Asia", 13.76, 100.50),
    ("Singapore", "SG", "Asia", "Southeast Asia", 1.35, 103.82),
    ("Seoul", "KR", "Asia", "East Asia", 37.57, 126.98),
    ("Dubai", "AE", "Asia", "Middle East", 25.20, 55.27),
    ("Riyadh", "SA", "Asia", "Middle East", 24.69, 46.72),
    ("Hong Kong", "HK", "Asia", "East Asia", 22.32, 114.17),
    ("Jakarta", "ID", "Asia", "Southeast Asia", -6.21, 106.85),
    ("Taipei", "TW", "Asia", "East Asia", 25.03, 121.57),
    ("Tel Aviv", "IL", "Asia", "Middle East", 32.09, 34.78),
    ("Karachi", "PK", "Asia", "South Asia", 24.86, 67.01),
    ("Dhaka", "BD", "Asia", "South Asia", 23.81, 90.41),
    ("Kuala Lumpur", "MY", "Asia", "Southeast Asia", 3.14, 101.69),
    ("Manila", "PH", "Asia", "Southeast Asia", 14.60, 120.98),
    ("Hanoi", "VN", "Asia", "Southeast Asia", 21.03, 105.85),
    ("Doha", "QA", "Asia", "Middle East", 25.29, 51.53),
    ("Cairo", "EG", "Africa", "North Africa", 30.04, 31.24),
    ("Lagos", "NG", "Africa", "West Africa", 6.52, 3.38),
    ("Nairobi", "KE", "Africa", "East Africa", -1.29, 36.82),
    ("Cape Town", "ZA", "Africa", "Southern Africa", -33.93, 18.42),
    ("Johannesburg", "ZA", "Africa", "Southern Africa", -26.20, 28.04),
    ("Casablanca", "MA", "Africa", "North Africa", 33.57, -7.59),
    ("Accra", "GH", "Africa", "West Africa", 5.56, -0.19),
    ("Addis Ababa", "ET", "Africa", "East Africa", 9.02, 38.75),
    ("Dar es Salaam", "TZ", "Africa", "East Africa", -6.79, 39.28),
    ("Algiers", "DZ", "Africa", "North Africa", 36.75, 3.04),
    ("Sydney", "AU", "Oceania", "Australia", -33.87, 151.21),
    ("Melbourne", "AU", "Oceania", "Australia", -37.81, 144.96),
    ("Auckland", "NZ", "Oceania", "New Zealand", -36.85, 174.76),
    ("Brisbane", "AU", "Oceania", "Australia", -27.47, 153.03),
    ("Honolulu", "US", "Oceania", "Pacific", 21.31, -157.86),
    ("Anchorage", "US", "North America", "Alaska", 61.22, -149.90),
    ("Reykjavik", "IS", "Europe", "Northern Europe", 64.15, -21.94),
    ("Norilsk", "RU", "Asia", "Siberia", 69.35, 88.20),
    ("Ushuaia", "AR", "South America", "South America South", -54.80, -68.30),
]


def city_catalogue_rows():
    return list(CITY_CATALOGUE)

# ---------------------------------------------------------------------------
# FIXED VALUES: document and brief templates as (literal text, column) pieces.
# A column printed as the application prints it (see functions.text.shown).
# ---------------------------------------------------------------------------
DOC_TEMPLATE_API = [
    ("City: ", "city"), (", State: ", "state"), (". Temperature: ", "temperature_fahrenheit"),
    ("°F (", "temperature_celsius"), ("°C). Humidity: ", "humidity_percent"),
    ("%. Wind Speed: ", "wind_speed_mph"), (" mph. Pressure: ", "pressure_hpa"),
    (" hPa. Heat Index: ", "heat_index"), ("°F. Wind Chill: ", "wind_chill"),
    ("°F. Weather: ", "weather_condition"), (". Cloud Cover: ", "cloud_cover_percent"),
    ("%. Extreme: ", "_extreme_yes"), (". Anomaly Score: ", "temp_anomaly_score"), (".", None),
]

DOC_TEMPLATE_RAG = [
    ("City: ", "city"), (", ", "state"), (" (", "country"), ("). Continent: ", "continent"),
    (". Temperature: ", "temperature_fahrenheit"), ("°F. Humidity: ", "humidity_percent"), ("%. Wind: ", "wind_speed_mph"),
    (" mph. Pressure: ", "pressure_hpa"), (" hPa. Heat Index: ", "heat_index"), ("°F. Wind Chill: ", "wind_chill"),
    ("°F. Condition: ", "weather_condition"), (". Cloud Cover: ", "cloud_cover_percent"), ("%. Visibility: ", "visibility_miles"),
    (" miles. Extreme Weather: ", "_extreme_word"), (". Anomaly Score: ", "temp_anomaly_score"),
    (". Temperature Anomaly: ", "temperature_anomaly"), ("°F. Season: ", "season"), (".", None),
]

# printed with miles: this Gold layer has no kilometre column
DOC_TEMPLATE_CHAT = [
    ("City: ", "city"), (", Country: ", "country"), (", Continent: ", "continent"), (", Region: ", "region"),
    (". Temperature: ", "temperature_fahrenheit"), ("F (", "temperature_celsius"), ("C). Humidity: ", "humidity_percent"),
    ("%. Wind: ", "wind_speed_mph"), (" mph. Pressure: ", "pressure_hpa"), (" hPa. Heat Index: ", "heat_index"),
    ("F. Wind Chill: ", "wind_chill"), ("F. Weather: ", "weather_condition"), (" - ", "weather_description"),
    (". Clouds: ", "cloud_cover_percent"), ("%. Visibility: ", "visibility_miles"), (" miles. Rain: ", "precipitation_mm"),
    (" mm. Extreme: ", "_extreme_yes"), (". Heatwave: ", "_heatwave"), (". Extreme Cold: ", "_cold"), (". High Wind: ", "_wind"),
    (". Anomaly Score: ", "temp_anomaly_score"), (". Temp Anomaly: ", "temperature_anomaly"), ("F.", None),
]

ANOMALY_BRIEF_TEMPLATE = [
    ("- City: ", "city"), (", ", "state"), ("\n- Country: ", "country"), ("\n- Continent: ", "continent"),
    ("\n- Current Temperature: ", "temperature_fahrenheit"),
    ("°F\n- City Average Temperature: ", "city_avg_temp"),
    ("°F\n- Temperature Anomaly: ", "temperature_anomaly"),
    ("°F from average\n- Anomaly Score: ", "temp_anomaly_score"),
    (" standard deviations\n- Humidity: ", "humidity_percent"), ("%\n- Pressure: ", "pressure_hpa"),
    (" hPa\n- Wind Speed: ", "wind_speed_mph"), (" mph\n- Heat Index: ", "heat_index"),
    ("°F\n- Season: ", "season"), ("\n- Extreme Weather Flags: Heatwave=", "is_heatwave"),
    (", \n  Extreme Cold=", "is_extreme_cold"), (", \n  High Wind=", "is_high_wind"), ("", None),
]

CITY_BRIEF_TEMPLATE = [
    ("- City: ", "city"), (", ", "state"), ("\n- Country: ", "country"), ("\n- Continent: ", "continent"),
    ("\n- Temperature: ", "temperature_fahrenheit"), ("°F (", "temperature_celsius"),
    ("°C)\n- Humidity: ", "humidity_percent"), ("%\n- Wind Speed: ", "wind_speed_mph"),
    (" mph\n- Pressure: ", "pressure_hpa"), (" hPa\n- Heat Index: ", "heat_index"),
    ("°F\n- Wind Chill: ", "wind_chill"), ("°F\n- Weather Condition: ", "weather_condition"),
    ("\n- Extreme Weather Flag: ", "_extreme_upper"), ("\n- Temperature Anomaly Score: ", "temp_anomaly_score"),
    ("\n- Temperature Anomaly: ", "temperature_anomaly"), ("°F\n- Season: ", "season"), ("", None),
]

# batch report line: "- {city}, {country}: {T}°F, Humidity {H}%, {⚠️ EXTREME | Normal}"
BATCH_LINE_TEMPLATE = [
    ("- ", "city"), (", ", "country"), (": ", "temperature_fahrenheit"), ("°F, Humidity ", "humidity_percent"),
    ("%, ", "_extreme_tag"), ("", None),
]
EXTREME_TAG = "⚠️ EXTREME"
BATCH_REPORT_LIMIT = 30

# ---------------------------------------------------------------------------
# FIXED VALUES: direct answers of the chat application ({place} = "city, country",
# {t}/{h}/{w} = value rounded to 1 dp, {n} = count, {lines}/{list} as described)
# ---------------------------------------------------------------------------
ANSWER_HOTTEST = "🔥 **{place}** has the highest temperature at **{t}°F**.\n\n**Top 5 Hottest:**\n{lines}"
ANSWER_COLDEST = "🥶 **{place}** has the lowest temperature at **{t}°F**.\n\n**Top 5 Coldest:**\n{lines}"
ANSWER_TOP_LINE = "  {rank}. **{place}** — {t}°F"            # lines joined by "\n"
ANSWER_HUMID = "💧 **{place}** — highest humidity at **{h}%** ({t}°F)."
ANSWER_WINDY = "💨 **{place}** — highest wind at **{w} mph** ({t}°F)."
ANSWER_LIST_ITEM = "**{place}** ({t}°F)"                      # items joined by ", "
ANSWER_EXTREME = "⚠️ **{n} extreme event(s):**\n\n{list}"
ANSWER_EXTREME_NONE = "✅ No extreme weather events detected."
ANSWER_HEATWAVE = "🔥 **{n} heatwave(s)** (>100°F):\n\n{list}"
ANSWER_HEATWAVE_NONE = "✅ No heatwave conditions detected."
ANSWER_COLD = "🥶 **{n} extreme cold** (<10°F):\n\n{list}"
ANSWER_COLD_NONE = "✅ No extreme cold detected."

# ---------------------------------------------------------------------------
# FIXED VALUES: direct answers of the API ({place} = "city, state")
# ---------------------------------------------------------------------------
API_HOTTEST = "🔥 {place} has the highest temperature at {t}°F.\n\nTop 5:\n{lines}"
API_COLDEST = "🥶 {place} has the lowest temperature at {t}°F.\n\nTop 5 Coldest:\n{lines}"
API_TOP_LINE = "{rank}. {place} — {t}°F"
API_HUMID = "💧 {place} has the highest humidity at {h}%."
API_WINDY = "💨 {place} has the highest wind speed at {w} mph."
API_EXTREME = "⚠️ {n} extreme weather event(s): {list}"
API_EXTREME_NONE = "✅ No extreme weather events detected across all monitored cities."

# ---------------------------------------------------------------------------
# FIXED VALUES: model inputs of the classifier and of the sequence model
# ---------------------------------------------------------------------------
FEATURES_24 = [
    "temperature_fahrenheit", "temperature_celsius", "humidity_percent", "pressure_hpa", "wind_speed_mph",
    "wind_direction_degrees", "precipitation_mm", "visibility_miles", "cloud_cover_percent", "heat_index",
    "wind_chill", "temperature_anomaly", "temp_anomaly_score", "city_avg_temp", "city_min_temp",
    "city_max_temp", "city_stddev_temp", "city_avg_humidity", "hour_of_day", "day_of_week", "month_of_year",
    "is_daytime", "latitude", "longitude",
]
SEQ_FEATURES = ["temperature_fahrenheit", "humidity_percent", "pressure_hpa", "wind_speed_mph", "heat_index",
                "wind_chill"]

# ---------------------------------------------------------------------------
# FIXED VALUES: the nine warehouse checks (name, least, most)
# ---------------------------------------------------------------------------
DQ_CHECKS = [
    ("Total fact records", 1, None),
    ("Unique cities", 1, None),
    ("Unique countries", 1, None),
    ("Extreme weather count", 0, None),
    ("Null temperatures", None, 0),
    ("Temperature range check", None, 0),
    ("Null time_key (should be low)", None, 50),
    ("Null location_key", None, 0),
    ("Records with source tag", 1, None),
]
