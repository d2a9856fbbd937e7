"""Fixed values of the domain: names, word lists, limits and colours.

Everything here is data, not logic.  The column names are part of the public
table schemas, so they keep the language of the source data.
"""

# ---------------------------------------------------------------------------
# Weather tables
# ---------------------------------------------------------------------------
WEATHER_CODES = {
    "PRECTOTCORR": "precip",
    "T2M": "temp",
    "T2M_MAX": "temp_max",
    "T2M_MIN": "temp_min",
    "RH2M": "humedad",
    "WS2M": "viento",
    "WS2M_MAX": "viento_max",
    "ALLSKY_SFC_SW_DWN": "radiacion",
    "PS": "presion",
    "QV2M": "humedad_especifica",
    "T2MDEW": "punto_rocio",
}
WEATHER_MEASURES = list(WEATHER_CODES.values())
WEATHER_REQUIRED = [
    "fecha", "lat", "lon", "precip", "temp", "humedad", "viento", "radiacion", "presion",
]
PAYLOAD_ANCHOR = "PRECTOTCORR"
SENTINEL_LIMIT = -99.0

# ---------------------------------------------------------------------------
# Call tables
# ---------------------------------------------------------------------------
CALL_REQUIRED = [
    "alcaldia_cierre", "fecha_creacion", "latitud", "longitud", "folio", "incidente_c4",
    "codigo_cierre",
]
CALL_RENAMES = {
    "folio": "id_incidente",
    "alcaldia_cierre": "alcaldia",
    "incidente_c4": "tipo_incidente",
}
INCIDENT_TYPES = [
    "inundacion", "encharcamiento", "aguas negras", "fuga de agua", "desborde canal rio presa",
]
CONFIRMED_CODES = ["a", "afirmativo"]
INCIDENT_RENAMES = {
    "desborde_canal_rio_presa": "desborde_canal",
    "fuga_de_agua": "fuga_agua",
}
INCIDENT_COLUMNS = [
    "aguas_negras", "desborde_canal", "encharcamiento", "fuga_agua", "inundacion",
]
INCIDENT_TOTALS = ["total_incidentes", "hubo_inundacion", "hubo_incidente_hidrico"]
CALL_BOX = {"lat": (19.0, 19.6), "lon": (-99.4, -98.9)}
DAY_FORMATS = [
    "yyyy-MM-dd HH:mm:ss[.SSSSSSSSS]",
    "yyyy-MM-dd'T'HH:mm:ss[.SSSSSSSSS]",
    "yyyy-MM-dd HH:mm",
    "yyyy-MM-dd",
    "yyyy-MM-dd'T'HH:mm:ss[.SSSSSSSSS]XXX",
    "yyyy-MM-dd HH:mm:ss[.SSSSSSSSS]XXX",
    "yyyy/MM/dd HH:mm:ss",
    "yyyy/MM/dd HH:mm",
    "M/d/yyyy h:mm:ss a",
    "yyyy/MM/dd",
    "M/d/yyyy H:mm:ss",
    "M/d/yyyy H:mm",
    "M/d/yyyy",
]

# Words that stand for a missing field in delimited text.
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# ---------------------------------------------------------------------------
# Sampling grid
# ---------------------------------------------------------------------------
GRID = {"minx": -99.36, "maxx": -98.94, "miny": 19.03, "maxy": 19.59, "step": 0.009}

# ---------------------------------------------------------------------------
# Features and label
# ---------------------------------------------------------------------------
HEAVY_RAIN = 5
RAIN = 1
SEASON_MONTHS = [6, 7, 8, 9, 10]
RAIN_WINDOWS = [3, 7, 14, 30]
INCIDENT_WINDOWS = [3, 7]
LAGGED_INCIDENTS = [
    "inundacion", "encharcamiento", "aguas_negras", "fuga_agua", "desborde_canal",
    "total_incidentes",
]
DIFFERENCES = {
    "rango_temp": ("temp_max", "temp_min"),
    "depresion_punto_rocio": ("temp", "punto_rocio"),
}
PRODUCTS = {
    "precip_x_humedad_especifica": ("precip", "humedad_especifica"),
    "precip_x_punto_rocio": ("precip", "punto_rocio"),
    "precip_x_viento_max": ("precip", "viento_max"),
    "precip_x_humedad": ("precip", "humedad"),
    "precip7_x_humedad": ("precip_7d", "humedad"),
    "precip7_x_humedad_especifica": ("precip_7d", "humedad_especifica"),
    "precip7_x_punto_rocio": ("precip_7d", "punto_rocio"),
}
# column -> (weight, divisor)
WEIGHTED_RAIN = {"precip_1d": (0.50, 1), "precip_3d": (0.30, 3), "precip_7d": (0.20, 7)}
LOG_COLUMNS = [
    "precip", "precip_1d", "precip_3d", "precip_7d", "precip_14d", "precip_30d",
    "lluvia_acumulada_ponderada",
]
LABEL = "lluvia_intensa"

# ---------------------------------------------------------------------------
# Model and risk classes
# ---------------------------------------------------------------------------
CATEGORICAL_FEATURES = ["alcaldia"]
NUMERIC_FEATURES = [
    "temp", "temp_max", "temp_min", "humedad", "viento", "viento_max", "radiacion", "presion",
    "humedad_especifica", "punto_rocio",
    "rango_temp", "depresion_punto_rocio",
    "mes", "trimestre", "dia_semana", "temporada_lluvias",
    "precip_1d", "precip_3d", "precip_7d", "precip_14d", "precip_30d",
    "llovio_ayer", "lluvia_intensa_ayer", "lluvia_acumulada_ponderada",
    "inundacion_1d", "inundacion_3d", "inundacion_7d",
    "encharcamiento_1d", "encharcamiento_3d", "encharcamiento_7d",
    "aguas_negras_1d", "aguas_negras_3d", "aguas_negras_7d",
    "fuga_agua_1d", "fuga_agua_3d", "fuga_agua_7d",
    "desborde_canal_1d", "desborde_canal_3d", "desborde_canal_7d",
    "total_incidentes_1d", "total_incidentes_3d", "total_incidentes_7d",
]
TRAIN_FRACTION = 0.80
MAX_ITERATIONS = 3000
THRESHOLD_START, THRESHOLD_STEP, THRESHOLD_COUNT = 0.01, 0.01, 99
RISK_EDGES = [0.0, 0.33, 0.66, 1.0]
RISK_LABELS = ["BAJO", "MEDIO", "ALTO"]

# Map colours
PALETTE = {"BAJO": "#10b981", "MEDIO": "#f59e0b", "ALTO": "#ef4444", "MUY ALTO": "#7f1d1d"}
UNKNOWN_RISK_COLOR = "#94a3b8"
NO_DATA_COLOR = "#cbd5e1"
DATA_OPACITY, NO_DATA_OPACITY = 0.75, 0.30
BORDER_COLOR, BORDER_WIDTH = "#ffffff", 2.0
