"""The names, lists and limits that inputs and results must agree on.

Operators take these as parameters; the values below are only the defaults.
"""

# Fixed values -- header text found in the input files, in the order it is replaced.
AREA_HEADERS = [
    ("Bairro", "bairro"),
    ("População", "populacao"),
    ("Estação", "estacao"),
]
WEATHER_HEADERS = [
    ("ção", "cao"),
    (" da ", "_"),
    ("Temp. Comp. Média", "temp_comp_media"),
    ("Temp. Máxima", "temp_maxima"),
    ("Código", "codigo"),
    ("Temp. Mínima", "temp_minima"),
]
CASE_HEADERS = [
    ("ano_notificacao", "notificacao_ano"),
]

# Fixed values -- station name in the data -> station column of the model base.
STATIONS = {
    "ARCOVERDE": "estacao_arcoverde",
    "CABROBO": "estacao_cabrobo",
    "GARANHUNS": "estacao_garanhuns",
    "OURICURI": "estacao_ouricuri",
    "PETROLINA": "estacao_petrolina",
    "RECIFE": "estacao_recife",
    "SEM_INFORMACAO": "estacao_seminfo",
    "SURUBIM": "estacao_surubim",
}

# Fixed values -- sentinel for a missing name, spelling aliases, kinds of base rows.
UNKNOWN = "SEM_INFORMACAO"
ALIASES = {"CABROBÓ": "CABROBO"}
OBSERVED = "original"
PREDICTED = "previsto"

# Fixed values -- date formats and the two formatted keys.
DAY_FIRST_DASH = "dd-MM-yyyy"
DAY_FIRST_SLASH = "dd/MM/yyyy"
YEAR_FIRST = "yyyy-MM-dd"
DATE_KEY = "yyyy/MM/dd HH:mm:ss"
LABEL_SEPARATOR = " - "

# Fixed values -- the case files: date format and the tag written to each row.
CASE_SOURCES = {
    "dengue": {"date_format": DAY_FIRST_DASH, "zika": 0},
    "chikungunya": {"date_format": YEAR_FIRST, "zika": 0},
    "zika": {"date_format": YEAR_FIRST, "zika": 1},
}

# Fixed values -- limits a score request has to keep.
REQUEST_BOUNDS = {
    "populacao": (1, 1_000_000),
    "precipitacao": (0.01, 100),
    "temp_maxima": (1, 50),
    "temp_minima": (1, 50),
    "temp_comp_media": (1, 50),
}

# Fixed values -- letters with accents and what they fold to.
ACCENTED = "ÁÀÂÃÄÉÈÊËÍÌÎÏÓÒÔÕÖÚÙÛÜÇÑáàâãäéèêëíìîïóòôõöúùûüçñ"
UNACCENTED = "AAAAAEEEEIIIIOOOOOUUUUCNaaaaaeeeeiiiiooooouuuucn"
