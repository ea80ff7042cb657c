"""Table schemas, model configurations and the station dimension."""

from __future__ import annotations

TARGETS = ["temperatura", "umidade", "velocidade_vento"]
TEMPORAL_FEATURES = ["ano", "mes", "dia", "hora", "dia_ano", "dia_semana",
                     "hora_sin", "hora_cos", "mes_sin", "mes_cos"]
READING_KEY = ["estacao", "data", "hora"]

# --- fixed values (must equal the reference) --------------------------------
# Imputer configurations: name, trees, depth, rounds; leaf 5, split 10.
MODEL_CONFIGS = [
    {"nome": "Modelo_Leve", "n_estimators": 5, "max_depth": 2, "max_iter": 2},
    {"nome": "Modelo_Medio", "n_estimators": 10, "max_depth": 3, "max_iter": 3},
    {"nome": "Modelo_Robusto", "n_estimators": 15, "max_depth": 4, "max_iter": 4},
]
MIN_SAMPLES_LEAF = 5
MIN_SAMPLES_SPLIT = 10
EVALUATION_RATIO = 0.10
RANDOM_STATE = 42

# Station dimension: name, code, type, description.
STATIONS = [
    ("PETROLINA", "A307", "Estação Meteorológica", "Estação meteorológica do INMET em Petrolina - PE"),
    ("ARCO_VERDE", "A309", "Estação Meteorológica", "Estação meteorológica do INMET em Arco Verde - PE"),
    ("CABROBO", "A329", "Estação Meteorológica", "Estação meteorológica do INMET em Cabrobó - PE"),
    ("CARUARU", "A341", "Estação Meteorológica", "Estação meteorológica do INMET em Caruaru - PE"),
    ("FLORESTA", "A351", "Estação Meteorológica", "Estação meteorológica do INMET em Floresta - PE"),
    ("GARANHUNS", "A322", "Estação Meteorológica", "Estação meteorológica do INMET em Garanhuns - PE"),
    ("IBIMIRIM", "A349", "Estação Meteorológica", "Estação meteorológica do INMET em Ibimirim - PE"),
    ("OURICURI", "A366", "Estação Meteorológica", "Estação meteorológica do INMET em Ouricuri - PE"),
    ("PALMARES", "A357", "Estação Meteorológica", "Estação meteorológica do INMET em Palmares - PE"),
    ("SALGUEIRO", "A370", "Estação Meteorológica", "Estação meteorológica do INMET em Salgueiro - PE"),
    ("SERRA_TALHADA", "A350", "Estação Meteorológica", "Estação meteorológica do INMET em Serra Talhada - PE"),
    ("SURUBIM", "A328", "Estação Meteorológica", "Estação meteorológica do INMET em Surubim - PE"),
]

# Model type lookup: suffix -> (description, complexity).
MODEL_TYPES = {
    "Leve": ("Modelo leve de previsão de sensação térmica", "baixa"),
    "Medio": ("Modelo médio de previsão de sensação térmica", "media"),
    "Robusto": ("Modelo robusto de previsão de sensação térmica", "alta"),
}

# Wind categories (simplified Beaufort): upper bounds in m/s, then the
# open-ended class, then the default for a missing speed.
WIND_BOUNDS = [(0.5, "Calmo"), (3.3, "Brisa Leve"), (5.5, "Brisa Moderada")]
WIND_STRONG = "Vento Forte"
WIND_UNKNOWN = "Desconhecido"
WIND_CATEGORIES = ["Calmo", "Brisa Leve", "Brisa Moderada", "Vento Forte", "Desconhecido"]

# Risk thresholds: humidity below, temperature above, wind above.
RISK_DRY_HUMIDITY = 20.0
RISK_HOT_TEMPERATURE = 35.0
RISK_STRONG_WIND = 5.5

# Raw file conventions.
RAW_MISSING = "-9999"
RAW_HEADER_LINES = 8
RAW_MIN_FIELDS = 19
RAW_COLUMNS = {"data": 0, "hora": 1, "temperatura": 7, "umidade": 15, "velocidade_vento": 18}
RAW_HEADER_MARKER = "DATA;HORA UTC"
RAW_STATION_LABEL = "ESTACAO:"
RESULT_PREFIX = "dados_para_update_neon_"
# Header keys of the metadata lines -> friendly names (checked in this order).
HEADER_KEYS = [
    ("REGIAO", "regiao"),
    ("UF", "estado"),
    ("ESTACAO", "estacao"),
    ("CODIGO", "codigo_estacao"),
    ("LATITUDE", "latitude"),
    ("LONGITUDE", "longitude"),
    ("ALTITUDE", "altitude"),
    ("DATA DE FUNDACAO", "data_fundacao"),
]
# Telemetry batch sizes used by the publishers.
BATCH_RESULTS = 500
