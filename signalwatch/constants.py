"""Values the results depend on.

Every value in this module is a FIXED VALUE: labels, defaults, weights and word
lists that must stay exactly as they are for results to come out the same.
"""

from __future__ import annotations

# --- fixed values: labels -----------------------------------------------------
UNKNOWN_CATEGORY = "desconhecido"
DELIVERED = "delivered"
DEFAULT_PROFILE = "padrao"

# (growth > 0 and acceleration > 0, growth > 0, acceleration > 0, otherwise)
PHASES = ("Aceleracao", "Crescimento Estavel", "Recuperacao", "Declinio")
PHASES_ENGLISH = ("acceleration", "steady_growth", "recovery", "decline")

# --- fixed values: what a missing signal counts as ------------------------------
SIGNAL_DEFAULTS = {
    "search_volume": 50.0,
    "search_lead_1": 50.0,
    "search_lead_2": 50.0,
    "sentiment_score": 50.0,
    "review_momentum": 0.0,
    "average_score": 3.5,
}

# --- fixed values: weights ------------------------------------------------------
EMERGENCE_WEIGHTS = {
    "search_momentum": 0.35,
    "acceleration": 0.25,
    "review_momentum": 0.25,
    "growth_rate": 0.15,
}
EMERGENCE_WEIGHTS_STANDALONE = {
    "search_momentum": 0.40,
    "acceleration": 0.35,
    "growth_rate": 0.25,
}
ALERT_WEIGHTS = {"search_momentum_avg": 0.40, "emergence_score_avg": 0.35, "acceleration_avg": 0.25}
ALERT_WEIGHTS_STANDALONE = {
    "search_momentum_avg": 0.45,
    "emergence_score_avg": 0.35,
    "acceleration_avg": 0.20,
}

# --- fixed values: thresholds -----------------------------------------------------
CRITICAL_ALERT = 80.0
ALERT_REFERENCE_LINE = 50.0
TARGET_R2 = 0.80
HEALTHY_GAP = 0.08
TRAIN_SHARE = 0.8
FOLDS = 5

# --- fixed values: model inputs, in order -----------------------------------------
FEATURES = (
    "search_volume", "search_lead_1", "search_lead_2", "search_momentum",
    "sentiment_score", "review_momentum", "growth_rate", "acceleration",
    "emergence_score", "lag_1", "moving_avg_3", "month", "quarter",
    "season_sin", "season_cos", "category_code",
)
FEATURES_STANDALONE = tuple(
    name for name in FEATURES if name not in ("sentiment_score", "review_momentum")
)
LABEL = "sales_volume"

# --- fixed values: search profiles; a category in two lists takes the first -----------
SEARCH_PROFILES = {
    "verao": [
        "esporte_lazer", "fashion_bolsas_e_acessorios", "cool_stuff",
        "bebidas", "alimentos", "moda_praia",
    ],
    "natal": [
        "brinquedos", "eletronicos", "pcs", "informatica_acessorios",
        "consoles_games", "telefonia", "relogios_presentes",
        "musica", "livros_interesse_geral",
    ],
    "ano_novo": [
        "esporte_e_lazer", "fitness_academia", "saude_beleza",
        "suplementos", "dieta_saude",
    ],
    "estavel": [
        "moveis_escritorio", "papelaria", "informatica_acessorios",
        "telefonia_fixa", "industria_comercio_e_negocios",
    ],
    "emergente": [
        "la_cuisine", "alimentos_bebidas", "cine_foto",
        "construcao_ferramentas_jardim", "casa_conforto_2",
        "sinalizacao_e_seguranca",
    ],
}

# --- fixed values: review profiles -----------------------------------------------------
REVIEW_PROFILES = {
    "emergente_positivo": [
        "la_cuisine", "alimentos_bebidas", "cine_foto",
        "construcao_ferramentas_jardim", "casa_conforto_2",
        "sinalizacao_e_seguranca",
    ],
    "estavel_alto": [
        "moveis_escritorio", "informatica_acessorios", "pcs", "telefonia",
        "papelaria",
    ],
    "moda_ciclo": [
        "fashion_bolsas_e_acessorios", "cool_stuff", "fashion_roupa",
        "fashion_calcados",
    ],
    "sazonal": ["brinquedos", "bebidas", "esporte_lazer", "natal_decoracoes"],
    "declinio": ["seguros_e_servicos", "fraldas_higiene", "portateis_cozinha_e_banho"],
}

# --- fixed values: profiles whose search signal runs ahead of sales, and by how much ----
EARLY_PROFILES = ("emergente", "natal", "verao")
EARLY_ROWS = 3

# --- fixed values: categories shown when signals are eyeballed ---------------------------
SAMPLE_CATEGORIES = (
    "la_cuisine", "moveis_escritorio", "brinquedos", "bebidas",
    "sinalizacao_e_seguranca", "pcs",
)
REVIEW_SAMPLE_CATEGORIES = (
    "la_cuisine", "moveis_escritorio", "brinquedos", "bebidas",
    "sinalizacao_e_seguranca", "pcs", "fashion_bolsas_e_acessorios",
)
SPOTLIGHT_CATEGORY = "la_cuisine"
