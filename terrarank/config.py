"""Declarative configuration: indicator sets, class groups, labels.

Values under the "fixed values" comments are part of the method being
reproduced and must not be changed for parity.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Indicator:
    name: str
    direction: int  # +1 higher is better, -1 higher is worse
    label: str = ""


# --- fixed values: the eight index indicators and their directions ---------
DEFAULT_INDICATORS: tuple[Indicator, ...] = (
    Indicator("gdp_per_capita", 1, "GDP per capita"),
    Indicator("pop_density", -1, "Population density"),
    Indicator("pct_native", 1, "Native cover (%)"),
    Indicator("pct_forest", 1, "Forest cover (%)"),
    Indicator("pct_agro", -1, "Agricultural area (%)"),
    Indicator("pct_urban", -1, "Urban area (%)"),
    Indicator("native_change_pp", 1, "Native cover change (p.p.)"),
    Indicator("pressure_index", -1, "Environmental pressure index"),
)

# --- fixed values: sub-index membership ------------------------------------
ENVIRONMENT_SUBINDEX = ("pct_native", "pct_forest", "native_change_pp")
ECONOMY_SUBINDEX = ("gdp_per_capita",)

# --- fixed values: model feature list (order matters for outputs) ----------
FEATURE_COLS: tuple[str, ...] = (
    "gdp_per_capita", "pop_density", "pct_native", "pct_forest",
    "pct_agro", "pct_urban", "native_change_pp", "pressure_index",
    "area_km2", "population", "herd_per_km2",
)

# --- fixed values: land-cover class groups (source classification codes) --
NATIVE_VEGETATION_CODES = [1, 3, 4, 5, 6, 10, 11, 12, 13, 29, 32, 49, 50]
FOREST_CODES = [1, 3, 4, 5, 6]
AGRO_CODES = [14, 15, 18, 19, 20, 35, 36, 39, 40, 41, 46, 47, 48]
URBAN_CODES = [24]

LAND_COVER_GROUPS: dict[str, list] = {
    "native": NATIVE_VEGETATION_CODES,
    "forest": FOREST_CODES,
    "agro": AGRO_CODES,
    "urban": URBAN_CODES,
}

# --- fixed values: land-cover class labels (source classification) --------
LAND_COVER_LABELS: dict[int, str] = {
    1: "Floresta",
    3: "Formação Florestal",
    4: "Formação Savânica",
    5: "Mangue",
    6: "Floresta Alagável",
    9: "Silvicultura",
    10: "Formação Natural Não Florestal",
    11: "Campo Alagado e Área Pantanosa",
    12: "Formação Campestre",
    13: "Outra Formação não Florestal",
    14: "Agropecuária",
    15: "Pastagem",
    18: "Agricultura",
    19: "Lavoura Temporária",
    20: "Cana",
    21: "Mosaico de Usos",
    22: "Área não Vegetada",
    23: "Praia, Duna e Areal",
    24: "Área Urbanizada",
    25: "Outra Área não Vegetada",
    26: "Corpo D'água",
    27: "Não Observado",
    29: "Afloramento Rochoso",
    30: "Mineração",
    31: "Aquicultura",
    32: "Apicum",
    33: "Rio, Lago e Oceano",
    35: "Palma",
    36: "Lavoura Perene",
    39: "Soja",
    40: "Arroz",
    41: "Outras Lavouras Temporárias",
    46: "Café",
    47: "Citrus",
    48: "Outras Lavouras Perenes",
    49: "Restinga Arbórea",
    50: "Restinga Herbácea",
}

# --- fixed values: crop survey variable codes → wide column names ----------
CROP_VARIABLES: dict[int, str] = {
    214: "crop_production_t",
    215: "crop_value_k",
    216: "planted_area_ha",
}

# --- fixed values: flat statistics extract column aliases ------------------
FLAT_EXTRACT_ALIASES: dict[str, tuple[str, ...]] = {
    "key": ("D1C",),
    "name": ("D1N",),
    "year": ("D2C",),
    "value": ("V", "valor"),
}

# Default profile names, by ascending mean score (a parameter of the job).
PROFILE_LABELS: tuple[str, ...] = tuple(f"profile {letter}" for letter in "ABCDEF")

# Row-count threshold under which a landed source is labelled a stub.
STUB_ROW_THRESHOLD = 100
# Parity value for the year gate of the yearly fact; the gate is off unless the caller asks for it.
YEAR_GATE_MIN_ROWS = 100

# --- declared schemas of the landed sources --------------------------------
_FLAT = "D1C string, D1N string, D2C string, D3C string, V string"
SOURCE_SCHEMAS: dict[str, str] = {
    "gdp": _FLAT,
    "population": _FLAT,
    "crops": _FLAT,
    "herd": _FLAT,
    "area": "entity_key string, name string, state string, area_km2 double",
    "landuse": "entity_key string, class_code int, year int, area double",
    "deforestation": "entity_key string, year int, biome string, deforested_km2 double",
    "fires": "entity_key string, year int, fire_spots bigint",
    "finance": "entity_key string, year int, revenue_total double, environment_spending double",
    "spending": "entity_key string, year int, environment_spending double",
    "education": "entity_key string, year int, school_index double",
    "registry": "entity_key string, properties bigint, registered_area_ha double, legal_reserve_ha double, "
                "protected_area_ha double, native_vegetation_ha double",
}

# --- fixed values: column names that the landed files of each source use ----
SOURCE_ALIASES: dict[str, dict[str, tuple[str, ...]]] = {
    "area": {"entity_key": ("geocodigo",), "name": ("municipio",), "state": ("uf_sigla",)},
    "landuse": {"entity_key": ("geocodigo",), "class_code": ("classe_codigo",), "year": ("ano",), "area": ("area_ha",)},
    "deforestation": {"entity_key": ("geocodigo",), "year": ("ano",), "biome": ("bioma",),
                      "deforested_km2": ("desmatamento_km2",)},
    "fires": {"entity_key": ("geocodigo",), "year": ("ano",), "fire_spots": ("focos_calor",)},
    "finance": {"entity_key": ("geocodigo",), "year": ("ano",), "revenue_total": ("receita_total",),
                "environment_spending": ("gasto_ambiental",)},
    "spending": {"entity_key": ("geocodigo",), "year": ("ano",), "environment_spending": ("gasto_ambiental_reais",)},
    "education": {"entity_key": ("geocodigo",), "year": ("ano",), "school_index": ("ideb",)},
    "registry": {"entity_key": ("geocodigo",), "properties": ("imoveis_cadastrados",),
                 "registered_area_ha": ("area_cadastrada_ha",), "legal_reserve_ha": ("reserva_legal_ha",),
                 "protected_area_ha": ("app_ha",), "native_vegetation_ha": ("vegetacao_nativa_ha",)},
}
