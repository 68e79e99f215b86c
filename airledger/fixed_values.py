"""Lookup values the results depend on.

FIXED VALUES: every list below must hold exactly these entries, in this order, for the
consolidated table and its products to come out right. They are data, not logic: the
operators turn them into small DataFrames (see ``operators.lookups``) and join on them.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES: words read as "missing" (compared after strip + lower).
# ---------------------------------------------------------------------------
NA_WORDS = ["", "na", "nan", "none", "null"]

# Words the later analytic steps read as missing (no "null" there).
NA_WORDS_ANALYTIC = ["", "na", "nan", "none"]

# Tokens pandas itself reads as missing when a CSV is loaded with default options.
PANDAS_NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# ---------------------------------------------------------------------------
# FIXED VALUES: pollutant label -> canonical code (label as written in the registers).
# ---------------------------------------------------------------------------
POLLUTANT_LABELS = [
    ("Ammonia", "NH3"),
    ("Nitrógeno amoniacal (o NH3)", "NH3"),
    ("Nitrógeno amoniacal", "NH3"),
    ("Arsenic", "ARSENIC"),
    ("Arsénico", "ARSENIC"),
    ("Arsenico", "ARSENIC"),
    ("Benceno", "BENZENE"),
    ("Benzene", "BENZENE"),
    ("Toluene", "TOLUENE"),
    ("Tolueno / metil benceno / Toluol / Fenilmetano", "TOLUENE"),
    ("Black Carbon", "BLACK_CARBON"),
    ("Carbon dioxide", "CO2"),
    ("Dióxido de carbono (CO2)", "CO2"),
    ("Carbon monoxide", "CO"),
    ("Monóxido de carbono", "CO"),
    ("Compuestos Orgánicos Volátiles", "VOC"),
    ("Volatile organic compounds (VOC)", "VOC"),
    ("Dibenzoparadioxinas policloradas y furanos (PCDD/F)", "PCDD_F"),
    ("PCDD-F", "PCDD_F"),
    ("Dióxido de azufre (SO2)", "SO2"),
    ("Dióxido de azúfre (SO2)", "SO2"),
    ("Sulfur dioxide", "SO2"),
    ("Sulfur oxides (SOx)", "SOX"),
    ("Lead", "PB"),
    ("Plomo", "PB"),
    ("MP10", "PM10"),
    ("PM10", "PM10"),
    ("PM10, primary", "PM10"),
    ("MP2,5", "PM2_5"),
    ("PM2.5", "PM2_5"),
    ("PM2.5, primary", "PM2_5"),
    ("PM, primary", "PM_PRIMARY"),
    ("Material particulado", "PM_TOTAL"),
    ("Mercury", "HG"),
    ("Mercurio", "HG"),
    ("Methane", "CH4"),
    ("NOx", "NOX"),
    ("Nitrogen oxides (NOx)", "NOX"),
    ("Nitrous oxide", "N2O"),
]

# ---------------------------------------------------------------------------
# FIXED VALUES: numeric pollutant id -> canonical group; any other id -> DEFAULT_GROUP.
# ---------------------------------------------------------------------------
POLLUTANT_ID_GROUPS = [
    (116, "Toluene"), (397, "Toluene"),
    (8, "Benzene"), (98, "Benzene"),
    (261, "Methane"),
    (45, "Carbon dioxide (CO2)"), (136, "Carbon dioxide (CO2)"),
    (73, "Carbon monoxide (CO)"), (137, "Carbon monoxide (CO)"),
    (123, "Nitrogen oxides (NOx)"), (303, "Nitrogen oxides (NOx)"),
    (304, "Nitrous oxide (N2O)"),
    (44, "Sulfur dioxide (SO2)"), (380, "Sulfur dioxide (SO2)"),
    (381, "Sulfur oxides (SOx) [familia]"),
    (77, "Ammonia (NH3)"), (87, "Ammonia (NH3)"),
    (84, "Lead (Pb)"), (250, "Lead (Pb)"),
    (67, "Mercury (Hg)"), (260, "Mercury (Hg)"),
    (80, "Particulate matter (PM, sin tamaño)"), (336, "Particulate matter (PM, sin tamaño)"),
    (74, "PM10"), (339, "PM10"),
    (122, "PM2.5"), (341, "PM2.5"),
    (35, "Volatile organic compounds (VOC)"), (417, "Volatile organic compounds (VOC)"),
    (121, "PCDD/F"), (999, "PCDD/F"),
    (998, "Black Carbon"),
    (6, "Arsenic (As)"), (93, "Arsenic (As)"),
]
DEFAULT_GROUP = "OTROS"

# ---------------------------------------------------------------------------
# FIXED VALUES: municipality key (normalised) -> canonical spelling.
# ---------------------------------------------------------------------------
MUNICIPALITIES = [
    ("santiago", "Santiago"),
    ("cerrillos", "Cerrillos"),
    ("cerro navia", "Cerro Navia"),
    ("conchali", "Conchalí"),
    ("el bosque", "El Bosque"),
    ("estacion central", "Estación Central"),
    ("huechuraba", "Huechuraba"),
    ("independencia", "Independencia"),
    ("la cisterna", "La Cisterna"),
    ("la florida", "La Florida"),
    ("la granja", "La Granja"),
    ("la pintana", "La Pintana"),
    ("la reina", "La Reina"),
    ("las condes", "Las Condes"),
    ("lo barnechea", "Lo Barnechea"),
    ("lo espejo", "Lo Espejo"),
    ("lo prado", "Lo Prado"),
    ("macul", "Macul"),
    ("maipu", "Maipú"),
    ("nunoa", "Ñuñoa"),
    ("pedro aguirre cerda", "Pedro Aguirre Cerda"),
    ("penalolen", "Peñalolén"),
    ("providencia", "Providencia"),
    ("pudahuel", "Pudahuel"),
    ("quilicura", "Quilicura"),
    ("quinta normal", "Quinta Normal"),
    ("recoleta", "Recoleta"),
    ("renca", "Renca"),
    ("san joaquin", "San Joaquín"),
    ("san miguel", "San Miguel"),
    ("san ramon", "San Ramón"),
    ("vitacura", "Vitacura"),
    ("puente alto", "Puente Alto"),
    ("pirque", "Pirque"),
    ("san jose de maipo", "San José de Maipo"),
    ("colina", "Colina"),
    ("lampa", "Lampa"),
    ("tiltil", "Tiltil"),
    ("san bernardo", "San Bernardo"),
    ("buin", "Buin"),
    ("calera de tango", "Calera de Tango"),
    ("paine", "Paine"),
    ("melipilla", "Melipilla"),
    ("alhue", "Alhué"),
    ("curacavi", "Curacaví"),
    ("maria pinto", "María Pinto"),
    ("san pedro", "San Pedro"),
    ("talagante", "Talagante"),
    ("el monte", "El Monte"),
    ("isla de maipo", "Isla de Maipo"),
    ("padre hurtado", "Padre Hurtado"),
    ("penaflor", "Peñaflor"),
]

# ---------------------------------------------------------------------------
# FIXED VALUES: activity-code section letter -> macro sector.
# ---------------------------------------------------------------------------
LETTER_MACRO = [
    ("A", "AGRO_FORESTRY"),
    ("B", "MINING"),
    ("C", "MANUFACTURING"),
    ("D", "ENERGY"),
    ("E", "WASTE_WATER"),
    ("F", "CONSTRUCTION"),
    ("G", "TRADE"),
    ("H", "TRANSPORT"),
    ("I", "SERVICES"),
    ("J", "SERVICES"),
    ("K", "SERVICES"),
    ("L", "SERVICES"),
    ("M", "SERVICES"),
    ("N", "SERVICES"),
    ("O", "PUBLIC_SOCIAL"),
    ("P", "PUBLIC_SOCIAL"),
    ("Q", "PUBLIC_SOCIAL"),
    ("R", "SERVICES"),
    ("S", "SERVICES"),
    ("T", "OTHER"),
    ("U", "OTHER"),
]

# FIXED VALUES: description keyword -> macro sector. Order matters: the first keyword
# contained in the normalised description wins.
KEYWORD_MACRO = [
    ("electric", "ENERGY"),
    ("energia", "ENERGY"),
    ("energ", "ENERGY"),
    ("generacion electrica", "ENERGY"),
    ("generación eléctrica", "ENERGY"),
    ("gas", "ENERGY"),
    ("petrol", "ENERGY"),
    ("min", "MINING"),
    ("mina", "MINING"),
    ("cantera", "MINING"),
    ("extract", "MINING"),
    ("const", "CONSTRUCTION"),
    ("obras", "CONSTRUCTION"),
    ("transp", "TRANSPORT"),
    ("logist", "TRANSPORT"),
    ("almacen", "TRANSPORT"),
    ("comerc", "TRADE"),
    ("hotel", "TRADE"),
    ("restaur", "TRADE"),
    ("agric", "AGRO_FORESTRY"),
    ("ganad", "AGRO_FORESTRY"),
    ("forest", "AGRO_FORESTRY"),
    ("pesca", "AGRO_FORESTRY"),
    ("acuic", "AGRO_FORESTRY"),
    ("residu", "WASTE_WATER"),
    ("desech", "WASTE_WATER"),
    ("alcantar", "WASTE_WATER"),
    ("aguas", "WASTE_WATER"),
    ("sanitari", "WASTE_WATER"),
    ("salud", "PUBLIC_SOCIAL"),
    ("hospital", "PUBLIC_SOCIAL"),
    ("educ", "PUBLIC_SOCIAL"),
    ("universidad", "PUBLIC_SOCIAL"),
    ("public", "PUBLIC_SOCIAL"),
]
DEFAULT_MACRO = "OTHER"

# FIXED VALUES: activity-code columns, in preference order.
ACTIVITY_CODE_COLUMNS = ["ciiu6_id", "id_ciiu6", "ciiu4_id", "id_ciiu4", "rubro_id", "id_rubro_vu"]

# ---------------------------------------------------------------------------
# FIXED VALUES: region spellings accepted as the metropolitan region.
# ---------------------------------------------------------------------------
RM_ALIASES = [
    "metropolitana de santiago",
    "region metropolitana de santiago",
    "region metropolitana",
    "metropolitana",
    "rm",
    "rm de santiago",
]
# Aliases used by the target-parameterised predicate (after the word "region" is deleted).
RM_TARGET_ALIASES = ["metropolitana de santiago", "metropolitana", "rm", "metropolitana santiago"]
RM_TARGETS = ["metropolitana de santiago", "metropolitana", "rm"]

# ---------------------------------------------------------------------------
# FIXED VALUES: source layouts (expected column order per family).
# ---------------------------------------------------------------------------
EFP_EXPECTED = [
    "año", "razon_social", "rut_razon_social", "nombre_establecimiento", "id_vu",
    "ciiu4", "id_ciiu4", "rubro_vu", "id_rubro_vu", "region", "provincia", "comuna",
    "id_comuna", "latitud", "longitud", "cantidad_toneladas", "unidad",
    "contaminantes", "id_contaminantes", "fuente_emisora_general", "id_fuente_emisora",
]
RUEA2023_EXPECTED = [
    "año", "id_vu", "declaracion_id", "razon_social", "rut_razon_social", "nombre_establecimiento",
    "ciiu4", "ciiu4_id", "ciiu6", "ciiu6_id", "rubro", "rubro_id", "region", "provincia", "comuna",
    "codigo_unico_territorial", "latitud", "longitud", "tipo_fuente", "source_id", "codigo_fuente",
    "combustible_primario", "ccf8_primario", "combustible_secundario", "ccf8_secundario", "ccf8_procesos",
    "contaminante_id", "contaminante", "emision_combustible_primario", "emision_combustible_secundario",
    "emision_procesos", "emision_total", "origen_data", "emision_retc", "tipo_outlier",
]
EFP_NUMERIC = ["latitud", "longitud", "cantidad_toneladas"]
RUEA2023_NUMERIC = [
    "latitud", "longitud", "emision_combustible_primario", "emision_combustible_secundario",
    "emision_procesos", "emision_total", "emision_retc",
]

# FIXED VALUES: column synonyms, normalised name -> canonical name.
EFP_SYNONYMS = [
    ("ano", "año"), ("anio", "año"), ("a_o", "año"),
    ("razon_social", "razon_social"),
    ("rut_razon_social", "rut_razon_social"),
    ("nombre_establecimiento", "nombre_establecimiento"),
    ("id_vu", "id_vu"),
    ("ciiu4", "ciiu4"),
    ("id_ciiu4", "id_ciiu4"),
    ("ciiu4_id", "id_ciiu4"),
    ("rubro_vu", "rubro_vu"),
    ("id_rubro_vu", "id_rubro_vu"),
    ("region", "region"),
    ("provincia", "provincia"),
    ("comuna", "comuna"),
    ("id_comuna", "id_comuna"),
    ("latitud", "latitud"),
    ("longitud", "longitud"),
    ("cantidad_toneladas", "cantidad_toneladas"),
    ("cantidad_tonelada", "cantidad_toneladas"),
    ("unidad", "unidad"),
    ("contaminantes", "contaminantes"),
    ("id_contaminantes", "id_contaminantes"),
    ("fuente_emisora_general", "fuente_emisora_general"),
    ("id_fuente_emisora", "id_fuente_emisora"),
]
RUEA2023_SYNONYMS = [
    ("ano", "año"), ("anio", "año"), ("a_o", "año"),
    ("id_vu", "id_vu"),
    ("declaracion_id", "declaracion_id"),
    ("razon_social", "razon_social"),
    ("rut_razon_social", "rut_razon_social"),
    ("nombre_establecimiento", "nombre_establecimiento"),
    ("ciiu4", "ciiu4"),
    ("ciiu4_id", "ciiu4_id"),
    ("id_ciiu4", "ciiu4_id"),
    ("ciiu6", "ciiu6"),
    ("ciiu6_id", "ciiu6_id"),
    ("rubro", "rubro"),
    ("rubro_id", "rubro_id"),
    ("region", "region"),
    ("provincia", "provincia"),
    ("comuna", "comuna"),
    ("codigo_unico_territorial", "codigo_unico_territorial"),
    ("latitud", "latitud"),
    ("longitud", "longitud"),
    ("tipo_fuente", "tipo_fuente"),
    ("source_id", "source_id"),
    ("codigo_fuente", "codigo_fuente"),
    ("combustible_primario", "combustible_primario"),
    ("ccf8_primario", "ccf8_primario"),
    ("combustible_secundario", "combustible_secundario"),
    ("ccf8_secundario", "ccf8_secundario"),
    ("ccf8_procesos", "ccf8_procesos"),
    ("contaminante_id", "contaminante_id"),
    ("contaminante", "contaminante"),
    ("emision_combustible_primario", "emision_combustible_primario"),
    ("emision_combustible_secundario", "emision_combustible_secundario"),
    ("emision_procesos", "emision_procesos"),
    ("emision_total", "emision_total"),
    ("origen_data", "origen_data"),
    ("emision_retc", "emision_retc"),
    ("tipo_outlier", "tipo_outlier"),
]

# FIXED VALUES: raw spellings renamed only when the target is absent (EFP eras).
EFP_ERA_RENAMES = [
    ("contaminante", "contaminantes"),
    ("id_contaminante", "id_contaminantes"),
    ("rut", "rut_razon_social"),
    ("CCF8_primario", "ccf8_primario"),
    ("CCF8_secundario", "ccf8_secundario"),
    ("CCF8_materia_prima", "ccf8_materia_prima"),
]
# FIXED VALUES: column order of the two EFP eras.
ORDER_2005_2018 = [
    "año", "razon_social", "rut_razon_social", "nombre_establecimiento", "id_vu",
    "ciiu4", "id_ciiu4", "rubro_vu", "id_rubro_vu", "region", "provincia", "comuna", "id_comuna",
    "latitud", "longitud", "cantidad_toneladas", "unidad",
    "contaminantes", "id_contaminantes", "fuente_emisora_general", "id_fuente_emisora",
    "sistema",
]
ORDER_2019_2022 = [
    "año", "razon_social", "rut_razon_social", "nombre_establecimiento", "id_vu",
    "ciiu4", "id_ciiu4", "ciiu6", "id_ciiu6", "rubro_vu", "id_rubro_vu",
    "region", "provincia", "comuna", "id_comuna", "latitud", "longitud",
    "cantidad_toneladas", "unidad",
    "contaminantes", "id_contaminantes", "fuente_emisora_general", "id_fuente_emisora",
    "tipo_fuente", "combustible_primario", "ccf8_primario", "combustible_secundario", "ccf8_secundario",
    "ccf8_materia_prima", "emision_primario", "emision_secundario", "emision_materia_prima",
    "sistema",
]
# FIXED VALUES: renames applied when EFP and the 2023 register are put together.
RUEA2023_TO_EFP = [("ciiu4_id", "id_ciiu4"), ("contaminante", "contaminantes"), ("contaminante_id", "id_contaminantes")]
EFP_CASE_RENAMES = [("CCF8_primario", "ccf8_primario"), ("CCF8_secundario", "ccf8_secundario"),
                    ("CCF8_materia_prima", "ccf8_materia_prima")]
# FIXED VALUES: minimum common columns and the extended canonical set.
MIN_COMMON = [
    "año", "razon_social", "nombre_establecimiento", "id_vu",
    "ciiu4", "id_ciiu4", "region", "provincia", "comuna", "latitud", "longitud",
]
CANON_EQUIV = [
    "año", "razon_social", "rut_razon_social", "nombre_establecimiento", "id_vu",
    "ciiu4", "id_ciiu4", "ciiu6", "id_ciiu6",
    "region", "provincia", "comuna", "latitud", "longitud",
    "contaminantes", "id_contaminantes",
    "tipo_fuente", "combustible_primario", "ccf8_primario", "combustible_secundario", "ccf8_secundario",
]

# FIXED VALUES: year eras fused into one table each (first year labels the era's ids).
ERAS = [("2005_2015", list(range(2005, 2016))), ("2016_2018", list(range(2016, 2019)))]

# ---------------------------------------------------------------------------
# FIXED VALUES: consolidated (gold) table.
# ---------------------------------------------------------------------------
TARGET_COLUMNS = [
    "id_unico", "año", "contaminante_canon", "actividad_canon", "actividad_macro",
    "emision_total", "rut", "comuna", "latitud", "longitud", "unidad",
]
RUT_CANDIDATES = ["rut_razon_social", "rut", "rut_establecimiento"]
EMISSION_SOURCE_DEFAULT = "cantidad_toneladas"
EMISSION_SOURCE_2023 = "emision_total"
EMISSION_FALLBACK_WITH_TOTAL = ["emision_total", "emision_primario", "emision_combustible_primario"]
EMISSION_FALLBACK_WITHOUT_TOTAL = ["emision_primario", "emision_total", "emision_combustible_primario"]
UNIT = "t/año"
UNIT_VARIANTS = [("ton/año", "t/año"), ("Ton/año", "t/año"), ("Tn/año", "t/año")]

# FIXED VALUES: duplicate column pairs merged (primary, secondary).
MERGE_PAIRS = [("cantidad_toneladas", "emision_total"), ("id_ciiu6", "ciiu6_id"), ("rubro_id", "id_rubro_vu")]

# FIXED VALUES: columns kept in the per-pollutant extracts.
EXTRACT_COLUMNS = [
    "año", "ano", "razon_social", "rut_razon_social", "nombre_establecimiento", "comuna",
    "id_comuna", "latitud", "longitud", "contaminantes", "cantidad_toneladas",
]

# FIXED VALUES: coordinate columns in preference order.
LAT_COLUMNS = ["latitud_nueva", "latitud"]
LON_COLUMNS = ["longitud_nueva", "longitud"]

# FIXED VALUES: analytics constants.
TOP_MUNICIPALITIES = 20
HISTOGRAM_BINS = 40
LOG_FLOOR = 1e-20
DATA_FILE_SUFFIXES = [".csv", ".xls", ".xlsx"]

# ---------------------------------------------------------------------------
# FIXED VALUES: register layout by the beginning of a file's name, and without one.
# ---------------------------------------------------------------------------
LAYOUT_PREFIXES = [("ruea-efp-", "efp"), ("ckan_ruea_2023", "ruea2023")]
DEFAULT_LAYOUT = "efp"
