"""Fixed values of the data contract: site list, alert thresholds, merge keys, state labels."""

# Air-quality sites of the capital region.
REGION_SITES = [
    "FR04002", "FR04004", "FR04012", "FR04023", "FR04034", "FR04048", "FR04053", "FR04055",
    "FR04058", "FR04066", "FR04098", "FR04099", "FR04118", "FR04122", "FR04123", "FR04131",
    "FR04156", "FR04158", "FR04173", "FR04179", "FR04181", "FR04319", "FR04328", "FR04329",
]

# Alert thresholds as (pollutant, threshold, unit, kind of threshold).
ALERT_THRESHOLDS = [
    ("NO2", 20.0, "µg/m3", "OMS annuel"),
    ("NO2", 100.0, "µg/m3", "OMS horaire"),
    ("PM10", 25.0, "µg/m3", "OMS journalier"),
    ("PM2.5", 12.0, "µg/m3", "OMS journalier"),
    ("O3", 50.0, "µg/m3", "OMS 8h glissant"),
    ("SO2", 10.0, "µg/m3", "OMS 24h"),
]

# Fixed value: an hourly measure above this puts its site "in alert" in the city indicators.
SITE_ALERT_LEVEL = 50.0

# Key of each served table. Alerts also need the kind of threshold, since one
# site-day may exceed two thresholds of the same pollutant.
MERGE_KEYS = {
    "dm_air_quality_daily": ["code_site", "polluant", "date_mesure"],
    "dm_alertes_pollution": ["code_site", "polluant", "date_mesure", "type_seuil"],
    "dm_velo_daily": ["compteur_id", "date_jour"],
    "dm_trafic_routier_daily": ["arc_id", "date_jour"],
    "dm_smartcity_kpi_daily": ["date_jour"],
    "dm_zone_kpi_daily": ["arrondissement_code", "date_jour"],
    "ref_arrondissements": ["arrondissement_code"],
}

# Date column of each served table that has one.
DATE_COLUMNS = {
    "dm_air_quality_daily": "date_mesure",
    "dm_alertes_pollution": "date_mesure",
    "dm_velo_daily": "date_jour",
    "dm_trafic_routier_daily": "date_jour",
    "dm_smartcity_kpi_daily": "date_jour",
    "dm_zone_kpi_daily": "date_jour",
}

# Traffic states, and the four that count as classified hours.
TRAFFIC_STATES = ["Fluide", "Dense", "Saturé", "Bloqué", "Inconnu", "Pré-saturé"]
CLASSIFIED_HOURS = {
    "nb_heures_bloque": "Bloqué",
    "nb_heures_sature": "Saturé",
    "nb_heures_dense": "Dense",
    "nb_heures_fluide": "Fluide",
}

# Accepted labels of two air-quality columns.
SITE_SETTINGS = [
    "Urbaine", "Périurbaine", "Rurale nationale", "Rurale près des villes", "Rurale régionale",
]
QUALITY_CODES = ["A", "N", "R"]

# Official levels offered as the default of a custom threshold.
OFFICIAL_LEVELS = {"NO2": 40, "PM10": 50, "PM2.5": 25, "O3": 100, "SO2": 20}

# Pollutant averages shown in the indicators.
PIVOT_COLUMNS = {"no2_moyen": "NO2", "pm10_moyen": "PM10", "pm25_moyen": "PM2.5", "o3_moyen": "O3"}
