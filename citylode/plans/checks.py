"""The declared checks of every table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from citylode.operators.quality import WARN, Accepted, AtMost, NotAfter, NotNull, Readable, Unique
from citylode.reference_values import CLASSIFIED_HOURS, QUALITY_CODES, SITE_SETTINGS, TRAFFIC_STATES

# Columns that must be present.
REQUIRED = {
    "raw_air_quality": [
        "date_debut", "date_fin", "organisme", "code_site", "polluant", "_file_name", "_loaded_at"],
    "raw_coordonnees": ["code_site", "latitude", "longitude", "_file_name", "_loaded_at"],
    "raw_trafic_velo": ["compteur_id", "sum_counts", "date", "_file_name", "_loaded_at"],
    "raw_trafic_routier": ["iu_ac", "t_1h", "_file_name", "_loaded_at"],
    "raw_stations_velib": [
        "stationcode", "name", "coordonnees_geo_lat", "coordonnees_geo_lon", "_file_name", "_loaded_at"],
    "raw_arrondissements_paris": ["raw_geojson", "_loaded_at"],
    "stg_air_quality": ["code_site", "polluant", "date_debut", "_loaded_at"],
    "stg_coordonnees": ["code_site", "latitude", "longitude"],
    "stg_trafic_velo": ["compteur_id", "date_jour"],
    "stg_trafic_routier": ["arc_id", "date_jour"],
    "stg_stations_velib": ["stationcode", "nom_station"],
    "stg_arrondissements": ["arrondissement_code", "code_insee", "nom_arrondissement", "geometry"],
    "int_air_quality_idf": ["code_site", "polluant", "date_mesure", "latitude", "longitude"],
    "int_velo_daily": ["compteur_id", "date_jour", "total_passages_jour"],
    "int_trafic_daily": ["arc_id", "date_jour", "nb_mesures"],
    "int_air_quality_zoned": ["arrondissement_code", "date_jour"],
    "int_trafic_zoned": ["arrondissement_code", "date_jour"],
    "int_velo_zoned": ["arrondissement_code", "date_jour"],
}

# Keys that must not repeat.
KEYS = [
    ("raw_coordonnees", ("code_site",)),
    ("stg_coordonnees", ("code_site",)),
    ("stg_stations_velib", ("stationcode",)),
    ("stg_arrondissements", ("arrondissement_code",)),
    ("stg_arrondissements", ("code_insee",)),
    ("int_velo_daily", ("compteur_id", "date_jour")),
    ("int_trafic_daily", ("arc_id", "date_jour")),
]

# Label lists, reported but not stopping a run.
LABELS = [
    ("raw_air_quality", "type_implantation", SITE_SETTINGS),
    ("raw_air_quality", "code_qualite", QUALITY_CODES),
    ("raw_trafic_routier", "etat_trafic", TRAFFIC_STATES),
    ("stg_trafic_routier", "etat_trafic", TRAFFIC_STATES),
]

# Tables whose dates must not lie in the future.
DATED = [
    ("int_air_quality_idf", "date_mesure"),
    ("int_velo_daily", "date_jour"),
    ("int_trafic_daily", "date_jour"),
]

# Coordinates: what cannot be read becomes NULL and is reported.
COORDINATES = [
    ("raw_coordonnees", "latitude", False),
    ("raw_coordonnees", "longitude", False),
    ("raw_trafic_velo", "coordonnees_geographiques", True),
    ("raw_trafic_routier", "geo_point_2d", True),
    ("raw_stations_velib", "coordonnees_geo_lat", False),
    ("raw_stations_velib", "coordonnees_geo_lon", False),
]

HOURS_IN_DAY = 24


def silver_checks(tables: Iterable[str], as_of: dt.date | None = None, hours: int = HOURS_IN_DAY) -> list:
    """All declared checks of the named tables."""
    wanted = set(tables)
    checks = [NotNull(t, c) for t, columns in REQUIRED.items() for c in columns]
    checks += [Unique(t, key) for t, key in KEYS]
    checks += [Accepted(t, c, tuple(values), WARN) for t, c, values in LABELS]
    checks += [Readable(t, c, pair) for t, c, pair in COORDINATES]
    checks += [NotAfter(t, c, as_of) for t, c in DATED]
    checks.append(AtMost("int_trafic_daily", tuple(CLASSIFIED_HOURS), hours))
    return [c for c in checks if c.table in wanted]
