"""Raw-shaped tables derived from the given test tables.

Each is a projection of one table, written once in SQL both engines read; ``{...}`` marks the few
functions they spell differently. Air dates are moved back 26 years to overlap the other domains.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SPARK = {
    "STAMP": lambda t: f"date_format({t}, 'yyyy/MM/dd HH:mm:ss')",
    "DAY_START": lambda t: f"cast(cast({t} as date) as timestamp_ntz)",
}
DUCK = {
    "STAMP": lambda t: f"strftime({t}, '%Y/%m/%d %H:%M:%S')",
    "DAY_START": lambda t: f"cast(cast({t} as date) as timestamp)",
}

X = "({k} * 7919 % 5003) * 5 / cast(5003 as double)"
Y = "({k} * 104729 % 4999) * 5 / cast(4999 as double)"
TS = "(ts - interval '9496' day)"
SITE = "user_id % 30"
ARC = "l_suppkey % 10"
COUNTER = "o_custkey % 150"


def point(template: str, key: str) -> str:
    return template.replace("{k}", key)


# table -> (source, {column: expression})
ANALOGS: dict[str, tuple[str, dict[str, str]]] = {
    "raw_air_quality": ("events", {
        "date_debut": f"{{STAMP:{TS}}}",
        "date_fin": f"{{STAMP:{TS} + interval '1' hour}}",
        "organisme": "concat('ORG', cast(user_id % 3 as string))",
        "code_zas": "concat('ZAS', cast(user_id % 5 as string))",
        "zas": "concat('Zone ', cast(user_id % 5 as string))",
        "code_site": f"case when event_id % 211 = 0 then null else concat('FR04', lpad(cast({SITE} as string), 3, '0')) end",
        "nom_site": f"concat('Site ', cast({SITE} as string))",
        "type_implantation": "case user_id % 4 when 0 then 'Urbaine' when 1 then 'Périurbaine' when 2 then 'Rurale régionale' else 'Trafic' end",
        "polluant": "case event_type when 'error' then 'NO2' when 'click' then 'PM10' when 'view' then 'PM2.5' when 'purchase' then 'O3' else 'SO2' end",
        "type_influence": "'Fond'",
        "discriminant": "'A'",
        "reglementaire": "case when event_id % 3 = 0 then 'Oui' when event_id % 3 = 1 then 'non' end",
        "type_evaluation": "'mesures fixes'",
        "procedure_mesure": "'Auto'",
        "type_valeur": "'moyenne horaire'",
        "valeur": "case when event_id % 97 = 0 then 'n/a' else cast(value as string) end",
        "valeur_brute": "cast(value as string)",
        "unite_mesure": "case when event_id % 31 = 0 then 'mg/m3' else 'µg/m3' end",
        "taux_saisie": "cast(event_id % 101 as string)",
        "couverture_temporelle": "cast(null as string)",
        "couverture_donnees": "cast(null as string)",
        "code_qualite": "case event_id % 5 when 0 then 'A' when 1 then 'N' when 2 then 'R' when 3 then 'X' end",
        "validite": "case when event_id % 7 = 0 then '-1' else '1' end",
        "_file_name": f"concat('air/', {{STAMP:{TS}}})",
        "_loaded_at": f"{{DAY_START:{TS}}} + interval '1' day + (case when event_id % 3 = 0 then interval '8' hour else interval '9' hour end)",
    }),
    "raw_coordonnees": ("events", {
        "code_site": f"concat('FR04', lpad(cast({SITE} as string), 3, '0'))",
        "latitude": f"case when {SITE} = 13 then 'unknown' else cast({point(Y, '(' + SITE + ')')} as string) end",
        "longitude": f"cast({point(X, '(' + SITE + ')')} as string)",
        "_file_name": "'coordonnees.csv'",
        "_loaded_at": "cast(null as timestamp)",
    }),
    "raw_trafic_velo": ("orders", {
        "compteur_id": f"case when o_orderkey % 307 = 0 then null else concat('c', cast({COUNTER} as string)) end",
        "compteur_nom": f"concat('Compteur ', cast({COUNTER} as string))",
        "site_id": f"concat('s', cast({COUNTER} as string))",
        "name": f"concat('Site ', cast({COUNTER} as string))",
        "sum_counts": "case when o_orderkey % 97 = 0 then 'bad' when o_orderkey % 5 = 0 then concat(cast(cast(floor(o_totalprice / 1000) as bigint) as string), '.0') else cast(cast(floor(o_totalprice / 1000) as bigint) as string) end",
        "date": "concat(cast(cast(o_orderdate as date) as string), 'T08:00:00+00:00')",
        "date_installation": "case when o_orderkey % 11 = 0 then '31/12/2020' else '2020-12-31' end",
        "coordonnees_geographiques": f"concat(cast({point(Y, '(' + COUNTER + ')')} as string), ',', cast({point(X, '(' + COUNTER + ')')} as string))",
        "mois_annee_comptage": "substr(cast(cast(o_orderdate as date) as string), 1, 7)",
        "_file_name": "concat('velo/', cast(o_orderkey as string))",
        "_loaded_at": "{DAY_START:o_orderdate} + interval '1' day + (case when o_orderkey % 3 = 0 then interval '7' hour else interval '8' hour end)",
    }),
    "raw_trafic_routier": ("lineitem", {
        "iu_ac": f"case when l_orderkey % 401 = 0 then null else concat('arc', cast({ARC} as string)) end",
        "libelle": f"concat('Rue ', cast({ARC} as string))",
        "t_1h": "concat(cast(cast(l_shipdate as date) as string), 'T0', cast(l_linenumber as string), ':00:00+02:00')",
        "k": "cast(l_discount as string)",
        "q": "case when l_orderkey % 89 = 0 then '' else cast(l_quantity as string) end",
        "etat_trafic": "case concat(l_returnflag, l_linestatus) when 'RF' then 'Fluide' when 'RO' then 'Dense' when 'NF' then 'Saturé' when 'NO' then 'Bloqué' when 'AF' then 'Inconnu' else 'Pré-saturé' end",
        "iu_nd_amont": f"concat('n', cast({ARC} as string))",
        "libelle_nd_amont": f"concat('Noeud ', cast({ARC} as string))",
        "iu_nd_aval": f"concat('n', cast({ARC} + 1 as string))",
        "libelle_nd_aval": f"concat('Noeud ', cast({ARC} + 1 as string))",
        "etat_barre": "'Ouvert'",
        "geo_point_2d": f"concat(cast({point(Y, '(' + ARC + ')')} as string), ', ', cast({point(X, '(' + ARC + ')')} as string))",
        "_file_name": "concat('road/', cast(l_orderkey as string))",
        "_loaded_at": "{DAY_START:l_shipdate} + interval '1' day + (case when l_orderkey % 4 = 0 then interval '7' hour else interval '8' hour end)",
    }),
    "raw_stations_velib": ("orders", {
        "stationcode": "case when o_orderkey % 503 = 0 then null else cast(o_custkey as string) end",
        "name": "concat('Station ', cast(o_custkey as string), ' ', o_orderstatus)",
        "capacity": "case when o_orderkey % 7 = 0 then '12.0' when o_orderkey % 13 = 0 then '' else cast(o_orderkey % 60 as string) end",
        "coordonnees_geo_lat": f"cast({point(Y, 'o_custkey')} as string)",
        "coordonnees_geo_lon": f"case when o_orderkey % 17 = 0 then null else cast({point(X, 'o_custkey')} as string) end",
        "nom_arrondissement_communes": "concat('Area ', cast(o_custkey % 20 as string))",
        "code_insee_commune": "concat('751', lpad(cast(o_custkey % 20 + 1 as string), 2, '0'))",
        "_file_name": "concat('stations_', lpad(cast(o_orderkey as string), 12, '0'), '.json')",
        "_loaded_at": "case when o_orderkey % 41 = 0 then null else {DAY_START:o_orderdate} end",
    }),
    "station_states": ("events", {
        "stationId": "case when user_id % 20 = 0 then null when user_id % 20 = 1 then '' else cast(user_id as string) end",
        "timestamp": "{STAMP:ts}",
        "num_bikes_available": "case when event_id % 29 = 0 then null else cast(floor(value) as bigint) end",
        "num_docks_available": "cast(event_id % 40 as bigint)",
        "mechanical": "cast(event_id % 7 as bigint)",
        "ebike": "cast(event_id % 5 as bigint)",
        "nom_arrondissement_communes": "concat('zone ', cast(user_id % 20 as string))",
        "latitude": f"case when user_id % 37 = 5 then null else {point(Y, 'user_id')} end",
        "longitude": point(X, "user_id"),
        "position": "cast(event_id as double)",
    }),
    "zone_shapes": ("nation", {
        "c_ar": "n_nationkey",
        "c_arinsee": "concat('751', lpad(cast(n_nationkey + 1 as string), 2, '0'))",
        "l_aroff": "n_name",
        "surface": "n_nationkey * 1000 + 0.5e0",
        "cx": "n_nationkey % 5 + 0.5e0",
        "cy": "floor(n_nationkey / 5) + 0.5e0",
        "half": "0.5e0",
        "doc": "0",
    }),
    "customer_shapes": ("customer", {
        "c_ar": "c_custkey",
        "c_arinsee": "concat('C', cast(c_custkey as string))",
        "l_aroff": "c_name",
        "surface": "c_acctbal",
        "cx": "c_custkey % 1000 + 0.5e0",
        "cy": "floor(c_custkey / 1000) + 0.5e0",
        "half": "0.25e0",
        "doc": "floor(c_custkey / 500)",
    }),
}
DISTINCT = {"raw_coordonnees"}


def render(expression: str, dialect: dict) -> str:
    """Replace {NAME:argument} by the dialect's spelling."""
    while (start := expression.find("{")) >= 0:
        end = expression.index("}", start)
        name, argument = expression[start + 1:end].split(":", 1)
        expression = expression[:start] + dialect[name](argument) + expression[end + 1:]
    return expression


def duck_cte(name: str) -> str:
    source, columns = ANALOGS[name]
    body = ", ".join(f'{render(e, DUCK)} as "{c}"' for c, e in columns.items())
    return f"select {'distinct ' if name in DISTINCT else ''}{body} from {source}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def analog(spark: SparkSession, sf_dir: str, name: str, rows: DataFrame | None = None) -> DataFrame:
    """A raw-shaped table from the rows of its source, as they lie in the folder or as given."""
    source, columns = ANALOGS[name]
    df = (table(spark, sf_dir, source) if rows is None else rows).selectExpr(
        *[f"{render(e, SPARK)} as `{c}`" for c, e in columns.items()])
    return df.distinct() if name in DISTINCT else df


def geojson_documents(spark: SparkSession, sf_dir: str, shapes: str = "zone_shapes") -> DataFrame:
    """Feature collections of diamond polygons: columns doc and value (the document text).

    A document holds the shapes of one ``doc`` number: 25 nations, or at most 500 customers.
    """
    cx, cy, half = F.col("cx"), F.col("cy"), F.col("half")
    corners = [(cx, cy - half), (cx + half, cy), (cx, cy + half), (cx - half, cy), (cx, cy - half)]
    geometry = F.struct(
        F.lit("Polygon").alias("type"),
        F.array(F.array(*[F.array(x, y) for x, y in corners])).alias("coordinates"))
    feature = F.struct(
        F.lit("Feature").alias("type"), geometry.alias("geometry"),
        F.struct(
            "c_ar", "c_arinsee", "l_aroff", "surface",
            F.struct(cy.alias("lat"), cx.alias("lon")).alias("geom_x_y"),
        ).alias("properties"))
    return analog(spark, sf_dir, shapes).groupBy("doc").agg(
        F.to_json(F.struct(
            F.lit("FeatureCollection").alias("type"), F.collect_list(feature).alias("features"),
        )).alias("value"))
