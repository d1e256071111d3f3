"""Postal views over the star-schema test tables: the same SQL for Spark and for the comparing engine.

{customer}, {nation} and {orders} stand for tables; Spark gets data frames for them, the other engine their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from postalis.functions import STATES

UFS, CODES = "".join(STATES), "".join(STATES.values())
M = "cast(floor({} / 100) as bigint) % 27"
IBGE = f"concat(substr('{CODES}', cast(2 * m + 1 as int), 2), lpad(cast(m as string), 5, '0'))"
CEP = "lpad(cast(1000000 + {} * 37 as string), 8, '0')"

ADDR = f"""SELECT {CEP.format("c_custkey")} AS cep, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_name END AS street, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_mktsegment END AS neighborhood,
    n_name AS city, CASE WHEN c_custkey % 211 = 0 THEN 'DF' ELSE substr('{UFS}', cast(2 * m + 1 as int), 2) END AS uf, {IBGE} AS ibge, m
    FROM (SELECT *, {M.format("c_custkey")} AS m FROM {{customer}}) c JOIN {{nation}} n ON c_nationkey = n_nationkey"""
OBS = f"""SELECT cast(o_orderkey as string) AS k, o_custkey, m, {CEP.format("o_custkey")} AS cep, {IBGE} AS ibge, o_orderpriority,
    -30 + m + ((o_orderkey * 7919) % 1000) / 1e6 + CASE WHEN o_orderkey % 17 = 0 THEN 0.5e0 ELSE 0e0 END + CASE WHEN o_orderkey % 101 = 0 THEN 6e0 ELSE 0e0 END AS latitude,
    -70 + m + ((o_orderkey * 6007) % 1000) / 1e6 AS longitude
    FROM (SELECT *, {M.format("o_custkey")} AS m FROM {{orders}}) o"""
FIRST_PARTY = f"""SELECT concat('store:', k) AS evidence_id, cep, ibge, latitude, longitude, concat(lower(replace(substr(o_orderpriority, 3), ' ', '-')), ':', k) AS source
    FROM ({OBS}) o WHERE o_custkey % 4 = 0 AND m % 5 <> 4 AND m % 9 <> 8"""
#: The other orders are map nodes, of which some have an unknown code, and the official sample: every order is in one view.
OSM = f"""SELECT concat('openstreetmap:node/', k) AS evidence_id, CASE WHEN cast(k as bigint) % 37 = 0 THEN concat('9', substr(cep, 2)) ELSE cep END AS cep, cast(NULL as string) AS ibge, latitude, longitude, concat('openstreetmap:node/', k) AS source
    FROM ({OBS}) o WHERE o_custkey % 4 = 1 OR (o_custkey % 4 = 0 AND (m % 5 = 4 OR m % 9 = 8))"""
HOLDOUT = f"SELECT CASE WHEN cast(k as bigint) % 41 = 0 THEN concat('9', substr(cep, 2)) ELSE cep END AS cep, latitude, longitude FROM ({OBS}) o WHERE o_custkey % 4 IN (2, 3)"
PLACES = f"SELECT DISTINCT m, {IBGE} AS ibge FROM (SELECT {M.format('c_custkey')} AS m FROM {{customer}}) c"
LOCALITIES = " UNION ALL ".join(
    [f"SELECT ibge, 'Cidade' AS category, cast(-30 + m as double) AS latitude, cast(-70 + m as double) AS longitude FROM ({PLACES}) p WHERE m % 9 <> 8"]
    + [f"SELECT ibge, 'Povoado' AS category, -30 + m + {0.01 * k}e0 AS latitude, -70 + m - {0.02 * k}e0 AS longitude FROM ({PLACES}) p" for k in (1, 2, 3)]
)
#: Corners of an outer ring, a hole and an island around each anchor, in nanodegrees.
RINGS = [[(-300, -300), (300, -300), (300, 700), (-300, 700)], [(100, 100), (200, 100), (200, 200), (100, 200)], [(400, 0), (450, 0), (425, 50)]]
EDGES = [(a[0] * 10**6, a[1] * 10**6, b[0] * 10**6, b[1] * 10**6) for ring in RINGS for a, b in zip(ring, ring[1:] + ring[:1], strict=True)]
POLYGONS = " UNION ALL ".join(
    f"SELECT ibge, cast((-70 + m) * 1000000000 + ({x1}) as bigint) AS x1, cast((-30 + m) * 1000000000 + ({y1}) as bigint) AS y1, cast((-70 + m) * 1000000000 + ({x2}) as bigint) AS x2, cast((-30 + m) * 1000000000 + ({y2}) as bigint) AS y2 FROM ({PLACES}) p WHERE m % 7 <> 6"
    for x1, y1, x2, y2 in EDGES
)
#: The same polygons for every municipality, as a build needs.
EVERY_POLYGON = POLYGONS.replace(" WHERE m % 7 <> 6", "")
#: Localities with the ones that stand for municipalities without a city.
EVERY_LOCALITY = LOCALITIES + f" UNION ALL SELECT ibge, 'Distrito Estadual de Fernando de Noronha' AS category, -30 + m + 0.05e0 AS latitude, cast(-70 + m as double) AS longitude FROM ({PLACES}) p WHERE m % 9 = 8"
#: A diff that keeps all rules: each row's action is the first that its classification allows.
SOUND_DIFF = f"""SELECT cep, CASE c WHEN 0 THEN 'added' WHEN 1 THEN 'address_changed' WHEN 2 THEN 'ibge_changed' WHEN 3 THEN 'missing_from_source' WHEN 4 THEN 'source_link_conflict' ELSE 'unchanged' END AS classification,
    CASE c WHEN 0 THEN 'assigned_municipality' WHEN 1 THEN 'preserved' WHEN 2 THEN 'reassigned_municipality' WHEN 3 THEN 'retained_missing' WHEN 4 THEN 'retained_source_link_conflict' ELSE 'preserved' END AS geography_action,
    true AS candidate_included, cast(NULL as string) AS current_ibge, cast(NULL as string) AS previous_ibge, cast(NULL as string) AS previous_cep, cast(NULL as string) AS valid_until
    FROM (SELECT {CEP.format("c_custkey")} AS cep, c_custkey % 6 AS c FROM {{customer}}) d"""
#: What becomes of a base row in the candidate that inherits from it, by its code's number.
FATES = f"""SELECT {CEP.format("c_custkey")} AS cep, c_custkey % 6 = 0 AND c_custkey % 12 <> 0 AS added, c_custkey % 90 = 5 AS smuggled, c_custkey % 113 = 0 AS lost, c_custkey % 6 = 1 OR c_custkey % 101 = 0 AS readdressed, c_custkey % 97 = 0 AS moved
    FROM {{customer}}"""
#: Doubles of which many are no decimal tie though their shortest notation is one.
HALVES = "SELECT o_orderkey, (o_orderkey % 40000) / 1e4 + 5e-4 AS small, (o_orderkey * 37 % 1000003) / 8e0 - 5e4 AS wide FROM {orders}"
#: All classifications and actions; every seventh customer's action is the next row's, so some pairs aren't allowed.
DIFF = f"""SELECT cep, c_custkey, CASE c WHEN 0 THEN 'added' WHEN 1 THEN 'address_changed' WHEN 2 THEN 'ibge_changed' WHEN 3 THEN 'missing_from_source' WHEN 4 THEN 'source_link_conflict' ELSE 'unchanged' END AS classification,
    CASE a WHEN 0 THEN CASE WHEN c_custkey % 4 = 0 THEN 'unresolved' ELSE 'assigned_municipality' END WHEN 1 THEN CASE WHEN c_custkey % 4 = 1 THEN 'preserved' ELSE 'invalidated_exact_to_municipality' END
        WHEN 2 THEN 'reassigned_municipality' WHEN 3 THEN 'retained_missing' WHEN 4 THEN 'retained_source_link_conflict' ELSE 'preserved' END AS geography_action,
    c_custkey % 53 <> 0 AS candidate_included, CASE WHEN c_custkey % 59 = 0 THEN '12' ELSE '1100205' END AS current_ibge, cast(NULL as string) AS previous_ibge, CASE WHEN c_custkey % 61 = 0 THEN 'x' ELSE cep END AS previous_cep
    FROM (SELECT {CEP.format("c_custkey")} AS cep, c_custkey, c_custkey % 6 AS c, CASE WHEN c_custkey % 7 = 0 THEN (c_custkey + 1) % 6 ELSE c_custkey % 6 END AS a FROM {{customer}}) d"""
#: Address records as text, as an input has them.
RECORDS = f"""SELECT concat(substr(cep, 1, 5), '-', substr(cep, 6)) AS cep, concat(chr(160), street, ' ') AS logradouro, '' AS complemento, cast(NULL as string) AS unidade, neighborhood AS bairro, concat(' ', city) AS localidade, uf, cast(NULL as string) AS estado, '  ' AS regiao, ibge
    FROM ({ADDR}) r"""
RAW = f"""SELECT c_custkey, concat(substr({CEP.format("c_custkey")}, 1, 5), CASE WHEN c_custkey % 4 = 0 THEN '' ELSE '-' END, substr({CEP.format("c_custkey")}, 6), CASE WHEN c_custkey % 7 = 0 THEN '9' ELSE '' END) AS raw_code,
    CASE WHEN c_custkey % 3 = 0 THEN '   ' WHEN c_custkey % 3 = 1 THEN concat(chr(160), c_name, '  ') ELSE c_name END AS raw_text FROM {{customer}}"""


def view(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("customer", "nation", "orders") if f"{{{t}}}" in sql}
    return spark.sql(sql, **tables)


def plain(sql: str) -> str:
    return sql.replace("{", "").replace("}", "")
