"""The comparing engine's SQL for the registered queries, as common table expressions over the adapter views."""

from __future__ import annotations

from postalis.functions import EARTH_KM, STATES
from postalis.operators.refresh import ACTIONS, ALLOWED, CANDIDATE_PRECISIONS
from postalis.plans import testdata as T


def km(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return f"(2*{EARTH_KM}e0*asin(sqrt(pow(sin((radians({lat2})-radians({lat1}))/2),2)+cos(radians({lat1}))*cos(radians({lat2}))*pow(sin(radians({lon2}-({lon1}))/2),2))))"


def median_chain(name: str, source: str, keys: str, samples: int, radius: float) -> str:
    """CTEs name_k (with retained), name_c (all centroids) and name (bounded ones) of a source with evidence."""
    return f"""
    {name}_a AS (SELECT *, median(latitude) OVER w AS clat, median(longitude) OVER w AS clon, count(*) OVER w AS n_ FROM {source} WINDOW w AS (PARTITION BY {keys})),
    {name}_b AS (SELECT *, {km("clat", "clon", "latitude", "longitude")} AS d_ FROM {name}_a),
    {name}_d AS (SELECT *, median(d_) OVER (PARTITION BY {keys}) AS md FROM {name}_b),
    {name}_e AS (SELECT *, median(abs(d_ - md)) OVER (PARTITION BY {keys}) AS mad FROM {name}_d),
    {name}_k AS (SELECT * EXCLUDE (clat, clon, n_, d_, md, mad), n_ < 3 OR d_ <= greatest(0.25e0, md + 3 * mad) AS retained FROM {name}_e),
    {name}_f AS (SELECT *, median(latitude) OVER w AS clat, median(longitude) OVER w AS clon FROM {name}_k WHERE retained WINDOW w AS (PARTITION BY {keys})),
    {name}_c AS (SELECT {keys}, min(clat) AS latitude, min(clon) AS longitude, count(*) AS evidence_count, round(max({km("clat", "clon", "latitude", "longitude")}), 3) AS radius_km,
        array_to_string(list_sort(list_distinct(list(trim(split_part(source, ':', 1))))), ',') AS geo_source FROM {name}_f GROUP BY {keys}),
    {name} AS (SELECT * FROM {name}_c WHERE evidence_count >= {samples} AND radius_km <= {radius}e0)"""


BUCKET = "cast(('0x' || substr(sha256({0}), 1, 16))::UBIGINT % 5 AS integer) = 0"
STATE_CODE = "CASE uf " + " ".join(f"WHEN '{u}' THEN '{c}'" for u, c in STATES.items()) + " END"
BASE = f"""WITH RECURSIVE addr AS ({T.plain(T.ADDR)}), fp AS ({T.plain(T.FIRST_PARTY)}), osm AS ({T.plain(T.OSM)}), holdout AS ({T.plain(T.HOLDOUT)}), loc AS ({T.plain(T.LOCALITIES)}),
    mean_ AS (SELECT ibge, avg(latitude) FILTER (category = 'Cidade') AS clat, avg(longitude) FILTER (category = 'Cidade') AS clon FROM loc GROUP BY ibge),
    muni AS (SELECT ibge, min(clat) AS latitude, min(clon) AS longitude, count(*) AS evidence_count, round(max({km("clat", "clon", "latitude", "longitude")}), 3) AS radius_km, 'ibge-localidades' AS geo_source
        FROM loc JOIN (SELECT * FROM mean_ WHERE clat IS NOT NULL) USING (ibge) GROUP BY ibge),
    known AS (SELECT o.evidence_id, o.cep, o.latitude, o.longitude, o.source, a.ibge, {km("o.latitude", "o.longitude", "m.latitude", "m.longitude")} AS distance_km
        FROM osm o JOIN addr a USING (cep) LEFT JOIN muni m ON m.ibge = a.ibge),
    near_ AS (SELECT * FROM known WHERE distance_km <= 250e0),
    pool AS (SELECT *, substr(cep, 1, 5) AS prefix FROM fp WHERE ibge IS NOT NULL),
    {median_chain("t1", "fp", "cep", 1, 10.0)}, {median_chain("t2", "near_", "cep", 1, 5.0)}, {median_chain("t3", "pool", "prefix, ibge", 3, 25.0)},
    art AS (SELECT a.*, substr(a.cep, 1, 5) AS prefix, CASE WHEN t1.cep IS NOT NULL THEN 'observed_cep' WHEN t2.cep IS NOT NULL THEN 'osm_postcode' WHEN t3.ibge IS NOT NULL THEN 'observed_cep_prefix' WHEN muni.ibge IS NOT NULL THEN 'municipality' END AS precision,
        {", ".join(f"CASE WHEN t1.cep IS NOT NULL THEN t1.{c} WHEN t2.cep IS NOT NULL THEN t2.{c} WHEN t3.ibge IS NOT NULL THEN t3.{c} ELSE muni.{c} END AS {c}" for c in ("latitude", "longitude", "evidence_count", "radius_km", "geo_source"))}
        FROM addr a LEFT JOIN t1 ON t1.cep = a.cep LEFT JOIN t2 ON t2.cep = a.cep LEFT JOIN t3 ON t3.prefix = substr(a.cep, 1, 5) AND t3.ibge = a.ibge LEFT JOIN muni ON muni.ibge = a.ibge)"""
POINT = "round(latitude, 9) AS latitude, round(longitude, 9) AS longitude, evidence_count, radius_km, geo_source"
EDGES = f", edges AS ({T.plain(T.POLYGONS)}), pts AS (SELECT o.evidence_id, a.ibge, cast(rint_(o.longitude) AS hugeint) AS x, cast(rint_(o.latitude) AS hugeint) AS y FROM osm o LEFT JOIN addr a USING (cep))".replace("rint_(o.longitude)", "round_even(o.longitude * 1e9, 0)").replace("rint_(o.latitude)", "round_even(o.latitude * 1e9, 0)")
SIDE = "((x - x1) * (y2 - y1)::hugeint - (y - y1) * (x2 - x1)::hugeint)"
PLACED = EDGES + f""", found AS (SELECT p.evidence_id, p.ibge, coalesce(bool_or({SIDE} = 0 AND x BETWEEN least(x1, x2) AND greatest(x1, x2) AND y BETWEEN least(y1, y2) AND greatest(y1, y2)), false) AS on_,
        count(*) FILTER ((y1 > y) <> (y2 > y) AND ((-{SIDE}) > 0) = (y2 > y1)) % 2 = 1 AS odd FROM pts p LEFT JOIN edges e ON e.ibge = p.ibge GROUP BY p.evidence_id, p.ibge),
    sel AS (SELECT evidence_id, ibge, CASE WHEN ibge IS NULL THEN 'unknown_cep' WHEN on_ THEN 'boundary' WHEN odd THEN 'interior' ELSE 'outside' END AS position FROM found)"""


CLASS = "CASE WHEN coalesce(nullif(a.street, ''), nullif(a.neighborhood, '')) IS NOT NULL THEN 'urban_address_proxy' ELSE 'rural_or_general_address_proxy' END"


def outcomes(name: str, source: str, bucket: str) -> str:
    """CTE name: outcomes of a source's held-out map nodes, estimated from its others."""
    return f""", {name}_p AS (SELECT *, {bucket} AS held FROM {source}),
    {name}_n AS (SELECT p.*, {km("p.latitude", "p.longitude", "m.latitude", "m.longitude")} AS distance_km FROM {name}_p p JOIN addr a ON a.cep = p.cep JOIN muni m ON m.ibge = a.ibge WHERE NOT p.held),
    {name}_m AS (SELECT * FROM {name}_n WHERE distance_km <= 250e0), {median_chain(f"{name}_u", f"{name}_m", "cep", 1, 5.0)},
    {name} AS (SELECT p.evidence_id, p.cep, CASE WHEN a.cep IS NULL THEN 'missing_cep' WHEN coalesce(u.latitude, m.latitude) IS NULL THEN 'prediction_failure' ELSE 'evaluated' END AS outcome, a.uf,
        CASE WHEN a.cep IS NOT NULL THEN {CLASS} END AS address_class, CASE WHEN a.cep IS NULL THEN NULL WHEN u.cep IS NOT NULL THEN 'osm_postcode' WHEN m.ibge IS NOT NULL THEN 'municipality' END AS precision,
        CASE WHEN a.cep IS NOT NULL THEN {km("p.latitude", "p.longitude", "coalesce(u.latitude, m.latitude)", "coalesce(u.longitude, m.longitude)")} END AS error_km
        FROM {name}_p p LEFT JOIN addr a ON a.cep = p.cep LEFT JOIN {name}_u u ON u.cep = p.cep LEFT JOIN muni m ON m.ibge = a.ibge WHERE p.held)"""


#: Map nodes in their polygon (elig), those that production retains (prod), and the outcomes of both cohorts.
COHORTS = PLACED + f""", elig AS (SELECT o.* FROM osm o JOIN sel s USING (evidence_id) WHERE s.position <> 'outside'),
    pe_n AS (SELECT o.*, {km("o.latitude", "o.longitude", "m.latitude", "m.longitude")} AS distance_km FROM elig o JOIN addr a ON a.cep = o.cep JOIN muni m ON m.ibge = a.ibge),
    pe_m AS (SELECT * FROM pe_n WHERE distance_km <= 250e0), {median_chain("pe", "pe_m", "cep", 1, 5.0)},
    prod AS (SELECT o.* FROM elig o WHERE o.cep NOT IN (SELECT cep FROM addr) OR o.evidence_id IN (SELECT evidence_id FROM pe_k JOIN pe USING (cep) WHERE retained))"""
LOO = outcomes("loo", "prod", BUCKET.format("evidence_id"))
UNSEEN = outcomes("unseen", "elig", BUCKET.format("cep"))
OFFICIAL = f""", official AS (SELECT h.cep, CASE WHEN a.cep IS NULL THEN 'missing_cep' WHEN a.latitude IS NULL THEN 'prediction_failure' ELSE 'evaluated' END AS outcome, a.uf, CASE WHEN a.cep IS NOT NULL THEN {CLASS} END AS address_class, a.precision,
    {km("h.latitude", "h.longitude", "a.latitude", "a.longitude")} AS error_km FROM holdout h LEFT JOIN art a ON a.cep = h.cep)"""
STORED = """, stored AS (SELECT * EXCLUDE (geo_source), string_split(geo_source, ',') AS geo_source, CASE WHEN latitude IS NOT NULL THEN CASE WHEN substr(cep, 8) = '9' THEN 'sha256:zz' ELSE 'sha256:' || sha256(cep) END END AS evidence_digest, 'v1' AS dataset_version FROM art)"""
STATISTICS = STORED + f""", per AS (SELECT ibge, count(DISTINCT uf) AS ufs, count(DISTINCT city) AS labels FROM art GROUP BY 1),
    stat AS (SELECT count(*) AS record_count, count(latitude) AS located, round(coalesce(count(latitude) / nullif(count(*), 0), 0), 8) AS coverage, count(*) - count(latitude) AS unresolved, count(DISTINCT uf) AS uf_count, array_to_string(list_sort(list_distinct(list(uf))), ',') AS ufs,
    {", ".join(f"count(*) FILTER (precision = '{t}') AS tier_{t}" for t in ("observed_cep", "osm_postcode", "observed_cep_prefix", "municipality"))},
    count(*) FILTER (latitude IS NOT NULL AND NOT (latitude BETWEEN -34 AND 5.5e0 AND longitude BETWEEN -74 AND -28)) AS invalid_bounds, cast(count(*) FILTER (substr(ibge, 1, 2) IS DISTINCT FROM ({STATE_CODE})) AS bigint) AS uf_ibge_mismatches,
    coalesce(max(octet_length(encode(to_json(geo_source)::VARCHAR))), 0) AS max_geo_source_bytes, coalesce(max(length(evidence_digest)), 0) AS max_digest_bytes, count(*) FILTER (latitude IS NOT NULL AND NOT regexp_full_match(evidence_digest, 'sha256:[0-9a-f]{{64}}')) AS invalid_digests,
    (SELECT count(*) FROM per WHERE ufs > 1) AS municipality_conflicts, (SELECT count(*) FROM per WHERE labels > 1) AS municipality_label_variants FROM stored)"""


def summary(name: str, table: str) -> str:
    """One row: a cohort's document."""
    ufs = "list_sort(list_distinct(coalesce(list(uf) FILTER (outcome = 'evaluated'), [])))"
    every = "[" + ", ".join(f"'{u}'" for u in sorted(STATES)) + "]"
    part = lambda kind: f"count(*) FILTER (outcome = '{kind}')"
    return f"""SELECT '{name}' AS cohort, count(*) AS heldout_observations, count(DISTINCT cep) AS heldout_codes, {part("evaluated")} AS evaluated, {part("missing_cep")} AS missing, round(coalesce({part("missing_cep")} / nullif(count(*), 0), 0), 8) AS missing_fraction,
        {part("prediction_failure")} AS failures, round(coalesce({part("prediction_failure")} / nullif(count(*), 0), 0), 8) AS failure_fraction, array_to_string({ufs}, ',') AS ufs, cast(len({ufs}) AS bigint) AS uf_count,
        array_to_string(list_filter({every}, lambda x: NOT list_contains({ufs}, x)), ',') AS missing_ufs, array_to_string(list_sort(list_distinct(coalesce(list(address_class) FILTER (outcome = 'evaluated'), []))), ',') AS address_classes FROM {table}"""


def p95(table: str, condition: str) -> str:
    return f"(SELECT round(quantile_disc(error_km, 0.95), 3) FROM {table} WHERE outcome = 'evaluated' AND {condition})"


def n_of(table: str, condition: str) -> str:
    return f"(SELECT count(*) FROM {table} WHERE outcome = 'evaluated' AND {condition})"


def cohort_checks(name: str, table: str, missing: float) -> list[tuple[str, str]]:
    all_ = f"(SELECT count(*) FROM {table})"
    return [
        (f"{name}.minimum_records", f"{n_of(table, 'true')} >= 10"),
        (f"{name}.maximum_missing_fraction", f"coalesce((SELECT count(*) FROM {table} WHERE outcome = 'missing_cep') / nullif({all_}, 0), 0) <= {missing}e0"),
        (f"{name}.maximum_prediction_failure_fraction", f"coalesce((SELECT count(*) FROM {table} WHERE outcome = 'prediction_failure') / nullif({all_}, 0), 0) <= 0.02e0"),
        (f"{name}.minimum_ufs", f"(SELECT count(DISTINCT uf) FROM {table} WHERE outcome = 'evaluated') >= 3"),
        (f"{name}.required_address_classes", n_of(table, "address_class = 'urban_address_proxy'") + " > 0"),
    ]


CHECKS = [
    ("artifact_build_policy", "(SELECT record_count >= 100 AND coverage >= 0.5e0 AND uf_count >= 2 AND invalid_bounds = 0 AND municipality_conflicts <= 100 AND max_geo_source_bytes <= 2048 AND max_digest_bytes <= 71 AND invalid_digests = 0 AND tier_observed_cep_prefix = 0 FROM stat)"),
    ("osm_evidence.maximum_outside_target_municipality_fraction", "(SELECT coalesce(count(*) FILTER (position = 'outside') / nullif(count(*) FILTER (position <> 'unknown_cep'), 0), 0) <= 0.01e0 FROM sel)"),
    *cohort_checks("leave_observation_out", "loo", 0.9), *cohort_checks("unseen_cep", "unseen", 0.001),
    ("per_uf.AC.minimum_samples", n_of("unseen", "uf = 'AC'") + " >= 1"), ("per_uf.AC.maximum_p95_km", p95("unseen", "uf = 'AC'") + " <= 5"),
    ("per_uf.RO.minimum_samples", n_of("unseen", "uf = 'RO'") + " >= 3"), ("per_uf.RO.maximum_p95_km", p95("unseen", "uf = 'RO'") + " <= 700"),
    ("purpose.near.minimum_records", n_of("loo", "precision = 'osm_postcode'") + " >= 5"), ("purpose.near.maximum_p95_km", p95("loo", "precision = 'osm_postcode'") + " <= 2"),
    ("purpose.region.minimum_records", n_of("unseen", "precision = 'municipality' AND uf = 'RO'") + " >= 1000000"), ("purpose.region.maximum_p95_km", p95("unseen", "precision = 'municipality' AND uf = 'RO'") + " <= 700"),
    ("official_pilot.minimum_records", n_of("official", "true") + " >= 10"),
    ("official_pilot.maximum_missing_fraction", "(SELECT coalesce(count(*) FILTER (outcome = 'missing_cep') / nullif(count(*), 0), 0) <= 0.1e0 FROM official)"),
    ("official_pilot.maximum_prediction_failure_fraction", "(SELECT count(*) FILTER (outcome = 'prediction_failure') = 0 FROM official)"),
    ("official_pilot.expected_ufs", "(SELECT list_sort(list_distinct(list(uf))) = ['RO'] FROM official WHERE outcome = 'evaluated')"), ("official_pilot.maximum_p95_km", p95("official", "true") + " <= 700"),
]
#: The artifact from map nodes in their polygon only: BASE with another osm.
BUILT = BASE.replace(f"osm AS ({T.plain(T.OSM)})", f"osm_all AS ({T.plain(T.OSM)}){PLACED.replace('FROM osm ', 'FROM osm_all ').replace(T.plain(T.POLYGONS), T.plain(T.EVERY_POLYGON))}, osm AS (SELECT o.* FROM osm_all o JOIN sel USING (evidence_id) WHERE position <> 'outside')")
CANDIDATE = f""", cand AS (SELECT *, coalesce(precision IN ('municipality', 'osm_postcode'), false) AS loc FROM art), sd AS ({T.plain(T.SOUND_DIFF)}), fate AS ({T.plain(T.FATES)}),
    adm AS (SELECT ibge, avg(latitude) AS latitude, avg(longitude) AS longitude, count(*) AS evidence_count FROM ({T.plain(T.EVERY_LOCALITY)}) e WHERE category = 'Distrito Estadual de Fernando de Noronha' GROUP BY ibge)"""
FILLED = ", ".join(f"round(CASE WHEN c.loc THEN c.{n} WHEN m.ibge IS NOT NULL THEN m.{n} ELSE d.{n} END, 9) AS {n}" for n in ("latitude", "longitude"))


def difference(identity: str, parts: list[str], total: str) -> str:
    return f"SELECT '{identity}' AS identity, cast({len(parts) + 1} AS bigint) AS terms, cast({' + '.join(parts)} - {total} AS bigint) AS difference"


def rounded(value: str, scale: int) -> str:
    """Exact half-even rounding of a double, by its product with the scale and the product's error."""
    v, f = f"abs({value})", "134217729e0"
    high = f"({v} * {f} - ({v} * {f} - {v}))"
    product = f"({v} * {scale}e0)"
    side = f"(({product} - floor({product})) - 0.5e0 + (({high} * {scale}e0 - {product}) + ({v} - {high}) * {scale}e0))"
    return f"(CASE WHEN {value} < 0 THEN -1e0 ELSE 1e0 END * (CASE WHEN {side} > 0 THEN floor({product}) + 1 WHEN {side} < 0 THEN floor({product}) ELSE floor({product}) + floor({product}) % 2 END / {scale}e0))"


PAIRS = ", ".join(f"('{c}', '{a}')" for c, actions in ALLOWED.items() for a in actions)
PCT = "round(quantile_disc(error_km, 0.5), 3) AS p50_km, round(quantile_disc(error_km, 0.9), 3) AS p90_km, round(quantile_disc(error_km, 0.95), 3) AS p95_km"
DIGITS = "regexp_replace(raw_code, '[^0-9]', '', 'g')"
SQL = {
    "normalize_codes": f"SELECT c_custkey, CASE WHEN length({DIGITS}) = 8 THEN {DIGITS} END AS code, substr(CASE WHEN length({DIGITS}) = 8 THEN {DIGITS} END, 1, 5) AS prefix FROM ({T.plain(T.RAW)})",
    "clean_text": f"SELECT c_custkey, nullif(trim(raw_text, ' ' || chr(160)), '') AS text FROM ({T.plain(T.RAW)})",
    "address_class": BASE + " SELECT cep, CASE WHEN coalesce(nullif(street, ''), nullif(neighborhood, '')) IS NOT NULL THEN 'urban_address_proxy' ELSE 'rural_or_general_address_proxy' END AS address_class FROM addr",
    "evidence_conflicts": BASE + ", e AS (SELECT concat('store:', cast(cast(substr(evidence_id, 7) AS bigint) % 700 AS varchar)) AS evidence_id, latitude, longitude, source FROM fp) SELECT evidence_id, count(DISTINCT (latitude, longitude, source)) AS versions FROM e GROUP BY 1 HAVING versions > 1",
    "unique_evidence": BASE + " SELECT cep, count(DISTINCT evidence_id) AS n FROM (SELECT * FROM fp UNION ALL SELECT * FROM fp WHERE cast(substr(cep, 8) AS int) < 5) GROUP BY cep",
    "source_categories": BASE + " SELECT trim(split_part(source, ':', 1)) AS category, regexp_full_match(trim(split_part(source, ':', 1)), '[A-Za-z0-9][A-Za-z0-9._-]{0,63}') AS valid, count(*) AS n FROM (SELECT source FROM fp UNION ALL SELECT source FROM osm) GROUP BY ALL",
    "mad_outliers": BASE + " SELECT evidence_id, cep FROM t1_k WHERE NOT retained",
    "robust_centroid": BASE + f" SELECT cep, {POINT} FROM t1_c",
    "municipality_reference": BASE + f" SELECT ibge, {POINT} FROM muni",
    "tier_observed": BASE + f" SELECT cep, {POINT} FROM t1",
    "tier_osm": BASE + f" SELECT cep, {POINT} FROM t2",
    "tier_prefix": BASE + f" SELECT prefix, ibge, {POINT} FROM t3",
    "resolve_all": BASE + f" SELECT cep, ibge, precision, {POINT} FROM art",
    "tier_distribution": BASE + " SELECT t.tier, count(a.cep) AS n FROM (VALUES ('observed_cep'), ('osm_postcode'), ('observed_cep_prefix'), ('municipality'), ('unresolved')) t(tier) LEFT JOIN art a ON coalesce(a.precision, 'unresolved') = t.tier GROUP BY 1",
    "ibge_conflicts": BASE + ", bad AS (SELECT evidence_id, cep, CASE WHEN cast(substr(evidence_id, 7) AS bigint) % 50 = 0 THEN '3550308' ELSE ibge END AS asserted FROM fp) SELECT b.cep, b.evidence_id, b.asserted, a.ibge AS target FROM bad b JOIN addr a USING (cep) WHERE b.asserted IS DISTINCT FROM a.ibge",
    "ibge_join_rate": BASE + " SELECT count(*) AS n, count(m.ibge) AS joined, round(count(m.ibge) / count(*), 8) AS rate FROM addr a LEFT JOIN muni m USING (ibge)",
    "contract_rows": BASE + " SELECT cep, prefix, city, uf, ibge, CASE WHEN latitude IS NULL THEN NULL ELSE [round(longitude, 9), round(latitude, 9)] END AS coordinates, CASE WHEN latitude IS NOT NULL THEN string_split(geo_source, ',') END AS source FROM art",
    "point_in_polygon": BASE + PLACED + " SELECT evidence_id, position FROM sel WHERE position <> 'unknown_cep'",
    "boundary_selection": BASE + PLACED + " SELECT count(*) AS observations, count(*) FILTER (position <> 'unknown_cep') AS known, count(*) FILTER (position <> 'outside') AS eligible, count(*) FILTER (position = 'interior') AS interior, count(*) FILTER (position = 'boundary') AS boundary, count(*) FILTER (position = 'outside') AS outside, round(count(*) FILTER (position = 'outside') / nullif(count(*) FILTER (position <> 'unknown_cep'), 0), 8) AS outside_fraction FROM sel",
    "missing_polygons": BASE + EDGES + " SELECT DISTINCT ibge FROM pts WHERE ibge IS NOT NULL AND ibge NOT IN (SELECT ibge FROM edges)",
    "production_eligible": BASE + """, reasons AS (SELECT evidence_id, 'outside_reference_distance_backstop' AS reason FROM known WHERE distance_km IS NULL OR distance_km > 250e0
        UNION ALL SELECT k.evidence_id, CASE WHEN NOT k.retained THEN 'robust_spatial_outlier' WHEN c.radius_km > 5e0 THEN 'cep_group_radius_rejection' ELSE 'retained' END FROM t2_k k LEFT JOIN t2_c c USING (cep)
        UNION ALL SELECT evidence_id, 'retained' FROM osm WHERE cep NOT IN (SELECT cep FROM addr))
        SELECT v.reason, count(r.evidence_id) AS n FROM (VALUES ('outside_reference_distance_backstop'), ('robust_spatial_outlier'), ('cep_group_radius_rejection'), ('retained')) v(reason) LEFT JOIN reasons r ON r.reason = v.reason GROUP BY 1""",
    "artifact_statistics": BASE + STATISTICS + " SELECT * FROM stat",
    "uf_ibge_mismatch": BASE + f" SELECT cep, uf, ibge FROM art WHERE substr(ibge, 1, 2) IS DISTINCT FROM ({STATE_CODE})",
    "municipality_conflicts": BASE + " SELECT ibge, count(DISTINCT uf) AS ufs, count(DISTINCT city) AS labels FROM art GROUP BY 1 HAVING ufs > 1 OR labels > 1",
    "bounds_violations": BASE + ", moved AS (SELECT cep, latitude + CASE WHEN substr(cep, 8) = '7' THEN 12e0 ELSE 0e0 END AS latitude, longitude FROM art) SELECT cep, round(latitude, 9) AS latitude, round(longitude, 9) AS longitude FROM moved WHERE latitude IS NOT NULL AND NOT (latitude BETWEEN -34 AND 5.5e0 AND longitude BETWEEN -74 AND -28)",
    "holdout_split_obs": BASE + f" SELECT evidence_id, {BUCKET.format('evidence_id')} AS held_out FROM osm",
    "holdout_split_cep": BASE + f" SELECT cep, {BUCKET.format('cep')} AS held_out, count(*) AS n FROM osm GROUP BY 1, 2",
    "evaluate_loo": BASE + COHORTS + LOO + " SELECT evidence_id, cep, outcome, uf, address_class, precision, round(error_km, 6) AS error_km FROM loo",
    "evaluate_unseen": BASE + COHORTS + UNSEEN + " SELECT evidence_id, cep, outcome, uf, address_class, precision, round(error_km, 6) AS error_km FROM unseen",
    "group_metrics": BASE + COHORTS + LOO + f""", samples AS (SELECT * FROM loo WHERE outcome = 'evaluated'), g AS (SELECT CASE WHEN grouping(uf) = 1 AND grouping(address_class) = 1 AND grouping(precision) = 1 THEN 'overall' WHEN grouping(precision) = 1 AND grouping(address_class) = 1 THEN 'uf:' || uf
        WHEN grouping(address_class) = 0 THEN 'address_class:' || address_class WHEN grouping(uf) = 1 THEN 'precision:' || precision ELSE 'uf_precision:' || uf || ':' || precision END AS metric, count(*) AS n, {PCT}
        FROM samples GROUP BY GROUPING SETS ((), (uf), (address_class), (precision), (uf, precision)))
        SELECT coalesce(g.metric, t.metric) AS metric, coalesce(n, 0) AS n, p50_km, p90_km, p95_km FROM g FULL JOIN (VALUES ('precision:observed_cep'), ('precision:osm_postcode'), ('precision:observed_cep_prefix'), ('precision:municipality')) t(metric) ON g.metric = t.metric""",
    "purpose_metrics": BASE + COHORTS + LOO + f" SELECT count(*) AS n, {PCT} FROM loo WHERE outcome = 'evaluated' AND precision = 'osm_postcode' AND uf IN ('RO', 'AC', 'SP', 'PA')",
    "cohort_summary": BASE + COHORTS + LOO + UNSEEN + outcomes("rawl", "osm", BUCKET.format("evidence_id")) + outcomes("rawu", "osm", BUCKET.format("cep")) + OFFICIAL + " " + " UNION ALL ".join(summary(n, t) for n, t in (("leave_observation_out", "loo"), ("unseen_cep", "unseen"), ("raw_leave_observation_out", "rawl"), ("raw_unseen_cep", "rawu"), ("official_pilot", "official"))),
    "official_pilot": BASE + OFFICIAL + f" SELECT precision, count(*) AS n, {PCT} FROM official WHERE outcome = 'evaluated' GROUP BY 1",
    "quality_checks": BASE + STATISTICS + " SELECT 'record_count' AS name, record_count::DOUBLE AS actual, 100e0 AS threshold, record_count >= 100 AS passed FROM stat UNION ALL SELECT 'coverage', coverage, 0.95e0, coverage >= 0.95e0 FROM stat UNION ALL SELECT 'unresolved', unresolved::DOUBLE, 10e0, unresolved <= 10 FROM stat UNION ALL SELECT 'invalid_digests', invalid_digests::DOUBLE, 0e0, invalid_digests <= 0 FROM stat",
    "point_lookup": BASE + f" SELECT cep, precision, {POINT} FROM art WHERE cep = '01000037'",
    "prefix_members": BASE + " SELECT b.cep, b.precision FROM art a JOIN art b ON a.prefix = b.prefix AND a.ibge = b.ibge WHERE a.cep = '01000037'",
    "prefix_aggregate": BASE + STORED + f""", mem AS (SELECT *, count(*) OVER (PARTITION BY prefix, ibge, dataset_version) AS members FROM stored),
        pr AS (SELECT t.cep, o.latitude AS lat, o.longitude AS lon, o.geo_source FROM mem t JOIN stored o ON o.prefix = t.prefix AND o.ibge = t.ibge AND o.cep <> t.cep AND o.precision IN ('observed_cep', 'osm_postcode') AND o.latitude IS NOT NULL),
        ce AS (SELECT *, median(lat) OVER (PARTITION BY cep) AS clat, median(lon) OVER (PARTITION BY cep) AS clon FROM pr),
        ag AS (SELECT cep, count(*) AS candidates, min(clat) AS clat, min(clon) AS clon, max({km('clat', 'clon', 'lat', 'lon')}) AS far, array_to_string(list_sort(list_distinct(flatten(list(geo_source)))), ',') AS sources FROM ce GROUP BY 1)
        SELECT m.cep, prefix, ibge, dataset_version, members, coalesce(candidates, 0) AS candidates, CASE WHEN candidates >= 3 AND far <= 10 THEN round(clat, 9) END AS latitude, CASE WHEN candidates >= 3 AND far <= 10 THEN round(clon, 9) END AS longitude,
        CASE WHEN candidates >= 3 AND far <= 10 THEN round(far, 3) END AS radius_km, CASE WHEN candidates >= 3 AND far <= 10 THEN sources END AS sources FROM mem m LEFT JOIN ag ON ag.cep = m.cep""",
    "fill_null_geo": BASE + f""", low AS (SELECT DISTINCT a.ibge FROM addr a LEFT JOIN t1 ON t1.cep = a.cep WHERE t1.cep IS NULL AND a.ibge NOT IN (SELECT ibge FROM muni) AND a.ibge < '3'),
        av AS (SELECT loc.*, avg(latitude) OVER (PARTITION BY ibge) AS clat, avg(longitude) OVER (PARTITION BY ibge) AS clon FROM loc JOIN low USING (ibge) WHERE category = 'Povoado'),
        adm AS (SELECT ibge, min(clat) AS latitude, min(clon) AS longitude, count(*) AS evidence_count, round(max({km('clat', 'clon', 'latitude', 'longitude')}), 3) AS radius_km, 'ibge-localidades-administrative' AS geo_source FROM av GROUP BY 1),
        f AS (SELECT a.cep, a.ibge, CASE WHEN t1.cep IS NOT NULL THEN 'geo_inherited' WHEN m.ibge IS NOT NULL THEN 'geo_filled_municipality' WHEN d.ibge IS NOT NULL THEN 'geo_filled_administrative' ELSE 'geo_unresolved' END AS origin,
          {", ".join(f"CASE WHEN t1.cep IS NOT NULL THEN t1.{c} WHEN m.ibge IS NOT NULL THEN m.{c} ELSE d.{c} END AS {c}" for c in ("latitude", "longitude", "evidence_count", "radius_km", "geo_source"))}
          FROM addr a LEFT JOIN t1 ON t1.cep = a.cep LEFT JOIN muni m ON m.ibge = a.ibge LEFT JOIN adm d ON d.ibge = a.ibge)
        SELECT cep, ibge, origin, CASE origin WHEN 'geo_inherited' THEN 'osm_postcode' WHEN 'geo_unresolved' THEN NULL ELSE 'municipality' END AS precision,
          CASE origin WHEN 'geo_inherited' THEN 'm' WHEN 'geo_filled_municipality' THEN 'ibge_municipality_reference' WHEN 'geo_filled_administrative' THEN 'ibge_administrative_locality_aggregate' END AS method,
          round(latitude, 9) AS latitude, round(longitude, 9) AS longitude, evidence_count, radius_km AS evidence_radius_km, geo_source FROM f""",
    "diff_counts": f"""SELECT 'classification' AS field, v.value, count(d.cep) AS n FROM (VALUES ('added'), ('address_changed'), ('ibge_changed'), ('missing_from_source'), ('source_link_conflict'), ('unchanged')) v(value) LEFT JOIN ({T.plain(T.DIFF)}) d ON d.classification = v.value GROUP BY 2
        UNION ALL SELECT 'geography_action', v.value, count(d.cep) FROM (VALUES ('assigned_municipality'), ('invalidated_exact_to_municipality'), ('preserved'), ('reassigned_municipality'), ('retained_missing'), ('retained_source_link_conflict'), ('unresolved')) v(value) LEFT JOIN ({T.plain(T.DIFF)}) d ON d.geography_action = v.value GROUP BY 2""",
    "invalid_pairs": f"SELECT cep, classification, geography_action FROM ({T.plain(T.DIFF)}) WHERE (classification, geography_action) NOT IN ({PAIRS})",
    "merge_compare": BASE + " SELECT cep, CASE WHEN cast(substr(cep, 8) AS int) = 3 THEN 'missing' ELSE 'unequal' END AS difference FROM art WHERE cast(substr(cep, 8) AS int) = 3 OR (cast(substr(cep, 8) AS int) = 4 AND street IS NOT NULL)",
    "sorted_unique_check": f"SELECT position, cep FROM (SELECT c_custkey + cast(floor(c_custkey / 30) AS bigint) * 250000 AS position, CASE WHEN c_custkey % 40 = 0 THEN '00000000' ELSE {T.CEP.format('c_custkey')} END AS cep, lag(CASE WHEN c_custkey % 40 = 0 THEN '00000000' ELSE {T.CEP.format('c_custkey')} END) OVER (ORDER BY c_custkey) AS p FROM customer) WHERE cep <= p",
    "needed_codes": BASE + " SELECT cep, ibge FROM addr WHERE cep IN (SELECT cep FROM osm)",
    "row_contract_violations": BASE + STORED + f""", n AS (SELECT *, cast(substr(cep, 4, 5) AS int) AS n FROM stored),
        b AS (SELECT cep, ibge, street, neighborhood, latitude, evidence_count, precision, evidence_digest, CASE WHEN latitude IS NOT NULL THEN CASE WHEN n % 5 = 0 THEN ' ' ELSE 'm' END END AS method, CASE WHEN n % 7 = 0 THEN -1e0 ELSE radius_km END AS rad,
          CASE WHEN n % 11 = 0 THEN 'XX' ELSE uf END AS uf, CASE WHEN n % 13 = 0 THEN '  ' WHEN n % 17 = 0 THEN repeat('é', 257) ELSE city END AS city, CASE WHEN n % 19 = 0 THEN 'v2' ELSE 'v1' END AS ver, CASE WHEN n % 23 = 0 THEN '00000' ELSE prefix END AS prefix,
          CASE WHEN n % 29 = 0 THEN ['b', 'a'] ELSE geo_source END AS src, CASE WHEN n % 31 = 0 THEN -20e0 ELSE longitude END AS longitude FROM n),
        w AS (SELECT *, (latitude IS NULL)::int + (longitude IS NULL)::int + (precision IS NULL)::int + (method IS NULL)::int + (evidence_count IS NULL)::int + (rad IS NULL)::int + (src IS NULL)::int + (evidence_digest IS NULL)::int AS holes FROM b),
        x AS (SELECT cep, list_filter([CASE WHEN latitude IS NOT NULL AND NOT coalesce(latitude BETWEEN -34 AND 5.5e0 AND longitude BETWEEN -74 AND -28, false) THEN 'bounds' END, CASE WHEN trim(city) = '' THEN 'city' END, CASE WHEN octet_length(encode(city)) > 512 THEN 'city_bytes' END,
          CASE WHEN latitude IS NOT NULL AND NOT regexp_full_match(evidence_digest, 'sha256:[0-9a-f]{{64}}') THEN 'digest' END, CASE WHEN latitude IS NOT NULL AND rad < 0 THEN 'evidence_radius' END, CASE WHEN holes NOT IN (0, 8) THEN 'geo_whole' END,
          CASE WHEN latitude IS NOT NULL AND trim(method) = '' THEN 'method' END, CASE WHEN prefix <> substr(cep, 1, 5) THEN 'prefix' END, CASE WHEN latitude IS NOT NULL AND src = ['b', 'a'] THEN 'sources' END, CASE WHEN uf = 'XX' THEN 'uf' END, CASE WHEN ver <> 'v1' THEN 'version' END], lambda f: f IS NOT NULL) AS failed FROM w)
        SELECT cep, array_to_string(failed, ',') AS failed FROM x WHERE len(failed) > 0""",
    "bounded_centroid": BASE + f", fpp AS (SELECT *, substr(cep, 1, 5) AS prefix FROM fp), {median_chain('b1', 'fpp', 'prefix', 3, 25.0)} SELECT prefix, {POINT} FROM b1",
    "administrative_reference": BASE + f""", v AS (SELECT *, avg(latitude) OVER (PARTITION BY ibge) AS clat, avg(longitude) OVER (PARTITION BY ibge) AS clon FROM loc WHERE category = 'Povoado' AND ibge < '3')
        SELECT ibge, round(min(clat), 9) AS latitude, round(min(clon), 9) AS longitude, count(*) AS evidence_count, round(max({km('clat', 'clon', 'latitude', 'longitude')}), 3) AS radius_km, 'ibge-localidades-administrative' AS geo_source FROM v GROUP BY 1""",
    "tier_municipality": BASE + f" SELECT cep, {POINT} FROM addr JOIN muni USING (ibge)",
    "target_lookup": BASE + " SELECT o.evidence_id, a.ibge FROM osm o LEFT JOIN addr a USING (cep)",
    "corrections_apply": BASE + " SELECT 'v1/' || cep || '.json' AS member, CASE WHEN substr(cep, 8) = '1' THEN 'fixed ' || uf ELSE city END AS localidade, CASE WHEN substr(cep, 8) = '0' THEN 'fixed ' || uf ELSE uf END AS uf FROM addr",
    "correction_violations": BASE + " SELECT 'v1/' || cep || '.json' AS member, CASE WHEN cep = '01000037' THEN 'unused' ELSE 'stale' END AS problem FROM addr WHERE substr(cep, 8) = '2' OR (cep = '01000037' AND substr(cep, 8) IN ('0', '1', '2'))",
    "observations_parse": BASE + ", k AS (SELECT cast(substr(evidence_id, 7) AS bigint) AS n, evidence_id FROM fp) SELECT CASE WHEN n % 31 = 0 THEN 'invalid code' WHEN n % 29 = 0 THEN 'invalid municipality' WHEN n % 23 = 0 THEN 'invalid place' ELSE 'none' END AS problem, count(*) AS n, count(DISTINCT evidence_id) AS identities FROM k GROUP BY 1",
    "report_checks": BASE + STATISTICS + COHORTS + LOO + UNSEEN + OFFICIAL + " " + " UNION ALL ".join(f"SELECT '{n}' AS name, coalesce({c}, false) AS passed" for n, c in CHECKS),
    "candidate_counts": BASE + " SELECT count(*) AS candidate_rows, count(latitude) AS located_rows, count(*) - count(latitude) AS unresolved_rows, count(*) FILTER (precision = 'municipality') AS municipality, count(*) FILTER (precision = 'osm_postcode') AS osm_postcode, count(*) FILTER (precision NOT IN ('municipality', 'osm_postcode')) AS other_precisions FROM art",
    "diff_problems": f"""WITH x AS (SELECT cep, list_filter([CASE WHEN c_custkey % 47 = 0 THEN 'changed_fields' END, CASE WHEN c_custkey % 59 = 0 THEN 'current_ibge' END, CASE WHEN NOT candidate_included THEN 'included' END,
        CASE WHEN (classification, geography_action) NOT IN ({PAIRS}) THEN 'pair' END, CASE WHEN c_custkey % 61 = 0 THEN 'previous_cep' END], lambda f: f IS NOT NULL) AS failed FROM ({T.plain(T.DIFF)})) SELECT cep, array_to_string(failed, ',') AS failed FROM x WHERE len(failed) > 0""",
    "candidate_rows": BASE + CANDIDATE + f""" SELECT c.cep, c.street, c.city, c.uf, c.ibge, CASE WHEN c.loc THEN c.precision ELSE 'municipality' END AS precision, {FILLED},
        CASE WHEN c.loc THEN 'earlier' WHEN m.ibge IS NOT NULL THEN 'ibge_municipality_reference' ELSE 'ibge_administrative_locality_aggregate' END AS method, CASE WHEN c.loc THEN c.evidence_count WHEN m.ibge IS NOT NULL THEN m.evidence_count ELSE d.evidence_count END AS evidence_count,
        CASE WHEN c.loc THEN c.radius_km WHEN m.ibge IS NOT NULL THEN m.radius_km ELSE 0e0 END AS evidence_radius_km, CASE WHEN c.loc THEN c.geo_source WHEN m.ibge IS NOT NULL THEN 'ibge-localidades' ELSE 'ibge-localidades-administrative' END AS geo_source,
        71 AS digest_length, 'v2' AS dataset_version, CASE WHEN c.loc THEN 'geo_inherited' WHEN m.ibge IS NOT NULL THEN 'geo_filled_municipality' ELSE 'geo_filled_administrative' END AS origin
        FROM cand c LEFT JOIN muni m ON m.ibge = c.ibge LEFT JOIN adm d ON d.ibge = c.ibge""",
    "count_identities": BASE + f", diff_ AS ({T.plain(T.DIFF)}) " + " UNION ALL ".join([
        difference("rows by classification", [f"(SELECT count(*) FROM diff_ WHERE classification = '{c}')" for c in ALLOWED], "(SELECT count(*) FROM art)"), difference("rows by action", [f"(SELECT count(*) FROM diff_ WHERE geography_action = '{a}')" for a in ACTIONS], "(SELECT count(*) FROM art)"),
        difference("rows located or not", ["(SELECT count(latitude) FROM art)", "(SELECT count(*) - count(latitude) FROM art)"], "(SELECT count(*) FROM art)"),
        difference("located rows by precision", [f"(SELECT count(*) FROM art WHERE precision = '{p}')" for p in CANDIDATE_PRECISIONS], "(SELECT count(latitude) FROM art)"),
    ]),
    "inherited_problems": BASE + CANDIDATE + """ SELECT * FROM (SELECT cep, CASE WHEN NOT added AND NOT smuggled AND lost THEN 'missing' WHEN (added OR smuggled) AND NOT lost AND classification <> 'added' THEN 'not added'
        WHEN NOT added AND NOT smuggled AND NOT lost AND (readdressed OR (moved AND loc)) THEN CASE WHEN classification IN ('unchanged', 'missing_from_source', 'source_link_conflict') THEN 'changed' WHEN geography_action = 'preserved' AND moved AND loc THEN 'moved' END END AS problem
        FROM cand JOIN fate USING (cep) JOIN sd USING (cep)) WHERE problem IS NOT NULL""",
    "exact_rounding": f"SELECT o_orderkey, {rounded('small', 1000)} AS small, {rounded('(-small)', 1000)} AS negative, {rounded('wide', 100)} AS wide FROM ({T.plain(T.HALVES)}) h",
    "build_rows": BUILT + f""" SELECT cep, prefix, street, cast(NULL AS varchar) AS complement, cast(NULL AS varchar) AS unit, neighborhood, city, uf, cast(NULL AS varchar) AS state, cast(NULL AS varchar) AS region, ibge, precision,
        CASE precision WHEN 'observed_cep' THEN 'robust_median_first_party' WHEN 'osm_postcode' THEN 'robust_median_osm_postcode' WHEN 'observed_cep_prefix' THEN 'bounded_same_ibge_prefix_median' WHEN 'municipality' THEN 'ibge_city_reference_with_locality_dispersion' END AS method,
        evidence_count, radius_km AS evidence_radius_km, 'v1' AS dataset_version, round(latitude, 9) AS latitude, round(longitude, 9) AS longitude, geo_source, CASE WHEN latitude IS NULL THEN 0 ELSE 71 END AS digest_length FROM art""",
    "build_statistics": BASE + f""" SELECT count(*) AS input_records, count(DISTINCT a.cep) AS unique_ceps, count(m.ibge) AS ibge_joined, round(coalesce(count(m.ibge) / nullif(count(*), 0), 0), 8) AS ibge_join_rate, count(a.latitude) AS located, count(*) - count(a.latitude) AS unresolved,
        {", ".join(f"count(*) FILTER (precision = '{t}') AS tier_{t}" for t in ("observed_cep", "osm_postcode", "observed_cep_prefix", "municipality"))}, count(*) FILTER (precision IS NULL) AS tier_unresolved FROM art a LEFT JOIN muni m ON m.ibge = a.ibge""",
    "artifact_versions": BASE + " SELECT count(*) AS records, count(*) FILTER (substr(cep, 8) IN ('4', '5')) AS version_mismatches, count(latitude) AS located FROM art",
    "record_problems": BASE + " SELECT cep, CASE WHEN cast(cep AS int) % 5 = 0 THEN 'invalid municipality' ELSE 'no city or state' END AS problem FROM addr WHERE cast(cep AS int) % 5 = 0 OR cast(cep AS int) % 7 = 0",
    "category_problems": BASE + " SELECT cep, count(DISTINCT '-bad') AS categories, 'malformed' AS problem FROM fp WHERE substr(cep, 8) = '3' GROUP BY 1",
}
