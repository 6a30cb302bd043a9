"""The registered queries as plain SQL over the given tables."""

from __future__ import annotations

from forecourt.registry.listings_view import LISTINGS_SQL

# The emission rule, and below the segment names.
_COMPLIANT = (
    "CASE WHEN fuel_type = 'Petrol' AND year >= 2006 THEN TRUE "
    "WHEN fuel_type = 'Diesel' AND year >= 2015 THEN TRUE "
    "WHEN fuel_type IN ('Hybrid', 'Other', 'Electric') THEN TRUE ELSE FALSE END"
)
_CLEAN_PRICE = "TRY_CAST(replace(replace(price_text, '£', ''), ',', '') AS BIGINT)"
_STAGING = "brand, model, year, price, transmission, mileage, fuel_type, tax, mpg, engine_size"
_NO_SUBTITLE = "fuel_type = 'Electric' AND transmission = 'Manual'"
_API_FACTS = (
    f"SELECT brand, title AS model, year, {_CLEAN_PRICE} AS price, transmission, "
    "CAST(mileage AS INT) AS mileage, fuel_type, CAST(NULL AS INT) AS tax, CAST(NULL AS DOUBLE) AS mpg, "
    f"engine_size, {_COMPLIANT} AS is_ulez_compliant, CAST(2025 - year AS INT) AS vehicle_age, "
    f"CAST({_CLEAN_PRICE} AS DOUBLE) / NULLIF(mileage, 0) AS price_per_mile FROM "
)
_COMPLETE = "price IS NOT NULL AND mileage IS NOT NULL AND year IS NOT NULL"

_CTES = {
    "listings": LISTINGS_SQL,
    "facts": (
        f"SELECT {_STAGING}, {_COMPLIANT} AS is_ulez_compliant, CAST(2025 - year AS INT) AS vehicle_age, "
        "CASE WHEN mileage > 0 THEN CAST(price AS DOUBLE) / mileage ELSE 0.0 END AS price_per_mile FROM listings"
    ),
    "answered": (
        "SELECT id AS request_id, CAST(id AS VARCHAR) AS id, brand, title, CAST(price AS VARCHAR) AS price, "
        "year, CAST(coalesce(mileage, 0) AS INT) AS mileage, fuel_type AS fuelType, "
        f"CASE WHEN {_NO_SUBTITLE} THEN 0.0 ELSE engine_size END AS engineSize, transmission, "
        "CASE WHEN fuel_type IN ('Diesel', 'Other') THEN fuel_type ELSE '' END AS fuel_filter, "
        "price_text <> 'None' AS ok FROM listings"
    ),
    "csv_rows": (
        "SELECT brand, model, year, CAST(price AS INT) AS price, transmission, CAST(mileage AS INT) AS mileage, "
        "fuel_type AS fuelType, tax, mpg, engine_size AS engineSize FROM listings"
    ),
    "api_rows": (
        "SELECT CAST(id AS VARCHAR) AS id, brand, title, price_text AS price, year, "
        "CAST(mileage AS INT) AS mileage, fuel_type AS fuelType, engine_size AS engineSize, transmission, "
        "change_action FROM listings"
    ),
    "api_facts": _API_FACTS + "listings",
    "inserted_api_facts": _API_FACTS + "listings WHERE change_action = 'INSERT'",
    "loaded_facts": _API_FACTS + "listings WHERE mpg >= 25",
    "missing_facts": (
        _API_FACTS + "listings WHERE NOT EXISTS (SELECT 1 FROM loaded_facts f WHERE f.model = listings.title)"
    ),
    "older_facts": _API_FACTS + "listings WHERE tax <= 80 AND mpg >= 25 AND change_action = 'DELETE'",
    "early_facts": _API_FACTS + "listings WHERE tax <= 80 AND change_action = 'INSERT'",
    "late_facts": _API_FACTS + "listings WHERE tax > 80 AND change_action = 'INSERT'",
    "early_missing": (
        _API_FACTS + "listings WHERE tax <= 80 AND title NOT IN "
        "(SELECT model FROM older_facts UNION ALL SELECT model FROM early_facts)"
    ),
    "late_missing": (
        _API_FACTS + "listings WHERE title NOT IN (SELECT model FROM older_facts UNION ALL SELECT model FROM early_facts "
        "UNION ALL SELECT model FROM early_missing UNION ALL SELECT model FROM late_facts)"
    ),
    "comings": (
        "SELECT *, CASE WHEN tax <= 80 THEN 1 ELSE 2 END AS first_inc, "
        "CASE WHEN tax BETWEEN 60 AND 80 OR tax > 80 THEN 2 ELSE 1 END AS later_inc FROM listings"
    ),
    "change_log": (
        "SELECT *, 1 AS seq, first_inc AS inc, 'INSERT' AS act, price AS image FROM comings "
        "UNION ALL SELECT *, 2, later_inc, 'DELETE', price FROM comings "
        "WHERE change_action = 'DELETE' OR fuel_type = 'Petrol' "
        "UNION ALL SELECT *, 3, later_inc, 'INSERT', price + 100 FROM comings "
        "WHERE change_action = 'INSERT' AND fuel_type = 'Petrol'"
    ),
    "net_inserts": (
        "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id, inc ORDER BY seq DESC, act DESC, model DESC, "
        "year DESC, image DESC, transmission DESC, mileage DESC NULLS LAST, fuel_type DESC, tax DESC, mpg DESC, "
        "engine_size DESC) AS back FROM change_log) "
        "WHERE back = 1 AND act = 'INSERT'"
    ),
    "adverts": "SELECT * REPLACE (CASE WHEN price_text <> 'None' THEN id END AS id) FROM listings",
    "known_adverts": "SELECT * FROM adverts WHERE id IS NOT NULL",
    "summary": (
        "SELECT brand, year, fuel_type, is_ulez_compliant, count(*) AS total_listings, "
        "round(avg(price), 2) AS avg_price, round(avg(mileage), 2) AS avg_mileage, "
        "round(avg(vehicle_age), 1) AS avg_age FROM facts GROUP BY 1, 2, 3, 4"
    ),
    "class_means": (
        "SELECT brand, model, fuel_type, is_ulez_compliant AS ok, avg(price) AS mean_price, count(*) AS n "
        "FROM facts GROUP BY ALL"
    ),
    "devaluation": (
        "SELECT good.brand, good.model, good.n + bad.n AS total_listings, "
        "round(good.mean_price, 0) AS avg_price_compliant, round(bad.mean_price, 0) AS avg_price_non_compliant, "
        "round(good.mean_price - bad.mean_price, 0) AS devaluation_amount, "
        "round((bad.mean_price - good.mean_price) / NULLIF(good.mean_price, 0) * 100, 1) AS devaluation_percent "
        "FROM class_means good JOIN class_means bad USING (brand, model, fuel_type) "
        "WHERE fuel_type = 'Diesel' AND good.ok AND NOT bad.ok"
    ),
    "brand_means": "SELECT brand, is_ulez_compliant AS ok, avg(price) AS mean_price FROM facts GROUP BY ALL",
    "gap": (
        "SELECT brand, avg_price_compliant, avg_price_non_compliant, round((avg_price_non_compliant "
        "- avg_price_compliant) / NULLIF(avg_price_compliant, 0) * 100, 1) AS percent_diff "
        "FROM (SELECT brand, any_value(mean_price) FILTER (ok) AS avg_price_compliant, "
        "any_value(mean_price) FILTER (NOT ok) AS avg_price_non_compliant FROM brand_means GROUP BY brand)"
    ),
    "test_rows": (
        f"SELECT *, {_COMPLIANT} AS is_ulez_compliant, CAST(2025 - year AS INT) AS vehicle_age FROM listings "
        "WHERE substr(md5(CAST(id AS VARCHAR)), 1, 4) < '3333'"
    ),
    "features": (
        "SELECT brand, model, year, price, mileage, fuel_type, engine_size, is_ulez_compliant FROM facts "
        f"WHERE {_COMPLETE}"
    ),
    "banded": (
        "SELECT *, CASE WHEN price < 30000 THEN 2 WHEN price < 60000 THEN 0 ELSE 1 END AS cluster_id FROM features"
    ),
    "profile": (
        "SELECT cluster_id, avg(price) AS avg_price, avg(mileage) AS avg_mileage, avg(year) AS avg_year "
        "FROM banded GROUP BY 1"
    ),
    "positions": (
        "SELECT cluster_id, avg_price, CAST(row_number() OVER (ORDER BY avg_price, cluster_id) AS INT) "
        "AS price_position FROM profile"
    ),
    "named": (
        "SELECT b.*, CASE price_position "
        "WHEN 1 THEN CASE WHEN is_ulez_compliant THEN 'Budget Entry (ULEZ Compliant)' "
        "ELSE 'Desperate Dump (Non-Compliant)' END "
        "WHEN 2 THEN CASE WHEN is_ulez_compliant THEN 'Standard Market (ULEZ Compliant)' "
        "ELSE 'Standard Market (Non-Compliant)' END "
        "WHEN 3 THEN CASE WHEN is_ulez_compliant THEN 'Premium Segment (ULEZ Compliant)' "
        "ELSE 'Premium Segment (Non-Compliant)' END END AS cluster_name "
        "FROM banded b JOIN positions p ON b.cluster_id = p.cluster_id"
    ),
    "mart": (
        "SELECT brand, model, year, CAST(price AS DOUBLE) AS price, CAST(mileage AS DOUBLE) AS mileage, "
        "fuel_type, engine_size, is_ulez_compliant, cluster_id, cluster_name FROM named"
    ),
}

_NEEDS = {
    "facts": ["listings"],
    "answered": ["listings"],
    "csv_rows": ["listings"],
    "api_rows": ["listings"],
    "api_facts": ["listings"],
    "inserted_api_facts": ["listings"],
    "loaded_facts": ["listings"],
    "missing_facts": ["loaded_facts"],
    "summary": ["facts"],
    "class_means": ["facts"],
    "devaluation": ["class_means"],
    "brand_means": ["facts"],
    "gap": ["brand_means"],
    "older_facts": ["listings"],
    "early_facts": ["listings"],
    "early_missing": ["older_facts", "early_facts"],
    "late_facts": ["listings"],
    "late_missing": ["early_missing", "late_facts"],
    "comings": ["listings"],
    "change_log": ["comings"],
    "net_inserts": ["change_log"],
    "adverts": ["listings"],
    "known_adverts": ["adverts"],
    "test_rows": ["listings"],
    "features": ["facts"],
    "banded": ["features"],
    "profile": ["banded"],
    "positions": ["profile"],
    "named": ["positions"],
    "mart": ["named"],
}


def _with(source: str, body: str) -> str:
    """``body`` with the named relations it reads, in the order they build on each other."""
    chain: list[str] = []

    def add(name: str) -> None:
        for below in _NEEDS.get(name, []):
            add(below)
        if name not in chain:
            chain.append(name)

    for name in source.split():
        add(name)
    return "WITH " + ", ".join(f"{name} AS ({_CTES[name]})" for name in chain) + " " + body


_TOP = "ORDER BY devaluation_percent ASC NULLS LAST, brand, model LIMIT "
_TOP_COLUMNS = "brand, model, avg_price_compliant, avg_price_non_compliant, devaluation_amount, devaluation_percent"
_ADVERT = (
    "CAST(id AS VARCHAR) AS id, brand, title, price_text AS price, year, CAST(mileage AS INT) AS mileage, "
    "fuel_type AS fuelType, engine_size AS engineSize, transmission"
)
_API_COLUMNS = "id, title, price, year, mileage, fuelType, engineSize, transmission"

ORACLES: dict[str, str] = {
    # sources, sinks, tables
    "csv_bulk_load": _with("csv_rows", "SELECT * FROM csv_rows"),
    "csv_load_report": _with(
        "listings",
        "SELECT brand, count(*) AS loaded, 3 * count(*) FILTER (price_text = 'None') AS rejected FROM listings GROUP BY 1",
    ),
    "brand_from_filename": _with(
        "csv_rows",
        "SELECT brand, count(*) AS listings, CAST(sum(price) AS BIGINT) AS total_price FROM csv_rows GROUP BY 1",
    ),
    "file_arrival_stream": _with("csv_rows", "SELECT * FROM csv_rows"),
    "api_response_source": _with("answered", f"SELECT brand AS make, {_API_COLUMNS} FROM answered WHERE ok"),
    "multi_request_union": _with(
        "answered",
        "SELECT brand AS make, fuel_filter, 1 AS page, count(*) AS listings, "
        "CAST(sum(CAST(price AS BIGINT)) AS BIGINT) AS total_price FROM answered WHERE ok GROUP BY 1, 2",
    ),
    "bronze_append": _with("answered", f"SELECT brand, {_API_COLUMNS} FROM answered WHERE ok"),
    "create_if_absent": _with(
        "csv_rows",
        "SELECT model, year, price, transmission, mileage, fuelType, tax, mpg, engineSize FROM csv_rows",
    ),
    "layered_namespaces": _with(
        "summary",
        "SELECT 'bronze' AS layer, 'Raw listings as they arrived' AS layer_comment, "
        "'api_listings' AS table_name, count(*) AS row_count FROM listings "
        "UNION ALL SELECT 'silver', 'Cleaned, typed and tagged listings', 'fct_cars', count(*) FROM facts "
        "UNION ALL SELECT 'gold', 'Aggregates and model output for reports', 'mart_ulez_impact', count(*) "
        "FROM summary",
    ),
    "schema_evolve_add": _with(
        "api_rows",
        "SELECT id, CASE WHEN change_action = 'INSERT' THEN brand END AS brand, title, price, year, mileage, "
        "fuelType, engineSize, transmission FROM api_rows",
    ),
    "partial_column_insert": _with("api_facts", "SELECT * FROM api_facts"),
    "table_materialize": _with("facts", "SELECT * FROM facts"),
    "view_materialize": _with("listings", f"SELECT {_STAGING} FROM listings"),
    "truncate_load": _with("mart", "SELECT * FROM mart"),
    "table_scan_project": _with(
        "facts",
        "SELECT brand, model, year, price, mileage, fuel_type, engine_size, is_ulez_compliant FROM facts",
    ),
    # JSON, arrays, strings
    "json_path_listings": _with(
        "listings",
        "SELECT id AS request_id, 1 AS page, 2 AS n_listings FROM listings "
        "UNION ALL SELECT id, 2, 0 FROM listings WHERE tax = 20",
    ),
    "explode_listings": _with("answered", "SELECT request_id, id, title FROM answered"),
    "response_status_gate": _with(
        "listings",
        "SELECT id AS request_id, brand AS make, 1 AS page FROM listings WHERE price_text <> 'None' "
        "UNION ALL SELECT id, brand, 2 FROM listings WHERE price_text <> 'None' AND tax = 20",
    ),
    "null_to_empty": _with(
        "listings",
        f"SELECT id AS request_id, CASE WHEN {_NO_SUBTITLE} THEN '' ELSE CAST(engine_size AS VARCHAR) || ' SE' "
        "|| CASE WHEN transmission = 'Automatic' THEN ' Auto' ELSE '' END || ' 5dr' END AS subtitle, "
        "CASE fuel_type WHEN 'Petrol' THEN 'Petrol Hybrid offer' WHEN 'Diesel' THEN 'Swap your Petrol' "
        "WHEN 'Hybrid' THEN 'Great Hybrid car' WHEN 'Electric' THEN 'Electric drive' ELSE '' END AS attention "
        "FROM listings",
    ),
    "mileage_from_badges": _with("answered", "SELECT request_id, mileage FROM answered"),
    "fuel_from_text": _with("answered", "SELECT request_id, fuelType AS fuel_type FROM answered"),
    "transmission_from_text": _with("answered", "SELECT request_id, transmission FROM answered"),
    "engine_size_regex": _with("answered", "SELECT request_id, engineSize AS engine_size FROM answered"),
    "listing_record": _with("answered", f"SELECT {_API_COLUMNS} FROM answered"),
    "price_clean_ingest": _with(
        "listings", "SELECT id, replace(replace(price_text, '£', ''), ',', '') AS price FROM listings"
    ),
    "price_clean_try": _with("listings", f"SELECT id, {_CLEAN_PRICE} AS price FROM listings"),
    "price_clean_strict": _with(
        "listings",
        "SELECT id, CAST(replace(NULLIF(replace(price_text, '£', ''), 'None'), ',', '') AS DOUBLE) AS price "
        "FROM listings",
    ),
    "brand_from_title": _with(
        "listings", "SELECT id, upper(substr(title, 1, instr(title, ' ') - 1)) AS brand FROM listings"
    ),
    "title_as_model": _with("listings", "SELECT CAST(id AS VARCHAR) AS id, title AS model FROM listings"),
    "rename_constants": _with(
        "api_rows",
        "SELECT id, brand, title, price, year, mileage, fuelType AS fuel_type, engineSize AS engine_size, "
        "transmission, 0 AS tax, CAST(0 AS DOUBLE) AS mpg FROM api_rows",
    ),
    "brand_literal": _with(
        "csv_rows",
        "SELECT 'MERCEDES' AS brand, model, year, CAST(price AS BIGINT) AS price, transmission, mileage, "
        "fuelType AS fuel_type, tax, mpg, engineSize AS engine_size FROM csv_rows",
    ),
    # projections, predicates, math
    "ulez_compliance": _with(
        "listings", f"SELECT id, fuel_type, year, {_COMPLIANT} AS is_ulez_compliant FROM listings"
    ),
    "vehicle_age": _with("listings", "SELECT id, CAST(2025 - year AS INT) AS vehicle_age FROM listings"),
    "price_per_mile_zero": _with(
        "listings",
        "SELECT id, CASE WHEN mileage > 0 THEN CAST(price AS DOUBLE) / mileage ELSE 0.0 END AS price_per_mile "
        "FROM listings",
    ),
    "price_per_mile_null": _with(
        "listings", "SELECT id, CAST(price AS DOUBLE) / NULLIF(mileage, 0) AS price_per_mile FROM listings"
    ),
    "enrich_facts": _with("facts", "SELECT * FROM facts"),
    "price_efficiency": _with(
        "summary",
        "SELECT brand, year, fuel_type, is_ulez_compliant, avg_price / NULLIF(avg_age, 0) AS price_efficiency "
        "FROM summary",
    ),
    "filter_fuel": _with("facts", "SELECT * FROM facts WHERE fuel_type = 'Diesel'"),
    "filter_complete": _with("facts", f"SELECT * FROM facts WHERE {_COMPLETE}"),
    "filter_inserts": _with(
        "listings",
        "SELECT model, year, CAST(price AS INT) AS price, transmission, CAST(mileage AS INT) AS mileage, "
        "fuel_type AS fuelType, tax, mpg, engine_size AS engineSize FROM listings WHERE change_action = 'INSERT'",
    ),
    "dimension_filter": _with(
        "facts",
        "SELECT * FROM facts WHERE brand IN ('BRAND#1', 'BRAND#2', 'BRAND#3') "
        "AND fuel_type IN ('Petrol', 'Diesel')",
    ),
    "recase_columns": _with(
        "api_rows",
        "SELECT id, brand, title, price, year, mileage, fuelType AS fueltype, engineSize AS enginesize, "
        "transmission FROM api_rows",
    ),
    "present_columns": _with(
        "devaluation",
        "SELECT brand, model, '£' || format('{:,}', CAST(avg_price_compliant AS BIGINT)) "
        'AS "Compliant Average Price", '
        "'£' || format('{:,}', CAST(avg_price_non_compliant AS BIGINT)) "
        'AS "Non-Compliant Average Price", devaluation_amount AS "Price Drop (£)", '
        "format('{:.1f}%', devaluation_percent) AS \"Devaluation (%)\" "
        f"FROM (SELECT * FROM devaluation {_TOP} 10)",
    ),
    # joins
    "backfill_anti_join": _with("missing_facts", "SELECT * FROM missing_facts"),
    # aggregations
    "impact_summary": _with(
        "summary", "SELECT *, avg_price / NULLIF(avg_age, 0) AS price_efficiency FROM summary"
    ),
    "diesel_devaluation_top10": _with("devaluation", f"SELECT {_TOP_COLUMNS} FROM devaluation {_TOP} 10"),
    "conditional_avg_pair": _with(
        "facts",
        "SELECT fuel_type, avg(CASE WHEN is_ulez_compliant THEN mileage END) AS avg_mileage_compliant, "
        "avg(CASE WHEN NOT is_ulez_compliant THEN mileage END) AS avg_mileage_non_compliant "
        "FROM facts GROUP BY 1",
    ),
    "having_both_classes": _with(
        "facts",
        "SELECT brand, model, fuel_type, count(CASE WHEN is_ulez_compliant THEN 1 END) AS n_compliant, "
        "count(CASE WHEN NOT is_ulez_compliant THEN 1 END) AS n_non_compliant FROM facts GROUP BY 1, 2, 3 "
        "HAVING count(CASE WHEN is_ulez_compliant THEN 1 END) >= 1 "
        "AND count(CASE WHEN NOT is_ulez_compliant THEN 1 END) >= 1",
    ),
    "brand_price_gap": _with("gap", "SELECT * FROM gap"),
    "devaluation_total_listings": _with("devaluation", "SELECT * FROM devaluation"),
    "row_counts": _with(
        "facts",
        f"SELECT count(*) AS total, count(CASE WHEN {_COMPLETE} THEN 1 END) AS valid FROM facts",
    ),
    "cluster_distribution": _with(
        "mart", "SELECT cluster_name, count(*) AS listings FROM mart GROUP BY 1 ORDER BY 2 DESC, 1"
    ),
    "cluster_profile_means": _with("profile", "SELECT * FROM profile"),
    # order and position
    "devaluation_rank": _with(
        "devaluation",
        "SELECT CAST(row_number() OVER (ORDER BY devaluation_percent ASC NULLS LAST, brand, model) AS INT) "
        f'AS "rank", {_TOP_COLUMNS} FROM (SELECT * FROM devaluation {_TOP} 10)',
    ),
    "sample_per_cluster": _with(
        "mart",
        "SELECT cluster_name, brand, model, year, price, mileage, is_ulez_compliant FROM (SELECT *, "
        "row_number() OVER (PARTITION BY cluster_name ORDER BY price, brand, model, year, mileage) AS n "
        "FROM mart) WHERE n <= 3 ORDER BY cluster_name, price, brand, model, year, mileage",
    ),
    "cluster_price_order": _with("positions", "SELECT * FROM positions"),
    "top_k_devaluation": _with("devaluation", f"SELECT {_TOP_COLUMNS} FROM devaluation {_TOP} 30"),
    "sort_by_gap": _with("gap", "SELECT brand, percent_diff FROM gap ORDER BY percent_diff ASC NULLS LAST, brand"),
    # set operations and reshaping
    "unified_listings": _with(
        "listings answered",
        "SELECT brand, model, year, price, transmission, CAST(mileage AS INT) AS mileage, fuel_type, tax, mpg, "
        "engine_size FROM listings UNION ALL "
        "SELECT brand, title, year, CAST(price AS BIGINT), transmission, mileage, fuelType, 0, 0, engineSize "
        "FROM answered WHERE ok",
    ),
    "melt_price_gap": _with(
        "gap",
        "SELECT brand, 'Compliant Average Price' AS category, avg_price_compliant AS avg_price FROM gap "
        "UNION ALL SELECT brand, 'Non-Compliant Average Price', avg_price_non_compliant FROM gap",
    ),
    "listing_dedup": _with(
        "known_adverts",
        "SELECT id, search_timestamp, price, brand, title, mileage FROM (SELECT *, row_number() OVER ("
        "PARTITION BY id ORDER BY search_timestamp DESC NULLS LAST, price NULLS LAST, brand NULLS LAST, "
        "title NULLS LAST, mileage NULLS LAST) AS n FROM known_adverts) WHERE n = 1 UNION ALL "
        "SELECT id, search_timestamp, price, brand, title, mileage FROM adverts WHERE id IS NULL",
    ),
    # streaming
    "cdc_insert_stream": _with(
        "net_inserts",
        "SELECT 'MERCEDES' AS brand, model, year, image AS price, transmission, CAST(mileage AS INT) AS mileage, "
        f"fuel_type, tax, mpg, engine_size, {_COMPLIANT} AS is_ulez_compliant, "
        "CAST(2025 - year AS INT) AS vehicle_age, CAST(image AS DOUBLE) / NULLIF(mileage, 0) AS price_per_mile "
        "FROM net_inserts",
    ),
    "api_cdc_stream": _with("inserted_api_facts", "SELECT * FROM inserted_api_facts"),
    "stream_compaction": _with("inserted_api_facts", "SELECT * FROM inserted_api_facts"),
    "incremental_trigger": _with(
        "inserted_api_facts",
        "SELECT 1 AS run, count(*) AS fact_rows FROM inserted_api_facts "
        "UNION ALL SELECT 2, count(*) FROM inserted_api_facts",
    ),
    "stream_dedup": _with(
        "known_adverts",
        f"SELECT {_ADVERT} FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY search_timestamp DESC "
        "NULLS LAST, brand NULLS LAST, title NULLS LAST, price_text NULLS LAST, year NULLS LAST, mileage NULLS LAST, "
        "fuel_type NULLS LAST, engine_size NULLS LAST, transmission NULLS LAST) AS n FROM known_adverts) WHERE n = 1 "
        f"UNION ALL SELECT {_ADVERT} FROM adverts WHERE id IS NULL",
    ),
    "stream_backfill": _with(
        "late_missing",
        "SELECT * FROM older_facts UNION ALL SELECT * FROM early_facts UNION ALL SELECT * FROM early_missing "
        "UNION ALL SELECT * FROM late_facts UNION ALL SELECT * FROM late_missing",
    ),
    "batch_stream_parity": _with(
        "inserted_api_facts",
        "SELECT brand, is_ulez_compliant, count(*) AS batch_rows, count(*) AS stream_rows, "
        "CAST(sum(price) AS BIGINT) AS batch_price, CAST(sum(price) AS BIGINT) AS stream_price "
        "FROM inserted_api_facts GROUP BY 1, 2",
    ),
    # machine learning
    "ml_feature_extract": _with("features", "SELECT * FROM features"),
    "standard_scale": _with(
        "listings",
        "SELECT id, "
        + ", ".join(
            f"round(({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER (), 6) AS scaled_{c}"
            for c in ("price", "mileage", "year")
        )
        + f" FROM (SELECT * FROM listings WHERE {_COMPLETE})",
    ),
    "cluster_business_names": _with("named", "SELECT * FROM named"),
    "kmeans_segments": _with(
        "listings", f"SELECT id, price, mileage, year, TRUE AS centred FROM listings WHERE {_COMPLETE}"
    ),
    "cluster_mart": _with(
        "mart", "SELECT * EXCLUDE (cluster_id, cluster_name), TRUE AS in_price_order FROM mart"
    ),
    "daily_refresh": _with(
        "listings inserted_api_facts",
        f"SELECT {_COMPLIANT} AS compliant, 3::BIGINT AS segments, count(*) AS listings FROM ("
        "SELECT price, mileage, year, fuel_type FROM listings WHERE change_action = 'DELETE' "
        f"UNION ALL SELECT price, mileage, year, fuel_type FROM inserted_api_facts) WHERE {_COMPLETE} GROUP BY 1",
    ),
    "price_regression": _with(
        "test_rows", "SELECT id, price, vehicle_age, mileage, engine_size, is_ulez_compliant, TRUE AS finite FROM test_rows"
    ),
    "shap_contributions": _with(
        "test_rows", "SELECT id, vehicle_age, mileage, engine_size, is_ulez_compliant, TRUE AS adds_up FROM test_rows"
    ),
    "train_test_split": _with(
        "listings",
        "SELECT id, price, CASE WHEN substr(md5(CAST(id AS VARCHAR)), 1, 4) < '3333' THEN 'test' ELSE 'train' END "
        "AS side FROM listings",
    ),
    "regression_metrics": _with(
        "listings",
        "SELECT round(avg(abs(price - mileage - 1000)), 6) AS mae, "
        "round(1 - sum(power(price - mileage - 1000, 2)) / (var_pop(price) * count(price)), 6) AS r2 "
        "FROM listings WHERE mileage IS NOT NULL",
    ),
    "categorical_encode": _with(
        "listings",
        ", fuels AS (SELECT fuel_type, row_number() OVER (ORDER BY count(*) DESC, fuel_type) - 1 AS i "
        "FROM listings GROUP BY 1), brands AS (SELECT brand, row_number() OVER (ORDER BY count(*) DESC, brand) - 1 "
        "AS i FROM listings GROUP BY 1) "
        "SELECT l.id, l.fuel_type, l.brand, CAST(f.i AS DOUBLE) AS fuel_type_index, "
        "CAST(b.i AS DOUBLE) AS brand_index, repeat('0', CAST(f.i AS INT)) || '1' || "
        "repeat('0', CAST((SELECT count(*) FROM fuels) - 1 - f.i AS INT)) AS fuel_type_slots "
        "FROM listings l JOIN fuels f ON l.fuel_type = f.fuel_type JOIN brands b ON l.brand = b.brand",
    ),
    # data quality
    "quality_counts": _with(
        "mart",
        "SELECT 'total' AS measure, count(*) AS row_count FROM facts "
        f"UNION ALL SELECT 'valid', count(*) FROM facts WHERE {_COMPLETE} "
        "UNION ALL SELECT 'cluster: ' || cluster_name, count(*) FROM mart GROUP BY cluster_name",
    ),
    "empty_or_missing_mart": _with("mart", "SELECT * FROM mart"),
}
