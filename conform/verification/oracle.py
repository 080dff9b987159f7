"""The result of every query in SQL for DuckDB, stated on its own and without the engine's code."""

from __future__ import annotations

# The raw feeds, then the cleaned tables, then the star schema; each step may use the ones before it.
STEPS = {
    "crm_cust_info": """
        SELECT CASE WHEN rev = 2 THEN NULL ELSE CAST(k AS INT) END AS cst_id,
               'AW' || lpad(CAST(k AS VARCHAR), 8, '0') AS cst_key,
               '  ' || c_mktsegment || ' ' AS cst_firstname,
               c_name || '  ' AS cst_lastname,
               CASE (k + rev) % 5 WHEN 0 THEN 'S' WHEN 1 THEN ' m' WHEN 2 THEN 'M ' WHEN 3 THEN 'D' END
                   AS cst_martial_status,
               CASE (k + rev) % 6 WHEN 0 THEN 'F' WHEN 1 THEN ' m ' WHEN 2 THEN 'M' WHEN 3 THEN 'f' WHEN 4 THEN 'X' END
                   AS cst_gndr,
               DATE '2024-01-01' + CAST(k % 300 AS INT) - rev * 30 AS cst_create_date
        FROM (SELECT c_custkey AS k, c_name, c_mktsegment, 0 AS rev FROM customer
              UNION ALL
              SELECT c_custkey, c_name, c_mktsegment, 1 FROM customer WHERE c_custkey % 7 = 0
              UNION ALL
              SELECT c_custkey, c_name, c_mktsegment, 2 FROM customer WHERE c_custkey % 50 = 3)""",
    "crm_prd_info": """
        SELECT CAST(id AS INT) AS prd_id,
               'C' || CAST(k % 5 AS VARCHAR) || '-' || lpad(CAST((k // 5) % 25 AS VARCHAR), 2, '0')
                   || '-P' || lpad(CAST(k AS VARCHAR), 8, '0') AS prd_key,
               p_name AS prd_nm,
               CASE WHEN id % 11 = 0 THEN NULL ELSE CAST(floor(p_retailprice) AS INT) END AS prd_cost,
               CASE p_size % 6 WHEN 0 THEN 'M ' WHEN 1 THEN 'r' WHEN 2 THEN 'S' WHEN 3 THEN ' t' WHEN 4 THEN 'Z' END
                   AS prd_line,
               CAST(DATE '2010-01-01' + CAST(k % 100 + (id % 3) * 400 AS INT) AS TIMESTAMP) AS prd_start_dt
        FROM (SELECT p_partkey AS id, p_partkey // 3 AS k, p_name, p_retailprice, p_size FROM part)""",
    "crm_sales_details": """
        SELECT 'SO' || CAST(ok AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS sls_ord_num,
               CASE WHEN ok % 41 = 0 THEN 'PXXX' ELSE 'P' || lpad(CAST(l_partkey // 3 AS VARCHAR), 8, '0') END
                   AS sls_prd_key,
               CASE WHEN ok % 43 = 0 THEN -1 ELSE CAST(o_custkey AS INT) END AS sls_cust_id,
               CASE WHEN ok % 97 = 0 THEN 0
                    WHEN ok % 89 = 0 THEN CAST(ordered // 10 AS INT)
                    ELSE CAST(ordered AS INT) END AS sls_order_dt,
               CAST(shipped AS INT) AS sls_ship_dt,
               CASE WHEN ok % 53 = 0 THEN NULL ELSE CAST(shipped AS INT) END AS sls_due_dt,
               CASE ok % 10 WHEN 0 THEN NULL WHEN 1 THEN -(q * p) WHEN 2 THEN q * p + 7 ELSE q * p END AS sls_sales,
               CASE WHEN ok % 61 = 0 THEN 0 ELSE q END AS sls_quantity,
               CASE ok % 13 WHEN 0 THEN NULL WHEN 1 THEN -p ELSE p END AS sls_price
        FROM (SELECT l_orderkey AS ok, l_linenumber, l_partkey, o_custkey,
                     year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) AS ordered,
                     year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate) AS shipped,
                     CAST(floor(l_quantity) AS INT) AS q,
                     CAST(floor(l_extendedprice / l_quantity) AS INT) AS p
              FROM lineitem JOIN orders ON l_orderkey = o_orderkey)""",
    "erp_cust_az12": """
        SELECT CASE WHEN c_custkey % 2 = 0 THEN 'NAS' ELSE '' END
                   || CASE WHEN c_custkey % 19 = 0 THEN 'XX' ELSE 'AW' END
                   || lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS cid,
               CASE WHEN c_custkey % 17 = 0 THEN DATE '2099-01-01'
                    ELSE DATE '1950-01-01' + CAST(c_custkey * 13 % 18000 AS INT) END AS bdate,
               CASE c_custkey % 7 WHEN 0 THEN 'F' WHEN 1 THEN 'Male ' WHEN 2 THEN 'FEMALE' WHEN 3 THEN 'm'
                                  WHEN 4 THEN '' WHEN 5 THEN 'X' END AS gen
        FROM customer""",
    "erp_loc_a101": """
        SELECT CASE WHEN c_custkey % 23 = 0 THEN 'XX-' ELSE 'AW-' END || lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS cid,
               CASE n_nationkey % 7 WHEN 0 THEN 'DE' WHEN 1 THEN 'US ' WHEN 2 THEN 'USA' WHEN 3 THEN '  '
                                    WHEN 5 THEN ' ' || n_name || ' ' WHEN 6 THEN n_name END AS cntry
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "erp_px_cat_g1v2": """
        SELECT CASE WHEN n_nationkey = 24 THEN 'X' ELSE 'C' END || CAST(r_regionkey AS VARCHAR)
                   || '_' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS id,
               r_name AS cat, n_name AS subcat,
               CASE WHEN n_nationkey % 2 = 0 THEN 'Yes' ELSE 'No' END AS maintenance
        FROM (SELECT DISTINCT p_partkey // 3 % 5 AS r, p_partkey // 3 // 5 % 25 AS n FROM part)
        JOIN region ON r = r_regionkey JOIN nation ON n = n_nationkey""",
    "latest_customers": """
        SELECT cst_id, cst_key, cst_firstname, cst_lastname, cst_martial_status, cst_gndr, cst_create_date
        FROM (SELECT *, row_number() OVER (PARTITION BY cst_id ORDER BY cst_create_date DESC NULLS LAST) AS place
              FROM crm_cust_info WHERE cst_id IS NOT NULL)
        WHERE place = 1""",
    "silver_customers": """
        SELECT cst_id AS customer_id, cst_key AS customer_number,
               trim(cst_firstname) AS first_name, trim(cst_lastname) AS last_name,
               CASE upper(trim(cst_martial_status)) WHEN 'S' THEN 'Single' WHEN 'M' THEN 'Married' ELSE 'n/a' END
                   AS marital_status,
               CASE upper(trim(cst_gndr)) WHEN 'F' THEN 'Female' WHEN 'M' THEN 'Male' ELSE 'n/a' END AS gender,
               cst_create_date AS created_date
        FROM latest_customers""",
    "product_versions": """
        SELECT *, CAST(lead(prd_start_dt) OVER (PARTITION BY prd_key ORDER BY prd_start_dt NULLS FIRST) AS DATE) - 1
                   AS end_date
        FROM crm_prd_info""",
    "silver_products": """
        SELECT prd_id AS product_id, replace(prd_key[1:5], '-', '_') AS category_id,
               substring(prd_key, 7) AS product_number, prd_nm AS product_name,
               coalesce(prd_cost, 0) AS product_cost,
               CASE upper(trim(prd_line)) WHEN 'M' THEN 'Mountain' WHEN 'R' THEN 'Road' WHEN 'S' THEN 'Other Sales'
                                          WHEN 'T' THEN 'Touring' ELSE 'n/a' END AS product_line,
               CAST(prd_start_dt AS DATE) AS start_date, end_date
        FROM product_versions""",
    # Which value stands, for each sign of the amount (none if it is missing) and whether it fits quantity times price.
    "amount_cases": """
        SELECT * FROM (VALUES (1, true, 'amount'), (1, NULL, 'amount'), (1, false, 'product'),
                              (0, true, 'product'), (0, NULL, 'product'), (0, false, 'product'),
                              (-1, true, 'product'), (-1, NULL, 'product'), (-1, false, 'product'),
                              (NULL, NULL, 'product')) AS cases(amount_sign, fits, stands)""",
    # The same for each sign of the price and whether the quantity is zero.
    "price_cases": """
        SELECT * FROM (VALUES (1, true, 'price'), (1, NULL, 'price'), (1, false, 'price'),
                              (0, true, 'nothing'), (0, NULL, 'nothing'), (0, false, 'quotient'),
                              (-1, true, 'nothing'), (-1, NULL, 'nothing'), (-1, false, 'quotient'),
                              (NULL, true, 'nothing'), (NULL, NULL, 'nothing'), (NULL, false, 'quotient'))
                      AS cases(price_sign, no_quantity, price_stands)""",
    "repaired_sales": """
        SELECT s.*,
               CASE stands WHEN 'amount' THEN sls_sales WHEN 'product' THEN product END AS sales_amount,
               CASE price_stands WHEN 'price' THEN CAST(sls_price AS DOUBLE)
                                 WHEN 'quotient' THEN sls_sales / sls_quantity END AS price
        FROM (SELECT *, sls_quantity * abs(sls_price) AS product FROM crm_sales_details) s
        JOIN amount_cases ON sign(sls_sales) IS NOT DISTINCT FROM amount_sign
                          AND (sls_sales = product) IS NOT DISTINCT FROM fits
        JOIN price_cases ON sign(sls_price) IS NOT DISTINCT FROM price_sign
                         AND (sls_quantity = 0) IS NOT DISTINCT FROM no_quantity""",
    "silver_sales": """
        SELECT sls_ord_num AS order_number, sls_prd_key AS product_number, sls_cust_id AS customer_id,
               CASE WHEN sls_order_dt <> 0 AND length(CAST(sls_order_dt AS VARCHAR)) = 8
                    THEN CAST(try_strptime(CAST(sls_order_dt AS VARCHAR), '%Y%m%d') AS DATE) END AS order_date,
               CASE WHEN sls_ship_dt <> 0 AND length(CAST(sls_ship_dt AS VARCHAR)) = 8
                    THEN CAST(try_strptime(CAST(sls_ship_dt AS VARCHAR), '%Y%m%d') AS DATE) END AS ship_date,
               CASE WHEN sls_due_dt <> 0 AND length(CAST(sls_due_dt AS VARCHAR)) = 8
                    THEN CAST(try_strptime(CAST(sls_due_dt AS VARCHAR), '%Y%m%d') AS DATE) END AS due_date,
               sales_amount, sls_quantity AS quantity, price
        FROM repaired_sales""",
    "silver_demographics": """
        SELECT CASE WHEN cid LIKE 'NAS%' THEN substring(cid, 4) ELSE cid END AS customer_number,
               CASE WHEN bdate > current_date THEN NULL ELSE bdate END AS birth_date,
               CASE WHEN upper(trim(gen)) IN ('F', 'FEMALE') THEN 'Female'
                    WHEN upper(trim(gen)) IN ('M', 'MALE') THEN 'Male' ELSE 'n/a' END AS gender
        FROM erp_cust_az12""",
    "silver_locations": """
        SELECT replace(cid, '-', '') AS customer_number,
               CASE WHEN trim(cntry) = 'DE' THEN 'Germany'
                    WHEN trim(cntry) IN ('US', 'USA') THEN 'United States'
                    WHEN cntry IS NULL OR trim(cntry) = '' THEN 'n/a'
                    ELSE trim(cntry) END AS country
        FROM erp_loc_a101""",
    "silver_categories": """
        SELECT id AS category_id, cat AS category, subcat AS subcategory, maintenance AS maintenance_flag
        FROM erp_px_cat_g1v2""",
    "dim_customers": """
        SELECT CAST(row_number() OVER (ORDER BY customer_id NULLS FIRST) AS INT) AS customer_key,
               customer_id, c.customer_number, first_name, last_name, country, marital_status,
               coalesce(nullif(c.gender, 'n/a'), d.gender, 'n/a') AS gender,
               birth_date AS birthdate, created_date AS create_date
        FROM silver_customers c
        LEFT JOIN silver_demographics d ON c.customer_number = d.customer_number
        LEFT JOIN silver_locations l ON c.customer_number = l.customer_number""",
    "dim_products": """
        SELECT CAST(row_number() OVER (ORDER BY start_date NULLS FIRST, product_number NULLS FIRST) AS INT)
                   AS product_key,
               product_id, product_number, product_name, p.category_id, category, subcategory, maintenance_flag,
               product_cost, product_line, start_date
        FROM silver_products p LEFT JOIN silver_categories c ON p.category_id = c.category_id
        WHERE end_date IS NULL""",
    "fact_sales": """
        SELECT order_number, product_key, customer_key, order_date, ship_date, due_date,
               sales_amount, quantity, price
        FROM silver_sales s
        LEFT JOIN dim_products p ON s.product_number = p.product_number
        LEFT JOIN dim_customers c ON s.customer_id = c.customer_id""",
}

_CHAIN = "WITH " + ",\n".join(f"{name} AS ({body})" for name, body in STEPS.items())


def _from_steps(select: str) -> str:
    return f"{_CHAIN}\n{select}"


def _row_counts(tables: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{label}' AS table_name, count(*) AS row_count FROM {step}" for label, step in tables.items()
    )


_RAW = ["crm_cust_info", "crm_prd_info", "crm_sales_details", "erp_cust_az12", "erp_loc_a101", "erp_px_cat_g1v2"]
_SILVER = {
    "crm_cust_info": "silver_customers",
    "crm_prd_info": "silver_products",
    "crm_sales_details": "silver_sales",
    "erp_cust_az12": "silver_demographics",
    "erp_loc_a101": "silver_locations",
    "erp_px_cat_g1v2": "silver_categories",
}
_GOLD = ["dim_customers", "dim_products", "fact_sales"]

_FROM_STEPS = {
    "q01_bronze_csv_scan": "SELECT * FROM crm_cust_info",
    "q02_bronze_ingest_all": _row_counts({name: name for name in _RAW}),
    "q03_dedupe_latest_customer": "SELECT * FROM latest_customers",
    "q04_marital_status_labels": """
        SELECT cst_id, cst_key, cst_martial_status,
               CASE upper(trim(cst_martial_status)) WHEN 'S' THEN 'Single' WHEN 'M' THEN 'Married' ELSE 'n/a' END
                   AS marital_status
        FROM crm_cust_info""",
    "q05_gender_code_labels": """
        SELECT cst_id, cst_key, cst_gndr,
               CASE upper(trim(cst_gndr)) WHEN 'F' THEN 'Female' WHEN 'M' THEN 'Male' ELSE 'n/a' END AS gender
        FROM crm_cust_info""",
    "q06_trimmed_names": """
        SELECT cst_id, cst_key, trim(cst_firstname) AS first_name, trim(cst_lastname) AS last_name
        FROM crm_cust_info""",
    "q07_silver_customers": "SELECT * FROM silver_customers",
    "q08_category_id_from_key": """
        SELECT prd_id, prd_key, replace(prd_key[1:5], '-', '_') AS category_id FROM crm_prd_info""",
    "q09_product_number_from_key": "SELECT prd_id, prd_key, substring(prd_key, 7) AS product_number FROM crm_prd_info",
    "q10_product_line_labels": """
        SELECT prd_id, prd_line,
               CASE upper(trim(prd_line)) WHEN 'M' THEN 'Mountain' WHEN 'R' THEN 'Road' WHEN 'S' THEN 'Other Sales'
                                          WHEN 'T' THEN 'Touring' ELSE 'n/a' END AS product_line
        FROM crm_prd_info""",
    "q11_cost_default": "SELECT prd_id, prd_cost, coalesce(prd_cost, 0) AS product_cost FROM crm_prd_info",
    "q12_product_validity": """
        SELECT prd_id, prd_key, CAST(prd_start_dt AS DATE) AS start_date, end_date FROM product_versions""",
    "q13_silver_products": "SELECT * FROM silver_products",
    "q14_packed_dates": """
        SELECT sls_ord_num, sls_order_dt, sls_ship_dt, sls_due_dt,
               CASE WHEN sls_order_dt <> 0 AND length(CAST(sls_order_dt AS VARCHAR)) = 8
                    THEN CAST(try_strptime(CAST(sls_order_dt AS VARCHAR), '%Y%m%d') AS DATE) END AS order_date,
               CASE WHEN sls_ship_dt <> 0 AND length(CAST(sls_ship_dt AS VARCHAR)) = 8
                    THEN CAST(try_strptime(CAST(sls_ship_dt AS VARCHAR), '%Y%m%d') AS DATE) END AS ship_date,
               CASE WHEN sls_due_dt <> 0 AND length(CAST(sls_due_dt AS VARCHAR)) = 8
                    THEN CAST(try_strptime(CAST(sls_due_dt AS VARCHAR), '%Y%m%d') AS DATE) END AS due_date
        FROM crm_sales_details""",
    "q15_repaired_amount": """
        SELECT sls_ord_num, sls_sales, sls_quantity, sls_price, sales_amount FROM repaired_sales""",
    "q16_repaired_price": """
        SELECT sls_ord_num, sls_sales, sls_quantity, sls_price, price FROM repaired_sales""",
    "q17_silver_sales": "SELECT * FROM silver_sales",
    "q18_strip_prefix": """
        SELECT cid, CASE WHEN cid LIKE 'NAS%' THEN substring(cid, 4) ELSE cid END AS customer_number
        FROM erp_cust_az12""",
    "q19_null_future_birthdate": """
        SELECT cid, bdate, CASE WHEN bdate > current_date THEN NULL ELSE bdate END AS birth_date
        FROM erp_cust_az12""",
    "q20_gender_word_labels": """
        SELECT cid, gen,
               CASE WHEN upper(trim(gen)) IN ('F', 'FEMALE') THEN 'Female'
                    WHEN upper(trim(gen)) IN ('M', 'MALE') THEN 'Male' ELSE 'n/a' END AS gender
        FROM erp_cust_az12""",
    "q21_silver_demographics": "SELECT * FROM silver_demographics",
    "q22_remove_hyphens": "SELECT cid, replace(cid, '-', '') AS customer_number FROM erp_loc_a101",
    "q23_country_labels": """
        SELECT cid, cntry,
               CASE WHEN trim(cntry) = 'DE' THEN 'Germany'
                    WHEN trim(cntry) IN ('US', 'USA') THEN 'United States'
                    WHEN cntry IS NULL OR trim(cntry) = '' THEN 'n/a'
                    ELSE trim(cntry) END AS country
        FROM erp_loc_a101""",
    "q24_silver_locations": "SELECT * FROM silver_locations",
    "q25_silver_categories": "SELECT * FROM silver_categories",
    "q26_customer_keys": """
        SELECT CAST(row_number() OVER (ORDER BY customer_id NULLS FIRST) AS INT) AS customer_key, customer_id
        FROM silver_customers""",
    "q27_gender_precedence": """
        SELECT customer_id, gender FROM dim_customers""",
    "q28_dim_customers": "SELECT * FROM dim_customers",
    "q29_current_products": "SELECT * FROM silver_products WHERE end_date IS NULL",
    "q30_product_keys": """
        SELECT CAST(row_number() OVER (ORDER BY start_date NULLS FIRST, product_number NULLS FIRST) AS INT)
                   AS product_key,
               start_date, product_number, product_id
        FROM silver_products WHERE end_date IS NULL""",
    "q31_dim_products": "SELECT * FROM dim_products",
    "q32_resolve_product_key": """
        SELECT order_number, s.product_number, product_key
        FROM silver_sales s LEFT JOIN dim_products p ON s.product_number = p.product_number""",
    "q33_resolve_customer_key": """
        SELECT order_number, s.customer_id, customer_key
        FROM silver_sales s LEFT JOIN dim_customers c ON s.customer_id = c.customer_id""",
    "q34_fact_sales": "SELECT * FROM fact_sales",
    "q35_layered_run": _row_counts(
        {f"bronze.{name}": name for name in _RAW}
        | {f"silver.{name}": step for name, step in _SILVER.items()}
        | {f"gold.{name}": name for name in _GOLD}
    ),
    "q39_star_schema_checks": """
        SELECT (SELECT count(*) > 0 FROM silver_sales) AS not_empty,
               (SELECT count(*) FROM (SELECT 1 FROM dim_customers GROUP BY customer_id)) AS customer_ids,
               (SELECT count(*) FROM (SELECT 1 FROM dim_customers GROUP BY customer_id HAVING count(*) > 1))
                   AS repeated_customer_ids,
               (SELECT count(*) FROM (SELECT 1 FROM dim_products GROUP BY product_number)) AS product_numbers,
               (SELECT count(*) FROM (SELECT 1 FROM dim_products GROUP BY product_number HAVING count(*) > 1))
                   AS repeated_product_numbers,
               (SELECT min(customer_key) FROM dim_customers) AS first_customer_key,
               (SELECT max(customer_key) FROM dim_customers) AS last_customer_key,
               (SELECT count(DISTINCT customer_key) FROM dim_customers) AS customer_keys,
               (SELECT min(customer_key) = 1 AND max(customer_key) = count(*)
                       AND count(DISTINCT customer_key) = count(*) FROM dim_customers) AS customer_keys_gapless,
               (SELECT min(product_key) FROM dim_products) AS first_product_key,
               (SELECT max(product_key) FROM dim_products) AS last_product_key,
               (SELECT count(DISTINCT product_key) FROM dim_products) AS product_keys,
               (SELECT min(product_key) = 1 AND max(product_key) = count(*)
                       AND count(DISTINCT product_key) = count(*) FROM dim_products) AS product_keys_gapless,
               (SELECT count(*) FROM (SELECT 1 FROM dim_products WHERE product_number IS NOT NULL
                                      GROUP BY product_number HAVING count(*) > 1)) AS product_fan_out_keys,
               (SELECT count(*) FROM (SELECT 1 FROM dim_customers WHERE customer_id IS NOT NULL
                                      GROUP BY customer_id HAVING count(*) > 1)) AS customer_fan_out_keys,
               (SELECT count(*) FROM silver_sales) AS rows_before,
               (SELECT count(*) FROM fact_sales) AS rows_after,
               (SELECT count(*) FROM silver_sales) = (SELECT count(*) FROM fact_sales) AS preserved,
               (SELECT count(*) FROM fact_sales WHERE product_key IS NULL) AS product_key_unresolved,
               (SELECT count(*) FROM fact_sales WHERE customer_key IS NULL) AS customer_key_unresolved""",
    "q40_layered_fact": "SELECT * FROM fact_sales",
    "q47_resumed_run": "SELECT * FROM fact_sales",
    "q48_stored_customers": "SELECT * FROM dim_customers",
    "q49_stored_products": "SELECT * FROM dim_products",
    "q50_stored_current_products": "SELECT * FROM silver_products WHERE end_date IS NULL",
}

_FROM_TABLES = {
    "q36_latest_order_per_customer": """
        SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS o_orderdate, o_totalprice
        FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
                                           ORDER BY CAST(o_orderdate AS DATE) DESC NULLS LAST, o_orderkey) AS place
              FROM orders WHERE o_custkey IS NOT NULL)
        WHERE place = 1""",
    "q37_order_validity_intervals": """
        SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS o_orderdate,
               lead(CAST(o_orderdate AS DATE)) OVER (PARTITION BY o_custkey
                   ORDER BY CAST(o_orderdate AS DATE) NULLS FIRST, o_orderkey) - 1 AS valid_to
        FROM orders""",
    "q38_gapless_order_key": """
        SELECT CAST(row_number() OVER (ORDER BY CAST(o_orderdate AS DATE) NULLS FIRST, o_orderkey) AS INT) AS order_seq,
               CAST(o_orderdate AS DATE) AS o_orderdate, o_orderkey
        FROM orders""",
    "q41_validity_of_hot_keys": """
        SELECT l_orderkey, l_linenumber, l_returnflag, CAST(l_shipdate AS DATE) AS l_shipdate,
               lead(CAST(l_shipdate AS DATE)) OVER (PARTITION BY l_returnflag
                   ORDER BY CAST(l_shipdate AS DATE) NULLS FIRST, l_orderkey, l_linenumber) - 1 AS valid_to
        FROM lineitem""",
    "q42_lookups_of_hot_keys": """
        SELECT l_orderkey, l_linenumber, l_suppkey, s_name, n_name
        FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN nation ON s_nationkey = n_nationkey""",
    "q43_hot_keys_in_a_lookup": """
        SELECT s_suppkey, s_name, l_orderkey, l_linenumber FROM supplier LEFT JOIN lineitem ON s_suppkey = l_suppkey""",
    "q44_gapless_key_of_copies": """
        SELECT row_number() OVER (ORDER BY l_returnflag NULLS FIRST, l_linestatus NULLS FIRST) AS line_seq,
               l_returnflag, l_linestatus
        FROM lineitem""",
    "q45_keys_in_bitmaps": """
        WITH named AS (
            SELECT 'o_orderkey' AS column_name, CAST(o_orderkey AS BIGINT) AS key FROM orders
            UNION ALL
            SELECT 'o_custkey_thinned', CASE WHEN o_custkey % 5 > 0 THEN CAST(o_custkey AS BIGINT) END FROM orders
            UNION ALL
            SELECT 'l_orderkey', CAST(l_orderkey AS BIGINT) FROM lineitem),
        per_key AS (SELECT column_name, key, count(*) AS n FROM named GROUP BY column_name, key)
        SELECT column_name, count(*) AS keys, count(*) FILTER (n > 1) AS repeated_keys,
               min(key) AS first_key, max(key) AS last_key, count(key) AS keys_set,
               min(key) = 1 AND max(key) = sum(n) AND count(key) = sum(n) AS gapless,
               count(*) FILTER (n > 1 AND key IS NOT NULL) AS fan_out_keys
        FROM per_key GROUP BY column_name""",
    "q46_rejected_lines": """
        WITH lines AS (
            SELECT c_custkey % 5 AS kind, CAST(c_custkey AS VARCHAR) AS key,
                   concat(c_custkey, ',AW', c_custkey, ',Ann,Lee,S,F,2024-01-01') AS good FROM customer)
        SELECT 'crm_cust_info' AS feed,
               CASE kind WHEN 1 THEN 'x' || good WHEN 2 THEN concat(key, ',AW', key) ELSE good || ',surplus' END AS line,
               (SELECT count(*) FROM lines) AS landed
        FROM lines WHERE kind IN (1, 2, 3)""",
}

ORACLE_SQL = {
    name: sql for name, sql in sorted(({n: _from_steps(s) for n, s in _FROM_STEPS.items()} | _FROM_TABLES).items())
}
