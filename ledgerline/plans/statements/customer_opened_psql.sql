-- Customers of the batch that open a version: new ones, and those whose tracked
-- columns differ from their active version; text that is missing is carried on.
SELECT s.id,
       s.source_system,
       s.customer_id,
       coalesce(s.customer_name, d.customer_name) AS customer_name,
       coalesce(s.customer_address, d.customer_address) AS customer_address,
       CAST(NULL AS TIMESTAMP_NTZ) AS created_at,
       s.updated_at,
       s.dwh_load_date,
       true AS is_active,
       CAST(:run_ts AS TIMESTAMP_NTZ) AS effective_start_date,
       CAST(NULL AS TIMESTAMP_NTZ) AS effective_end_date
FROM IDENTIFIER(:stage) AS s
LEFT JOIN (SELECT * FROM IDENTIFIER(:dim) WHERE is_active) AS d ON d.id = s.id
WHERE d.id IS NULL
   OR s.customer_name <> coalesce(d.customer_name, '')
   OR s.customer_address <> coalesce(d.customer_address, '')
