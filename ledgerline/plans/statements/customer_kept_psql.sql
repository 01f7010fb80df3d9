-- All versions so far; every version of an id that opens one again ends now.
SELECT d.customer_key, d.id, d.source_system, d.customer_id, d.customer_name, d.customer_address,
       d.created_at, d.updated_at, d.dwh_load_date,
       d.is_active AND o.id IS NULL AS is_active,
       d.effective_start_date,
       CASE WHEN o.id IS NULL THEN d.effective_end_date ELSE CAST(:run_ts AS TIMESTAMP_NTZ) END AS effective_end_date
FROM IDENTIFIER(:dim) AS d
LEFT JOIN IDENTIFIER(:opened) AS o ON o.id = d.id
