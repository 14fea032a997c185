-- Silver HR rows -> gold facts for one business date.
-- Bound by the caller: {source} (silver), :ingestion_date, :year, :month, :day, :run_id, :processed_at_utc.
-- The labels of the scores are added by the plan.
SELECT
  employee_number                                                    AS employee_id,
  CAST(:ingestion_date AS DATE)                                      AS ingestion_date,
  CAST(:year AS INT)                                                 AS year,
  CAST(:month AS INT)                                                AS month,
  CAST(:day AS INT)                                                  AS day,
  department,
  job_role,
  job_level,
  attrition,
  monthly_income,
  percent_salary_hike,
  years_at_company,
  years_since_last_promotion,
  total_working_years,
  over_time,
  job_satisfaction                                                   AS job_satisfaction_score,
  environment_satisfaction                                           AS environment_satisfaction_score,
  relationship_satisfaction                                          AS relationship_satisfaction_score,
  work_life_balance                                                  AS work_life_balance_score,
  source_file,
  CAST(:run_id AS STRING)                                            AS run_id,
  CAST(:processed_at_utc AS TIMESTAMP)                               AS processed_at_utc
FROM {source}
