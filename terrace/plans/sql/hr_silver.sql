-- Landing HR CSV (all text) -> typed silver rows.
-- Bound by the caller: {source} (the landing rows with their _source_file), :source_file (or NULL), :run_id, :processed_at_utc.
SELECT
  try_cast(EmployeeNumber AS INT)                                    AS employee_number,
  trim(lower(Department))                                            AS department,
  trim(lower(JobRole))                                               AS job_role,
  try_cast(JobLevel AS INT)                                          AS job_level,
  coalesce(trim(lower(OverTime)) IN ('yes', 'true'), false)          AS over_time,
  try_cast(MonthlyIncome AS DECIMAL(12, 2))                          AS monthly_income,
  try_cast(PercentSalaryHike AS INT)                                 AS percent_salary_hike,
  try_cast(YearsAtCompany AS INT)                                    AS years_at_company,
  try_cast(YearsSinceLastPromotion AS INT)                           AS years_since_last_promotion,
  try_cast(TotalWorkingYears AS INT)                                 AS total_working_years,
  try_cast(JobSatisfaction AS INT)                                   AS job_satisfaction,
  try_cast(EnvironmentSatisfaction AS INT)                           AS environment_satisfaction,
  try_cast(RelationshipSatisfaction AS INT)                          AS relationship_satisfaction,
  try_cast(WorkLifeBalance AS INT)                                   AS work_life_balance,
  coalesce(trim(lower(Attrition)) IN ('yes', 'true'), false)         AS attrition,
  coalesce(CAST(:source_file AS STRING), _source_file) AS source_file,
  CAST(:run_id AS STRING)                                            AS run_id,
  CAST(:processed_at_utc AS TIMESTAMP)                               AS processed_at_utc
FROM {source}
