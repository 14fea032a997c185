"""HR attrition medallion: landing CSV -> silver -> gold -> BI snapshot, silver and gold from SQL.

The SQL files read ``{source}`` (the previous table, bound as a DataFrame)
and take run values as typed ``:name`` parameters.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace import functions as TF
from terrace.contract import Contract, load_contracts
from terrace.plans.chain import MedallionPlan
from terrace.plans.jobs import TableSpec, sql_transform
from terrace.run import RunContext
from terrace.sources import read_csv_strings

_HERE = Path(__file__).parent
CONTRACTS: dict[str, Contract] = load_contracts(_HERE / "contracts" / "hr.yaml")
SILVER = CONTRACTS["silver_hr_employees"]
GOLD = CONTRACTS["gold_hr_attrition_fact"]
BI = CONTRACTS["bi_hr_attrition_snapshot"]


def sql_text(name: str) -> str:
    return (_HERE / "sql" / f"{name}.sql").read_text(encoding="utf-8")


to_silver = sql_transform(sql_text("hr_silver"))
_facts = sql_transform(sql_text("hr_gold"))

# The landing columns of an HR file; further ones are dropped.
BRONZE_COLUMNS = [
    "EmployeeNumber", "Department", "JobRole", "JobLevel", "OverTime", "MonthlyIncome", "PercentSalaryHike",
    "YearsAtCompany", "YearsSinceLastPromotion", "TotalWorkingYears", "JobSatisfaction", "EnvironmentSatisfaction",
    "RelationshipSatisfaction", "WorkLifeBalance", "Attrition",
]


def to_gold(silver: DataFrame, run: RunContext) -> DataFrame:
    """Gold facts of one business date, every ``*_score`` with its label."""
    facts = _facts(silver, run)
    labels = {name: TF.score_label(name.replace("_label", "_score")) for name in GOLD.names if name.endswith("_label")}
    return facts.withColumns(labels).select(*GOLD.names)


def to_bi(gold: DataFrame, run: RunContext) -> DataFrame:
    """One business date of gold in the snapshot's column order; the equalities prune every other date's folder."""
    for name, value in run.partition_values.items():
        gold = gold.where(F.col(name) == value)
    return gold.select(*BI.names)


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    """Landing HR CSV: the columns above by header name, in any order, every one as text."""
    return read_csv_strings(spark, path, BRONZE_COLUMNS, with_file_name=True)


def silver_spec(path: str, **overrides) -> TableSpec:
    return TableSpec(contract=SILVER, path=path, **overrides)


def gold_spec(path: str, **overrides) -> TableSpec:
    options = dict(write_mode="overwrite_partition", partition_by=tuple(GOLD.partition_columns))
    options.update(overrides)
    return TableSpec(contract=GOLD, path=path, **options)


def bi_spec(path: str, fmt: str = "csv", **overrides) -> TableSpec:
    """The snapshot: a folder at a stable path, written in parallel (``layout="file"`` for one file)."""
    return TableSpec(contract=BI, path=path, fmt=fmt, check_run_date=False, **overrides)


def plan() -> MedallionPlan:
    return MedallionPlan("hr_attrition", read_bronze, to_silver, to_gold, to_bi, silver_spec, gold_spec, bi_spec)
