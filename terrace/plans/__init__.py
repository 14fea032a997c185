from terrace.plans.chain import MedallionPaths, MedallionPlan, backfill, run_chain, run_partition_summary
from terrace.plans.jobs import JobResult, TableSpec, publish, run_table_job, sql_transform

__all__ = [
    "JobResult",
    "MedallionPaths",
    "MedallionPlan",
    "TableSpec",
    "backfill",
    "publish",
    "run_chain",
    "run_partition_summary",
    "run_table_job",
    "sql_transform",
]
