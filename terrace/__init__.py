"""Contract-driven medallion tables on Spark: landing files -> silver -> gold -> snapshot."""

from terrace.contract import ColumnSpec, Contract, load_contracts
from terrace.run import Arrival, RunContext, parse_business_date
from terrace.session import build_session, shared_root

__all__ = ["Arrival", "ColumnSpec", "Contract", "RunContext", "build_session", "load_contracts", "parse_business_date", "shared_root"]
