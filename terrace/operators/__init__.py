from terrace.operators.quality import (
    ContractError,
    GateResult,
    QualityError,
    check_columns,
    compile_rules,
    duplicate_key_groups,
    enforce,
    quality_report,
)

__all__ = [
    "ContractError",
    "GateResult",
    "QualityError",
    "check_columns",
    "compile_rules",
    "duplicate_key_groups",
    "enforce",
    "quality_report",
]
