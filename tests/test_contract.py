import pytest
from pyspark.sql import types as T

from terrace.contract import Contract, load_contracts
from terrace.plans import hr, orders


def test_hr_contracts_have_declared_shapes():
    assert len(hr.SILVER.names) == 18
    assert len(hr.GOLD.names) == 26
    assert hr.BI.names == hr.GOLD.names
    assert hr.SILVER.primary_key == ("employee_number",)
    assert hr.GOLD.partition_columns == ("year", "month", "day")
    assert hr.BI.partition_columns == ()


def test_schema_types():
    schema = hr.GOLD.schema
    assert schema["monthly_income"].dataType == T.DecimalType(12, 2)
    assert schema["ingestion_date"].dataType == T.DateType()
    assert schema["processed_at_utc"].dataType == T.TimestampType()
    assert schema["attrition"].dataType == T.BooleanType()
    assert not schema["employee_id"].nullable


def test_partitions_last_for_catalog():
    names = hr.GOLD.with_partitions_last().names
    assert names[-3:] == ["year", "month", "day"]
    assert orders.GOLD.with_partitions_last().names[0] == "order_key"


def test_invalid_contracts_are_rejected():
    with pytest.raises(ValueError):
        Contract.from_dict("x", {"columns": []})
    with pytest.raises(ValueError):
        Contract.from_dict("x", {"primary_key": ["nope"], "columns": [{"name": "a"}]})
    with pytest.raises(ValueError):
        Contract.from_dict("x", {"columns": [{"name": "a", "type": "blob"}]}).schema


def test_load_from_dict():
    contracts = load_contracts({"datasets": {"t": {"columns": [{"name": "a", "type": "decimal(5, 1)"}]}}})
    assert contracts["t"].schema["a"].dataType == T.DecimalType(5, 1)
