import pytest

from packetloom.contract import (
    IDENTITY_PAYLOAD_COLUMNS,
    PACKET_COLUMNS,
    WINDOW_SUMMARY_FIELDS,
    FeatureContract,
    Thresholds,
    feature_columns,
    merge_fields,
    requested_fields,
    resolve_thresholds,
    source_names,
    spark_names,
    split_supported,
)


def test_field_lists():
    assert len(PACKET_COLUMNS) == len(set(spark_names(PACKET_COLUMNS))) == 63
    assert len(IDENTITY_PAYLOAD_COLUMNS) == 15 and set(IDENTITY_PAYLOAD_COLUMNS) < set(PACKET_COLUMNS)
    assert len(WINDOW_SUMMARY_FIELDS) == 18
    assert len(feature_columns(spark_names(PACKET_COLUMNS))) == 61
    assert source_names(spark_names(PACKET_COLUMNS)) == PACKET_COLUMNS


def test_merge_and_support():
    assert merge_fields(["b", "a"], ["a", "c"]) == ["b", "a", "c"]
    assert split_supported(["c", "a", "b"], {"a", "c"}) == (["c", "a"], ["b"])
    assert split_supported(["c"], None) == (["c"], [])
    with pytest.raises(ValueError):
        split_supported(["c"], {"x"})
    contract = FeatureContract(["tcp_flags", "x"], ["x"], ["tcp_flags"])
    assert requested_fields(contract, False) == ["tcp_flags", "x"]
    assert requested_fields(contract).count("tcp_flags") == 1


def test_threshold_precedence():
    argument, baseline, bundle = Thresholds(file_ratio=0.9), Thresholds(0.6, min_records=20), Thresholds(0.7, 0.8, 0.3, 5)
    assert resolve_thresholds(argument, baseline, bundle) == Thresholds(0.6, 0.8, 0.9, 20)
    assert resolve_thresholds(None, Thresholds(0.7)) == Thresholds(0.7, 0.7, 0.4, 50)
    # An explicit value stands even if it equals the default.
    assert resolve_thresholds(Thresholds(min_records=50), Thresholds(min_records=3)).min_records == 50


def test_contract_round_trip(spark):
    contract = FeatureContract(["a"], ["a"], [], 10, 8, "Attack_label", medians={"a": 1.5}, min_records=7)
    assert FeatureContract.from_json(contract.to_json()) == contract
    assert contract.report(spark).first().asDict()["rows_after_drop_duplicates"] == 8
