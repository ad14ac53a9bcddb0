import json

import pytest

from catalogue import check, collecting

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("bits", [5, 12])
def test_contracts_are_written_as_bounded_arrays(spark, tmp_path, monkeypatch, bits):
    monkeypatch.setattr(collecting, "BLOCK_BITS", bits)
    monkeypatch.setattr(collecting.session, "shared_folder", lambda _: str(tmp_path))
    _, _, same, said = check.compare(spark, check.connect(SF), SF, *collecting.ENTRIES["register_contracts"])
    assert same, said
    written = [json.loads(f.read_text()) for f in tmp_path.glob("contracts-*/part-*") if f.stat().st_size]
    total = spark.read.parquet(f"{SF}/customer.parquet").count()
    assert max(map(len, written)) <= 1 << bits and sum(map(len, written)) == total


def test_contracts_of_no_customers(spark, tmp_path):
    customers = spark.read.parquet(f"{SF}/customer.parquet").limit(0)
    customers.write.parquet(str(tmp_path / "customer.parquet"))
    assert collecting.q_contracts(spark, str(tmp_path)).collect() == []
