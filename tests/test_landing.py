"""Landing files that cannot be read whole: nothing that arrived is lost."""

import json

from conftest import CUSTOMERS
from tierwise.operators import silver as sv
from tierwise.operators.clean import split
from tierwise.sources import readers


def test_a_broken_json_file_keeps_its_text(spark, tmp_path):
    (tmp_path / "good.json").write_text(json.dumps(CUSTOMERS))
    broken = '[{"customer_id": "CUST09", "name": "Cut off'
    (tmp_path / "broken.json").write_text(broken)
    rows = readers.scan_json(spark, str(tmp_path), readers.CUSTOMERS_COLUMNS)
    good, bad = split(sv.labelled(sv.customer_entity("string"), rows, drop=[], keep_raw=True))
    assert good.count() == len(CUSTOMERS)
    (row,) = bad.collect()
    assert (row["data_issue"], row["_corrupt_record"]) == ("malformed record", broken)
    assert row["_file"].endswith("broken.json")


def test_a_broken_json_line_keeps_its_text(spark, tmp_path):
    (tmp_path / "lines.json").write_text("\n".join([json.dumps(CUSTOMERS[0]), '{"customer_id": ', json.dumps(CUSTOMERS[1])]))
    rows = readers.scan_json(spark, str(tmp_path), readers.CUSTOMERS_COLUMNS, multiline=False).collect()
    assert [r["customer_id"] for r in rows if r["_corrupt_record"] is None] == ["CUST01", "CUST02"]
    assert [r["_corrupt_record"] for r in rows if r["_corrupt_record"]] == ['{"customer_id": ']
