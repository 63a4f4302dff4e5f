"""Encoders and parser queries on batches beyond what small tables hold."""

from decimal import Decimal

import duckdb
import pytest
from pyspark.sql import functions as F

from tallyproof import catalog
from tallyproof.sources import batches, encoders
from test_queries import rows


def test_slips_of_very_many_lots_keep_their_order(spark):
    one = {"batch_id": "B000000000000001", "file_date": "20260723", "payment_reference": "R", "due": "20260731", "paid": "20260723", "status": "PG", "bank_reference": "B", "tax_type": "F", "tax_id": "00012345678909", "name": "N", "bank": "001", "branch": "00012", "account": "000000000001", "digit": "7", "client_reference": "C"}
    places = [(1, 1), (1, 300_000), (2, 300_001), (2_047, 500_000), (2_048, 500_001), (999_998, 999_998)]
    slips = spark.createDataFrame([one | {"lot": lot, "position": at, "settlement_id": f"SLP{at:013d}"} for lot, at in places]).withColumns({"lot": F.col("lot").cast("int"), "position": F.col("position").cast("int"), **{x: F.lit(v).cast("decimal(18,2)") for x, v in (("face_amount_brl", "10.00"), ("discount_brl", "0.01"), ("fee_brl", "2.00"))}})
    text = encoders.payment_slips(slips).first().content
    assert "".join(line[0] for line in text.split("\r\n") if line) == "HLABABTLABTLABTLABTLABTZ"
    found = batches.payment_slips(spark.createDataFrame([("/in/a", bytearray(text.encode()))], "path string, content binary"), b"k").batches.first()
    assert (found.rejection_code, found.computed_net) == (None, Decimal("71.94"))


@pytest.mark.parametrize("name", ["parser_chargebacks", "parser_instant_payments", "parser_merchant_fees"])
def test_batches_beyond_the_rows_of_a_file(spark, sf, monkeypatch, name):
    monkeypatch.setattr(batches, "MOST_ROWS", 3)  # of the layout, so that a table of some rows a batch goes beyond it
    con = duckdb.connect()
    con.execute(f"create view customer as select * from '{sf}/customer.parquet'")
    assert rows(catalog.QUERIES[name](spark, sf).toArrow()) == rows(con.sql(catalog.SQL[name]).to_arrow_table())
