"""Whole-file parsing: accepted batches, source lies and malformed files."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyproof.sources import batches as B

KEY = b"a key for tests"


def files(spark, **named):
    return spark.createDataFrame([(f"/in/{k}", bytearray(v)) for k, v in named.items()], "path string, content binary")


def verdicts(result):
    return {r.path.rsplit("/", 1)[1]: r.rejection_code for r in result.batches.collect()}


def card(net="0000000000173 4E".replace(" ", ""), count="000002", second="00000000500", sign="{", move="P"):
    lines = [
        "H20260723B202607230000004CRD_SETTLE01001",
        "DTXN0000000000001MERCHANT000000014111111111111111123456789092026072309153000000001234EBRLPA1B2C3000000000001TERMINAL00000001",
        f"DTXN0000000000002MERCHANT00000002555555555555444498765432100202607231015{'00'}{second}{sign}BRL{move}D4E5F6000000000002TERMINAL00000002",
        f"T20260723{count}{net}B202607230000004",
    ]
    return ("\n".join(lines) + "\n").encode("latin-1")


def test_card_settlement(spark):
    good = card(net="00000000001734E")
    result = B.card_settlement(
        files(spark, good=good, lie=card(net="00000000001734D"), short=card(net="00000000001734E", count="000003"), crlf=good.replace(b"\n", b"\r\n"), punch=good.replace(b"1234EBRL", b"1234ZBRL"), sign=card(net="00000000001734E", move="R"), cut=good.replace(b"TERMINAL00000002", b"TERMINAL0002"), empty=b"", bare=b"H\n"),
        KEY,
    )
    assert verdicts(result) == {
        "good": None, "lie": "SOURCE_CONTROL_TOTAL_MISMATCH", "short": "TRAILER_MISMATCH", "crlf": "INVALID_TRANSPORT", "punch": "INVALID_OVERPUNCH", "sign": "INVALID_MOVEMENT_AMOUNT", "cut": "INVALID_RECORD_LENGTH", "empty": "INVALID_TRANSPORT", "bare": "INVALID_RECORD_SEQUENCE",
    }
    rows = result.details.orderBy("source_record_number").collect()
    assert [(r.source_record_number, r.amount_brl, r.card_last4, r.cpf_masked, r.transaction_ts) for r in rows] == [
        (2, Decimal("123.45"), "1111", "*******8909", "2026-07-23T09:15:30-03:00"),
        (3, Decimal("50.00"), "4444", "*******2100", "2026-07-23T10:15:00-03:00"),
    ]
    lie = result.batches.filter(F.col("path").endswith("lie")).first()
    assert (lie.declared_net, lie.computed_net) == (Decimal("173.44"), Decimal("173.45"))


EVENTS = r"""H|PIX_EVENTS01|001|20260723|B202607230000101
D|E2026072300000000000000000000001|PIXTXN0000000001|CPF|12345678909|CNPJ|12345678000195|2026-07-23T09:00:00-03:00|200.00|C|SETTLED||Invoice 1001
D|E2026072300000000000000000000002|PIXTXN0000000002|CNPJ|98765432000198|CPF|11144477735|2026-07-23T10:00:00-03:00|26.55|D|RETURNED|AC03|Return\|beneficiary
T|2|200.00|26.55|173.45
"""


def test_instant_payments(spark):
    change = lambda a, b: EVENTS.replace(a, b).encode()
    result = B.instant_payments(
        files(spark, good=EVENTS.encode(), lie=change("173.45", "173.44"), credit=change("T|2|200.00", "T|2|200.01"), fields=change("|Invoice 1001", ""), escape=change(r"Return\|", r"Return\x"), document=change("12345678909", "12345678900"), code=change("RETURNED|AC03", "RETURNED|"), time=change("2026-07-23T09", "2026-07-22T09"), twice=change("PIXTXN0000000002", "PIXTXN0000000001"), formula=change("Invoice", "=Invoice")),
        KEY,
    )
    assert verdicts(result) == {
        "good": None, "lie": "SOURCE_CONTROL_NET_MISMATCH", "credit": "SOURCE_CONTROL_CREDIT_MISMATCH", "fields": "INVALID_FIELD_COUNT", "escape": "INVALID_ESCAPE", "document": "INVALID_DOCUMENT", "code": "INVALID_STATUS_RETURN_CODE", "time": "INVALID_TIMESTAMP", "twice": "DUPLICATE_IDENTIFIER", "formula": "INVALID_DESCRIPTION",
    }
    rows = result.details.orderBy("source_record_number").collect()
    assert [(r.amount_brl, r.return_code, r.description) for r in rows] == [(Decimal("200.00"), None, "Invoice 1001"), (Decimal("-26.55"), "AC03", "Return|beneficiary")]


CHARGEBACK = """chargeback_id;batch_id;merchant_id;merchant_tax_id;reason_code;description;original_amount_brl;rate_percent;chargeback_amount_brl;business_date
CBK2026072305001;B202607230000501;MER0000000000001;12345678000195;FRAUD;"Ajuste ""de""; chargeback";67,00;1,500;1,01;23/07/2026
"""


def test_merchant_csv(spark):
    change = lambda a, b: CHARGEBACK.replace(a, b).encode()
    result = B.merchant_csv(
        files(spark, good=CHARGEBACK.encode(), even=change(";1,01;", ";1,00;"), quoting=change("FRAUD", '"FRAUD"'), header=change("chargeback_id;", "id;"), date=change("23/07/2026", "31/02/2026"), count=change(";23/07/2026", ""), document=change("000195", "000194")), "06",
    )
    assert verdicts(result) == {"good": None, "even": "CHARGEBACK_CALCULATION_MISMATCH", "quoting": "INVALID_CSV_QUOTING", "header": "INVALID_HEADER", "date": "INVALID_BUSINESS_DATE", "count": "INVALID_FIELD_COUNT", "document": "INVALID_DOCUMENT"}
    row = result.details.first()
    assert (row.description, row.calculated_amount_brl, row.business_date) == ('Ajuste "de"; chargeback', Decimal("1.01"), "2026-07-23")


def test_declared_totals_of_a_csv(spark):
    source = files(spark, good=CHARGEBACK.encode())
    declared = spark.createDataFrame([("/in/good", Decimal("1.00"))], "path string, amount decimal(18,2)")
    assert verdicts(B.merchant_csv(source, "06", declared)) == {"good": "SOURCE_CONTROL_CHARGEBACK_MISMATCH"}


def slip(face="000000000010000", pair="000001", total="000000000009850"):
    fill = lambda s: s + "~" * (240 - len(s))
    ident = "SLP0000000000001"
    lines = [
        "H20260723B202607230000201PAY_SLIPS_01001BANK0001000001",
        "L000001PAYMENT_SLIPBRL20260723B202607230000201ORIGIN0000000001",
        "A000001000001" + ident + "REF".ljust(48, "0") + face + "20260731" + "20260723" + "000000000500" + "000000000350" + "OK" + "BANKREF0000000000001",
        "B000001" + pair + ident + "P" + "00012345678909" + "NAME".ljust(40) + "001" + "00001" + "000000000001" + "1" + "CLIENTREF00000000001",
        "T000001000001" + "000000000010000" + "000000000000500" + "000000000000350" + total + "B202607230000201",
        "Z000001000006000001" + total + "B202607230000201",
    ]
    return ("\r\n".join(map(fill, lines)) + "\r\n").encode()


def test_payment_slips(spark):
    result = B.payment_slips(files(spark, good=slip(), pair=slip(pair="000002"), net=slip(total="000000000009849"), short=slip()[:-5] + b"\r\n"), KEY)
    assert verdicts(result) == {"good": None, "pair": "SEGMENT_PAIR_MISMATCH", "net": "SOURCE_CONTROL_NET_MISMATCH", "short": "INVALID_RECORD_LENGTH"}
    row = result.details.first()
    assert (row.net_amount_brl, row.beneficiary_tax_id_type, row.due_date) == (Decimal("98.50"), "CPF", "2026-07-31")


def ted(back="-00000000025000", net="+00000000075000"):
    tid, lines = "TED0000000000001", []
    party = "123456780001000000000001" + "00012345678909" + "F"
    lines.append("H20260723B202607230000301TED_SETTLE01001" + "2026072312345678")
    lines.append("D" + tid + "+00000000100000BRL20260723090000" + party + party + "PURPOSE001" + "RT" + "NAME".ljust(23))
    lines.append("R" + "RET0000000000001" + tid + back + "20260723100000" + "AC03 " + "RETURNED".ljust(24))
    lines.append("T20260723000001000001" + "+00000000100000" + "-00000000025000" + net + "B202607230000301")
    return ("\r\n".join(lines) + "\r\n").encode()


def test_ted_transfers(spark):
    whole = ted(back="-00000000100000", net="+00000000000000").replace(b"-00000000025000+", b"-00000000100000+")
    result = B.ted_transfers(files(spark, whole=whole, part=ted(), lie=whole.replace(b"+00000000000000B", b"+00000000000001B")), KEY)
    assert verdicts(result) == {"whole": None, "part": "RETURN_LINK_MISMATCH", "lie": "SOURCE_CONTROL_NET_MISMATCH"}
    assert {r.movement_kind: r.amount_brl for r in result.details.collect()} == {"TRANSFER": Decimal("1000.00"), "RETURN": Decimal("-1000.00")}


@pytest.mark.parametrize("kind", ["01", "02", "03", "04", "05", "06"])
def test_no_files(spark, kind):
    result = B.parse(kind, spark.createDataFrame([], "path string, content binary"), KEY)
    assert result.batches.count() == 0 and result.details.count() == 0


def test_normal_form_bounds_and_sidecars(spark, tmp_path):
    odd = EVENTS.replace("Invoice 1001", "Invoice é").encode()
    fine = EVENTS.replace("Invoice 1001", "Invoice é").encode()
    head, one, two, tail = EVENTS.strip("\n").split("\n")
    many = "\n".join([head, *[one] * 10_001, tail]) + "\n"
    assert verdicts(B.instant_payments(files(spark, odd=odd, fine=fine), KEY)) == {"odd": "INVALID_DESCRIPTION", "fine": None}
    (tmp_path / "many").write_text(many)
    assert verdicts(B.instant_payments(B.read_files(spark, str(tmp_path)), KEY)) == {"many": "INVALID_RECORD_SEQUENCE"}
    blank = CHARGEBACK.replace("FRAUD", " FRAUD").encode()
    assert verdicts(B.merchant_csv(files(spark, blank=blank), "06")) == {"blank": "INVALID_CSV_QUOTING"}
    rows = spark.createDataFrame([("/in/B1/a.csv", bytearray(CHARGEBACK.encode())), ("/in/B2/a.csv", bytearray(CHARGEBACK.encode())), ("/in/B3/a.csv", bytearray(CHARGEBACK.encode()))], "path string, content binary")
    beside = spark.createDataFrame([("/in/B1/source-manifest.json", bytearray(b'{"source_controls":{"row_count":1,"chargeback_amount":"1.00"}}')), ("/in/B2/source-manifest.json", bytearray(b'{"controls":{"row_count":2}}'))], "path string, content binary")
    found = {r.path: r.rejection_code for r in B.parse("06", rows, KEY, beside).batches.collect()}
    assert found == {"/in/B1/a.csv": "SOURCE_CONTROL_CHARGEBACK_MISMATCH", "/in/B2/a.csv": "SOURCE_CONTROL_COUNT_MISMATCH", "/in/B3/a.csv": None}
