"""Payment batches: one file is one batch; it is accepted whole or refused with one code.

Each parser turns whole files into records with their place, then into rule
findings (phase, place, code).  A batch's code is that of the earliest phase
and, in it, the earliest record, as the contracts order their checks.  A
refused batch gives no rows; its declared and computed totals are kept.
Each rule is a query of its own, so the records of types 02, 03, 05 and 06 are
written to the scratch folder once they are cut, and not cut again for each.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyproof.functions import money as M
from tallyproof.functions import privacy as P
from tallyproof.functions import text as X
from tallyproof.functions import timestamps as T
from tallyproof.operators.controls import first_by_phase
from tallyproof.plans.storage import written

BATCH = r"^B[0-9]{15}\z"
#: The most events or rows of a file of types 02, 05 and 06.
MOST_ROWS = 10_000


@dataclass
class Result:
    """``batches``: path, batch_id, accepted, rejection_code and totals; ``details``: rows of accepted batches."""

    batches: DataFrame
    details: DataFrame


def read_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, content) of whole files."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path).select("path", "content")


@dataclass
class Rules:
    """Findings gathered from several frames with the columns path, position."""

    frames: list[DataFrame] = field(default_factory=list)

    def add(self, rows: DataFrame, phase: int, code: str, wrong: Column, position: Column | None = None) -> None:
        at = F.col("position") if position is None else position
        self.frames.append(rows.filter(F.coalesce(wrong, F.lit(True))).select("path", F.lit(phase).alias("phase"), at.cast("int").alias("position"), F.lit(code).alias("code")))

    def verdicts(self) -> DataFrame:
        found = self.frames[0]
        for f in self.frames[1:]:
            found = found.unionByName(f)
        return first_by_phase(found, "path")


def lines_of(files: DataFrame, charset: str, ending: str) -> DataFrame:
    """(path, position from 1, record, n) of each line of each file."""
    text = F.decode("content", charset)
    body = F.when(text.endswith(ending), text.substr(F.lit(1), F.length(text) - len(ending))).otherwise(text)
    split = files.filter(F.length("content") > 0).select("path", F.split(body, ending, -1).alias("all"))
    counted = split.select("path", F.size("all").alias("n"), "all")  # before the lines part, or each would carry them all
    return counted.select("path", "n", F.posexplode("all").alias("p", "record")).select("path", (F.col("p") + 1).alias("position"), "record", "n")


def transport(files: DataFrame, ending: str, ascii_only: bool = False, utf8: bool = False, most: int | None = None) -> Column:
    """Whether a file's bytes are refused before any record is read."""
    raw = F.decode("content", "ISO-8859-1")
    wrong = (F.length("content") == 0) | ~raw.endswith(ending)
    wrong = wrong | (raw.contains("\r") if ending == "\n" else F.regexp_replace(raw, "\r\n", "").rlike("[\r\n]"))
    if ascii_only:
        wrong = wrong | raw.rlike("[^\\x00-\\x7F]")
    if utf8:
        wrong = wrong | ~F.is_valid_utf8(F.col("content")) | raw.startswith("ï»¿") | raw.contains("\u0000")
    if most:
        wrong = wrong | (F.length("content") > most)
    return wrong


def kind_of(record: Column) -> Column:
    return F.substring(record, 1, 1)


def _finish(files: DataFrame, rules: Rules, totals: DataFrame, checks: list[tuple[str, str]], details: DataFrame) -> Result:
    """Verdicts of all files: findings first, then the first declared total that differs from the computed one."""
    early = rules.verdicts()
    joined = files.select("path").join(early, "path", "left").join(totals, "path", "left")
    late = F.coalesce(*(F.when(~F.col(f"declared_{c}").eqNullSafe(F.col(f"computed_{c}")), code) for c, code in checks))
    code = F.coalesce(F.col("rejection_code"), late)
    batches = joined.withColumn("rejection_code", code).withColumn("accepted", F.col("rejection_code").isNull())
    kept = details.join(batches.filter("accepted").select("path"), "path", "left_semi")
    return Result(batches, kept)


def _cross(path: Column, date: Column, batch: Column) -> Column:
    """Whether a file's name tells another date or batch than its header."""
    d, b = F.regexp_extract(path, r"(\d{8})_(B[0-9]{15})[^/]*$", 1), F.regexp_extract(path, r"(\d{8})_(B[0-9]{15})[^/]*$", 2)
    return (d != "") & ((d != date) | (b != batch))


def card_settlement(files: DataFrame, key: bytes) -> Result:
    """Type 01: fixed width, ISO-8859-1, H 40, D 124, T 46."""
    rules = Rules()
    rules.add(files, 0, "INVALID_TRANSPORT", transport(files, "\n"), F.lit(0))
    rows = lines_of(files, "ISO-8859-1", "\n")
    r = F.col("record")
    wanted = F.when(F.col("position") == 1, "H").when(F.col("position") == F.col("n"), "T").otherwise("D")
    rules.add(rows, 1, "INVALID_RECORD_SEQUENCE", (kind_of(r) != wanted) | (F.col("n") < 3))
    size = F.when(wanted == "H", 40).when(wanted == "T", 46).otherwise(124)
    rules.add(rows, 2, "INVALID_RECORD_LENGTH", F.length(r) != size)
    s = lambda a, b: X.slice_of(r, a, b)
    head = rows.filter("position = 1").select("path", "position", s(2, 9).alias("file_date"), s(10, 25).alias("batch_id"), s(26, 37).alias("kind"), s(38, 40).alias("layout"))
    tail = rows.filter("position = n and n > 1").select("path", s(2, 9).alias("t_date"), s(10, 15).alias("count"), M.overpunch_decode(s(16, 30)).alias("declared_net"), s(31, 46).alias("t_batch"))
    rules.add(head, 3, "HEADER_MISMATCH", (F.col("kind") != "CRD_SETTLE01") | (F.col("layout") != "001") | ~F.col("file_date").rlike(r"^\d{8}\z"))
    rules.add(head, 4, "INVALID_BATCH_ID", ~F.col("batch_id").rlike(BATCH))
    rules.add(tail.withColumn("position", F.lit(0)), 5, "INVALID_TRAILER", ~F.col("count").rlike(r"^\d{6}\z"))
    rules.add(tail.withColumn("position", F.lit(0)), 5, "INVALID_OVERPUNCH", F.col("declared_net").isNull())
    both = head.join(tail, "path")
    rules.add(both, 6, "HEADER_MISMATCH", (F.col("file_date") != F.col("t_date")) | (F.col("batch_id") != F.col("t_batch")) | _cross(F.col("path"), F.col("file_date"), F.col("batch_id")))
    body = rows.filter("position > 1 and position < n").select(
        "path", "position", s(2, 17).alias("transaction_id"), s(18, 33).alias("merchant_id"), s(34, 49).alias("pan"), s(50, 60).alias("cpf"), s(61, 68).alias("date"), s(69, 74).alias("time"),
        M.overpunch_decode(s(75, 86)).alias("amount_brl"), s(87, 89).alias("currency"), s(90, 90).alias("movement_code"), s(91, 96).alias("authorization_code"), s(97, 108).alias("nsu"), s(109, 124).alias("terminal_id"),
    )
    amount, move = F.col("amount_brl"), F.col("movement_code")
    rules.add(body, 7, "INVALID_OVERPUNCH", amount.isNull())
    shape = F.col("transaction_id").rlike(r"^[A-Z0-9]{16}\z") & F.col("merchant_id").rlike(r"^[A-Z0-9]{16}\z") & F.col("authorization_code").rlike(r"^[A-Z0-9]{6}\z") & F.col("nsu").rlike(r"^\d{12}\z") & F.col("terminal_id").rlike(r"^[A-Z0-9]{16}\z") & F.col("date").rlike(r"^\d{8}\z") & F.col("time").rlike(r"^\d{6}\z")
    rules.add(body, 8, "INVALID_DETAIL", (F.col("currency") != "BRL") | ~move.isin("P", "R") | ~shape)
    rules.add(body, 9, "INVALID_MOVEMENT_AMOUNT", ((move == "P") & (amount <= 0)) | ((move == "R") & (amount >= 0)))
    sums = body.groupBy("path").agg(F.count(F.lit(1)).alias("computed_count"), F.coalesce(F.sum("amount_brl"), F.lit(0)).cast("decimal(18,2)").alias("computed_net"))
    totals = both.select("path", "batch_id", F.col("count").try_cast("long").alias("declared_count"), "declared_net").join(sums, "path", "left")
    details = body.join(head.select("path", "batch_id"), "path").select(
        "path", "batch_id", F.col("position").alias("source_record_number"), "transaction_id", "merchant_id", P.token(F.col("pan"), key).alias("card_token"), F.substring("pan", -4, 4).alias("card_last4"),
        P.mask_last4(F.col("cpf"), 7).alias("cpf_masked"), T.local_iso(F.col("date"), F.col("time")).alias("transaction_ts"), "amount_brl", "movement_code", "authorization_code", "nsu", "terminal_id",
    )
    return _finish(files, rules, totals, [("count", "TRAILER_MISMATCH"), ("net", "SOURCE_CONTROL_TOTAL_MISMATCH")], details)


def instant_payments(files: DataFrame, key: bytes) -> Result:
    """Type 02: escaped pipes, UTF-8; H 5, D 13 and T 5 fields."""
    rules = Rules()
    rules.add(files, 0, "INVALID_TRANSPORT", transport(files, "\n", utf8=True, most=5_200_000), F.lit(0))
    rows = written(lines_of(files, "UTF-8", "\n").withColumn("f", X.escaped_fields(F.col("record"))), "records")
    at, n = F.col("position"), F.col("n")
    rules.add(rows, 1, "INVALID_RECORD_LENGTH", F.octet_length("record") > 512)
    rules.add(rows, 2, "INVALID_ESCAPE", F.col("f").isNull())
    count = F.when((at == 1) | (at == n), 5).otherwise(13)
    rules.add(rows, 3, "INVALID_FIELD_COUNT", F.size("f") != count)
    rules.add(rows, 4, "INVALID_RECORD_SEQUENCE", (F.get("f", F.lit(0)) != F.when(at == 1, "H").when(at == n, "T").otherwise("D")) | (n < 3) | (n > 2 + MOST_ROWS))
    g = lambda i: F.get("f", F.lit(i))
    head = rows.filter("position = 1").select("path", "position", g(1).alias("kind"), g(2).alias("layout"), g(3).alias("file_date"), g(4).alias("batch_id"))
    rules.add(head, 4, "INVALID_RECORD_SEQUENCE", (F.col("kind") != "PIX_EVENTS01") | (F.col("layout") != "001") | ~F.col("file_date").rlike(r"^\d{8}\z") | ~F.col("batch_id").rlike(BATCH) | _cross(F.col("path"), F.col("file_date"), F.col("batch_id")))
    cents = r"^(0|[1-9][0-9]*)\.[0-9]{2}\z"
    tail = rows.filter("position = n and n > 1").select("path", "position", g(1).alias("count"), g(2).alias("credit"), g(3).alias("debit"), g(4).alias("net"))
    rules.add(tail, 5, "INVALID_AMOUNT", ~F.col("count").rlike(r"^\d+\z") | ~F.col("credit").rlike(cents) | ~F.col("debit").rlike(cents) | ~F.col("net").rlike(r"^-?(0|[1-9][0-9]*)\.[0-9]{2}\z"))
    names = ["end_to_end_id", "transaction_id", "payer_type", "payer", "payee_type", "payee", "event_timestamp", "amount", "direction", "status", "return_code", "description"]
    body = rows.filter("position > 1 and position < n").select("path", "position", *(g(i + 1).alias(x) for i, x in enumerate(names))).join(head.select("path", "batch_id", "file_date"), "path")
    c = F.col
    rules.add(body, 6, "INVALID_RECORD_SEQUENCE", ~c("end_to_end_id").rlike(r"^E[A-Z0-9]{31}\z") | ~c("transaction_id").rlike(r"^[A-Z0-9]{16}\z") | ~c("direction").isin("C", "D") | ~c("status").isin("SETTLED", "RETURNED"))
    known = lambda t, d: F.when(c(t) == "CPF", P.valid_cpf(c(d), False)).when(c(t) == "CNPJ", P.valid_cnpj(c(d), False)).otherwise(False)
    rules.add(body, 7, "INVALID_DOCUMENT", ~known("payer_type", "payer") | ~known("payee_type", "payee"))
    amount = F.when(c("amount").rlike(cents), c("amount")).try_cast("decimal(18,2)")
    rules.add(body, 8, "INVALID_AMOUNT", ~(amount > 0))
    rules.add(body, 9, "INVALID_STATUS_RETURN_CODE", ~c("return_code").rlike(r"^([A-Z0-9]{4})?\z") | ((c("status") == "SETTLED") != (c("return_code") == "")))
    instant = T.strict_offset(c("event_timestamp"))
    rules.add(body, 10, "INVALID_TIMESTAMP", F.date_format(F.convert_timezone(F.lit("UTC"), F.lit(T.ZONE), F.to_utc_timestamp(instant, F.current_timezone()).cast("timestamp_ntz")), "yyyyMMdd") != c("file_date"))
    rules.add(body, 11, "INVALID_DESCRIPTION", ~P.safe_text(c("description")) | ~P.composed(c("description")) | c("description").contains(c("payer")) | c("description").contains(c("payee")))
    for name in ("end_to_end_id", "transaction_id"):
        twice = body.groupBy("path", name).agg(F.count(F.lit(1)).alias("k"), F.max("position").alias("position"))
        rules.add(twice, 12, "DUPLICATE_IDENTIFIER", c("k") > 1)
    signed = body.withColumn("amount_brl", M.signed_by(c("direction"), amount))
    zero = F.lit("0.00").cast("decimal(18,2)")
    sums = signed.groupBy("path").agg(
        F.count(F.lit(1)).alias("computed_count"),
        F.coalesce(F.sum(F.when(c("direction") == "C", c("amount_brl"))), zero).cast("decimal(18,2)").alias("computed_credit"),
        F.coalesce(F.sum(F.when(c("direction") == "D", -c("amount_brl"))), zero).cast("decimal(18,2)").alias("computed_debit"),
        F.coalesce(F.sum("amount_brl"), zero).cast("decimal(18,2)").alias("computed_net"),
    )
    totals = head.select("path", "batch_id").join(tail.select("path", c("count").try_cast("long").alias("declared_count"), *(c(x).try_cast("decimal(18,2)").alias(f"declared_{x}") for x in ("credit", "debit", "net"))), "path").join(sums, "path", "left")
    doc = lambda t, d, to: [P.token(c(d), key, "doc_").alias(f"{to}_document_token"), F.when(c(t) == "CPF", P.mask_last4(c(d), 7)).otherwise(P.mask_last4(c(d), 10)).alias(f"{to}_document_masked")]
    details = signed.select("path", "batch_id", c("position").alias("source_record_number"), "end_to_end_id", "transaction_id", *doc("payer_type", "payer", "payer"), *doc("payee_type", "payee", "payee"), "event_timestamp", "amount_brl", "direction", "status", F.nullif("return_code", F.lit("")).alias("return_code"), "description")
    return _finish(files, rules, totals, [(x, f"SOURCE_CONTROL_{x.upper()}_MISMATCH") for x in ("count", "credit", "debit", "net")], details)


def payment_slips(files: DataFrame, key: bytes) -> Result:
    """Type 03: 240-byte records, lots of A and B segments between L and T, Z at the end."""
    rules = Rules()
    rules.add(files, 0, "INVALID_TRANSPORT", transport(files, "\r\n", ascii_only=True), F.lit(0))
    rows = lines_of(files, "US-ASCII", "\r\n")
    r, c = F.col("record"), F.col
    rules.add(rows, 1, "INVALID_RECORD_LENGTH", F.length(r) != 240)
    order = Window.partitionBy("path").orderBy("position")
    rows = rows.withColumn("kind", kind_of(r)).withColumn("before", F.lag("kind").over(order)).withColumn("lot_no", F.sum(F.when(c("kind") == "L", 1).otherwise(0)).over(order)).withColumn("next", F.lead("record").over(order))
    rows = written(rows, "records")
    follows = F.when(c("kind") == "H", c("before").isNull()).when(c("kind") == "L", c("before").isin("H", "T")).when(c("kind") == "A", c("before").isin("L", "B")).when(c("kind") == "B", c("before") == "A").when(c("kind") == "T", c("before") == "B").when(c("kind") == "Z", (c("before") == "T") & (c("position") == c("n"))).otherwise(False)
    rules.add(rows, 2, "INVALID_RECORD_SEQUENCE", ~follows | ((c("position") == c("n")) & (c("kind") != "Z")))
    filler = {"H": 55, "L": 63, "A": 155, "B": 126, "T": 90, "Z": 51}
    blank = F.lit(True)
    for k, start in filler.items():
        blank = F.when(c("kind") == k, X.is_filler(r, start, 240)).otherwise(blank)
    rules.add(rows, 3, "INVALID_FILLER", ~blank)
    s = lambda a, b, of=r: X.slice_of(of, a, b)
    head = rows.filter("kind = 'H' and position = 1").select("path", "position", s(2, 9).alias("file_date"), s(10, 25).alias("batch_id"), s(26, 37).alias("type"), s(38, 40).alias("layout"))
    rules.add(head, 4, "INVALID_FIELD", ~c("batch_id").rlike(BATCH) | (c("layout") != "001") | T.strict_date(c("file_date"), "yyyyMMdd").isNull())
    lots = rows.filter("kind = 'L'").select("path", "lot_no", s(2, 7).alias("lot"), s(23, 30).alias("settlement_date"))
    nx = c("next")
    pairs = rows.filter("kind = 'A'").select(
        "path", "position", "lot_no", s(2, 7).alias("lot_number"), s(8, 13).alias("sequence"), s(14, 29).alias("settlement_id"), X.rtrim_filler(s(30, 77)).alias("payment_reference"), *(M.implied_decimal(s(a, b)).alias(x) for x, a, b in (("face_amount_brl", 78, 92), ("discount_brl", 109, 120), ("fee_brl", 121, 132))),
        s(93, 100).alias("due"), s(101, 108).alias("paid"), s(133, 134).alias("status"), s(135, 154).alias("bank_reference"),
        s(1, 29, nx).alias("b_head"), s(30, 30, nx).alias("tax_type"), s(31, 44, nx).alias("tax_id"), s(85, 87, nx).alias("bank"), s(88, 92, nx).alias("branch"), s(93, 104, nx).alias("account"), s(105, 105, nx).alias("digit"), X.rtrim_filler(s(106, 125, nx)).alias("client_reference"),
    ).withColumn("net_amount_brl", (c("face_amount_brl") - c("discount_brl") + c("fee_brl")).cast("decimal(18,2)"))
    pairs = written(pairs.withColumns({"tax": P.tagged_tax_id(c("tax_id")), "due": T.strict_date(c("due"), "yyyyMMdd"), "paid_on": T.strict_date(c("paid"), "yyyyMMdd")}), "pairs")
    rules.add(pairs, 5, "INVALID_FIELD", c("face_amount_brl").isNull() | c("discount_brl").isNull() | c("fee_brl").isNull() | (c("discount_brl") > c("face_amount_brl")) | (c("net_amount_brl") < 0))
    tax = c("tax")
    rules.add(pairs, 6, "INVALID_DOCUMENT", tax["kind"].isNull())
    rules.add(pairs, 7, "SEGMENT_PAIR_MISMATCH", c("b_head") != F.concat(F.lit("B"), c("lot_number"), c("sequence"), c("settlement_id")))
    twice = pairs.groupBy("path", "settlement_id").agg(F.count(F.lit(1)).alias("k"), F.max("position").alias("position"))
    rules.add(twice, 8, "DUPLICATE_IDENTIFIER", c("k") > 1)
    dated = pairs.join(lots, ["path", "lot_no"], "left")
    due, paid = c("due"), c("paid_on")
    rules.add(dated, 9, "INVALID_BUSINESS_DATE", due.isNull() | paid.isNull() | (paid > due) | (c("paid") != c("settlement_date")))
    measures = {"face": "face_amount_brl", "discount": "discount_brl", "fee": "fee_brl", "net": "net_amount_brl"}
    by_lot = pairs.groupBy("path", "lot_no").agg(F.count(F.lit(1)).alias("count"), *(F.sum(x).cast("decimal(18,2)").alias(m) for m, x in measures.items()))
    ends = rows.filter("kind = 'T'").select("path", "position", "lot_no", s(8, 13).try_cast("long").alias("d_count"), *(M.implied_decimal(s(a, b)).alias(f"d_{m}") for m, a, b in (("face", 14, 28), ("discount", 29, 43), ("fee", 44, 58), ("net", 59, 73))))
    checked = ends.join(by_lot, ["path", "lot_no"], "left")
    for i, (m, code) in enumerate((("count", "LOGICAL_COUNT"), ("face", "FACE"), ("discount", "DISCOUNT"), ("fee", "FEE"), ("net", "NET"))):
        rules.add(checked, 10 + i, f"SOURCE_CONTROL_{code}_MISMATCH", ~c(f"d_{m}").eqNullSafe(c(m)))
    computed = rows.groupBy("path").agg(F.count(F.when(c("kind") == "L", 1)).alias("computed_lots"), F.count(F.lit(1)).alias("computed_physical"), F.count(F.when(c("kind") == "A", 1)).alias("computed_logical"))
    net = pairs.groupBy("path").agg(F.sum("net_amount_brl").cast("decimal(18,2)").alias("computed_net"))
    last = rows.filter("kind = 'Z' and position = n").select("path", s(2, 7).try_cast("long").alias("declared_lots"), s(8, 13).try_cast("long").alias("declared_physical"), s(14, 19).try_cast("long").alias("declared_logical"), M.implied_decimal(s(20, 34)).alias("declared_net"))
    totals = head.select("path", "batch_id").join(last, "path").join(computed, "path").join(net, "path", "left")
    details = dated.join(head.select("path", "batch_id"), "path").select(
        "path", "batch_id", c("position").alias("source_record_number_a"), (c("position") + 1).alias("source_record_number_b"), "lot_number", "sequence", "settlement_id", P.token(c("payment_reference"), key, "payref_").alias("payment_reference_token"), F.substring("payment_reference", -4, 4).alias("payment_reference_last4"),
        P.token(tax["document"], key, "party_").alias("beneficiary_token"), tax["kind"].alias("beneficiary_tax_id_type"), F.when(tax["kind"] == "CPF", P.mask_last4(tax["document"], 7)).otherwise(P.mask_last4(tax["document"], 10)).alias("beneficiary_tax_id_masked"),
        P.token(P.composite_key(c("bank"), c("branch"), c("account"), c("digit")), key, "acct_").alias("bank_account_token"), F.substring("account", -4, 4).alias("bank_account_last4"), F.date_format(due, "yyyy-MM-dd").alias("due_date"), F.date_format(paid, "yyyy-MM-dd").alias("payment_date"),
        *measures.values(), "status", "bank_reference", "client_reference",
    )
    return _finish(files, rules, totals, [("lots", "SOURCE_CONTROL_LOT_COUNT_MISMATCH"), ("physical", "SOURCE_CONTROL_PHYSICAL_COUNT_MISMATCH"), ("logical", "SOURCE_CONTROL_LOGICAL_COUNT_MISMATCH"), ("net", "SOURCE_CONTROL_NET_MISMATCH")], details)


def ted_transfers(files: DataFrame, key: bytes) -> Result:
    """Type 04: H 56, D 162, R 91, T 82; a return follows the transfer that it undoes."""
    rules = Rules()
    rules.add(files, 0, "INVALID_TRANSPORT", transport(files, "\r\n", ascii_only=True), F.lit(0))
    rows = lines_of(files, "US-ASCII", "\r\n").withColumn("kind", kind_of(F.col("record")))
    r, c = F.col("record"), F.col
    size = F.when(c("kind") == "H", 56).when(c("kind") == "D", 162).when(c("kind") == "R", 91).when(c("kind") == "T", 82)
    rules.add(rows, 1, "INVALID_RECORD_LENGTH", F.length(r) != size)
    order = Window.partitionBy("path").orderBy("position")
    s = lambda a, b, of=r: X.slice_of(of, a, b)
    rows = rows.withColumn("above", F.lag("record").over(order))
    follows = F.when(c("position") == 1, c("kind") == "H").when(c("position") == c("n"), c("kind") == "T").otherwise(c("kind").isin("D", "R"))
    rules.add(rows, 2, "INVALID_RECORD_SEQUENCE", ~follows | ((c("kind") == "R") & (kind_of(c("above")) != "D")))
    head = rows.filter("kind = 'H' and position = 1").select("path", "position", s(10, 25).alias("batch_id"), s(2, 9).alias("file_date"))
    rules.add(head, 3, "INVALID_FIELD", ~c("batch_id").rlike(BATCH) | T.strict_date(c("file_date"), "yyyyMMdd").isNull())
    moves = rows.filter("kind = 'D'").select(
        "path", "position", s(2, 17).alias("movement_id"), F.lit(None).cast("string").alias("original_transfer_id"), F.lit("TRANSFER").alias("movement_kind"), T.local_iso(s(36, 43), s(44, 49)).alias("movement_ts"), M.signed_implied(s(18, 18), s(19, 32)).alias("amount_brl"),
        F.concat_ws(":", s(50, 57), s(58, 61), s(62, 73)).alias("payer_account"), s(74, 87).alias("payer_tax"), F.concat_ws(":", s(89, 96), s(97, 100), s(101, 112)).alias("beneficiary_account"), s(113, 126).alias("beneficiary_tax"), s(89, 96).alias("beneficiary_ispb"), X.rtrim_filler(F.rtrim(s(128, 137))).alias("purpose_code"), s(138, 139).alias("status_code"), F.lit(None).cast("string").alias("return_reason_code"),
    )
    up = c("above")
    backs = rows.filter("kind = 'R'").select(
        "path", "position", s(2, 17).alias("movement_id"), s(18, 33).alias("original_transfer_id"), F.lit("RETURN").alias("movement_kind"), T.local_iso(s(49, 56), s(57, 62)).alias("movement_ts"), M.signed_implied(s(34, 34), s(35, 48)).alias("amount_brl"),
        F.concat_ws(":", s(50, 57, up), s(58, 61, up), s(62, 73, up)).alias("payer_account"), s(74, 87, up).alias("payer_tax"), F.concat_ws(":", s(89, 96, up), s(97, 100, up), s(101, 112, up)).alias("beneficiary_account"), s(113, 126, up).alias("beneficiary_tax"), s(89, 96, up).alias("beneficiary_ispb"), X.rtrim_filler(F.rtrim(s(128, 137, up))).alias("purpose_code"), F.lit("RT").alias("status_code"), F.rtrim(s(63, 67)).alias("return_reason_code"),
        s(2, 17, up).alias("linked_id"), M.signed_implied(s(18, 18, up), s(19, 32, up)).alias("linked_amount"), T.local_iso(s(36, 43, up), s(44, 49, up)).alias("linked_ts"),
    )
    rules.add(moves, 4, "INVALID_FIELD", c("amount_brl").isNull() | (c("amount_brl") <= 0) | c("movement_ts").isNull() | ~c("status_code").isin("OK", "RT"))
    rules.add(backs, 4, "INVALID_FIELD", c("amount_brl").isNull() | (c("amount_brl") >= 0) | c("movement_ts").isNull())
    rules.add(moves, 5, "INVALID_DOCUMENT", P.tagged_tax_id(c("payer_tax"))["kind"].isNull() | P.tagged_tax_id(c("beneficiary_tax"))["kind"].isNull())
    rules.add(backs, 6, "RETURN_LINK_MISMATCH", (c("original_transfer_id") != c("linked_id")) | (c("amount_brl") != -c("linked_amount")))
    rules.add(backs, 7, "INVALID_TIMESTAMP", c("movement_ts") <= c("linked_ts"))
    body = moves.unionByName(backs.drop("linked_id", "linked_amount", "linked_ts"))
    twice = body.groupBy("path", "movement_id").agg(F.count(F.lit(1)).alias("k"), F.max("position").alias("position"))
    rules.add(twice, 8, "DUPLICATE_IDENTIFIER", c("k") > 1)
    zero = F.lit("0.00").cast("decimal(18,2)")
    transfer = c("movement_kind") == "TRANSFER"
    sums = body.groupBy("path").agg(F.count(F.when(transfer, 1)).alias("computed_transfer_count"), F.count(F.when(~transfer, 1)).alias("computed_return_count"), *(F.coalesce(F.sum(e), zero).cast("decimal(18,2)").alias(f"computed_{m}") for m, e in (("gross", F.when(transfer, c("amount_brl"))), ("returned", F.when(~transfer, c("amount_brl"))), ("net", c("amount_brl")))))
    tail = rows.filter("kind = 'T' and position = n").select("path", s(10, 15).try_cast("long").alias("declared_transfer_count"), s(16, 21).try_cast("long").alias("declared_return_count"), *(M.signed_implied(s(a, a), s(a + 1, b)).alias(f"declared_{m}") for m, a, b in (("gross", 22, 36), ("returned", 37, 51), ("net", 52, 66))))
    totals = head.select("path", "batch_id").join(tail, "path").join(sums, "path", "left")
    mask = lambda t: F.when(t["kind"] == "CPF", P.mask_last4(t["document"], 7)).otherwise(P.mask_last4(t["document"], 10))
    details = body.join(head.select("path", "batch_id"), "path").select(
        "path", "batch_id", c("position").alias("source_record_number"), "movement_id", "original_transfer_id", "movement_kind", "movement_ts", "amount_brl", P.token(c("payer_account"), key, "tedacct_").alias("payer_account_token"), mask(P.tagged_tax_id(c("payer_tax"))).alias("payer_tax_id_masked"),
        P.token(c("beneficiary_account"), key, "tedacct_").alias("beneficiary_account_token"), mask(P.tagged_tax_id(c("beneficiary_tax"))).alias("beneficiary_tax_id_masked"), "beneficiary_ispb", "purpose_code", "status_code", "return_reason_code",
    )
    return _finish(files, rules, totals, [(m, f"SOURCE_CONTROL_{m.upper()}_MISMATCH") for m in ("transfer_count", "return_count", "gross", "returned", "net")], details)


#: What types 05 and 06 call their columns.
CSV_TYPES = {
    "05": ("assessment_id;batch_id;merchant_id;merchant_tax_id;fee_code;description;gross_amount_brl;rate_percent;assessed_fee_brl;assessment_date", "calculated_fee_brl", "FEE_CALCULATION_MISMATCH"),
    "06": ("chargeback_id;batch_id;merchant_id;merchant_tax_id;reason_code;description;original_amount_brl;rate_percent;chargeback_amount_brl;business_date", "calculated_amount_brl", "CHARGEBACK_CALCULATION_MISMATCH"),
}


def merchant_csv(files: DataFrame, kind: str, declared: DataFrame | None = None) -> Result:
    """Types 05 and 06: quoted CSV, only the sixth field in quotes, amounts recomputed half up.

    ``declared`` may give path, count, base, amount and calculated totals; what
    it does not give counts as declared as computed.
    """
    header, calculated, mismatch = CSV_TYPES[kind]
    names = header.split(";")
    ident, code_name, base, amount, date = names[0], names[4], names[6], names[8], names[9]
    rules, c = Rules(), F.col
    rules.add(files, 0, "INVALID_TRANSPORT", transport(files, "\n", utf8=True, most=5_130_138), F.lit(0))
    rows = lines_of(files, "UTF-8", "\n")
    rules.add(rows, 1, "INVALID_RECORD_LENGTH", F.octet_length("record") > (511 if kind == "06" else 512))
    rules.add(rows, 2, "INVALID_HEADER", (c("position") == 1) & (c("record") != header))
    rules.add(rows.filter("position = 1"), 4, "INVALID_FIELD_COUNT", c("n") > 1 + MOST_ROWS)
    body = written(rows.filter("position > 1").withColumn("f", X.quoted_fields(c("record"))), "records")
    only_sixth = F.transform("f", lambda x, i: x["quoted"] == (i == 5))
    rules.add(body, 3, "INVALID_CSV_QUOTING", c("f").isNull() | ((F.size("f") == 10) & ~F.forall(only_sixth, lambda x: x)))
    rules.add(body, 4, "INVALID_FIELD_COUNT", F.size("f") != 10)
    if kind == "06":  # no empty fields, no blanks around one
        rules.add(body, 4, "INVALID_CSV_QUOTING", F.exists("f", lambda x: (x["value"] == "") | (F.trim(x["value"]) != x["value"])))
    body = body.select("path", "position", *(F.get("f", F.lit(i))["value"].alias(x) for i, x in enumerate(names)))
    body = body.withColumns({base: M.locale_decimal(c(base), 2), "rate_percent": M.locale_decimal(c("rate_percent"), 3, 9), amount: M.locale_decimal(c(amount), 2)})
    rules.add(body, 5, "INVALID_FIELD", ~((c(base) > 0) & (c("rate_percent") > 0) & (c("rate_percent") <= 100) & (c(amount) >= 0)))
    rules.add(body, 6, "INVALID_DOCUMENT", ~P.valid_cnpj(c("merchant_tax_id")))
    rules.add(body, 7, "INVALID_IDENTIFIER", ~c(ident).rlike(r"^[A-Z0-9]{16}\z") | ~c("merchant_id").rlike(r"^[A-Z0-9]{16}\z") | ~c(code_name).rlike(r"^[A-Z0-9_]{1,12}\z"))
    rules.add(body, 8, "INVALID_DESCRIPTION", ~P.safe_text(c("description")) | ~P.composed(c("description")))
    day = T.strict_date(c(date))
    rules.add(body, 9, "INVALID_BUSINESS_DATE", day.isNull() | ~c("batch_id").rlike(BATCH) | _cross(c("path"), F.date_format(day, "yyyyMMdd"), c("batch_id")))
    twice = body.groupBy("path", ident).agg(F.count(F.lit(1)).alias("k"), F.max("position").alias("position"))
    rules.add(twice, 10, "DUPLICATE_IDENTIFIER", c("k") > 1)
    body = body.withColumn(calculated, M.half_up(c(base), c("rate_percent")))
    if kind == "06":
        rules.add(body, 11, mismatch, c(amount) != c(calculated))
    sums = body.groupBy("path").agg(F.min("batch_id").alias("batch_id"), F.count(F.lit(1)).alias("computed_count"), *(F.sum(x).cast("decimal(18,2)").alias(f"computed_{m}") for m, x in (("base", base), ("amount", amount), ("calculated", calculated))))
    measures = ["count", "base", "amount", "calculated"]
    if declared is None:
        totals = sums.withColumns({f"declared_{m}": c(f"computed_{m}") for m in measures})
    else:
        given = declared.select("path", *(c(m).alias(f"given_{m}") for m in measures if m in declared.columns))
        joined = sums.join(given, "path", "left")
        totals = joined.withColumns({f"declared_{m}": F.coalesce(c(f"given_{m}"), c(f"computed_{m}")) if f"given_{m}" in joined.columns else c(f"computed_{m}") for m in measures})
    labels = {"base": "GROSS" if kind == "05" else "ORIGINAL", "amount": "ASSESSED_FEE" if kind == "05" else "CHARGEBACK", "calculated": "CALCULATED", "count": "COUNT"}
    details = body.select("path", "batch_id", c("position").alias("source_record_number"), ident, "merchant_id", P.mask_last4(c("merchant_tax_id"), 10).alias("merchant_tax_id_masked"), code_name, "description", base, "rate_percent", amount, calculated, F.date_format(day, "yyyy-MM-dd").alias(date), F.lit("HALF_UP").alias("rounding_mode"))
    return _finish(files, rules, totals, [(m, f"SOURCE_CONTROL_{labels[m]}_MISMATCH") for m in measures], details)


def declared_controls(files: DataFrame, manifests: DataFrame, kind: str) -> DataFrame:
    """(path, count, base, amount, calculated) that the ``source-manifest.json`` beside a file of type 05 or 06 declares.

    ``manifests`` has (path, content); a control that is not there is null, and counts as declared as computed.
    """
    text = F.decode("content", "UTF-8")
    controls = F.coalesce(F.get_json_object(text, "$.source_controls"), F.get_json_object(text, "$.controls"))
    names = ("row_count", "gross_amount", "assessed_fee", "calculated_fee") if kind == "05" else ("row_count", "original_amount", "chargeback_amount", "calculated_amount")
    kinds = ("bigint", *["decimal(18,2)"] * 3)
    folder = F.regexp_extract("path", r"^(.*)/[^/]*$", 1)
    told = manifests.select(folder.alias("_folder"), *(F.get_json_object(controls, f"$.{n}").try_cast(k).alias(m) for n, k, m in zip(names, kinds, ("count", "base", "amount", "calculated"))))
    return files.select("path", folder.alias("_folder")).join(told, "_folder").drop("_folder")


def parse(kind: str, files: DataFrame, key: bytes, manifests: DataFrame | None = None) -> Result:
    """Parse files of one registered type; ``manifests`` are the documents beside files of types 05 and 06."""
    readers = {"01": card_settlement, "02": instant_payments, "03": payment_slips, "04": ted_transfers}
    if kind in readers:
        return readers[kind](files, key)
    return merchant_csv(files, kind, None if manifests is None else declared_controls(files, manifests, kind))
