"""Batches written in the layouts that the parsers read, for fixtures and round trips."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyproof.functions.money import overpunch_encode


def fixed(*parts: tuple[Column, int]) -> Column:
    """Fields side by side, each cut or filled with blanks to its width."""
    return F.concat(*(F.rpad(value.cast("string"), width, " ") for value, width in parts))


def digits(value: Column, width: int) -> Column:
    return F.lpad(value.cast("string"), width, "0")


def minor(amount: Column, width: int) -> Column:
    """Cents as digits."""
    return digits((F.abs(amount.cast("decimal(18,2)")) * 100).cast("decimal(20,0)"), width)


def signed_minor(amount: Column, width: int) -> Column:
    return F.concat(F.when(amount < 0, "-").otherwise("+"), minor(amount, width - 1))


def escaped(value: Column) -> Column:
    return F.regexp_replace(value, r"([\\|])", r"\\$1")


def quoted(value: Column) -> Column:
    return F.concat(F.lit('"'), F.replace(value, F.lit('"'), F.lit('""')), F.lit('"'))


def locale(amount: Column, places: int) -> Column:
    return F.translate(amount.cast(f"decimal(18,{places})").cast("string"), ".", ",")


def _file(lines: DataFrame, by: list[str], ending: str) -> DataFrame:
    """One text per batch from (by, position, line) rows; a batch is one file."""
    ordered = F.sort_array(F.collect_list(F.struct("position", "line")))
    body = F.concat(F.array_join(F.transform(ordered, lambda x: x["line"]), ending), F.lit(ending))
    return lines.groupBy(*by).agg(body.alias("content"))


def card_settlement(rows: DataFrame) -> DataFrame:
    """Type 01 files from batch_id, file_date, position, transaction_id, merchant_id, pan, cpf, date, time, amount_brl, movement_code, authorization_code, nsu, terminal_id."""
    c, by = F.col, ["batch_id", "file_date"]
    heads = rows.select(*by).distinct().select(*by, F.lit(-(1 << 30)).alias("position"), F.concat(F.lit("H"), "file_date", "batch_id", F.lit("CRD_SETTLE01001")).alias("line"))
    body = rows.select(*by, c("position"), F.concat(F.lit("D"), "transaction_id", "merchant_id", "pan", "cpf", "date", "time", overpunch_encode(c("amount_brl"), 12), F.lit("BRL"), "movement_code", "authorization_code", "nsu", "terminal_id").alias("line"))
    tails = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.sum("amount_brl").cast("decimal(18,2)").alias("net")).select(*by, F.lit(1 << 30).alias("position"), F.concat(F.lit("T"), "file_date", digits(c("n"), 6), overpunch_encode(c("net"), 15), "batch_id").alias("line"))
    return _file(heads.unionByName(body).unionByName(tails), by, "\n")


def instant_payments(rows: DataFrame, *parts: str) -> DataFrame:
    """Type 02 files from batch_id, file_date, position, the twelve event fields as text, and amount as a decimal; a file for each value of ``parts`` in a batch."""
    c, by = F.col, ["batch_id", "file_date", *parts]
    heads = rows.select(*by).distinct().select(*by, F.lit(-(1 << 30)).alias("position"), F.concat_ws("|", F.lit("H"), F.lit("PIX_EVENTS01"), F.lit("001"), "file_date", "batch_id").alias("line"))
    names = ["end_to_end_id", "transaction_id", "payer_type", "payer", "payee_type", "payee", "event_timestamp"]
    body = rows.select(*by, c("position"), F.concat_ws("|", F.lit("D"), *names, c("amount").cast("decimal(18,2)").cast("string"), "direction", "status", F.coalesce("return_code", F.lit("")), escaped(c("description"))).alias("line"))
    total = lambda side: F.coalesce(F.sum(F.when(c("direction") == side, c("amount"))), F.lit(0)).cast("decimal(18,2)")
    sums = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), total("C").alias("credit"), total("D").alias("debit"))
    tails = sums.select(*by, F.lit(1 << 30).alias("position"), F.concat_ws("|", F.lit("T"), c("n").cast("string"), c("credit").cast("string"), c("debit").cast("string"), (c("credit") - c("debit")).cast("decimal(18,2)").cast("string")).alias("line"))
    return _file(heads.unionByName(body).unionByName(tails), by, "\n")


def merchant_csv(rows: DataFrame, header: str, *parts: str) -> DataFrame:
    """Type 05 or 06 files: ``rows`` has the header's columns, decimals and a date, and position; a file for each value of ``parts`` in a batch."""
    names, by = header.split(";"), ["batch_id", *parts]
    show = lambda n, i: quoted(F.col(n)) if i == 5 else locale(F.col(n), 3) if n == "rate_percent" else locale(F.col(n), 2) if n.endswith("_brl") else F.date_format(n, "dd/MM/yyyy") if i == 9 else F.col(n)
    body = rows.select(*by, "position", F.concat_ws(";", *(show(n, i) for i, n in enumerate(names))).alias("line"))
    heads = rows.select(*by).distinct().select(*by, F.lit(-(1 << 30)).alias("position"), F.lit(header).alias("line"))
    return _file(heads.unionByName(body), by, "\n")


def payment_slips(rows: DataFrame) -> DataFrame:
    """Type 03 files from batch_id, file_date, lot (a number from 1), position and the fields of the A and B segments.

    Dates are ``yyyyMMdd`` text; a lot settles on the day that its slips are paid.
    """
    c, by = F.col, ["batch_id", "file_date"]
    fill = lambda line: F.rpad(line, 240, "~")
    text = lambda value, width: F.rpad(value, width, "~")
    first, last = F.lit(-(1 << 40)), F.lit(1 << 62)
    lot = digits(c("lot"), 6)
    net = c("face_amount_brl") - c("discount_brl") + c("fee_brl")
    sums = lambda *keys: rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.max("paid").alias("paid"), *(F.sum(x).cast("decimal(18,2)").alias(x) for x in ("face_amount_brl", "discount_brl", "fee_brl")), F.countDistinct("lot").alias("lots"))
    place = lambda rank, at=F.lit(0): c("lot").cast("bigint") * (1 << 40) + at.cast("bigint") * 4 + rank  # noqa: E731  # longs: an int ends at 2,047 lots
    heads = rows.select(*by).distinct().select(*by, first.alias("position"), fill(F.concat(F.lit("H"), "file_date", "batch_id", F.lit("SLIPSETTLE01001"), F.lit("BANK0001000001"))).alias("line"))
    lots = sums(*by, "lot")
    opens = lots.select(*by, place(-4).alias("position"), fill(F.concat(F.lit("L"), lot, F.lit("SLIPSETTLE01BRL"), "paid", "batch_id", F.lit("ORIGINATOR000001"))).alias("line"))
    a = rows.select(*by, place(0, c("position")).alias("position"), fill(F.concat(F.lit("A"), lot, digits(c("position"), 6), "settlement_id", text(c("payment_reference"), 48), minor(c("face_amount_brl"), 15), "due", "paid", minor(c("discount_brl"), 12), minor(c("fee_brl"), 12), "status", text(c("bank_reference"), 20))).alias("line"))
    b = rows.select(*by, place(1, c("position")).alias("position"), fill(F.concat(F.lit("B"), lot, digits(c("position"), 6), "settlement_id", "tax_type", "tax_id", text(c("name"), 40), "bank", "branch", "account", "digit", text(c("client_reference"), 20))).alias("line"))
    whole = (c("face_amount_brl") - c("discount_brl") + c("fee_brl")).cast("decimal(18,2)")
    ends = lots.select(*by, place((1 << 40) - 8).alias("position"), fill(F.concat(F.lit("T"), lot, digits(c("n"), 6), minor(c("face_amount_brl"), 15), minor(c("discount_brl"), 15), minor(c("fee_brl"), 15), minor(whole, 15), "batch_id")).alias("line"))
    tails = sums(*by).select(*by, last.alias("position"), fill(F.concat(F.lit("Z"), digits(c("lots"), 6), digits(2 + 2 * c("lots") + 2 * c("n"), 6), digits(c("n"), 6), minor(whole, 15), "batch_id")).alias("line"))
    frames = [x.withColumn("position", c("position").cast("bigint")) for x in (heads, opens, a, b, ends, tails)]
    lines = frames[0]
    for x in frames[1:]:
        lines = lines.unionByName(x)
    return _file(lines, by, "\r\n")


def ted_transfers(rows: DataFrame) -> DataFrame:
    """Type 04 files from batch_id, file_date, position, the fields of a transfer and, where it came back, of its return.

    ``payer`` and ``beneficiary`` are structs of ispb, branch, account, tax and party; ``returned`` is null or a struct of
    return_id, date, time, reason and text.
    """
    c, by = F.col, ["batch_id", "file_date"]
    side = lambda who: [c(f"{who}.{x}") for x in ("ispb", "branch", "account", "tax", "party")]
    heads = rows.select(*by).distinct().select(*by, F.lit(-(1 << 40)).alias("position"), F.concat(F.lit("H"), "file_date", "batch_id", F.lit("TEDSETTLE01 001"), "file_date", F.lit("12345678")).alias("line"))
    moves = rows.select(*by, (c("position") * 2).alias("position"), F.concat(F.lit("D"), "transfer_id", signed_minor(c("amount_brl"), 15), F.lit("BRL"), "date", "time", *side("payer"), *side("beneficiary"), F.rpad("purpose", 10, " "), F.when(c("returned").isNull(), "OK").otherwise("RT"), F.rpad("name", 23, " ")).alias("line"))
    back = rows.filter("returned is not null").select(*by, (c("position") * 2 + 1).alias("position"), F.concat(F.lit("R"), "returned.return_id", "transfer_id", signed_minor(-c("amount_brl"), 15), "returned.date", "returned.time", F.rpad("returned.reason", 5, " "), F.rpad("returned.text", 24, " ")).alias("line"))
    undone = F.coalesce(F.sum(F.when(c("returned").isNotNull(), -c("amount_brl"))), F.lit(0)).cast("decimal(18,2)")
    sums = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.count("returned").alias("r"), F.sum("amount_brl").cast("decimal(18,2)").alias("gross"), undone.alias("undone"))
    tails = sums.select(*by, F.lit(1 << 40).alias("position"), F.concat(F.lit("T"), "file_date", digits(c("n"), 6), digits(c("r"), 6), signed_minor(c("gross"), 15), signed_minor(c("undone"), 15), signed_minor((c("gross") + c("undone")).cast("decimal(18,2)"), 15), "batch_id").alias("line"))
    lines = heads.unionByName(moves.withColumn("position", c("position").cast("bigint"))).unionByName(back.withColumn("position", c("position").cast("bigint"))).unionByName(tails)
    return _file(lines, by, "\r\n")
