"""Insider transactions from ownership forms in XML: one tolerant parse of a form, rows for what it holds, a reject for what cannot be read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The elements of an ownership form that are read.
_VALUE = "struct<value: string>"
_TRANSACTION = f"""struct<securityTitle: {_VALUE}, transactionDate: {_VALUE}, transactionCoding: struct<transactionCode: struct<_text: string, value: string>>,
transactionAmounts: struct<transactionShares: {_VALUE}, transactionPricePerShare: {_VALUE}, transactionAcquiredDisposedCode: {_VALUE}>,
postTransactionAmounts: struct<sharesOwnedFollowingTransaction: {_VALUE}>, ownershipNature: struct<directOrIndirectOwnership: {_VALUE}>>"""
_OWNER = """struct<rptOwnerName: string, reportingOwnerId: struct<rptOwnerCik: string, rptOwnerName: string>,
reportingOwnerRelationship: struct<isDirector: string, isOfficer: string, isTenPercentOwner: string, officerTitle: string>>"""
FORM = f"""issuer struct<issuerCik: string, issuerTradingSymbol: string>, reportingOwner array<{_OWNER}>, nonDerivativeTable struct<nonDerivativeTransaction: array<{_TRANSACTION}>>,
derivativeTable struct<derivativeTransaction: array<{_TRANSACTION}>>, unread string""".replace("\n", " ")


def parsed(forms: DataFrame, xml_col: str) -> DataFrame:
    """forms with the struct `form`, and `reject`: why a form has none. A null, blank or broken form has a reject and stops no other."""
    trimmed = forms.withColumn("_text", F.trim(F.coalesce(F.col(xml_col), F.lit("")), F.lit(" \t\r\n﻿")))  # a column of its own: done once
    out = trimmed.withColumn("_form", F.from_xml(F.nullif(F.col("_text"), F.lit("")), FORM, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "unread", "valueTag": "_text"}))
    reject = F.when(F.col("_text") == "", "empty").when(F.col("_form").isNull() | F.col("_form.unread").isNotNull(), "not well-formed")
    return out.withColumn("reject", reject).withColumn("form", F.when(F.col("reject").isNull(), F.col("_form"))).drop("_form", "_text")


def rejected_forms(forms: DataFrame, id_col: str, xml_col: str) -> DataFrame:
    """(id, reject, length in characters) of the forms that cannot be read."""
    found = F.when(F.col("reject").isNotNull(), F.array("reject")).otherwise(F.array().cast("array<string>"))  # exploded, not filtered, as below
    return parsed(forms, xml_col).select(F.col(id_col).alias("id"), F.explode(found).alias("reject"), F.coalesce(F.length(xml_col), F.lit(0)).alias("length"))


def insider_transactions(forms: DataFrame, id_col: str, xml_col: str) -> DataFrame:
    """One row per transaction of each readable form, those of the plain table first: all fields, with dates and numbers that cannot be read as null and missing texts as empty.

    Fields of the first owner hold for all transactions of a form; the ticker is in upper case; a transaction code counts bare or inside a value element; value_usd is shares
    times price to the cent. Forms without transactions, and rejected ones, have no rows; ids may be null or repeat."""
    word = lambda c: F.trim(F.coalesce(c, F.lit("")))
    number = lambda c: word(c).try_cast("double")
    flag = lambda c: F.lower(word(c)).isin("true", "1", "yes")
    owner = F.get("form.reportingOwner", F.lit(0))
    both = F.concat(*[_listed(table, name, derivative) for table, name, derivative in (("nonDerivativeTable", "nonDerivativeTransaction", False), ("derivativeTable", "derivativeTransaction", True))])
    # no filter on the form: it would move below the parse, and each form would be parsed again for every condition in it; what has no form has no transactions either
    f = parsed(forms, xml_col).select(F.col(id_col).alias("id"), F.col("form.issuer").alias("i"), owner.alias("o"), F.explode(both).alias("x"))
    t = "x.t."
    shares, price = number(F.col(f"{t}transactionAmounts.transactionShares.value")), number(F.col(f"{t}transactionAmounts.transactionPricePerShare.value"))
    code = F.coalesce(F.nullif(word(F.col(f"{t}transactionCoding.transactionCode._text")), F.lit("")), word(F.col(f"{t}transactionCoding.transactionCode.value")))
    role = "o.reportingOwnerRelationship."
    return f.select(
        "id", F.upper(word(F.col("i.issuerTradingSymbol"))).alias("ticker"), word(F.col("i.issuerCik")).alias("issuer_cik"),
        F.coalesce(F.nullif(word(F.col("o.reportingOwnerId.rptOwnerName")), F.lit("")), word(F.col("o.rptOwnerName"))).alias("owner"), F.nullif(word(F.col("o.reportingOwnerId.rptOwnerCik")), F.lit("")).alias("owner_cik"),
        flag(F.col(f"{role}isDirector")).alias("is_director"), flag(F.col(f"{role}isOfficer")).alias("is_officer"), flag(F.col(f"{role}isTenPercentOwner")).alias("is_ten_percent_owner"), word(F.col(f"{role}officerTitle")).alias("officer_title"),
        F.col("x.derivative").alias("is_derivative"), F.col("x.nth").alias("nth"), word(F.col(f"{t}securityTitle.value")).alias("security"), F.substring(word(F.col(f"{t}transactionDate.value")), 1, 10).try_cast("date").alias("date"), code.alias("code"),
        word(F.col(f"{t}transactionAmounts.transactionAcquiredDisposedCode.value")).alias("acquired"), shares.alias("shares"), price.alias("price"), F.round(shares * price, 2).alias("value_usd"),
        number(F.col(f"{t}postTransactionAmounts.sharesOwnedFollowingTransaction.value")).alias("after"), word(F.col(f"{t}ownershipNature.directOrIndirectOwnership.value")).alias("direct_or_indirect"),
    )


def _listed(table: str, name: str, derivative: bool) -> Column:
    """The transactions of one table with their place in it; a missing table has none."""
    return F.coalesce(F.transform(F.col(f"form.{table}.{name}"), lambda t, n: F.struct(F.lit(derivative).alias("derivative"), n.alias("nth"), t.alias("t"))), F.array())
