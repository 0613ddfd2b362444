"""Ownership forms: every field of good ones, rejects for broken ones, in one job."""

import datetime as dt

from barloom.sources import ownership_forms, readers

GOOD = """<?xml version="1.0"?>
<ownershipDocument><issuer><issuerCik> 0001 </issuerCik><issuerTradingSymbol> abc </issuerTradingSymbol></issuer>
<reportingOwner><reportingOwnerId><rptOwnerCik>77</rptOwnerCik><rptOwnerName>Doe &amp; Co</rptOwnerName></reportingOwnerId>
<reportingOwnerRelationship><isDirector>1</isDirector><isOfficer>TRUE</isOfficer><isTenPercentOwner>0</isTenPercentOwner><officerTitle>Chief</officerTitle></reportingOwnerRelationship></reportingOwner>
<reportingOwner><reportingOwnerId><rptOwnerCik>78</rptOwnerCik><rptOwnerName>Second</rptOwnerName></reportingOwnerId></reportingOwner>
<nonDerivativeTable><nonDerivativeTransaction><securityTitle><value>Common</value><footnoteId id="F1"/></securityTitle><transactionDate><value>2024-05-06-05:00</value></transactionDate>
<transactionCoding><transactionFormType>4</transactionFormType><transactionCode>P</transactionCode></transactionCoding>
<transactionAmounts><transactionShares><value>10.5</value></transactionShares><transactionPricePerShare><value>3.333</value></transactionPricePerShare><transactionAcquiredDisposedCode><value>A</value></transactionAcquiredDisposedCode></transactionAmounts>
<postTransactionAmounts><sharesOwnedFollowingTransaction><value>100</value></sharesOwnedFollowingTransaction></postTransactionAmounts><ownershipNature><directOrIndirectOwnership><value>I</value></directOrIndirectOwnership></ownershipNature></nonDerivativeTransaction>
<nonDerivativeTransaction><transactionCoding><transactionCode><value>S</value></transactionCode></transactionCoding><transactionAmounts><transactionShares><value>many</value></transactionShares></transactionAmounts></nonDerivativeTransaction></nonDerivativeTable>
<derivativeTable><derivativeTransaction><securityTitle><value>Option</value></securityTitle><transactionDate><value>soon</value></transactionDate></derivativeTransaction></derivativeTable></ownershipDocument>"""
BROKEN = {"no end tag": GOOD.replace("</issuer>", ""), "bare ampersand": GOOD.replace("&amp;", "&"), "cut": GOOD[:900], "text": "not xml at all", "blank": " \n ", "null": None, "two ends": GOOD.replace("</issuer>", "</issuer></issuer>")}


def test_fields_of_good_forms_beside_broken_ones(spark):
    rows = [(1, GOOD), (2, "<ownershipDocument/>"), (3, "<ownershipDocument><issuer/></ownershipDocument>"), *[(n + 10, x) for n, x in enumerate(BROKEN.values())], (None, GOOD)]
    forms = spark.createDataFrame(rows, "id int, xml string").repartition(3)
    got = ownership_forms.insider_transactions(forms, "id", "xml")
    mine = sorted((tuple(r)[1:] for r in got.where("id = 1").collect()), key=lambda r: (r[8], r[9]))
    who = ("ABC", "0001", "Doe & Co", "77", True, True, False, "Chief")
    assert mine == [
        (*who, False, 0, "Common", dt.date(2024, 5, 6), "P", "A", 10.5, 3.333, 35.0, 100.0, "I"), (*who, False, 1, "", None, "S", "", None, None, None, None, ""), (*who, True, 0, "Option", None, "", "", None, None, None, None, ""),
    ]
    assert {r["id"] for r in got.collect()} == {1, None} and got.count() == 6
    bad = {r["id"]: r["reject"] for r in ownership_forms.rejected_forms(forms, "id", "xml").collect()}
    assert bad == {n + 10: "empty" if k in ("blank", "null") else "not well-formed" for n, k in enumerate(BROKEN)}
    short = readers.ownership_transactions(forms, "id", "xml").where("id = 1").collect()
    assert sorted((r["table"], r["nth"], r["issuer"], r["code"]) for r in short) == [("derivative", 0, "ABC", None), ("non_derivative", 0, "ABC", "P"), ("non_derivative", 1, "ABC", "S")]
    assert ownership_forms.insider_transactions(forms.limit(0), "id", "xml").count() == 0


def test_each_form_is_parsed_once(spark):
    """A filter on what came of the parse moved below it, and its conditions parsed each form again: three times for rejects, four for transactions."""
    forms = spark.createDataFrame([(1, GOOD)], "id int, xml string")
    for got in (ownership_forms.insider_transactions(forms, "id", "xml"), ownership_forms.rejected_forms(forms, "id", "xml"), readers.ownership_transactions(forms, "id", "xml")):
        assert got._jdf.queryExecution().executedPlan().toString().count("from_xml(") == 1
