"""Column names and schemas of the files the jobs read and write."""

from __future__ import annotations

from pyspark.sql import types as T

CH, VAT, PAYE, TCN, LINKS = "CH", "VAT", "PAYE", "TCN", "LINKS"

# The first number ever issued is BASE_UBRN + 1.
BASE_UBRN = 10**15

# Column names and types of the source files, in file order.
_COMPANY_COLUMNS = """
    CompanyName CompanyNumber RegAddressCareOf RegAddressPOBox
    RegAddressAddressLine1 RegAddressAddressLine2 RegAddressPostTown
    RegAddressCounty RegAddressCountry RegAddressPostCode
    CompanyCategory CompanyStatus CountryOfOrigin DissolutionDate IncorporationDate
    AccountsAccountRefDay AccountsAccountRefMonth AccountsNextDueDate
    AccountsLastMadeUpdate AccountsAccountCategory
    ReturnsNextDueDate ReturnsLastMadeDate
    MortgagesNumMortCharges MortgagesNumMortOutstanding
    MortgagesNumMortPartSatisfied MortgagesNumMortSatisfied
    SICCodeSicText_1 SICCodeSicText_2 SICCodeSicText_3 SICCodeSicText_4
    LimitedPartnershipsNumGenPartners LimitedPartnershipsNumLimPartners URI
    PreviousName_1CONDATE PreviousNAme_1CompanyName
    PreviousName_2CONDATE PreviousNAme_2CompanyName
    PreviousName_3CONDATE PreviousNAme_3CompanyName
    PreviousName_4CONDATE PreviousNAme_4CompanyName
    PreviousName_5CONDATE PreviousNAme_5CompanyName
    PreviousName_6CONDATE PreviousNAme_6CompanyName
    PreviousName_7CONDATE PreviousNAme_7CompanyName
    PreviousName_8CONDATE PreviousNAme_8CompanyName
    PreviousName_9CONDATE PreviousNAme_9CompanyName
    PreviousName_10CONDATE PreviousNAme_10CompanyName
    ConfStmtNextDueDate ConfStmtLastMadeUpDate
"""
_PAYE_COLUMNS = """
    entref payeref deathcode birthdate deathdate
    mfullemp msubemp ffullemp fsubemp unclemp unclsubemp
    dec_jobs:double mar_jobs:double june_jobs:double sept_jobs:double jobs_lastupd
    status:int prevpaye employer_cat stc:int crn actiondate addressref marker inqcode
    name1 name2 name3 tradstyle1 tradstyle2 tradstyle3
    address1 address2 address3 address4 address5 postcode mkr
"""
_VAT_COLUMNS = """
    entref vatref:bigint deathcode birthdate deathdate
    sic92 turnover:bigint turnover_date record_type status:int
    actiondate crn marker addressref inqcode
    name1 name2 name3 tradstyle1 tradstyle2 tradstyle3
    address1 address2 address3 address4 address5 postcode mkr
"""
_TCN_COLUMNS = "TCN SIC07"


_TYPES = {
    "": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "strings": T.ArrayType(T.StringType()),
    "bigints": T.ArrayType(T.LongType()),
}


def _schema(columns: str) -> T.StructType:
    """``name`` or ``name:type`` per column; no type means text."""
    parts = (name.partition(":") for name in columns.split())
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, _, kind in parts])


ADMIN_SCHEMAS: dict[str, T.StructType] = {
    CH: _schema(_COMPANY_COLUMNS),
    VAT: _schema(_VAT_COLUMNS),
    PAYE: _schema(_PAYE_COLUMNS),
    TCN: _schema(_TCN_COLUMNS),
}

RAW_LINKS = _schema("CH:strings VAT:strings PAYE:strings")
NUMBERED_LINKS = _schema("UBRN:bigint CH:strings VAT:strings PAYE:strings")
# GID is the per-run row key of a new link; it lives only between the matching rules.
MATCHED_LINKS = _schema("UBRN:bigint GID:bigint CH:strings VAT:strings PAYE:strings")

INDEX = _schema("""
    id:bigint BusinessName TradingStyle UPRN:bigint PostCode
    Address1 Address2 Address3 Address4 Address5
    IndustryCode LegalStatus TradingStatus Turnover EmploymentBands
    CompanyNo VatRefs:bigints PayeRefs:strings
""")
LEGAL_ENTITY_COLUMNS = [c for c in INDEX.names if c not in ("UPRN", "VatRefs", "PayeRefs")]
