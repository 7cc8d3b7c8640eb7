"""Series identifiers, dimension codes, labels and row tokens.

They must equal what the vendors use, so they are stated as they are.
"""

from __future__ import annotations

# US Treasury constant-maturity series.
CONSTANT_MATURITY = {
    "1M": "DGS1MO",
    "3M": "DGS3MO",
    "6M": "DGS6MO",
    "1Y": "DGS1",
    "2Y": "DGS2",
    "3Y": "DGS3",
    "5Y": "DGS5",
    "7Y": "DGS7",
    "10Y": "DGS10",
    "20Y": "DGS20",
    "30Y": "DGS30",
}

# Series of the fitted curves by tenor.
ZERO_COUPON = {
    "1Y": "THREEFY1",
    "2Y": "THREEFY2",
    "3Y": "THREEFY3",
    "4Y": "THREEFY4",
    "5Y": "THREEFY5",
    "6Y": "THREEFY6",
    "7Y": "THREEFY7",
    "8Y": "THREEFY8",
    "9Y": "THREEFY9",
    "10Y": "THREEFY10",
}

INSTANTANEOUS_FORWARD = {
    "1Y": "THREEFF1",
    "2Y": "THREEFF2",
    "3Y": "THREEFF3",
    "4Y": "THREEFF4",
    "5Y": "THREEFF5",
    "6Y": "THREEFF6",
    "7Y": "THREEFF7",
    "8Y": "THREEFF8",
    "9Y": "THREEFF9",
    "10Y": "THREEFF10",
}

TERM_PREMIUM_SPOT = {
    "1Y": "THREEFYTP1",
    "2Y": "THREEFYTP2",
    "3Y": "THREEFYTP3",
    "4Y": "THREEFYTP4",
    "5Y": "THREEFYTP5",
    "6Y": "THREEFYTP6",
    "7Y": "THREEFYTP7",
    "8Y": "THREEFYTP8",
    "9Y": "THREEFYTP9",
    "10Y": "THREEFYTP10",
}

TERM_PREMIUM_FORWARD = {
    "1Y": "THREEFFTP1",
    "2Y": "THREEFFTP2",
    "3Y": "THREEFFTP3",
    "4Y": "THREEFFTP4",
    "5Y": "THREEFFTP5",
    "6Y": "THREEFFTP6",
    "7Y": "THREEFFTP7",
    "8Y": "THREEFFTP8",
    "9Y": "THREEFFTP9",
    "10Y": "THREEFFTP10",
}

CURVES: dict[str, dict[str, str]] = {
    "constant_maturity": CONSTANT_MATURITY,
    "zero_coupon": ZERO_COUPON,
    "instantaneous_forward": INSTANTANEOUS_FORWARD,
    "term_premium_spot": TERM_PREMIUM_SPOT,
    "term_premium_forward": TERM_PREMIUM_FORWARD,
}

# Tenor prefixes in the combined wide curve.
CURVE_PREFIXES = {
    "constant_maturity": "",
    "zero_coupon": "ZC_",
    "instantaneous_forward": "FWD_",
    "term_premium_spot": "TP_",
    "term_premium_forward": "TPFWD_",
}

# Central bank series by group and label.
ECB_GROUPS: dict[str, dict[str, str]] = {
    "interest_rates": {
        "mro_fixed_rate": "FM.D.U2.EUR.4F.KR.MRR_FR.LEV",
        "mro_min_bid_rate": "FM.D.U2.EUR.4F.KR.MRR_RT.LEV",
        "deposit_facility": "FM.D.U2.EUR.4F.KR.DFR.LEV",
    },
    "hicp": {
        "hicp_all_items": "ICP.M.U2.Y.000000.3.INX",
        "hicp_energy": "ICP.M.U2.Y.XEF000.4.INX",
        "hicp_food": "ICP.M.U2.Y.XFD000.3.INX",
        "hicp_core": "ICP.M.U2.Y.XFN000.3.INX",
    },
    "monetary_aggregates": {
        "m3": "BSI.M.U2.Y.V.M30.X.1.U2.2300.Z01.E",
        "m1": "BSI.M.U2.Y.V.M10.X.1.U2.2300.Z01.E",
    },
}

# Statistical office dimension codes.
GEO_COLUMN = "geo\\TIME_PERIOD"
CURVE_MATURITIES = ["Y1", "Y2", "Y3", "Y5", "Y10", "Y20", "Y30"]
BOND_COUNTRIES = ["BE", "DE", "IE", "ES", "FR", "IT", "NL", "AT", "PT", "FI"]
MACRO_AREAS = ["EA", "DE", "FR", "IT", "ES", "NL"]

# Number texts that stand for "no value" in fundamentals.
NULL_TOKENS = ["None", "", "null", "NULL"]

# Source labels written into the audit column.
SOURCE_FRED = "FRED"
SOURCE_ECB = "ECB"
SOURCE_EUROSTAT = "EUROSTAT"
SOURCE_FUNDAMENTALS = "ALPHA_VANTAGE"
SOURCE_BARS = "POLYGON"
SOURCE_OPTIONS = "YFINANCE"

# Fixed value: listing page size of the ticker directory.
LISTING_PAGE = 500
