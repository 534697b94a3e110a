"""Business labels: voucher types and company codes."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from closewright.functions.text import strip

__all__ = [
    "harmonize_voucher_type", "country_to_company", "gl_description", "COMPANY_OVERRIDES", "COUNTRY_COMPANY", "COUNTRY_CURRENCY", "GL_DESCRIPTIONS",
]

# Source labels of each harmonised voucher type.
VOUCHER_TYPE_LABELS = {
    "refund": ("refund", "rf_", "rfn"),
    "store_credit": ("store credit", "store_credit", "storecredit"),
    "apology": ("apology", "commercial gesture", "cxp"),
    "jforce": ("jforce", "pyt_", "pyt_pf"),
    "expired": ("expired", "exp"),
    "vtc": ("vtc", "voucher to cash"),
}

# Countries whose FX company code is not EC_<country>.
COMPANY_OVERRIDES = {"EG": "JM_EG", "GH": "JD_GH"}

# Extraction company of each country.
COUNTRY_COMPANY = {
    "NG": "EC_NG", "GH": "JD_GH", "CI": "EC_IC", "SN": "HF_SN", "KE": "EC_KE",
    "UG": "JD_UG", "DZ": "JD_DZ", "EG": "JM_EG", "MA": "EC_MA",
}

# Currency of each country.
COUNTRY_CURRENCY = {
    "NG": "NGN", "GH": "GHS", "CI": "XOF", "SN": "XOF", "KE": "KES",
    "UG": "UGX", "DZ": "DZD", "EG": "EGP", "MA": "MAD", "US": "USD",
}

# Names of the reconciled ledger accounts.
GL_DESCRIPTIONS = {
    "13003": "Customer AR - Trade",
    "13004": "Customer AR - Other",
    "13005": "Packages Delivered Not Reconciled",
    "13009": "Customer AR - Allowance for Doubtful Accounts",
    "13024": "Packages Not Reconciled - Other",
    "18317": "Marketplace Refund Liability",
    "18350": "Customer Prepayments",
    "18412": "Voucher Liabilities",
}


def gl_description(c: Column | str) -> Column:
    """Name of a ledger account; an unlisted one is spelled out."""
    code = F.col(c) if isinstance(c, str) else c
    out = F.when(code.isNull(), None)
    for account, name in GL_DESCRIPTIONS.items():
        out = out.when(code == account, name)
    return out.otherwise(F.concat(F.lit("Unknown GL: "), code))


def harmonize_voucher_type(c: Column | str) -> Column:
    """Canonical voucher type; blank is "Unknown", an unlisted label is "other"."""
    label = F.lower(strip(c))
    out = F.when(label.isNull() | (label == ""), "Unknown")
    for canonical, labels in VOUCHER_TYPE_LABELS.items():
        out = out.when(label.isin(*labels), canonical)
    return out.otherwise("other")


def country_to_company(c: Column | str, overrides: Mapping[str, str] = COMPANY_OVERRIDES) -> Column:
    """Company code that carries the FX rate of a country; a null country stays null."""
    code = F.upper(F.col(c) if isinstance(c, str) else c)
    out = None
    for country, company in overrides.items():
        out = F.when(code == country, company) if out is None else out.when(code == country, company)
    default = F.concat(F.lit("EC_"), code)
    return default if out is None else out.otherwise(default)
