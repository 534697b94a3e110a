"""Column-name resolution at plan time."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from closewright.functions.text import MONEY, to_number


def first_existing(df: DataFrame, candidates: Sequence[str]) -> str | None:
    """The first candidate that is a column of the frame."""
    present = set(df.columns)
    return next((name for name in candidates if name in present), None)


def rename_first_existing(df: DataFrame, mapping: Mapping[str, Sequence[str]]) -> DataFrame:
    """Rename the first present alias of each canonical name; other columns stay as they are.

    A canonical name that is already a column wins over its aliases.
    """
    renames = {}
    for canonical, aliases in mapping.items():
        found = first_existing(df, [canonical, *aliases])
        if found and found != canonical:
            renames[found] = canonical
    return df.withColumnsRenamed(renames) if renames else df


def require_columns(df: DataFrame, names: Sequence[str], context: str) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"{context}: missing columns {missing}; available {df.columns}")


def column_or_null(df: DataFrame, candidates: Sequence[str], dtype: str = "string") -> Column:
    """The first present candidate, or a typed null."""
    found = first_existing(df, candidates)
    return F.col(f"`{found}`") if found else F.lit(None).cast(dtype)


def amount_column(df: DataFrame, name: str, fill=0, target=MONEY) -> Column:
    """A column read as money, whatever its stored type."""
    return to_number(F.col(f"`{name}`"), df.schema[name].dataType, target, fill)


def cast_matching_amounts(df: DataFrame, pattern: str = "amount", columns: Sequence[str] | None = None, fill=None) -> DataFrame:
    """Read the listed columns, or all whose name contains the pattern, as money in one projection."""
    names = list(columns) if columns is not None else [c for c in df.columns if pattern.lower() in c.lower()]
    require_columns(df, names, "amount columns")
    return df.withColumns({n: amount_column(df, n, fill) for n in names}) if names else df


def is_numeric(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, NumericType)


# Headings under which ledger and voucher columns arrive, in order of preference.
LEDGER_ALIASES = {
    "company_code": ("id_company", "ID_Company", "ID_COMPANY", "Company_Code"),
    "gl_account": ("Chart of Accounts No_", "chart_of_accounts_no", "GL Account", "GL_Account", "Account_No", "account_no"),
    "amount": ("Amount", "Amt", "amt"),
    "user_id": ("User ID", "User_ID", "userid", "UserID"),
    "description": ("Document Description", "document_description", "Description", "desc"),
    "comment": ("Comment", "Comments", "comments"),
    "bal_account_type": ("Bal_ Account Type", "Bal_Account_Type"),
    "document_type": ("Document Type", "Document_Type"),
    "document_no": ("Document No", "Document No_", "doc_no", "Doc_No"),
    "voucher_no": ("Voucher No_", "[Voucher No_]", "Voucher_No"),
    "posting_date": ("Posting Date", "Posting_Date"),
}
VOUCHER_ALIASES = {
    "id": ("Voucher_Id", "voucher_id", "VoucherId"),
    "company_code": ("id_company", "ID_COMPANY", "ID_Company", "Company_Code"),
    "business_use": ("business_use_formatted", "BusinessUse", "Business_Use"),
    "is_valid": ("Is_Valid",),
    "created_at": ("Created_At", "creation_date", "Creation_Date"),
    "inactive_at": (
        "Inactive_At", "inactive_date", "Inactive_Date", "voucher_inactive_date", "Voucher_Inactive_Date",
        "min_inactive_date", "Min_Inactive_Date",
    ),
    "remaining_amount": ("Remaining Amount", "Remaining_Amount"),
    "total_amount_used": ("Total Amount Used", "TotalAmountUsed", "usage_tv", "Usage_TV"),
    "transaction_no": ("Transaction_No", "Transaction_No_", "TransactionNo"),
}
OPS_USAGE_ALIASES = {
    "voucher_id": ("Voucher Id", "Voucher_Id", "VoucherId", "id", "voucher"),
    "amount_used": ("Amount Used", "Amount_Used", "AmountUsed", "amount"),
}
# Headings of a voucher's use, and of the columns of the drilldown view, in order of preference.
USE_HEADINGS = ("business_use", "business_use_formatted", "BusinessUse", "Business_Use")
DRILLDOWN_HEADINGS = {
    "category": ("category", "bridge_category"),
    "country_code": ("country_code", "company_code", "id_company", "Company_Code"),
    "voucher_id": ("voucher_id", "voucher_no", "Voucher_ID", "Voucher No_", "Voucher Id", "VoucherId", "Voucher No"),
    "amount": ("amount_local", "amount_lcy", "amount", "Amount", "Amount_LCY"),
    "date": ("posting_date", "Posting Date", "Posting_Date", "PostingDate", "Date"),
    "business_line": ("business_line", "Business Line", "Business_Line", "integration_type"),
    "details": ("document_description", "Document Description", "description", "Document Type", "document_type"),
}
CUSTOMER_LEDGER_ALIASES = {
    "customer_id": ("Customer No_", "customer_no", "cust_no"),
    "customer_name": ("Customer Name", "Name"),
    "posting_group": ("Customer Posting Group", "customer_posting_group", "Posting Group"),
    "business_line_code": ("Busline Code", "busline_code", "Business Line"),
    "amount_lcy": ("rem_amt_LCY", "rem_amt_lcy", "Amount (LCY)"),
}
