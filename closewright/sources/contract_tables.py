"""The declared datasets: columns, tags, types, required marks and headings, table by table."""

from __future__ import annotations

from closewright.sources.contracts import AMOUNT, CODE, DATE, ID, INTEGER, NAME, OTHER, RATE, Contract, Field

# The contract of each dataset, columns in order, headings in order of preference.

CR_03 = Contract("CR_03", 1, (
    Field("id_company", ID, True, ("id_company", "ID_Company", "ID_COMPANY")),
    Field("company_country", CODE, False, ("Company_Country", "company_country", "Country")),
    Field("flg_in_conso_scope", CODE, False, ("Flg_In_Conso_Scope", "flg_in_conso_scope", "In Consolidation Scope"), dtype=INTEGER),
    Field("opco_central", CODE, False, ("Opco/Central_?", "opco_central", "Opco Central")),
    Field("entry_no", ID, True, ("Entry No_", "entry_no", "Entry Number"), dtype=INTEGER),
    Field("document_no", ID, False, ("Document No_", "document_no", "Document Number")),
    Field("external_document_no", ID, False, ("External Document No_", "external_document_no", "External Doc No")),
    Field("voucher_no", ID, False, ("Voucher No_", "voucher_no", "Voucher Number")),
    Field("posting_date", DATE, True, ("Posting Date", "posting_date", "Post Date")),
    Field("document_date", DATE, False, ("Document Date", "document_date", "Doc Date")),
    Field("document_type", CODE, False, ("Document Type", "document_type", "Doc Type")),
    Field("chart_of_accounts_no", CODE, False, ("Chart of Accounts No_", "chart_of_accounts_no", "Account No")),
    Field("account_name", NAME, False, ("Account Name", "account_name", "Account")),
    Field("group_coa_account_no", CODE, False, ("Group_COA_Account_no", "group_coa_account_no", "Group Account No")),
    Field("group_coa_account_name", NAME, False, ("Group_COA_Account_Name", "group_coa_account_name", "Group Account Name")),
    Field("document_description", OTHER, False, ("Document Description", "document_description", "Description")),
    Field("amount", AMOUNT, True, ("Amount", "amount")),
    Field("remaining_amount", AMOUNT, False, ("Remaining_amount", "remaining_amount", "rem_bal_LCY")),
    Field("busline_code", CODE, False, ("Busline Code", "busline_code", "Business Line Code")),
    Field("department_code", CODE, False, ("Department Code", "department_code", "Dept Code")),
    Field("bal_account_type", CODE, False, ("Bal_ Account Type", "bal_account_type", "Balance Account Type")),
    Field("bal_account_no", CODE, False, ("Bal_ Account No_", "bal_account_no", "Balance Account No")),
    Field("bal_account_name", NAME, False, ("Bal_ Account Name", "bal_account_name", "Balance Account Name")),
    Field("reason_code", CODE, False, ("Reason Code", "reason_code")),
    Field("source_code", CODE, False, ("Source Code", "source_code")),
    Field("reversed", CODE, False, ("Reversed", "reversed"), dtype=INTEGER),
    Field("user_id", ID, False, ("User ID", "user_id", "User")),
    Field("g_l_creation_date", DATE, False, ("G_L Creation Date", "g_l_creation_date", "Creation Date")),
    Field("destination_code", CODE, False, ("Destination Code", "destination_code")),
    Field("partner_code", CODE, False, ("Partner Code", "partner_code")),
    Field("system_created_entry", CODE, False, ("System-Created Entry", "system_created_entry"), dtype=INTEGER),
    Field("source_type", CODE, False, ("Source Type", "source_type")),
    Field("source_no", ID, False, ("Source No", "source_no")),
    Field("ic_partner_code", CODE, False, ("IC Partner Code", "ic_partner_code", "Intercompany Partner")),
    Field("vendortag_code", CODE, False, ("VendorTag Code", "vendortag_code", "Vendor Tag")),
    Field("customertag_code", CODE, False, ("CustomerTag Code", "customertag_code", "Customer Tag")),
    Field("service_period", CODE, False, ("Service_Period", "service_period", "Service Period")),
    Field("level_1_name", CODE, False, ("Level_1_Name", "level_1_name", "IFRS Level 1")),
    Field("level_2_name", CODE, False, ("Level_2_Name", "level_2_name", "IFRS Level 2")),
    Field("level_3_name", CODE, False, ("Level_3_Name", "level_3_name", "IFRS Level 3")),
    Field("entrytype", CODE, False, ("EntryType", "entrytype", "Entry Type")),
), ("id_company", "entry_no"))

CR_04 = Contract("CR_04", 2, (
    Field("id_company", ID, True, ("ID_COMPANY", "id_company", "ID_Company")),
    Field("company_name", NAME, False, ("COMPANY_NAME", "company_name", "Company Name")),
    Field("country_code", CODE, False, ("COUNTRY_CODE", "country_code", "Country Code")),
    Field("country_name", NAME, False, ("COUNTRY_NAME", "country_name", "Country Name")),
    Field("closing_date", DATE, True, ("CLOSING_DATE", "closing_date", "Closing Date")),
    Field("refresh_date", DATE, False, ("REFRESH_DATE", "refresh_date", "Refresh Date")),
    Field("group_coa_account_no", CODE, True, ("GROUP_COA_ACCOUNT_NO", "group_coa_account_no", "Group COA Account No")),
    Field("group_coa_account_name", NAME, False, ("GROUP_COA_ACCOUNT_NAME", "group_coa_account_name", "Group COA Account Name")),
    Field("real_coa", CODE, False, ("REAL_COA", "real_coa", "Real COA")),
    Field("currency", CODE, False, ("CURRENCY", "currency", "Currency")),
    Field("fx_rate", RATE, False, ("FX_RATE", "fx_rate", "FX Rate")),
    Field("balance_at_date", AMOUNT, True, ("BALANCE_AT_DATE", "balance_at_date", "Balance At Date", "Balance", "Amount")),
    Field("busline_code", CODE, False, ("BUSLINE_CODE", "busline_code", "Business Line Code", "BL Code")),
    Field("reporting_country_code", CODE, False, ("REPORTING_COUNTRY_CODE", "reporting_country_code", "Reporting Country Code")),
    Field("reporting_country_name", NAME, False, ("REPORTING_COUNTRY_NAME", "reporting_country_name", "Reporting Country Name")),
    Field("partner_code", CODE, False, ("PARTNER_CODE", "partner_code", "Partner Code")),
    Field("ic_partner_code", CODE, False, ("IC_PARTNER_CODE", "ic_partner_code", "IC Partner Code", "Intercompany Partner")),
    Field("is_recharge", CODE, False, ("IS_RECHARGE", "is_recharge", "Is Recharge"), dtype=INTEGER),
    Field("is_retained_earnings", CODE, False, ("IS_RETAINED_EARNINGS", "is_retained_earnings", "Is Retained Earnings"), dtype=INTEGER),
    Field("conso_account_no", CODE, False, ("CONSO_ACCOUNT_NO", "conso_account_no", "Conso Account No")),
    Field("conso_account_name", NAME, False, ("CONSO_ACCOUNT_NAME", "conso_account_name", "Conso Account Name")),
    Field("ifrs_level_1_name", CODE, False, ("IFRS_LEVEL_1_NAME", "ifrs_level_1_name", "IFRS Level 1")),
    Field("ifrs_level_2_name", CODE, False, ("IFRS_LEVEL_2_NAME", "ifrs_level_2_name", "IFRS Level 2")),
    Field("ifrs_level_3_name", CODE, False, ("IFRS_LEVEL_3_NAME", "ifrs_level_3_name", "IFRS Level 3")),
    Field("is_interco", CODE, False, ("IS_INTERCO", "is_interco", "Is Interco", "Intercompany"), dtype=INTEGER),
), ("id_company", "closing_date", "group_coa_account_no"))

CR_05 = Contract("CR_05", 2, (
    Field("company_code", ID, True, ("Company_Code", "company_code", "ID_Company", "ID_COMPANY")),
    Field("company_name", NAME, False, ("Company_Name", "company_name", "Company Name")),
    Field("opco_central", CODE, False, ("Opco/Central_?", "opco_central", "Opco Central")),
    Field("company_country", CODE, False, ("Company_Country", "company_country", "Country Code")),
    Field("is_active", CODE, False, ("Is_Active?", "is_active", "Is Active"), dtype=INTEGER),
    Field("rate_type", CODE, False, ("rate_type", "Rate_Type", "Rate Type")),
    Field("year", CODE, False, ("year", "Year", "YEAR"), dtype=INTEGER),
    Field("cod_month", CODE, False, ("cod_month", "Cod_Month", "Month Code"), dtype=INTEGER),
    Field("fx_rate", RATE, False, ("FX_rate", "fx_rate", "FX Rate", "Exchange Rate")),
    Field("country_name", NAME, False, ("Country_Name", "country_name", "Country Name")),
), ("company_code",))

CR_05A = Contract("CR_05a", 1, (
    Field("currency_code", CODE, True, ("Currency Code", "currency_code", "Currency")),
    Field("year", CODE, True, ("year", "Year", "YEAR"), dtype=INTEGER),
    Field("month", CODE, True, ("month", "Month", "MONTH"), dtype=INTEGER),
    Field("relational_exch_rate_amount", AMOUNT, True, ("Relational Exch_ Rate Amount", "relational_exch_rate_amount", "Exchange Rate")),
), ("currency_code", "year", "month"))

DOC_VOUCHER_USAGE = Contract("DOC_VOUCHER_USAGE", 1, (
    Field("id_company", ID, True, ("ID_Company", "id_company", "ID_COMPANY")),
    Field("id", ID, True, ("id", "ID", "voucher_id")),
    Field("transaction_no", ID, False, ("Transaction_No", "transaction_no", "Transaction Number")),
    Field("voucher_type", CODE, False, ("voucher_type", "Voucher_Type", "Voucher Type")),
    Field("business_use", CODE, False, ("business_use", "Business_Use", "Business Use")),
    Field("creation_year", CODE, False, ("creation_year", "Creation_Year", "Creation Year"), dtype=INTEGER),
    Field("delivery_mth", CODE, True, ("Delivery_mth", "delivery_mth", "Delivery Month"), dtype=INTEGER),
    Field("shipping_storecredit", AMOUNT, False, ("shipping_storecredit", "Shipping_StoreCredit", "Shipping Store Credit")),
    Field("mpl_storecredit", AMOUNT, False, ("MPL_storecredit", "mpl_storecredit", "Marketplace Store Credit")),
    Field("rtl_storecredit", AMOUNT, False, ("RTL_storecredit", "rtl_storecredit", "Retail Store Credit")),
    Field("totalamountused", AMOUNT, True, ("TotalAmountUsed", "totalamountused", "Total Amount Used")),
), ("id_company", "id", "delivery_mth"))

IPE_07 = Contract("IPE_07", 2, (
    Field("id_company", ID, True, ("id_company", "ID_Company", "ID_COMPANY")),
    Field("company_country", CODE, False, ("Company_Country", "company_country", "Country")),
    Field("opco_central", CODE, False, ("Opco/Central_?", "opco_central", "Opco Central")),
    Field("entry_no", ID, True, ("Entry No_", "entry_no", "Entry Number"), dtype=INTEGER),
    Field("gl_entry_no", ID, False, ("GL Entry No_", "gl_entry_no", "GL Entry Number"), dtype=INTEGER),
    Field("document_no", ID, False, ("Document No_", "document_no", "Doc No")),
    Field("document_type", CODE, False, ("Document Type", "document_type", "Doc Type")),
    Field("external_document_no", ID, False, ("External Document No_", "external_document_no", "External Doc No")),
    Field("posting_date", DATE, True, ("Posting Date", "posting_date", "Post Date")),
    Field("customer_no", ID, True, ("Customer No_", "Customer No", "customer_no", "cust_no")),
    Field("customer_name", NAME, False, ("Customer Name", "customer_name", "Name")),
    Field("customer_busline", CODE, False, ("Customer Busline", "customer_busline", "Customer Business Line")),
    Field("automatically_integrated", CODE, False, ("Automatically integrated", "automatically_integrated", "Auto Integrated"), dtype=INTEGER),
    Field("currentpostinggroup", CODE, False, ("currentpostinggroup", "Current Posting Group")),
    Field("stream", CODE, False, ("Stream", "stream")),
    Field("customer_posting_group", CODE, True, ("Customer Posting Group", "customer_posting_group", "Posting Group")),
    Field("description", OTHER, False, ("Description", "description")),
    Field("source_code", CODE, False, ("Source Code", "source_code")),
    Field("reason_code", CODE, False, ("Reason Code", "reason_code")),
    Field("busline_code", CODE, False, ("Busline Code", "busline_code", "Business Line", "BL Code")),
    Field("busline_vertical_name_1", CODE, False, ("Busline_Vertical_Name_1", "busline_vertical_name_1", "Business Line Vertical 1")),
    Field("busline_vertical_name_2", CODE, False, ("Busline_Vertical_Name_2", "busline_vertical_name_2", "Business Line Vertical 2")),
    Field("busline_vertical_name_3", CODE, False, ("Busline_Vertical_Name_3", "busline_vertical_name_3", "Business Line Vertical 3")),
    Field("department_code", CODE, False, ("Department Code", "department_code", "Dept Code")),
    Field("original_amount", AMOUNT, False, ("Original Amount", "original_amount")),
    Field("currency", CODE, False, ("Currency", "currency", "Currency Code")),
    Field("original_amount_lcy", AMOUNT, False, ("Original Amount (LCY)", "original_amount_lcy", "Original Amount LCY")),
    Field("rem_amt_lcy", AMOUNT, True, ("rem_amt_LCY", "rem_amt_lcy", "Remaining Amount", "Amount LCY", "amount_lcy", "remaining_amount")),
    Field("open", CODE, False, ("Open", "open"), dtype=INTEGER),
    Field("due_date", DATE, False, ("Due Date", "due_date")),
    Field("posted_by", ID, False, ("Posted by", "posted_by", "Posted By")),
    Field("destination_code", CODE, False, ("Destination Code", "destination_code")),
    Field("partner_code", CODE, False, ("Partner Code", "partner_code")),
    Field("ic_partner_code", CODE, False, ("IC Partner Code", "ic_partner_code", "Intercompany Partner")),
    Field("debit_credit_duemonth", CODE, False, ("Debit_Credit_DueMonth", "debit_credit_duemonth", "Debit Credit Due Month")),
), ("id_company", "entry_no"))

IPE_08 = Contract("IPE_08", 2, (
    Field("id_company", ID, True, ("ID_COMPANY", "id_company", "ID_Company")),
    Field("id", ID, True, ("id", "ID", "Voucher_Id", "voucher_id", "VoucherId")),
    Field("business_use", CODE, False, ("business_use", "Business_Use", "Business Use")),
    Field("business_use_formatted", CODE, False, ("business_use_formatted", "Business_Use_Formatted")),
    Field("template_id", ID, False, ("template_id", "Template_Id", "Template ID")),
    Field("template_name", NAME, False, ("template_name", "Template_Name", "Template Name")),
    Field("description", OTHER, False, ("description", "Description")),
    Field("is_active", CODE, False, ("is_active", "Is_Active", "Is Active"), dtype=INTEGER),
    Field("type", CODE, False, ("type", "Type")),
    Field("template_status", CODE, False, ("Template_status", "template_status", "Template Status")),
    Field("discount_amount", AMOUNT, False, ("discount_amount", "Discount_Amount", "Amount Issued", "Amount")),
    Field("from_date", DATE, False, ("from_date", "From_Date", "From Date")),
    Field("to_date", DATE, False, ("to_date", "To_Date", "To Date", "Expiration Date")),
    Field("expiration_ym", CODE, False, ("expiration_ym", "Expiration_YM", "Expiration Year-Month")),
    Field("is_valid", CODE, False, ("Is_Valid", "is_valid", "Is Valid")),
    Field("created_at", DATE, False, ("created_at", "Created_At", "Creation Date", "Created Date")),
    Field("creation_ym", CODE, False, ("creation_ym", "Creation_YM", "Creation Year-Month")),
    Field("last_update_ym", CODE, False, ("last_update_ym", "Last_Update_YM")),
    Field("last_time_used", DATE, False, ("last_time_used", "Last_Time_Used", "Last Time Used")),
    Field("snapshot_date", DATE, False, ("snapshot_date", "Snapshot_Date", "Snapshot Date")),
    Field("voucher_inactive_date", DATE, False, ("voucher_inactive_date", "Voucher_Inactive_Date")),
    Field("template_inactive_date", DATE, False, ("template_inactive_date", "Template_Inactive_Date")),
    Field("codeinactive_ym", CODE, False, ("codeinactive_ym", "Code Inactive YM")),
    Field("templateinactive_ym", CODE, False, ("templateinactive_ym", "Template Inactive YM")),
    Field("reason", OTHER, False, ("reason", "Reason")),
    Field("updated_at", DATE, False, ("updated_at", "Updated_At", "Updated Date")),
    Field("fk_customer", ID, False, ("fk_customer", "FK_Customer", "Customer ID")),
    Field("used_discount_amount", AMOUNT, False, ("used_discount_amount", "Used_Discount_Amount", "Amount Used")),
    Field("times_used", CODE, False, ("times_used", "Times_Used", "Times Used"), dtype=INTEGER),
    Field("remaining_amount", AMOUNT, False, ("remaining_amount", "Remaining_Amount", "Remaining Amount", "Balance")),
    Field("voucher_type", CODE, False, ("voucher_type", "Voucher_Type", "Voucher Type")),
    Field("shipping_discount", AMOUNT, False, ("shipping_discount", "Shipping_Discount", "Shipping Discount")),
    Field("shipping_storecredit", AMOUNT, False, ("shipping_storecredit", "Shipping_StoreCredit", "Shipping Store Credit")),
    Field("mpl_storecredit", AMOUNT, False, ("MPL_storecredit", "mpl_storecredit", "Marketplace Store Credit")),
    Field("rtl_storecredit", AMOUNT, False, ("RTL_storecredit", "rtl_storecredit", "Retail Store Credit")),
    Field("totalamountused", AMOUNT, False, ("TotalAmountUsed", "totalamountused", "Total Amount Used")),
    Field("totalremainingamount", AMOUNT, False, ("TotalRemainingAmount", "totalremainingamount", "Total Remaining Amount")),
    Field("min_inactive_date", DATE, False, ("min_inactive_date", "Min_Inactive_Date", "Minimum Inactive Date")),
), ("id_company", "id"))

IPE_10 = Contract("IPE_10", 1, (
    Field("id_company", ID, True, ("ID_COMPANY", "id_company", "ID_Company")),
    Field("is_prepayment", CODE, True, ("IS_PREPAYMENT", "is_prepayment", "Is Prepayment"), dtype=INTEGER),
    Field("cod_oms_sales_order_item", ID, True, ("COD_OMS_SALES_ORDER_ITEM", "cod_oms_sales_order_item", "OMS Sales Order Item")),
    Field("order_nr", ID, True, ("ORDER_NR", "order_nr", "Order Number")),
    Field("bob_id_customer", ID, False, ("BOB_ID_CUSTOMER", "bob_id_customer", "Customer ID")),
    Field("current_status", CODE, False, ("CURRENT_STATUS", "current_status", "Status")),
    Field("is_closed", CODE, False, ("IS_CLOSED", "is_closed", "Is Closed"), dtype=INTEGER),
    Field("is_marketplace", CODE, False, ("IS_MARKETPLACE", "is_marketplace", "Is Marketplace"), dtype=INTEGER),
    Field("payment_method", CODE, False, ("PAYMENT_METHOD", "payment_method", "Payment Method")),
    Field("order_creation_date", DATE, False, ("ORDER_CREATION_DATE", "order_creation_date", "Order Creation Date")),
    Field("finance_verified_date", DATE, False, ("FINANCE_VERIFIED_DATE", "finance_verified_date", "Finance Verified Date")),
    Field("delivered_date", DATE, False, ("DELIVERED_DATE", "delivered_date", "Delivered Date")),
    Field("package_delivery_date", DATE, False, ("PACKAGE_DELIVERY_DATE", "package_delivery_date", "Package Delivery Date")),
    Field("refund_completed", CODE, False, ("REFUND_COMPLETED", "refund_completed", "Refund Completed"), dtype=INTEGER),
    Field("refund_date", DATE, False, ("REFUND_DATE", "refund_date", "Refund Date")),
    Field("fail_date", DATE, False, ("FAIL_DATE", "fail_date", "Fail Date")),
    Field("paid_for_items", AMOUNT, True, ("PAID_FOR_ITEMS", "paid_for_items", "Paid For Items")),
    Field("paid_price", AMOUNT, True, ("PAID_PRICE", "paid_price", "Paid Price")),
    Field("paid_for_shipping", AMOUNT, True, ("PAID_FOR_SHIPPING", "paid_for_shipping", "Paid For Shipping")),
), ("id_company", "cod_oms_sales_order_item"))

IPE_11 = Contract("IPE_11", 1, (
    Field("id_company", ID, True, ("ID_Company", "id_company", "ID_COMPANY")),
    Field("sc_created_date", DATE, True, ("SC_Created_Date", "sc_created_date", "Created Date")),
    Field("sc_id_transaction", ID, True, ("SC_ID_Transaction", "sc_id_transaction", "ID Transaction")),
    Field("sc_transaction_no", ID, False, ("SC_Transaction_No", "sc_transaction_no", "Transaction No")),
    Field("sc_transaction_type", CODE, False, ("SC_Transaction_Type", "sc_transaction_type", "Transaction Type")),
    Field("sc_asg_name", CODE, False, ("SC_ASG_Name", "sc_asg_name", "ASG Name")),
    Field("sc_nav_type", CODE, False, ("SC_Nav_Type", "sc_nav_type", "Nav Type")),
    Field("sc_nav_message", OTHER, False, ("SC_Nav_Message", "sc_nav_message", "ERP_Name", "erp_name")),
    Field("sc_transaction_amount", AMOUNT, True, ("SC_Transaction_Amount", "sc_transaction_amount", "Transaction Amount")),
    Field("sc_created_manually", CODE, False, ("SC_Created_Manually", "sc_created_manually", "Created Manually"), dtype=INTEGER),
    Field("sc_vendor_no", ID, False, ("SC_Vendor_No", "sc_vendor_no", "Vendor Short Code")),
    Field("bob_id_vendor", ID, False, ("BOB_ID_Vendor", "bob_id_vendor", "BOB Vendor ID")),
    Field("sc_vendor_name", NAME, False, ("SC_Vendor_Name", "sc_vendor_name", "Vendor Name")),
    Field("is_global", CODE, False, ("Is_Global", "is_global", "IsGlobal"), dtype=INTEGER),
    Field("sc_id_sales_order_item", ID, False, ("SC_ID_Sales_Order_Item", "sc_id_sales_order_item", "SC Sales Order Item ID")),
    Field("oms_id_sales_order_item", ID, False, ("OMS_ID_Sales_Order_Item", "oms_id_sales_order_item", "OMS Sales Order Item ID")),
    Field("bob_id_sales_order_item", ID, False, ("BOB_ID_Sales_Order_Item", "bob_id_sales_order_item", "BOB Sales Order Item ID")),
    Field("order_nr", ID, False, ("Order_Nr", "order_nr", "Order Number")),
    Field("sc_id_account_statement", ID, False, ("SC_ID_Account_Statement", "sc_id_account_statement", "ID Account Statement")),
    Field("sc_transaction_statement_no", ID, False, ("SC_Transaction_Statement_No", "sc_transaction_statement_no", "Statement No")),
    Field("sc_start_date", DATE, False, ("SC_Start_Date", "sc_start_date", "Start Date")),
    Field("sc_end_date", DATE, False, ("SC_End_Date", "sc_end_date", "End Date")),
    Field("sc_paid", CODE, False, ("SC_Paid", "sc_paid", "Paid"), dtype=INTEGER),
    Field("sc_paid_date", DATE, False, ("SC_Paid_Date", "sc_paid_date", "Paid Date")),
    Field("asg_level_1", CODE, False, ("ASG_Level_1", "asg_level_1", "ASG L1")),
    Field("asg_level_2", CODE, False, ("ASG_Level_2", "asg_level_2", "ASG L2")),
    Field("asg_level_3", CODE, False, ("ASG_Level_3", "asg_level_3", "ASG L3")),
    Field("asg_level_4", CODE, False, ("ASG_Level_4", "asg_level_4", "ASG L4")),
), ("id_company", "sc_id_transaction"))

IPE_12 = Contract("IPE_12", 1, (
    Field("id_company", ID, True, ("ID_COMPANY", "id_company", "ID_Company")),
    Field("cod_oms_id_package", ID, True, ("COD_OMS_ID_PACKAGE", "cod_oms_id_package", "OMS Package ID")),
    Field("payment_method", CODE, False, ("PAYMENT_METHOD", "payment_method", "Payment Method")),
    Field("is_marketplace", CODE, False, ("IS_MARKETPLACE", "is_marketplace", "Is Marketplace"), dtype=INTEGER),
    Field("order_nr", ID, False, ("Order_nr", "order_nr", "ORDER_NR", "Order Number")),
    Field("package_number", ID, False, ("PACKAGE_NUMBER", "package_number", "Package Number")),
    Field("voucher_type", CODE, False, ("VOUCHER_TYPE", "voucher_type", "Voucher Type")),
    Field("bob_id_customer", ID, False, ("BOB_ID_CUSTOMER", "bob_id_customer", "Customer ID")),
    Field("order_creation_date", DATE, False, ("ORDER_CREATION_DATE", "order_creation_date", "Order Creation Date")),
    Field("shipped_date", DATE, False, ("SHIPPED_DATE", "shipped_date", "Shipped Date")),
    Field("delivered_date", DATE, False, ("DELIVERED_DATE", "delivered_date", "Delivered Date")),
    Field("package_delivery_date", DATE, False, ("PACKAGE_DELIVERY_DATE", "package_delivery_date", "Package Delivery Date")),
    Field("is_prepayment", CODE, False, ("IS_PREPAYMENT", "is_prepayment", "Is Prepayment"), dtype=INTEGER),
    Field("mtr_shipping_fee_modification", AMOUNT, False, ("MTR_SHIPPING_FEE_MODIFICATION", "mtr_shipping_fee_modification", "Shipping Fee Modification")),
    Field("tracking_number", ID, False, ("TRACKING_NUMBER", "tracking_number", "Tracking Number")),
    Field("oms_package_status", CODE, False, ("OMS_PACKAGE_STATUS", "oms_package_status", "OMS Package Status")),
    Field("customer_type", CODE, False, ("Customer Type", "customer_type", "Customer_Type")),
    Field("amount_expected", AMOUNT, False, ("amount_expected", "Amount Expected")),
    Field("amount_received", AMOUNT, False, ("amount_received", "Amount Received")),
    Field("fk_package_status", CODE, False, ("fk_package_status", "FK Package Status")),
    Field("delivered_update_date", DATE, False, ("delivered_update_date", "Delivered Update Date")),
    Field("delivery_date", DATE, False, ("delivery_date", "Delivery Date")),
    Field("fk_collection_partner", CODE, False, ("fk_collection_partner", "FK Collection Partner")),
    Field("last_mile", CODE, False, ("last_mile", "Last Mile")),
    Field("package_status_cashrec", CODE, False, ("package_status", "Package Status Cashrec")),
    Field("payment_method_confirmed", CODE, False, ("payment_method_confirmed", "Payment Method Confirmed")),
    Field("troubleshoot_resolution_date", DATE, False, ("troubleshoot_resolution_date", "Troubleshoot Resolution Date")),
    Field("amount_paid", AMOUNT, True, ("amount_paid", "Amount Paid")),
    Field("paid_price", AMOUNT, True, ("paid_price", "Paid Price")),
    Field("paid_shipping", AMOUNT, True, ("paid_shipping", "Paid Shipping")),
), ("id_company", "cod_oms_id_package"))

IPE_31 = Contract("IPE_31", 1, (
    Field("id_company", ID, True, ("ID_Company", "ID_COMPANY", "id_company")),
    Field("event_date", DATE, True, ("Event_date", "event_date", "Event Date")),
    Field("cp", CODE, True, ("CP", "cp", "Collection_Partner")),
    Field("transaction_type", CODE, True, ("Transaction_Type", "transaction_type", "Type")),
    Field("related_entity", ID, True, ("Related_Entity", "related_entity", "Related Entity")),
    Field("amount", AMOUNT, True, ("Amount", "amount")),
    Field("service_provider", NAME, False, ("SERVICE_PROVIDER", "service_provider", "Service Provider")),
    Field("type", CODE, False, ("type", "CP_Type")),
    Field("erp_name", CODE, False, ("ERP_Name", "erp_name", "ERP Name")),
    Field("company_country", CODE, False, ("Company_Country", "company_country", "Country")),
    Field("closing_date", DATE, False, ("Closing_date", "closing_date", "Closing Date")),
    Field("g_l_bank_account_no", CODE, False, ("G_L Bank Account No_", "g_l_bank_account_no", "Bank Account No")),
), ("id_company", "event_date", "cp", "transaction_type", "related_entity"))

IPE_34 = Contract("IPE_34", 1, (
    Field("id_company", ID, True, ("ID_COMPANY", "id_company", "ID_Company")),
    Field("current_status", CODE, False, ("CURRENT_STATUS", "current_status", "Status")),
    Field("case_type", CODE, True, ("Case_Type", "case_type", "Case Type")),
    Field("is_marketplace", CODE, False, ("IS_MARKETPLACE", "is_marketplace", "Is Marketplace"), dtype=INTEGER),
    Field("order_nr", ID, True, ("ORDER_NR", "order_nr", "Order Number")),
    Field("bob_id_customer", ID, False, ("BOB_ID_CUSTOMER", "bob_id_customer", "Customer ID")),
    Field("return_date", DATE, False, ("RETURN_DATE", "return_date", "Return Date")),
    Field("is_global", CODE, False, ("IS_GLOBAL", "is_global", "Is Global"), dtype=INTEGER),
    Field("finance_verified_date", DATE, False, ("FINANCE_VERIFIED_DATE", "finance_verified_date", "Finance Verified Date")),
    Field("refund_date", DATE, False, ("REFUND_DATE", "refund_date", "Refund Date")),
    Field("oms_type", CODE, False, ("OMS_Type", "oms_type", "OMS Type")),
    Field("customer_type_l1", CODE, False, ("Customer_Type_L1", "customer_type_l1", "Customer Type")),
    Field("amounttorefund", AMOUNT, True, ("AmountToRefund", "amounttorefund", "Amount To Refund")),
), ("id_company", "order_nr", "case_type"))

OPS_USAGE = Contract("OPS_USAGE", 1, (
    Field("voucher_id", ID, True, ("Voucher Id", "Voucher_Id", "voucher_id", "VoucherId", "id", "voucher")),
    Field("amount_used", AMOUNT, True, ("Amount Used", "Amount_Used", "amount_used", "AmountUsed", "amount", "Ordered Amount")),
    Field("usage_date", DATE, False, ("Usage Date", "usage_date", "Date Used", "Transaction Date")),
    Field("order_id", ID, False, ("Order Id", "Order_Id", "order_id", "OrderId")),
    Field("customer_id", ID, False, ("Customer Id", "Customer_Id", "customer_id", "CustomerId")),
    Field("status", CODE, False, ("Status", "status", "Voucher Status")),
), ("voucher_id",))

CONTRACTS: dict[str, Contract] = {c.dataset_id: c for c in (CR_03, CR_04, CR_05, CR_05A, DOC_VOUCHER_USAGE, IPE_07, IPE_08, IPE_10, IPE_11, IPE_12, IPE_31, IPE_34, OPS_USAGE)}

# The second id under which a dataset may be supplied.
DATASET_ALIASES = {"IPE_08": "IPE_08_ISSUANCE", "DOC_VOUCHER_USAGE": "IPE_08_USAGE"}
