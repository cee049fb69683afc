"""Column-role lists of the data model.

Fixed values: these names must equal the reference's for the same features
to be built; they are listed as text in the reference's order.
"""

# Application columns kept by the 20-feature model (label last).
APP_COLS_TARGET_20 = [
    "EXT_SOURCE_2", "EXT_SOURCE_3", "AMT_CREDIT", "AMT_GOODS_PRICE", "EXT_SOURCE_1",
    "ORGANIZATION_TYPE", "CODE_GENDER", "OWN_CAR_AGE", "DAYS_EMPLOYED", "NAME_EDUCATION_TYPE",
    "AMT_ANNUITY", "DAYS_BIRTH", "TARGET",
]

# Refusal model: columns dropped, label sources, and per-encoder routing.
REFUSED_MODEL_COLS_TO_DROP = [
    "SK_ID_CURR", "RATE_INTEREST_PRIMARY", "RATE_INTEREST_PRIVILEGED", "NAME_CONTRACT_STATUS",
    "DAYS_FIRST_DRAWING", "DAYS_FIRST_DUE", "DAYS_LAST_DUE_1ST_VERSION", "DAYS_LAST_DUE",
    "DAYS_TERMINATION", "NFLAG_INSURED_ON_APPROVAL",
]
REFUSED_BINARY_COLUMNS = ["FLAG_LAST_APPL_PER_CONTRACT"]
REFUSED_PASSTHROUGH_COLUMNS = [
    "SK_ID_PREV", "AMT_ANNUITY", "AMT_APPLICATION", "AMT_CREDIT", "AMT_DOWN_PAYMENT", "AMT_GOODS_PRICE",
    "HOUR_APPR_PROCESS_START", "NFLAG_LAST_APPL_IN_DAY", "RATE_DOWN_PAYMENT", "DAYS_DECISION",
    "SELLERPLACE_AREA", "CNT_PAYMENT",
]
REFUSED_TARGET_COLUMNS = [
    "WEEKDAY_APPR_PROCESS_START", "NAME_CASH_LOAN_PURPOSE", "NAME_GOODS_CATEGORY", "CHANNEL_TYPE",
    "NAME_SELLER_INDUSTRY", "PRODUCT_COMBINATION",
]
REFUSED_ONE_HOT_COLUMNS = [
    "NAME_CONTRACT_TYPE", "NAME_PAYMENT_TYPE", "NAME_TYPE_SUITE", "NAME_CLIENT_TYPE", "NAME_PORTFOLIO",
    "NAME_PRODUCT_TYPE", "NAME_YIELD_GROUP",
]

# Scoring request: 25 declared fields (name, type) in request order.
REQUEST_FIELDS = [
    ("SK_ID_PREV", "int"), ("AMT_ANNUITY", "double"), ("AMT_APPLICATION", "double"), ("AMT_CREDIT", "double"),
    ("AMT_DOWN_PAYMENT", "double"), ("AMT_GOODS_PRICE", "double"), ("WEEKDAY_APPR_PROCESS_START", "string"),
    ("HOUR_APPR_PROCESS_START", "int"), ("FLAG_LAST_APPL_PER_CONTRACT", "string"),
    ("NFLAG_LAST_APPL_IN_DAY", "int"), ("RATE_DOWN_PAYMENT", "double"), ("NAME_CASH_LOAN_PURPOSE", "string"),
    ("DAYS_DECISION", "int"), ("NAME_PAYMENT_TYPE", "string"), ("NAME_TYPE_SUITE", "string"),
    ("NAME_CLIENT_TYPE", "string"), ("NAME_GOODS_CATEGORY", "string"), ("NAME_PORTFOLIO", "string"),
    ("NAME_PRODUCT_TYPE", "string"), ("CHANNEL_TYPE", "string"), ("SELLERPLACE_AREA", "int"),
    ("NAME_SELLER_INDUSTRY", "string"), ("CNT_PAYMENT", "double"), ("NAME_YIELD_GROUP", "string"),
    ("PRODUCT_COMBINATION", "string"),
]

# Income per confusion cell (truth, prediction) used by the profit report.
INCOME_TN, INCOME_FP, INCOME_FN, INCOME_TP = 0.2, -0.2, -0.8, 0.0
# Decision threshold the scoring service applies.
PROFITABLE_THRESHOLD = 0.35

# Final refusal model: encoded columns removed by feature selection, before and after encoding.
REFUSED_FEAT_SEL_BEFORE_PREP = ["NAME_CONTRACT_TYPE"]
REFUSED_FEAT_SEL_AFTER_PREP = [
    "NAME_PORTFOLIO_XNA", "NAME_YIELD_GROUP_XNA", "NAME_PAYMENT_TYPE_Non-cash from your account",
    "NAME_TYPE_SUITE_Group of people", "NAME_PORTFOLIO_Cards", "NAME_CLIENT_TYPE_XNA",
    "NAME_PAYMENT_TYPE_Cashless from the account of the employer", "NAME_PORTFOLIO_Cars",
]

# Payment-difficulty model: columns left out after the latest bureau features were added, and after all aggregates were.
TARGET_DROP_AFTER_LATEST = [
    "NONLIVINGAPARTMENTS_MODE", "FLAG_DOCUMENT_6", "bur_CREDIT_TYPE_nunique", "bur_Has_prolong_sum", "FLAG_EMAIL",
    "FLAG_DOCUMENT_5", "FLAG_DOCUMENT_14", "FLAG_DOCUMENT_11", "FLAG_DOCUMENT_8", "AMT_REQ_CREDIT_BUREAU_HOUR",
    "bur_CREDIT_CURRENCY_nunique", "FLAG_DOCUMENT_15", "REG_REGION_NOT_LIVE_REGION", "FLAG_CONT_MOBILE",
    "HOUSETYPE_MODE", "FLAG_DOCUMENT_21", "FLAG_DOCUMENT_19", "bur_CREDIT_TYPE_infrequent_sum",
    "bur_CREDIT_TYPE_business_sum", "FLAG_MOBIL", "FLAG_DOCUMENT_17", "bur_CREDIT_ACTIVE_Bad_debt_sum",
    "FLAG_DOCUMENT_7", "FLAG_DOCUMENT_9", "FLAG_DOCUMENT_20",
]
TARGET_DROP_AFTER_ALL = [
    "BASEMENTAREA_MEDI", "NONLIVINGAPARTMENTS_AVG", "FLAG_DOCUMENT_13", "COMMONAREA_AVG",
    "prev_NAME_CONTRACT_STATUS_Unused_offer_sum", "prev_NAME_PORTFOLIO_POS_sum", "cred_SK_DPD_mean", "FLOORSMIN_AVG",
    "FLOORSMIN_MODE", "cred_SK_DPD_max", "YEARS_BUILD_MEDI", "ENTRANCES_MODE", "NONLIVINGAPARTMENTS_MEDI",
    "LIVE_CITY_NOT_WORK_CITY", "cred_AMT_DRAWINGS_OTHER_CURRENT_max", "AMT_REQ_CREDIT_BUREAU_WEEK",
    "cred_AMT_DRAWINGS_OTHER_CURRENT_mean", "REG_REGION_NOT_WORK_REGION", "cred_Has_overdue_sum",
    "prev_RATE_INTEREST_PRIMARY_max", "cred_CNT_DRAWINGS_OTHER_CURRENT_mean", "prev_RATE_INTEREST_PRIMARY_min",
    "ELEVATORS_MODE", "prev_NFLAG_LAST_APPL_IN_DAY_mean", "cred_AMT_DRAWINGS_CURRENT_min", "cred_Status_Active_count",
    "cred_SK_ID_PREV_nunique", "prev_RATE_INTEREST_PRIVILEGED_mean", "cred_Has_overdue_def_sum",
    "cred_CNT_DRAWINGS_OTHER_CURRENT_max", "prev_RATE_INTEREST_PRIMARY_mean", "REG_CITY_NOT_WORK_CITY",
    "cred_SK_DPD_DEF_max", "prev_RATE_INTEREST_PRIVILEGED_max", "cred_AMT_DRAWINGS_ATM_CURRENT_min", "FLAG_EMP_PHONE",
    "prev_RATE_INTEREST_PRIVILEGED_min", "bur_Has_overdue_sum", "bur_lat_CNT_CREDIT_PROLONG",
    "cred_AMT_TOTAL_RECEIVABLE_min", "cred_AMT_TOTAL_RECEIVABLE_max", "EMERGENCYSTATE_MODE",
]

# Columns derived from one instalment, as SQL over its columns.
INST_DERIVED = {"Days_till_deadline": "DAYS_INSTALMENT - DAYS_ENTRY_PAYMENT", "Amt_deficit": "AMT_INSTALMENT - AMT_PAYMENT"}
