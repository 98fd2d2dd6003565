"""Thresholds and domain column lists of the mining study."""

from __future__ import annotations

from dataclasses import dataclass, field

INF = float("inf")

# ---------------------------------------------------------------------------
# Names, maps, cut points and labels of the loan domain. They
# decide the results, so they are stated as they are.
# ---------------------------------------------------------------------------
ID_TEXT_COLUMNS = ("id", "member_id", "url", "emp_title", "title", "desc", "zip_code")
LEAKAGE_COLUMNS = (
    "funded_amnt", "funded_amnt_inv", "out_prncp", "out_prncp_inv", "total_pymnt",
    "total_pymnt_inv", "total_rec_prncp", "total_rec_int", "total_rec_late_fee",
    "recoveries", "collection_recovery_fee", "last_pymnt_amnt", "last_fico_range_high",
    "last_fico_range_low", "collections_12_mths_ex_med",
)
LEAKAGE_PREFIXES = ("hardship_", "settlement_", "debt_settlement")
DATE_COLUMNS = (
    "issue_d", "last_pymnt_d", "next_pymnt_d", "last_credit_pull_d", "earliest_cr_line",
)
EMPLOYMENT_YEARS = {
    "< 1 year": 0, "1 year": 1, "2 years": 2, "3 years": 3, "4 years": 4, "5 years": 5,
    "6 years": 6, "7 years": 7, "8 years": 8, "9 years": 9, "10+ years": 10,
}
GRADE_ORDER = {"A": 1, "B": 2, "C": 3, "D": 4, "E": 5, "F": 6, "G": 7}
BASKET_NOMINALS = ("purpose", "home_ownership", "verification_status", "addr_state")
DROPPED_NOMINALS = (
    "home_ownership", "purpose", "addr_state", "verification_status", "pymnt_plan",
    "disbursement_method",
)
QUANTILE_BINS = {
    "annual_inc": ("Low", "Medium", "High", "Very High"),
    "dti": ("Low", "Medium", "High", "Very High"),
    "int_rate": ("Low", "Medium", "High", "Very High"),
    "loan_amnt": ("Small", "Medium", "Large", "Very Large"),
    "fico_range_low": ("Very Low", "Low", "Medium", "High", "Very High"),
}
DOMAIN_BINS = {
    "fico_range_low": (
        (-INF, 670, 740, 800, INF),
        ("FICO Fair(<670)", "FICO Good(670-739)", "FICO VeryGood(740-799)", "FICO Excellent(800+)"),
    ),
    "dti": (
        (-INF, 20, 35, 43, INF),
        ("DTI Healthy(<20)", "DTI Manageable(20-35)", "DTI Borderline(36-43)", "DTI HighRisk(>43)"),
    ),
    "revol_util": (
        (-INF, 30, 60, 90, INF),
        ("Util Excellent(<30)", "Util Moderate(30-60)", "Util High(60-90)", "Util Maxed(>90)"),
    ),
    "annual_inc": (
        (-INF, 50000, 100000, 150000, INF),
        ("Inc Low(<50k)", "Inc Mid(50-100k)", "Inc Upper(100-150k)", "Inc High(>150k)"),
    ),
    "loan_amnt": (
        (-INF, 10000, 25000, INF),
        ("Loan Small(<10k)", "Loan Medium(10-25k)", "Loan Large(>25k)"),
    ),
    "emp_length": (
        (-1, 3, 7, 10),
        ("Emp Short(0-3)", "Emp Mid(4-7)", "Emp Long(8+)"),
    ),
}
PROTECTED_COLUMNS = (
    "grade", "sub_grade", "annual_inc", "dti", "int_rate", "fico_range_low",
    "fico_range_high", "emp_length", "loan_amnt", "revol_util", "term",
)
ORDINAL_COLUMNS = ("grade", "sub_grade", "term", "emp_length", "is_joint", "initial_list_status")
CORRELATION_PRIORITY = (
    "grade", "annual_inc", "dti", "int_rate", "fico_range_low", "loan_amnt",
    "emp_length", "revol_util", "term", "open_acc", "mort_acc",
)
CORE_FEATURES = (
    "grade", "annual_inc", "dti", "fico_range_low", "revol_util", "emp_length",
    "loan_amnt", "term",
)
RISK_COLUMNS = ("dti", "revol_util", "all_util", "inq_last_6mths")
BAD_STATUSES = (
    "Charged Off", "Default", "Late (31-120 days)", "Late (16-30 days)",
    "Does not meet the credit policy. Status:Charged Off",
)
ITEM_PREFIXES = (
    "fico_range_low", "annual_inc", "loan_amnt", "revol_util", "emp_length",
    "int_rate", "dti", "grade", "purpose", "home",
)
# Missing-value mechanism by column name: the first matching pattern decides.
MISSING_RULES = (
    (r"^(id|member_id|url)$", "IDENTIFIER — not a feature"),
    (r"joint|^sec_app_", "STRUCTURAL — filled for joint applications only"),
    (r"^mths_since", "STRUCTURAL — empty means the event never happened"),
    (r"^hardship_|^settlement_|debt_settlement", "POST-LOAN LEAKAGE — known after the outcome only"),
    (r"^desc$", "OPTIONAL — free text"),
    (
        r"_il|il_|open_acc_6m|all_util|inq_last_12m|open_rv|max_bal_bc|total_cu_tl|inq_fi",
        "MAR TEMPORAL — collected in some periods only",
    ),
)
MISSING_OTHER = "TO REVIEW — mechanism unknown"


@dataclass(frozen=True)
class MiningConfig:
    """Every threshold and column list of the study; defaults are the loan domain."""

    label: str = "loan_status"
    target: str = "grade"
    seed: int = 42
    percent_columns: tuple = ("int_rate", "revol_util")
    term_column: str = "term"
    years_column: str = "emp_length"
    years_map: dict = field(default_factory=lambda: dict(EMPLOYMENT_YEARS))
    id_columns: tuple = ID_TEXT_COLUMNS
    leakage_columns: tuple = LEAKAGE_COLUMNS + DATE_COLUMNS
    leakage_prefixes: tuple = LEAKAGE_PREFIXES
    structural_prefix: str = "mths_since"
    sentinel: float = 999.0
    joint_column: str = "application_type"
    joint_text: str = "Joint"
    joint_fragments: tuple = ("joint",)
    joint_prefixes: tuple = ("sec_app_",)
    max_missing_pct: float = 40.0
    group_impute: tuple | None = ("mort_acc", "total_acc")
    grade_columns: dict = field(default_factory=lambda: {"grade": dict(GRADE_ORDER)})
    ordinal_text: tuple = ("sub_grade",)
    binary_text: dict = field(default_factory=lambda: {"initial_list_status": "w"})
    nominals: tuple = BASKET_NOMINALS
    dropped_nominals: tuple = DROPPED_NOMINALS
    quantile_bins: dict = field(default_factory=lambda: dict(QUANTILE_BINS))
    ordinal_columns: tuple = ORDINAL_COLUMNS
    winsor: tuple = (0.01, 0.99)
    winsor_skew: float = 1.0
    log_skew: float = 1.0
    quasi_constant: float = 0.99
    protected: tuple = PROTECTED_COLUMNS
    max_correlation: float = 0.85
    priority: tuple = CORRELATION_PRIORITY
    mi_sample: int | None = None  # rows for the neighbour estimate; None reads all
    mi_neighbors: int = 5
    core: tuple = CORE_FEATURES
    n_features: int = 12
    guard_correlation: float = 0.70
    pca_variance: float = 0.90
