"""Fixed values and parameters shared by every stage."""

from __future__ import annotations

from dataclasses import dataclass, field

# --- fixed values: literals that decide results and must not change ---------

KEYS = ["Customer_ID", "snapshot_date"]

# whole-value markers that mean "missing" in string columns
MASKED_VALUES = [
    "#F%$D@*&8",
    "_______",
    "___",
    "NULL",
    "null",
    "N/A",
    "n/a",
    "",
    " ",
    "?",
    "-",
    "Unknown",
    "unknown",
]

CREDIT_MIX_CODES = {"Good": 2, "Standard": 1, "Bad": 0}
CREDIT_MIX_MASK = "_"
PAYMENT_BEHAVIOUR_MASK = "!@9#%8"

# financial columns that arrive as dirty text and become numbers
FINANCIAL_NUMERIC = [
    "Annual_Income",
    "Monthly_Inhand_Salary",
    "Num_Bank_Accounts",
    "Num_Credit_Card",
    "Interest_Rate",
    "Num_of_Loan",
    "Delay_from_due_date",
    "Num_of_Delayed_Payment",
    "Outstanding_Debt",
    "Num_Credit_Inquiries",
    "Credit_Utilization_Ratio",
    "Total_EMI_per_month",
    "Monthly_Balance",
]
FINANCIAL_0_TO_100 = ["Num_Credit_Card", "Num_Bank_Accounts", "Interest_Rate", "Num_of_Loan"]
FINANCIAL_NON_NEGATIVE = ["Delay_from_due_date", "Num_of_Delayed_Payment"]

# numeric columns in which the imputer treats a negative value as missing
IMPUTER_NON_NEGATIVE = [
    "Age",
    "Annual_Income",
    "Monthly_Inhand_Salary",
    "Num_Bank_Accounts",
    "Num_Credit_Card",
    "Num_of_Loan",
]

GOLD_FEATURES = [
    "Annual_Income",
    "Outstanding_Debt",
    "Credit_Utilization_Ratio",
    "Total_EMI_per_month",
    "Num_of_Delayed_Payment",
    "Debt_to_Income_Ratio",
    "EMI_Burden_Ratio",
    "Credit_Mix_encoded",
]

# never features: keys, targets and lineage
NON_FEATURES = ["Customer_ID", "snapshot_date", "loan_id", "label", "label_def", "target"]

# reporting order of the evaluation datasets
DATASET_ORDER = ["Training", "OOT1", "OOT2"]

# hyper-parameter grid of the random search (names follow the boosted-tree vocabulary)
SEARCH_GRID = {
    "n_estimators": [25, 50],
    "max_depth": [2, 3],
    "learning_rate": [0.01, 0.1],
    "subsample": [0.6, 0.8],
    "colsample_bytree": [0.6, 0.8],
    "gamma": [0, 0.1],
    "min_child_weight": [1, 3, 5],
    "reg_alpha": [0, 0.1, 1],
    "reg_lambda": [1, 1.5, 2],
}

# how each feature is imputed
IMPUTE_STRATEGIES = {
    "Age": "median",
    "Annual_Income": "iterative",
    "Monthly_Inhand_Salary": "iterative",
    "Outstanding_Debt": "median",
    "Total_EMI_per_month": "median",
    "Monthly_Balance": "median",
    "Debt_to_Income_Ratio": "median",
    "EMI_Burden_Ratio": "median",
    "Interest_Rate": "median",
    "Credit_Utilization_Ratio": "median",
    "Num_of_Loan": "median",
    "Num_Credit_Card": "median",
    "Num_Bank_Accounts": "median",
    "Num_of_Delayed_Payment": "median",
    "Delay_from_due_date": "median",
    "Credit_Mix_encoded": "most_frequent",
}

# --- parameters --------------------------------------------------------------


@dataclass(frozen=True)
class LabelRule:
    """A loan is bad when it is ``dpd`` or more days past due at ``mob`` months on book."""

    dpd: int = 30
    mob: int = 6

    @property
    def name(self) -> str:
        return f"{self.dpd}dpd_{self.mob}mob"


@dataclass(frozen=True)
class ImputeRule:
    numeric: str = "median"
    categorical: str = "most_frequent"
    knn_neighbors: int = 5
    max_iter: int = 10
    tol: float = 1e-3
    drop_above: float = 0.5
    keep_sparse: bool = False
    # default for a numeric column with no rule of its own, while fewer than this share is missing
    numeric_default_below_pct: float = 10.0
    per_feature: dict[str, str] = field(default_factory=lambda: dict(IMPUTE_STRATEGIES))


@dataclass(frozen=True)
class MonitorRule:
    psi_threshold: float = 0.1
    psi_bins: int = 10
    missing_alert_pct: float = 20.0
    missing_warning_pct: float = 10.0
    mean_shift_stds: float = 2.0
    drift_share: float = 0.2


DECISION_THRESHOLD = 0.7
NO_PROBABILITY_THRESHOLD = 0.5
TRAIN_RATIO = 0.8
FOLDS = 3
SEED = 42
BOOTSTRAP_ROWS = 10_000
