"""Settings of a run. The defaults describe the full training matrix; ``small()`` gives the same shape with little work,
for tests and for the registered queries that search a grid or train the whole matrix."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

# Column names, grids and constants that must equal the source system's.
SELECTED_FEATURES = (
    "Curricular units 2nd sem (approved)",
    "Curricular units 2nd sem (grade)",
    "Curricular units 2nd sem (evaluations)",
    "Curricular units 1st sem (approved)",
    "Curricular units 1st sem (grade)",
    "Curricular units 1st sem (evaluations)",
    "Tuition fees up to date",
    "Age at enrollment",
    "Mother's occupation",
    "Admission grade",
    "Previous qualification (grade)",
    "Gender",
    "Father's occupation",
    "Debtor",
    "Application order",
    "Daytime/evening attendance",
    "Previous qualification",
)
BINARISED = (
    "Father's occupation",
    "Mother's occupation",
    "Curricular units 2nd sem (evaluations)",
    "Curricular units 1st sem (evaluations)",
)
FOREST_GRID = {
    "n_estimators": (200, 400, 600),
    "max_depth": (None, 10, 20, 30),
    "min_samples_leaf": (1, 2, 4),
}
BOOST_GRID = {
    "n_estimators": (100, 200),
    "max_depth": (3, 6, 10),
    "learning_rate": (0.01, 0.1, 0.2),
    "subsample": (0.8, 1.0),
}


@dataclass(frozen=True)
class Settings:
    seed: int = 42
    test_size: float = 0.2
    folds: int = 3
    lr_max_iter: int = 1000
    lr_c: float = 1.0
    forest_trees: int = 300
    forest_max_depth: int = 30
    boost_rounds: int = 100
    boost_depth: int = 6
    boost_rate: float = 0.3
    forest_grid: dict = field(default_factory=lambda: dict(FOREST_GRID))
    boost_grid: dict = field(default_factory=lambda: dict(BOOST_GRID))
    features: tuple = SELECTED_FEATURES
    binarised: tuple = BINARISED
    # Projection trees that synthetic rows look for neighbours in, and rows of a leaf; 0 trees search exactly.
    smote_trees: int = 8
    smote_leaf_rows: int = 2_000
    target: str = "Target"
    row_id: str = "row_id"
    # The layout that forests see: partitions of ``tree_small_rows`` up to ``tree_partitions`` of them, then of ``tree_rows``.
    # Bagging draws depend on it, and on nothing of the session.
    tree_small_rows: int = 4_000
    tree_partitions: int = 64
    tree_rows: int = 200_000

    def small(self) -> "Settings":
        return replace(
            self,
            lr_max_iter=50,
            forest_trees=8,
            forest_max_depth=5,
            boost_rounds=2,
            boost_depth=3,
            forest_grid={"n_estimators": (4, 8), "max_depth": (3, 5)},
            boost_grid={"n_estimators": (1, 2), "max_depth": (2,)},
        )
