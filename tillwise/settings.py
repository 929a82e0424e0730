"""Parameters of the named queries; every operator takes them as arguments."""

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Boosting:
    """How many trees to grow and how. Without a quantile the loss is the squared error.

    With patience, rows held out stop the growth after so many trees without gain, and the trees up to
    the least held-out error stay. Without patience they are trained on like all others.
    """

    trees: int
    depth: int
    rate: float
    row_share: float = 1.0
    column_share: float = 1.0
    patience: int | None = None
    quantile: float | None = None
    seed: int = 42


@dataclass(frozen=True)
class Settings:
    """Years, divisions and customer types of a store. The defaults fit the star-schema tables."""

    year: int = 1999
    next_year: int = 2000
    cold_group: list[int] = field(default_factory=lambda: [21, 11])
    flat_group: list[int] = field(default_factory=lambda: [24, 14])
    watched: list[int] = field(default_factory=lambda: [8, 18])
    spotlight: int = 9
    demo_division: int = 14
    bias_group: list[int] = field(default_factory=lambda: [24, 14, 22, 12])
    bias_weekday: str = "Thursday"
    customer_types: list[str] = field(
        default_factory=lambda: ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
    )
    seed: int = 42
    cluster_restarts: int = 10
    cluster_iterations: int = 300
    # fixed values: the sizes of the forecast models, and of those of the walk-forward log
    models: dict[str, Boosting] = field(
        default_factory=lambda: {
            "point": Boosting(500, 6, 0.05, row_share=0.8, column_share=0.8, patience=20),
            "lower": Boosting(400, 5, 0.05, quantile=0.15),
            "upper": Boosting(400, 5, 0.05, quantile=0.85),
        }
    )
    log_models: dict[str, Boosting] = field(
        default_factory=lambda: {
            "point": Boosting(150, 5, 0.1, row_share=0.8, column_share=0.8),
            "lower": Boosting(100, 4, 0.1, quantile=0.15),
            "upper": Boosting(100, 4, 0.1, quantile=0.85),
        }
    )
    refit_weeks: int = 26


# A fashion store with two-digit division codes, where 2x is women's and 3x is men's wear.
FASHION_STORE = Settings(
    year=2024,
    next_year=2025,
    cold_group=[21, 31],
    flat_group=[24, 34],
    watched=[28, 38],
    spotlight=29,
    demo_division=34,
    bias_group=[24, 34, 22, 32],
    customer_types=["casual", "loyalty", "tourist"],
)
