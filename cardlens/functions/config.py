"""Parameters of the feature plans.

``reference()`` carries the real card-log values; ``events_fixture()`` maps the
same roles onto the synthetic ``events`` table (see FIXTURES.md).
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field, fields, replace

from cardlens.functions import constants as K


@dataclass(frozen=True)
class DivisibleBy:
    """Code list as a rule: codes that one of the divisors divides."""
    divisors: tuple

    def __call__(self, code):
        out = code % self.divisors[0] == 0
        for d in self.divisors[1:]:
            out = out | (code % d == 0)
        return out


def codes_to_json(codes):
    """A code list or a ``DivisibleBy`` rule; any other predicate cannot be saved."""
    if isinstance(codes, DivisibleBy):
        return {"divisible_by": list(codes.divisors)}
    if callable(codes):
        raise ValueError("a saved configuration needs a list of codes or DivisibleBy")
    return list(codes)


def codes_from_json(codes):
    return DivisibleBy(tuple(codes["divisible_by"])) if isinstance(codes, dict) else tuple(codes)


@dataclass(frozen=True)
class FeatureConfig:
    pos_category: str = K.POS_CATEGORY
    income_categories: tuple = tuple(K.IN_OPERATIONS)
    bad_mcc: object = tuple(K.BAD_MCC_CODES)     # a list of codes, or a predicate on the code column
    holidays: tuple = tuple(K.HOLIDAYS)
    base_year: int = K.BASE_YEAR
    days_since: str = K.DAYS_SINCE_DATE
    max_day_number: int = K.MAX_DAY_NUMBER
    period_parts: tuple = tuple(K.PERIOD_PARTS)
    max_period_day: int = K.MAX_PERIOD_DAY
    max_transaction_day: int = K.MAX_TRANSACTION_DAY
    relative_months: tuple = tuple(K.RELATIVE_MONTHS)
    recency_days: tuple = tuple(K.RECENCY_DAYS)
    month_state_threshold: float = K.MONTH_STATE_THRESHOLD
    round_divisors: tuple = tuple(K.ROUND_DIVISORS)
    weekdays: tuple = tuple(K.WEEKDAYS)
    currencies: tuple = tuple(K.CURRENCIES)
    extra: dict = field(default_factory=dict)

    def with_(self, **kw) -> "FeatureConfig":
        return replace(self, **kw)

    def to_json(self) -> str:
        return json.dumps({**asdict(self.with_(bad_mcc=())), "bad_mcc": codes_to_json(self.bad_mcc)})

    @classmethod
    def from_json(cls, text: str) -> "FeatureConfig":
        d = json.loads(text)
        tuples = {f.name for f in fields(cls) if isinstance(f.default, tuple)}
        return cls(**{k: codes_from_json(v) if k == "bad_mcc" else tuple(v) if k in tuples else v for k, v in d.items()})


def reference() -> FeatureConfig:
    return FeatureConfig()


def events_fixture() -> FeatureConfig:
    """Stand-ins on ``tx_e``: POS -> purchase, income -> signup,
    bad MCC -> every code divisible by 7 (a predicate, so it covers any code)."""
    return FeatureConfig(
        pos_category="purchase",
        income_categories=("signup",),
        bad_mcc=DivisibleBy((7,)),
        base_year=2024,
        holidays=("2024-01-01", "2024-01-06", "2024-01-07", "2024-01-13", "2024-01-14"),
    )


def orders_fixture() -> FeatureConfig:
    """Stand-ins on ``tx_o``: multi-year orders, base year 1995."""
    return FeatureConfig(pos_category="1-URGENT", income_categories=("5-LOW",), bad_mcc=(), base_year=1995)
