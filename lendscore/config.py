"""Settings: the pipeline's configuration and run tags.

Support code, not an operator.  The credit rule set is one config value
(:data:`CREDIT_RULES`); every operator is column-name generic.
"""

from __future__ import annotations

import json
import tomllib
from dataclasses import dataclass, field, fields
from typing import Any

ENVIRONMENTS = ("dev", "test", "prod")


@dataclass(frozen=True)
class ColumnRule:
    """Cleaning steps for one column, applied in this order:
    tokens -> null, category merges, fill of nulls."""
    column: str
    null_tokens: tuple[str, ...] = ()
    merge: dict[str, str] = field(default_factory=dict)
    fill: Any = None


@dataclass(frozen=True)
class EncodeRule:
    """Value map + cast into ``output`` (``output`` may equal ``column``)."""
    column: str
    output: str
    mapping: dict[Any, Any]
    dtype: str = "int"
    on_unknown: str = "error"      # "error" | "null" | "cast"


@dataclass(frozen=True)
class FeatureRules:
    columns: tuple[ColumnRule, ...] = ()
    encodings: tuple[EncodeRule, ...] = ()


@dataclass
class Settings:
    numerical_features: list[str]
    categorical_features: list[str]
    target: str
    primary_keys: list[str]
    catalog_name: str = "lendscore_dev"
    schema_name: str = "credit"
    hyperparameters: dict[str, Any] = field(default_factory=dict)
    experiment_name: str = "credit-basic"
    feature_table: str = "credit_features"
    model_name: str = "credit-model"
    seed: int = 42
    test_fraction: str = "0.2"
    n_folds: int = 5

    @classmethod
    def for_env(cls, env: str, **kw: Any) -> "Settings":
        if env not in ENVIRONMENTS:
            raise ValueError(f"unknown environment {env!r}; known: {', '.join(ENVIRONMENTS)}")
        kw.setdefault("catalog_name", f"lendscore_{env}")
        return cls(**kw)

    @property
    def model_features(self) -> list[str]:
        return [*self.numerical_features, *self.categorical_features]


@dataclass(frozen=True)
class Tags:
    git_sha: str
    branch: str
    run_id: str | None = None

    def to_dict(self) -> dict[str, str]:
        """The tags that are set, by name."""
        return {f.name: value for f in fields(self) if (value := getattr(self, f.name)) is not None}


# ---------------------------------------------------------------------------
# The credit data's cleaning and encoding rules.  These must
# equal the reference pipeline's for the feature table to match.
#   null token:        "NA" (Saving_accounts, Checking_account)
#   Saving_accounts:   "quite rich" -> "rich"
#   fill value:        "no account/unknown" (Saving_accounts, Checking_account)
#   Housing:           "free", "rent" -> "non-own"
#   Purpose:           "domestic appliances", "repairs", "vacation/others" -> "other"
#   Saving ordinal:    little 0, moderate 1, no account/unknown 2, rich 3
#   Checking ordinal:  little 0, moderate 1, rich 2, no account/unknown 3
#   Risk label:        good 0, bad 1
# ---------------------------------------------------------------------------
UNKNOWN_ACCOUNT = "no account/unknown"

CREDIT_RULES = FeatureRules(
    columns=(
        ColumnRule("Saving_accounts", null_tokens=("NA",),
                   merge={"quite rich": "rich"}, fill=UNKNOWN_ACCOUNT),
        ColumnRule("Checking_account", null_tokens=("NA",), fill=UNKNOWN_ACCOUNT),
        ColumnRule("Housing", merge={"free": "non-own", "rent": "non-own"}),
        ColumnRule("Purpose", merge={"domestic appliances": "other",
                                     "repairs": "other",
                                     "vacation/others": "other"}),
    ),
    encodings=(
        EncodeRule("Saving_accounts", "Saving_accounts_ordinal_enc",
                   {"little": 0, "moderate": 1, UNKNOWN_ACCOUNT: 2, "rich": 3}),
        EncodeRule("Checking_account", "Checking_account_ordinal_enc",
                   {"little": 0, "moderate": 1, "rich": 2, UNKNOWN_ACCOUNT: 3}),
        EncodeRule("Risk", "Risk", {"good": 0, "bad": 1}),
    ),
)

CREDIT_SETTINGS = dict(
    numerical_features=["Credit_amount", "Duration", "Age"],
    categorical_features=["Sex", "Job", "Housing", "Purpose",
                          "Saving_accounts_ordinal_enc", "Checking_account_ordinal_enc"],
    target="Risk",
    primary_keys=["CustomerId"],
    hyperparameters={"learning_rate": 0.01, "n_estimators": 100},
)


def settings_from_file(path: str, env: str = "dev") -> Settings:
    """Settings from a TOML or JSON file: fields of :class:`Settings` at the top, over
    which the table named like ``env`` wins.  An unknown name is an error."""
    with open(path, "rb") as f:
        values = json.load(f) if path.endswith(".json") else tomllib.load(f)
    own = values.get(env, {})
    merged = {k: v for k, v in values.items() if k not in ENVIRONMENTS} | own
    unknown = sorted(merged.keys() - {f.name for f in fields(Settings)})
    if unknown:
        raise ValueError(f"unknown settings in {path}: {', '.join(unknown)}")
    return Settings.for_env(env, **merged)


def credit_settings(env: str = "dev", **overrides: Any) -> Settings:
    kw = dict(CREDIT_SETTINGS)
    kw.update(overrides)
    return Settings.for_env(env, **kw)
