"""The check registry: each check is a row condition or a key that must be unique."""

from __future__ import annotations

from dataclasses import dataclass, replace

from tallywatch.config import HOME_CURRENCY, REQUIRED_FIELDS, VALID_CURRENCIES
from tallywatch.functions.columns import listed, lookup, missing

CRITICAL, WARNING = "critical", "warning"
TYPED_FIELDS = ("amount", "transaction_ts")


@dataclass(frozen=True)
class Check:
    """A threshold-gated check.

    ``condition`` is SQL text, true on affected rows; ``{now}`` in it stands for the
    run's point in time. A check without a condition affects all copies of a repeated
    ``transaction_id``. ``shows`` names the columns worth seeing on an affected row.
    """

    name: str
    severity: str
    threshold_pct: float
    condition: str | None = None
    shows: tuple[str, ...] = ()

    @property
    def dimension(self) -> str:
        return self.name.split(".")[0]

    def where(self, now: str) -> str:
        """The condition as a filter, left plain so that it can reach the scan."""
        return "is_duplicate" if self.condition is None else f"({self.condition.replace('{now}', now)})"

    def on_row(self, now: str) -> str:
        """True on affected rows and never NULL; repeated ids read ``is_duplicate``."""
        return f"coalesce({self.where(now)}, false)"


DEFAULT_CHECKS: tuple[Check, ...] = (
    Check("completeness.missing_customer_id", CRITICAL, 2.0, missing("customer_id"), ("customer_id",)),
    Check("completeness.missing_required_fields", CRITICAL, 1.0,
          " OR ".join(missing(f, f not in TYPED_FIELDS) for f in REQUIRED_FIELDS), REQUIRED_FIELDS[1:]),
    Check("uniqueness.duplicate_transaction_id", CRITICAL, 0.1),
    Check("validity.negative_or_zero_amount", CRITICAL, 1.0, "amount <= 0", ("amount",)),
    Check("validity.invalid_currency_code", WARNING, 0.5,
          f"upper(currency) NOT IN ({listed(VALID_CURRENCIES)}) OR currency <> upper(currency)", ("currency",)),
    Check("consistency.future_dated_transaction", CRITICAL, 0.3, "transaction_ts > {now}", ("transaction_ts",)),
    Check("consistency.currency_country_mismatch", WARNING, 1.0,
          f"currency <> {lookup(HOME_CURRENCY, 'country')}", ("currency", "country")),
)


def with_thresholds(checks: tuple[Check, ...], limits: dict[str, float]) -> tuple[Check, ...]:
    """The same checks with some thresholds replaced."""
    unknown = set(limits) - {c.name for c in checks}
    if unknown:
        raise KeyError(f"no such check: {sorted(unknown)}")
    return tuple(replace(c, threshold_pct=limits.get(c.name, c.threshold_pct)) for c in checks)


def by_name(name: str, checks: tuple[Check, ...] = DEFAULT_CHECKS) -> Check:
    return next(c for c in checks if c.name == name)


def where_any(checks: tuple[Check, ...], severity: str, now: str) -> str:
    """A filter for rows that fail a check of this severity."""
    return " OR ".join(c.where(now) for c in checks if c.severity == severity) or "false"


def fails_any(checks: tuple[Check, ...], severity: str, now: str) -> str:
    """Does the row by itself fail a check of this severity? Never NULL."""
    flags = [c.on_row(now) for c in checks if c.severity == severity and c.condition]
    return f"({' OR '.join(flags)})" if flags else "false"


def watches_copies(checks: tuple[Check, ...], severity: str) -> bool:
    return any(c.severity == severity and c.condition is None for c in checks)
