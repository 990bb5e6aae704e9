"""Registered queries with their equivalent SQL."""

from __future__ import annotations

from ledgersync.checks.harness import Query


def registered() -> dict[str, Query]:
    from ledgersync.checks.change_checks import changes
    from ledgersync.checks.operator_checks import operators
    from ledgersync.checks.plan_checks import plans

    return {**operators.items, **plans.items, **changes.items}
