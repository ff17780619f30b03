"""Model governance: every model is documented and covered by a declared test."""

from __future__ import annotations

from ledgerlake.operators.quality import declared_checks
from ledgerlake.operators.staging import STAGING_SPECS
from ledgerlake.plans.dashboards import DASHBOARDS
from ledgerlake.plans.models import MARTS, SHARED, STAGING, build_order
from ledgerlake.plans.pipeline import MODEL_DOCS


def test_every_model_has_a_docstring():
    for name, (_, builder) in STAGING.items():
        assert builder.__doc__, name
    for name, (builder, _) in MARTS.items():
        assert builder.__doc__ and len(builder.__doc__.strip()) > 20, name
    for name, (builder, _) in DASHBOARDS.items():
        assert builder.__doc__, name


def test_every_model_has_at_least_one_test():
    tested = {c.model for c in declared_checks()}
    for name in list(STAGING) + list(MARTS) + ["model_catalog"]:
        assert name in tested, f"{name} has no declared test"


def test_every_mart_is_described_in_the_catalog():
    assert set(MARTS) | {"model_catalog"} == set(MODEL_DOCS)
    assert all(len(text) > 15 for text in MODEL_DOCS.values()), MODEL_DOCS


def test_build_order_respects_dependencies():
    order = build_order()
    for name, (_, deps) in MARTS.items():
        assert all(d in SHARED or order.index(d) < order.index(name) for d in deps), name
    assert set(order) == set(STAGING_SPECS) | set(MARTS)


def test_command_line_requires_a_source():
    import pytest

    from ledgerlake.__main__ import main
    with pytest.raises(SystemExit) as err:
        main([])
    assert err.value.code == 2
