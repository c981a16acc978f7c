from __future__ import annotations

import pytest

from bazaarcube.plans.cubes import INVENTORY_CUBES, ORDER_CUBES, build_cube, specs_for
from bazaarcube.plans.lattice import build_cubes, open_cube, quarter_of, roll_up_plan, weight
from bazaarcube.session import new_folder
from tests.conftest import values


@pytest.mark.parametrize(("specs", "families", "from_base"), [(ORDER_CUBES, 12, 20), (INVENTORY_CUBES, 7, 10)])
def test_most_cubes_come_from_a_smaller_cube(specs, families, from_base):
    plans = roll_up_plan(specs)
    assert len(plans) == families
    steps = [(p, s, parent) for p in plans for s, parent in p.steps]
    assert sorted(s.name for _, s, _ in steps) == sorted(s.name for s in specs)
    assert sum(parent is None for _, _, parent in steps) <= from_base
    for plan, spec, parent in steps:
        assert set(spec.group) <= quarter_of(parent.group if parent else plan.base.group)
        if parent:
            assert parent.axes == spec.axes and weight(parent.group) >= weight(spec.group)
            # no finished cube that would do is smaller
            others = [s for s, _ in plan.steps if s.axes == spec.axes and set(spec.group) <= quarter_of(s.group) and s != spec]
            assert weight(parent.group) == min(weight(s.group) for s in others)


@pytest.mark.parametrize("subject", ["order", "inventory"])
@pytest.mark.parametrize("dims", [(0, 1, 2, 3), (1, 2)])
def test_stored_cubes_equal_direct_ones(spark, edge_star, subject, dims):
    """Rows without a day, customer, office or product, equal city names, all measures 0."""
    path = new_folder(spark, "cubes")
    names = build_cubes(edge_star, path, subject, dims)
    assert sorted(names) == sorted(s.name for s in specs_for(subject, dims))
    for spec in specs_for(subject, dims):
        if len(spec.group) != 3 or spec.dims == 3:  # some are enough
            assert values(open_cube(spark, path, spec)) == values(build_cube(edge_star, spec)), spec.name
