import tracemalloc

import numpy as np

from opinio.operators.cells import CODE_BITS, Fit


def test_a_plan_of_many_queries_is_made_some_at_a_time():
    rng = np.random.default_rng(1)
    unit = rng.normal(size=(3000, 16))
    codes = rng.integers(0, 256, (20_000, CODE_BITS // 8), np.uint8)
    fit = Fit(rng.normal(size=(100, 16)), np.full(100, 200), codes)
    tracemalloc.start()
    reads, most = fit.plan(unit, 0.5, 0.2)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100 << 20  # the whole would be 480 MB for each table of distances
    one, bits = fit.plan(unit[1000:1001], 0.5, 0.2)
    assert (reads[1000] == one[0]).all() and most[1000] == bits[0]
