import random

import numpy as np

from rastertab.functions.numtext import _axis_values, box_edges, c_format, round_half_even, trimmed_text


def test_c_format_matches_python_on_ties_and_tiny_values():
    rng = random.Random(7)
    vals = [rng.uniform(-180, 180) for _ in range(2000)]
    vals += [round(rng.uniform(-180, 180), 8) for _ in range(2000)]
    vals += [rng.uniform(-1e-6, 1e-6) for _ in range(200)] + [0.0, -0.0, 126.94782185, 1e-5]
    assert c_format(vals) == ["%.10g" % v for v in vals]
    assert c_format([-0.0]) == ["-0"]
    assert c_format([-179.95]) == ["-179.95"]


def test_round_half_even_equals_numpy_round():
    rng = np.random.default_rng(3)
    v = rng.uniform(-180, 180, 20000)
    assert np.array_equal(round_half_even(v), np.round(v, 8))


def test_trimmed_text():
    assert trimmed_text([90.0, -179.75, 1e-8, 0.0]) == ["90", "-179.75", "0.00000001", "0"]


def test_separable_axis_values_equal_per_pixel_formula():
    gt = (110.0, 0.000833333333, 0.0, 10.0, 0.0, -0.000833333333)
    sep, gx, gy = _axis_values(gt, 3, 2, 17, 5, 256)
    assert sep
    xs = 3 * 256 + np.arange(17)
    ys = 2 * 256 + np.arange(5)
    mx, my = np.meshgrid(xs, ys)
    full_x = gt[0] + (mx + 0.5) * gt[1] + (my + 0.5) * gt[2]
    full_y = gt[3] + (mx + 0.5) * gt[4] + (my + 0.5) * gt[5]
    assert np.array_equal(np.tile(gx, 5), full_x.ravel())
    assert np.array_equal(np.repeat(gy, 17), full_y.ravel())


def test_box_clip_and_nan():
    lo_x, hi_x, lo_y, hi_y = box_edges(np.array([179.9, np.nan]), np.array([89.9, 0.0]), 0.5, -0.5)
    assert hi_x[0] == 180.0 and hi_y[0] == 90.0
    assert np.isnan(hi_x[1])
