import numpy as np
from conftest import rows
from hypothesis import given, settings
from hypothesis import strategies as st

from foliar.operators.resample import resample_long, resample_packed, spline_at


@given(
    st.lists(st.floats(0.5, 9.0), min_size=3, max_size=40),
    st.tuples(*[st.floats(-3, 3)] * 4),
)
@settings(max_examples=60, deadline=None)
def test_reproduces_a_cubic(steps, c):
    x = 400 + np.cumsum([0.0, *steps])
    u = (x - x.mean()) / (x[-1] - x[0])
    poly = np.polynomial.Polynomial(c)
    out = np.linspace(x[0], x[-1], 50)
    got = spline_at(x, poly(u), out)
    assert np.allclose(got, poly((out - x.mean()) / (x[-1] - x[0])), atol=1e-8)


def test_few_points():
    assert spline_at(np.array([1.0]), np.array([5.0]), np.array([1.0])).tolist() == [5.0]
    assert spline_at(np.array([1.0, 3.0]), np.array([1.0, 5.0]), np.array([2.0])).tolist() == [3.0]
    x = np.array([0.0, 1.0, 3.0])
    assert np.allclose(spline_at(x, x**2, np.array([2.0, 0.5])), [4.0, 0.25])


def test_interpolates_and_is_smooth():
    x = np.array([0.0, 1, 2, 3, 5, 6, 8])
    y = np.sin(x)
    assert np.allclose(spline_at(x, y, x), y)
    e = 1e-5
    for k in (2.0, 3.0, 5.0):
        left, mid, right = spline_at(x, y, np.array([k - e, k, k + e]))
        assert abs((right - mid) - (mid - left)) < 1e-9


def test_grid_of_long_spectra(spark):
    pts = [("s", w, 2 * w) for w in (350.4, 351.7, 353.2, 354.9, 355.0)]
    pts += [("s", 355.0, 2 * 355.0), ("s", 352.0, None), ("short", 10.2, 1.0)]
    df = spark.createDataFrame(pts, "id string, wavelength double, spectravalue double")
    out = rows(resample_long(df, ["id"], "reflectance"))
    assert [(i, k, w, round(v, 9)) for i, k, w, v in out] == [
        ("s", "reflectance", float(w), 2.0 * w) for w in range(351, 356)
    ]


def test_mixed_lengths_in_one_batch(spark):
    data = [(i, [float(x) for x in range(0, 2 * n, 2)], [float(x) ** 2 for x in range(0, 2 * n, 2)]) for i, n in enumerate([5, 4, 5, 2, 1, 3])]
    df = spark.createDataFrame(data, "id int, wavelengths array<double>, v array<double>").coalesce(1)
    out = resample_packed(df, ["id"], {"r": "v"})
    got = {(r.id, r.wavelength): r.spectravalue for r in out.collect()}
    for i, n in enumerate([5, 4, 5, 2, 1, 3]):
        for w in range(0, 2 * n - 1):
            want = 2.0 * w if n == 2 else float(w) ** 2
            assert abs(got[(i, float(w))] - want) < 1e-9
