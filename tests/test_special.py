import numpy as np
import pytest

from statwright.functions import special as s


@pytest.mark.parametrize("got, want", [
    (s.t_ppf(0.975, 10), 2.2281388520), (s.t_ppf(0.025, 10), -2.2281388520), (s.t_two_sided(2.0, 5), 0.1019394788),
    (s.chi2_ppf(0.95, 5), 11.0704976935), (s.chi2_sf(3.0, 2), 0.2231301601), (s.f_sf(4.0, 2, 10), 0.0529221494),
    (s.norm_ppf(0.975), 1.9599639845), (s.norm_sf(1.0), 0.1586552539), (s.beta_i(2, 3, 0.4), 0.5248),
])
def test_known_values(got, want):
    assert got == pytest.approx(want, rel=1e-8)


def test_studentized_range():
    assert s.studentized_range_sf(3.578, 3, 20) == pytest.approx(0.05, abs=2e-4)
    assert s.studentized_range_sf(3.314, 3, 1e9) == pytest.approx(0.05, abs=2e-4)


def test_shapiro_wilk():
    w, p = s.shapiro_wilk(np.array([148, 154, 158, 160, 161, 162, 166, 170, 182, 195, 236]))
    assert w == pytest.approx(0.7888, abs=1e-4) and p == pytest.approx(0.006704, abs=1e-5)
    w, p = s.shapiro_wilk(np.random.default_rng(0).normal(size=400))
    assert w > 0.99 and p > 0.05


def test_k_squared_accepts_normal_and_rejects_skewed():
    rng = np.random.default_rng(1)

    def test(x):
        z = (x - x.mean()) / x.std()
        return s.dagostino_k2(len(x), (z ** 3).mean(), (z ** 4).mean() - 3)[1]
    assert test(rng.normal(size=6000)) > 0.01
    assert test(rng.exponential(size=6000)) < 1e-9


def test_kolmogorov_tail():
    assert s.kolmogorov_sf(1.3581 / np.sqrt(10_000), 10_000) == pytest.approx(0.05, abs=5e-4)
