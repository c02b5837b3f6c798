"""p-value helpers against known critical values (pure Python)."""
import math

from churnspark.functions.stats import chi2_sf, gamma_q, ks_sf, norm_sf


def test_normal_tail():
    assert abs(2 * norm_sf(1.959963984540054) - 0.05) < 1e-12
    assert abs(norm_sf(0.0) - 0.5) < 1e-15


def test_chi2_critical_values():
    assert abs(chi2_sf(3.841458820694124, 1) - 0.05) < 1e-10
    assert abs(chi2_sf(5.991464547107979, 2) - 0.05) < 1e-10
    assert abs(chi2_sf(2 * 1.5, 2) - math.exp(-1.5)) < 1e-12      # 2 dof: exp(-x/2)
    assert abs(chi2_sf(23.209251158954356, 10) - 0.01) < 1e-9


def test_gamma_q_bounds():
    assert gamma_q(2.0, 0.0) == 1.0
    assert 0.0 < gamma_q(5.0, 30.0) < 1e-8


def test_ks_asymptotic():
    # lambda ~ 1.358 -> p ~ 0.05 for large samples
    assert abs(ks_sf(1.358 / math.sqrt(1e6), 1e6) - 0.05) < 2e-3
    assert ks_sf(0.0, 100) == 1.0
