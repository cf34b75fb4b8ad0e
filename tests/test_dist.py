import pytest

from tidewater.functions import dist


def test_tails_against_table_values():
    assert dist.norm_ppf(0.975) == pytest.approx(1.959963985, abs=1e-8)
    assert dist.t_ppf(0.975, 10) == pytest.approx(2.228138852, abs=1e-6)
    assert dist.chi2_sf(5.991464547, 2) == pytest.approx(0.05, abs=1e-9)
    assert dist.f_sf(3.4928, 2, 20) == pytest.approx(0.05, abs=1e-4)
    # studentised range critical values (published tables)
    assert dist.ptukey(3.877, 3, 10) == pytest.approx(0.95, abs=1e-3)
    assert dist.ptukey(4.232, 5, 20) == pytest.approx(0.95, abs=1e-3)
    assert dist.ptukey(4.646, 10, 60) == pytest.approx(0.95, abs=1e-3)
