from datetime import date

import pytest

from care_measures.functions.periods import Period, add_months


@pytest.mark.parametrize("as_of, start, end", [
    (date(2024, 1, 1), date(2023, 12, 1), date(2023, 12, 31)),
    (date(2024, 2, 29), date(2024, 1, 1), date(2024, 1, 31)),
    (date(2024, 3, 31), date(2024, 2, 1), date(2024, 2, 29)),
    (date(2023, 3, 15), date(2023, 2, 1), date(2023, 2, 28)),
])
def test_previous_month(as_of, start, end):
    p = Period.previous_month(as_of)
    assert (p.start, p.end) == (start, end)


def test_lookback_anchor_and_clamping():
    p = Period.previous_month(date(2024, 3, 5))
    assert p.lookback(years=1) == date(2023, 2, 1)
    assert p.lookback(years=1, anchor="end") == date(2023, 2, 28)
    assert p.lookback(months=4) == date(2023, 10, 1)
    assert p.year_start() == date(2024, 1, 1)
    with pytest.raises(ValueError):
        p.lookback(years=1, anchor="middle")


def test_prior_month_forms():
    p = Period.previous_month(date(2023, 3, 5))
    assert p.prior_month().end == date(2023, 1, 31)
    assert p.prior_month(end="clamped").end == date(2023, 1, 28)
    assert p.prior_month().start == date(2023, 1, 1)


def test_add_months_crosses_years():
    assert add_months(date(2024, 1, 31), -11) == date(2023, 2, 28)
    assert add_months(date(2023, 12, 31), 2) == date(2024, 2, 29)
