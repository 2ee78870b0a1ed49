"""Every registered query with its oracle."""

from __future__ import annotations

from tarn.plans import cases_landing, cases_media, cases_search, cases_text

ALL = {**cases_landing.CASES, **cases_text.CASES, **cases_media.CASES, **cases_search.CASES}
