"""Plain SQL with the same answers, for comparison by DuckDB."""

from oracles.customers import MEASURES, RANKINGS, REPORT, RFM, STATS
from oracles.regression import REGRESSION
from oracles.sales import OVERVIEW, QUALITY, TRENDS

ORACLES: dict[str, str] = {
    **QUALITY, **OVERVIEW, **TRENDS, **RFM, **RANKINGS, **STATS, **MEASURES, **REPORT,
    **REGRESSION}
