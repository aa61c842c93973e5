"""coverlens: price and coverage analytics over a catalogue x location grid, on Spark.

Every operator takes DataFrames and returns a DataFrame built from Spark
built-ins (joins, aggregates, windows, higher-order functions).  Nothing is
collected to the driver; ordered operators never put a whole group in one task.
"""

from coverlens.operators.coverage import no_favorable, pair_coverage, pair_coverage_by_source
from coverlens.operators.matching import match_codes
from coverlens.operators.ordered import running_scan
from coverlens.operators.responses import extract_prices
from coverlens.plans.collection import analyze_prices, enrich_catalog, parse_failures, plan_requests
from coverlens.session import build_session, work_dir

__all__ = [
    "analyze_prices", "build_session", "enrich_catalog", "extract_prices", "match_codes", "no_favorable",
    "pair_coverage", "pair_coverage_by_source", "parse_failures", "plan_requests", "running_scan", "work_dir",
]
