from tierline.plans.checks import (
    CountCheck,
    DomainCheck,
    KeyCheck,
    OrphanCheck,
    PairCheck,
    ReconcileCheck,
    RowCheck,
    assert_checks,
    run_checks,
)
from tierline.plans.pipeline import build_clean, build_star, ingest_layer, register, run
from tierline.plans.stored import measure_load, run_stored_checks
from tierline.plans.suites import clean_suite, raw_suite, star_suite

__all__ = [
    "CountCheck",
    "DomainCheck",
    "KeyCheck",
    "OrphanCheck",
    "PairCheck",
    "ReconcileCheck",
    "RowCheck",
    "assert_checks",
    "build_clean",
    "build_star",
    "clean_suite",
    "ingest_layer",
    "measure_load",
    "raw_suite",
    "register",
    "run",
    "run_checks",
    "run_stored_checks",
    "star_suite",
]
