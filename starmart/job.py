"""The whole job: load, validate, clean up, profile and dump.

A validation that fails is reported and the others still run; the load itself
is one commit (``starmart.load``), and what follows only reads it.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import SparkSession

from starmart.load import LoadReport, run_load
from starmart.plans import quality
from starmart.sinks import export
from starmart.sinks.warehouse import Warehouse
from starmart.sources.raw import RawSources


@dataclass
class JobReport:
    load: LoadReport
    validations: dict[str, list[dict]] = field(default_factory=dict)
    errors: dict[str, str] = field(default_factory=dict)
    profile: list[dict] = field(default_factory=list)
    dump: list[str] = field(default_factory=list)


def validate(wh: Warehouse, report: JobReport) -> None:
    """The three reconciliations, each by itself: rows by name, or what went wrong."""
    checks = {
        "validate_counts": lambda: quality.validate_counts(wh.read_clean(), wh.read_star()),
        "validate_null_keys": lambda: quality.validate_null_keys(wh.read_star()),
        "validate_price_sum": lambda: quality.validate_price_sum(wh.read_clean(), wh.read_star()),
    }
    for name, check in checks.items():
        try:
            report.validations[name] = [r.asDict() for r in check().collect()]
        except (PySparkException, Py4JError, OSError, KeyError) as e:
            report.errors[name] = f"{type(e).__name__}: {e}"[:500]


def run_job(
    spark: SparkSession,
    raw: RawSources,
    root: str,
    profile_dir: str | None = None,
    dump_dir: str | None = None,
    keep_intermediate: bool = False,
    **load_options,
) -> JobReport:
    """Load, then validate against the clean layer, drop it, and write profile and dump where asked."""
    report = JobReport(run_load(spark, raw, root, keep_intermediate=True, **load_options))
    wh = Warehouse(spark, root)
    validate(wh, report)
    if not keep_intermediate:
        wh.drop_intermediates()
    if profile_dir:
        report.profile = [r.asDict() for r in export.write_profile(spark, wh, profile_dir).collect()]
    if dump_dir:
        report.dump = export.write_dump(wh, dump_dir)
    return report
