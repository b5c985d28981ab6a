"""Raw pages to a typed staging folder, one date at a time."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import date as Date
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.checks import Rule, check_together, evaluate
from millrace.session import write_once
from millrace.sinks.tables import replace_folder, save_table
from millrace.sources.files import SALES_SCHEMA, read_json_pages


def check_date(date: str) -> str:
    if not date:
        raise ValueError("a date is needed to stage one day of sales")
    try:
        parsed = datetime.strptime(date, "%Y-%m-%d")
    except ValueError:
        raise ValueError(f"date must be YYYY-MM-DD, not {date!r}") from None
    return parsed.strftime("%Y-%m-%d")


def stage_sales(
    spark: SparkSession, raw_dir: str, stg_dir: str, date: str, schema: str = SALES_SCHEMA, format: str = "avro",
    pattern: str = "*.json",
) -> None:
    """Stage the pages of one date; staging the date again replaces that date and no other.

    ``raw_dir`` holds the date's JSON pages; the staged rows go to the partition ``date=<date>`` of
    ``stg_dir``. Records that do not fit the schema fail the run. The default format needs Spark's Avro
    package on the class path.
    """
    date = check_date(date)
    if not raw_dir or not stg_dir:
        raise ValueError("raw_dir and stg_dir are required")
    pages = read_json_pages(spark, raw_dir, schema, pattern)
    complete = pages.select(*[
        F.coalesce(c, F.raise_error(F.lit(f"a record has no {c}")).cast(pages.schema[c].dataType)).alias(c)
        for c in pages.columns
    ])
    # The whole folder of the date is replaced, so a date without rows leaves none behind.
    replace_folder(complete, f"{stg_dir.rstrip('/')}/date={date}", format)


def catch_up(start: str, end: str) -> list[str]:
    """The dates from start to end, both included, that a scheduled run would stage."""
    first, last = Date.fromisoformat(check_date(start)), Date.fromisoformat(check_date(end))
    return [(first + timedelta(days=i)).isoformat() for i in range((last - first).days + 1)]


Check = Callable[[DataFrame], DataFrame]


def build_and_check(
    df: DataFrame, name: str, checks: Sequence[tuple[str, Check]], fail_fast: bool = True, path: str | None = None,
    rules: Mapping[str, Rule] | None = None,
) -> dict[str, tuple[str, int]]:
    """Compute a model once, check the rows that were written, and publish these only if all checks pass.

    ``rules`` are checked first and together: one scan for all on rows, one for each set of grouping columns.
    """
    written = write_once(df)
    try:
        results = check_together(written.rows, rules or {})
        for label, check in checks:
            if fail_fast and any(status == "error" for status, _ in results.values()):
                break
            results[label] = evaluate(check(written.rows))
        failed = {k: v for k, v in results.items() if v[0] == "error"}
        if failed:
            raise ValueError(f"{name} not written; failing checks: {failed}")
        save_table(written.rows, name, path=path)
        return results
    finally:
        written.delete()
