"""Writing leads as delimited text, with the summary of what was written."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame

from firmscout.operators.filters import by_score
from firmscout.operators.joins import ORDER, stage
from firmscout.operators.profile import sector_counts
from firmscout.operators.quality import REASON
from firmscout.plans.leads import LEAD_COLUMNS, LeadRun


@dataclass(frozen=True)
class Summary:
    written: int
    sectors: DataFrame
    rejected: int = 0


def write_delimited(df: DataFrame, path: str, *, delimiter: str = ",", encoding: str = "UTF-8") -> None:
    """Header, quotes doubled, missing values empty, white space kept. One file per partition."""
    df.write.mode("overwrite").options(
        header=True,
        sep=delimiter,
        quote='"',
        escape='"',
        emptyValue="",
        nullValue="",
        encoding=encoding,
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    ).csv(path)


def export_leads(leads: DataFrame, path: str, *, single_file: bool = False, staged: bool = False) -> Summary:
    """Write leads (with ``_ord``) sorted by score; part files in name order are the sorted table.

    ``single_file`` is for small results. The leads are staged, so that writing,
    counting and the sector summary do not compute them three times, unless they are ``staged`` already.
    """
    leads = leads if staged else stage(leads)
    ordered = by_score(leads).select(*LEAD_COLUMNS)
    write_delimited(ordered.coalesce(1) if single_file else ordered, path)
    return Summary(leads.count(), sector_counts(leads))


def export_run(run: LeadRun, path: str, rejected_path: str | None = None, *, single_file: bool = False) -> Summary:
    """Write the leads of a run, and the rejected rows with their reasons in file order next to them.

    ``rejected_path`` is ``path`` with ``-rejected`` unless given.
    """
    rejected = run.rejected if run.staged else stage(run.rejected)
    write_delimited(rejected.orderBy(ORDER).select(*LEAD_COLUMNS, REASON), rejected_path or f"{path.rstrip('/')}-rejected")
    summary = export_leads(run.leads, path, single_file=single_file, staged=run.staged)
    return replace(summary, rejected=rejected.count())


def dry_run(leads: DataFrame) -> int:
    """How many leads a run would write."""
    return leads.count()
