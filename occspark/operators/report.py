"""Text reports, rendered on the driver from small result tables."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame

from .summaries import filter_report, group_summary, year_summary

WIDTH = 72


def _title(text: str) -> list[str]:
    return [text, "=" * len(text)]


def _section(text: str) -> list[str]:
    return ["", text, "-" * len(text)]


def filter_text(n_raw: int, filtered: DataFrame, dataset: str, config: dict[str, object], top: int = 10) -> str:
    """The report of a filter run: settings, totals, ranges, commonest and all names, counts by group."""
    f = filter_report(n_raw, filtered).first()
    lines = [*_title(f"{dataset}: filtering summary"), *_section("Settings"), *(f"{k}: {v}" for k, v in config.items()), *_section("Totals")]
    lines += [f"Raw records: {n_raw}", f"Filtered records: {f['n_filtered']} ({f['pct_kept']:.2f}%)", f"Distinct names: {f['n_names']}", f"Distinct taxon keys: {f['n_taxon_keys']}"]
    if not f["n_filtered"]:
        return "\n".join([*lines, "", "No records left after filtering."]) + "\n"
    lines += [f"Years: {f['year_min']}-{f['year_max']}", f"Latitude: {f['decimalLatitude_min']:.4f} to {f['decimalLatitude_max']:.4f}", f"Longitude: {f['decimalLongitude_min']:.4f} to {f['decimalLongitude_max']:.4f}", f"Countries: {f['n_countries']}"]
    names = group_summary(filtered, "scientificName").collect()
    for title, rows in (("Basis of record", group_summary(filtered, "basisOfRecord").collect()), (f"Top {top} names", names[:top]), ("Records per country", group_summary(filtered, "countryCode").collect()), ("Records per year", year_summary(filtered).collect()), ("All names", names)):
        lines += [*_section(title), *(f"{r[0]}: {r[1]} ({100 * r[1] / f['n_filtered']:.2f}%)" for r in rows)]
    return "\n".join(lines) + "\n"


def profile_text(profile: DataFrame, dataset: str) -> str:
    """A schema profile by column groups."""
    rows = profile.orderBy("ord").collect()
    lines = _title(f"{dataset}: schema summary")
    for kind in dict.fromkeys(r["logical_type"] for r in rows):
        lines += _section(kind)
        for r in (r for r in rows if r["logical_type"] == kind):
            lines += [f"{r['column']} ({r['role']}, {r['dtype']})", f"  non-null {r['non_null']}, missing {r['missing']} ({r['missing_pct']:.2f}%), distinct {r['unique_values']}, flags {r['warning_flags']}"]
            if r["numeric_min"] is not None:
                lines.append(f"  min {r['numeric_min']}, max {r['numeric_max']}, mean {r['numeric_mean']}, median {r['numeric_median']}")
            if r["date_like_valid_values"] is not None:
                lines.append(f"  dates {r['date_like_valid_values']} ({r['date_like_valid_pct']:.2f}%)")
    return "\n".join(lines) + "\n"


def readiness_text(report: DataFrame, dataset: str) -> str:
    """A readiness report by sections; checks that did not pass carry their status."""
    lines, section = _title(f"{dataset}: spatial readiness"), None
    for r in report.orderBy("ord").collect():
        if r["section"] != section:
            section = r["section"]
            lines += _section(section.replace("_", " ").title())
        mark = f" [{r['status']}]" if r["status"] in ("WARNING", "FAIL") else ""
        lines.append(f"{r['metric'].replace('_', ' ')}: {r['value']}{mark}")
        if r["notes"]:
            lines.append(f"  {r['notes']}")
    return "\n".join([*lines, *_section("Reading the report"), "PASS: no issue. WARNING: review before use. FAIL: joins to sites would be wrong or impossible."]) + "\n"


def table_text(title: str, *tables: tuple[str, DataFrame]) -> str:
    """Result tables under a title, all their rows: study area, grid, autocorrelation and validation summaries."""
    lines = _title(title)
    for name, df in tables:
        rows = list(df.toLocalIterator())
        lines += _section(name)
        lines += [f"{k}: {v}" for k, v in rows[0].asDict().items()] if len(rows) == 1 else [", ".join(f"{k}={v}" for k, v in r.asDict().items()) for r in rows]
    return "\n".join(lines) + "\n"


def write_text(text: str, path: str) -> None:
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(text, encoding="utf-8")
