"""One filter grammar for all reports."""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ALL = "All"
SEPARATOR = "|||"
METHODS = ("is", "contains", "does_not_contain")


@dataclass(frozen=True)
class Tokens:
    """Texts joined by SEPARATOR; blank ones are ignored, and % and _ are wildcards for the two contains methods."""

    text: str = ""
    method: str = "contains"

    def test(self, column: str) -> Column | None:
        if not self.text.strip(" "):
            return None
        if self.method not in METHODS:
            raise ValueError(f"unknown match method {self.method!r}")
        tokens = [t.strip(" ").lower() for t in self.text.split(SEPARATOR) if t.strip(" ")]
        value = F.lower(F.coalesce(F.col(column), F.lit("")))
        if self.method == "is":
            return value.isin(tokens) if tokens else F.lit(False)
        found = F.lit(False)
        for token in tokens:
            found = found | value.like(f"%{token}%")
        return found if self.method == "contains" else ~found


@dataclass(frozen=True)
class FilterSpec:
    """What the reader of a report has chosen; every field has a value that filters nothing."""

    start: date | None = None
    end: date | None = None
    search_term: str = ALL
    job_level: str = ALL
    degree_requirement: str = ALL
    search_location: str = ALL
    job_platform: str = ALL
    listing_status: str = ALL
    states: tuple[str, ...] = (ALL,)
    job_title: Tokens = field(default_factory=Tokens)
    company_name: Tokens = field(default_factory=Tokens)
    location_like: bool = False

    def but(self, **changes: object) -> FilterSpec:
        return replace(self, **changes)


CHOICES = ("search_term", "job_level", "degree_requirement", "search_location", "job_platform", "listing_status")


def tests(spec: FilterSpec, day: str | Column | None = "posted_date", only: tuple[str, ...] = CHOICES, states: bool = True, tokens: bool = True) -> list[Column]:
    """The conditions a specification stands for; nothing is tested that filters nothing."""
    found: list[Column] = []
    if day is not None:
        when = F.col(day) if isinstance(day, str) else day
        if spec.start and spec.end:
            found.append(when.between(F.lit(spec.start), F.lit(spec.end)))
        elif spec.start or spec.end:
            found.append(when >= F.lit(spec.start) if spec.start else when <= F.lit(spec.end))
    for name in only:
        value = getattr(spec, name)
        if value != ALL:
            loose = name == "search_location" and spec.location_like
            found.append(F.col(name).like(f"%{value}%") if loose else F.col(name) == value)
    if states and ALL not in spec.states:
        found.append(F.col("state_name").isin(*spec.states))
    if tokens:
        found += [t for t in (spec.job_title.test("job_title"), spec.company_name.test("company_name")) if t is not None]
    return found


def apply_filters(df: DataFrame, spec: FilterSpec, **how: object) -> DataFrame:
    for test in tests(spec, **how):
        df = df.where(test)
    return df
