"""Months, services and the raw paths built from them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values: services of the source, and the raw layout ----------------
SERVICES = ("yellow", "green", "fhv", "fhvhv")
RAW_PREFIX = "raw/tlc"
# ---------------------------------------------------------------------------


class BadMonth(ValueError):
    """Text that does not name a month."""


class BadService(ValueError):
    """A service the source does not have."""


@dataclass(frozen=True, order=True)
class Month:
    """A calendar month; its text form is ``YYYY-MM``."""

    year: int
    number: int

    @classmethod
    def of(cls, text: str) -> Month:
        year, dash, number = text.partition("-") if isinstance(text, str) else ("", "", "")
        digits = (year + number).isascii() and (year + number).isdigit()
        if dash and digits and len(year) == 4 and len(number) == 2 and 1 <= int(number) <= 12:
            return cls(int(year), int(number))
        raise BadMonth(f"expected a month such as 2024-01, got {text!r}")

    def __str__(self) -> str:
        return f"{self.year:04d}-{self.number:02d}"

    def next(self) -> Month:
        return Month(self.year + self.number // 12, self.number % 12 + 1)


def month_text(text: str) -> str:
    """``text`` itself if it names a month, else ``BadMonth``."""
    return str(Month.of(text))


def month_range(first: str, last: str) -> list[str]:
    """All months from ``first`` to ``last`` inclusive (driver-side, for paths)."""
    now, end = Month.of(first), Month.of(last)
    out = []
    while now <= end:
        out.append(str(now))
        now = now.next()
    return out


def service_name(name: str) -> str:
    if name in SERVICES:
        return name
    raise BadService(f"no service called {name!r} (there are {', '.join(SERVICES)})")


def raw_root(lake_root: str, service: str) -> str:
    return f"{lake_root.rstrip('/')}/{RAW_PREFIX}/{service_name(service)}"


def raw_folder(lake_root: str, service: str, month: str) -> str:
    """A month landed as a partition folder of many files."""
    return f"{raw_root(lake_root, service)}/mes={month_text(month)}"


def raw_object(lake_root: str, service: str, month: str) -> str:
    """A month landed as the source publishes it, one object."""
    return f"{raw_root(lake_root, service)}/{month_text(month)}.parquet"


def file_month(path: Column | None = None) -> Column:
    """The month named by the path of a row's file, in either raw layout."""
    path = F.col("_metadata.file_path") if path is None else path
    return F.regexp_extract(path, r".*/(?:mes=)?(\d{4}-\d{2})(?:/|[.]parquet)", 1)
