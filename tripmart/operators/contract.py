"""Column contracts: which raw columns enter silver, under which name and type.

Resolution is metadata work on the driver (column names only); the typed
projection it yields is one ``select`` that Catalyst prunes into the scan.
Casts are ``try_cast``: a value that does not fit becomes null and the job goes
on, and the nulls each cast created are counted, never hidden.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

# Name of the column that carries the month of the source file when a raw
# DataFrame spans several files (fixtures, backfills). Never a contract column.
FILE_MONTH = "mes_archivo"


# --- Fixed values (must equal the reference's data model) -------------------
# Per service: raw name, silver name, silver type; in this order.
CONTRACTS: dict[str, tuple[tuple[str, str, str], ...]] = {
    "yellow": (
        ("VendorID", "vendor_id", "int"),
        ("tpep_pickup_datetime", "pickup_datetime", "timestamp_ntz"),
        ("tpep_dropoff_datetime", "dropoff_datetime", "timestamp_ntz"),
        ("passenger_count", "passenger_count", "int"),
        ("trip_distance", "trip_distance", "double"),
        ("RatecodeID", "ratecode_id", "int"),
        ("store_and_fwd_flag", "store_and_fwd_flag", "string"),
        ("PULocationID", "pu_location_id", "int"),
        ("DOLocationID", "do_location_id", "int"),
        ("payment_type", "payment_type", "int"),
        ("fare_amount", "fare_amount", "decimal(10,2)"),
        ("extra", "extra", "decimal(10,2)"),
        ("mta_tax", "mta_tax", "decimal(10,2)"),
        ("tip_amount", "tip_amount", "decimal(10,2)"),
        ("tolls_amount", "tolls_amount", "decimal(10,2)"),
        ("improvement_surcharge", "improvement_surcharge", "decimal(10,2)"),
        ("total_amount", "total_amount", "decimal(10,2)"),
        ("congestion_surcharge", "congestion_surcharge", "decimal(10,2)"),
        ("Airport_fee", "airport_fee", "decimal(10,2)"),
    ),
}
# ---------------------------------------------------------------------------


class ContractError(ValueError):
    """A service without a contract, or a file that does not meet its service's."""


@dataclass(frozen=True)
class Match:
    """How the fields of one file meet a service's contract.

    ``spellings`` holds, for each contract column, the file's fields of that name in
    any case: one is a match, none an absence, several an ambiguity.
    """

    service: str
    spellings: tuple[tuple[str, ...], ...]
    extras: tuple[str, ...]

    @property
    def columns(self) -> tuple[tuple[str, str, str], ...]:
        return CONTRACTS[self.service]

    @property
    def silver_names(self) -> list[str]:
        return [silver for _, silver, _ in self.columns]

    @property
    def absent(self) -> list[str]:
        return [c[0] for c, found in zip(self.columns, self.spellings) if not found]

    @property
    def ambiguous(self) -> list[tuple[str, ...]]:
        return [found for found in self.spellings if len(found) > 1]

    @property
    def complaint(self) -> str | None:
        """One sentence with everything that keeps the file from being read, or None."""
        parts = []
        if self.absent:
            parts.append(f"absent: {', '.join(self.absent)}")
        if self.ambiguous:
            parts.append("same name in other case: " + ", ".join("=".join(g) for g in self.ambiguous))
        return f"{self.service} file breaks its contract; " + "; ".join(parts) if parts else None

    def required(self) -> Match:
        if self.complaint:
            raise ContractError(self.complaint)
        return self

    def _pairs(self):
        for (_, silver, kind), found in zip(self.columns, self.required().spellings):
            yield found[0], F.col(f"`{found[0]}`"), silver, kind

    def projection(self) -> list[Column]:
        """Each contract column under its silver name, by ``try_cast``."""
        return [col.try_cast(kind).alias(silver) for _, col, silver, kind in self._pairs()]

    def losses(self, schema: StructType | None = None) -> list[Column]:
        """Per column, how many values its cast turns into null.

        With the file's ``schema`` given, casts that cannot lose a value are left
        out, so the count costs nothing for columns that already have their type.
        """
        types = {f.name: f.dataType for f in schema.fields} if schema is not None else {}
        return [
            F.count_if(col.isNotNull() & col.try_cast(kind).isNull()).alias(f"cast_nulls_{silver}")
            for name, col, silver, kind in self._pairs()
            if name not in types or cast_can_lose(types[name], kind)
        ]


def match(service: str, fields: Iterable[str]) -> Match:
    """Group a file's fields by folded name and lay them beside the contract."""
    if service not in CONTRACTS:
        raise ContractError(f"{service!r} has no contract yet; there is one for {', '.join(sorted(CONTRACTS))}")
    folded: dict[str, list[str]] = {}
    for name in fields:
        if name != FILE_MONTH:
            folded.setdefault(name.casefold(), []).append(name)
    spellings = tuple(tuple(folded.pop(raw.casefold(), ())) for raw, _, _ in CONTRACTS[service])
    return Match(service, spellings, tuple(sorted(name for group in folded.values() for name in group)))


# Casts that never turn a non-null value into null (besides the identity).
_LOSSLESS = {
    ("tinyint", "int"), ("smallint", "int"), ("tinyint", "bigint"), ("smallint", "bigint"),
    ("int", "bigint"), ("float", "double"), ("int", "double"), ("bigint", "double"),
    ("timestamp", "timestamp_ntz"), ("date", "timestamp_ntz"),
}


def cast_can_lose(source: DataType, target: str) -> bool:
    src = source.simpleString()
    return not (src == target or target == "string" or (src, target) in _LOSSLESS)


def typed(raw: DataFrame, service: str) -> tuple[DataFrame, Match]:
    """Typed, renamed projection of the contract columns (plus the file month if present)."""
    found = match(service, raw.columns)
    keep = [F.col(FILE_MONTH)] if FILE_MONTH in raw.columns else []
    return raw.select(*found.projection(), *keep), found


# --- Type probe of a raw file (S7) ------------------------------------------
# A raw file is usable when some column whose name holds each word
# has a type whose simple string starts with one of the accepted prefixes.
PROBE_REQUIRED = {
    "pickup": ("timestamp",),
    "dropoff": ("timestamp",),
    "distance": ("double", "float", "decimal"),
}


def type_probe(raw: DataFrame) -> list[str]:
    """Problems found in a raw schema; an empty list means the probe passes."""
    problems = []
    for word, prefixes in PROBE_REQUIRED.items():
        candidates = [f for f in raw.schema.fields if word in f.name.lower()]
        if not any(f.dataType.simpleString().startswith(prefixes) for f in candidates):
            seen = ", ".join(f"{f.name}:{f.dataType.simpleString()}" for f in candidates) or "none"
            problems.append(f"no column with {word!r} of type {'/'.join(prefixes)} (found {seen})")
    return problems
