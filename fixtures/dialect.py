"""The few spellings that differ between Spark SQL and DuckDB.

The study fixture is one SQL text, rendered once for Spark (as the input of the
queries) and once for DuckDB (as the leading CTEs of the oracles), so both sides
start from equal rows.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Dialect:
    name: str

    def idiv(self, a: str, b: int | str) -> str:
        return f"(({a}) div {b})" if self.name == "spark" else f"(({a}) // {b})"

    def dmy(self, d: str) -> str:
        if self.name == "spark":
            return f"upper(date_format({d}, 'dd/MMM/yyyy'))"
        return f"upper(strftime({d}, '%d/%b/%Y'))"

    def iso(self, d: str) -> str:
        if self.name == "spark":
            return f"date_format({d}, 'yyyy-MM-dd')"
        return f"strftime({d}, '%Y-%m-%d')"

    def plus_days(self, d: str, n: str) -> str:
        return f"({d} + CAST({n} AS INT))"

    def explode(self, base: str, rows: list[dict[str, str]]) -> str:
        """One output row per entry of ``rows`` for every row of ``base``."""
        if self.name == "spark":
            structs = ", ".join(
                "named_struct(" + ", ".join(f"'{n}', {e}" for n, e in r.items()) + ")"
                for r in rows
            )
            names = ", ".join(rows[0])
            return f"SELECT * FROM ({base}) b LATERAL VIEW inline(array({structs})) x AS {names}"
        structs = ", ".join(
            "{" + ", ".join(f"'{n}': {e}" for n, e in r.items()) + "}" for r in rows
        )
        return f"SELECT b.*, unnest([{structs}], recursive := true) FROM ({base}) b"


SPARK = Dialect("spark")
DUCKDB = Dialect("duckdb")
