"""Independent SQL statements of the expected results, for DuckDB.

Each statement is assembled from named common table expressions. They derive the
same text extracts as ``loanloom.samples`` and then state each result in its
plainest form, with other methods than the Spark code where there is a choice.
"""

from __future__ import annotations

import re

from loanloom.oracles.lending import LENDING_CTES, LENDING_SQL
from loanloom.oracles.operators import OPERATOR_SQL
from loanloom.oracles.triage import TRIAGE_CTES, TRIAGE_SQL

CTES = {**LENDING_CTES, **TRIAGE_CTES}


def _needed(sql: str, found: list[str]) -> list[str]:
    for name in re.findall(r"\b[a-z]+_[a-z0-9_]+\b", sql):
        if name in CTES and name not in found:
            _needed(CTES[name], found)
            if name not in found:
                found.append(name)
    return found


def statement(select: str) -> str:
    """The select with every table expression it uses in front of it."""
    if select.strip().startswith("WITH"):
        select = f"SELECT * FROM ({select})"
    names = _needed(select, [])
    if not names:
        return select
    with_list = ",\n".join(f"{n} AS MATERIALIZED ({CTES[n].strip()})" for n in names)
    return f"WITH {with_list}\n{select.strip()}"


def all_statements() -> dict[str, str]:
    every = {**LENDING_SQL, **OPERATOR_SQL, **TRIAGE_SQL}
    return {name: statement(sql) for name, sql in every.items()}
