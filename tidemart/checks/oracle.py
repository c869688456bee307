"""DuckDB SQL for the registered queries, over the given tables.

`VIEWS` are named sub-queries; a query text gets those it mentions, directly or through others.
"""

from __future__ import annotations

import re

from tidemart.checks.oracle_queries import TEXTS
from tidemart.checks.oracle_views import VIEWS


def _used(sql: str) -> list[str]:
    return [name for name in VIEWS if re.search(rf"\b{name}\b", sql)]


def _closure(sql: str) -> list[str]:
    wanted: set[str] = set()
    pending = _used(sql)
    while pending:
        name = pending.pop()
        if name not in wanted:
            wanted.add(name)
            pending += [n for n in _used(VIEWS[name]) if n != name]
    return [name for name in VIEWS if name in wanted]  # views are listed before their users


def oracle_texts() -> dict[str, str]:
    texts = {}
    for name, sql in TEXTS.items():
        views = ",\n".join(f"{v} AS ({VIEWS[v].strip()})" for v in _closure(sql))
        texts[name] = f"WITH {views}\n{sql.strip()}" if views else sql.strip()
    return texts
