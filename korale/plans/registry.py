"""All registered queries of the core, and their SQL."""

from __future__ import annotations

from korale.plans import analytics, chats, corpus, grounded, more, reports, strings

MODULES = (corpus, analytics, more, chats, strings, reports, grounded)


def queries() -> dict:
    return dict(corpus.QUERIES) | {k: v for m in MODULES for k, v in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v for m in MODULES for k, v in m.SQL.items()}
