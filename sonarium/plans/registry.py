"""All queries of the core, with their SQL twins where SQL can say the same."""

from __future__ import annotations

from ..operators import entities, feeds, history, publishing, refresh, serving, snapshots, tags, vectors

_MODULES = [snapshots, tags, entities, vectors, history, publishing, refresh, serving, feeds]


def flagship(spark, sf_dir: str):
    return queries()["tag_rank_zidf"](spark, sf_dir)


def queries() -> dict:
    return {name: q for m in _MODULES for name, q in m.QUERIES.items()}


def oracle_sql() -> dict:
    return {name: q for m in _MODULES for name, q in m.SQL.items()}
