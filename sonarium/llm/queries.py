"""The queries of the numbered problems, with their SQL where SQL can say the same."""

from __future__ import annotations

from . import bpe, leakage, linkage, names, neighbours, residue, term_counts, topn

_MODULES = [names, term_counts, neighbours, linkage, topn, bpe, leakage, residue]
QUERIES = {name: q for m in _MODULES for name, q in m.QUERIES.items()}
SQL = {name: q for m in _MODULES for name, q in m.SQL.items()}
