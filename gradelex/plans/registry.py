"""All queries of the core and their SQL."""

from gradelex.plans import contract, flows, lists, reports, training

_MODULES = (training, contract, lists, flows, reports)
QUERIES = {name: f for m in _MODULES for name, f in m.QUERIES.items()}
SQL = {name: q for m in _MODULES for name, q in m.SQL.items()}
