"""Every registered query, by family."""

from tidemark.plans import checked, grouped, landed, matched, modelled, ordered, reported, scalars, streamed

FAMILIES = [m.FAMILY for m in (
    modelled, ordered, grouped, matched, scalars, checked, landed, reported, streamed)]


def all_queries():
    return {name: q for family in FAMILIES for name, q in family.queries.items()}


def all_oracles():
    return {name: sql for family in FAMILIES for name, sql in family.oracles.items()}
