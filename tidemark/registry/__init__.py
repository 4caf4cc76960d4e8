"""All registered queries."""

from . import base, inputs, shapes, joining, grouping, ordering, columns, checks, streaming, chain, evm, messages, exchanges, directory, markets, scoring, interfaces, packets, buses, bridges  # noqa: F401

QUERIES, ORACLES = base.QUERIES, base.ORACLES
