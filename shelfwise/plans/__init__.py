"""Query plans; importing ``all_queries`` registers every named query."""


def all_queries():
    from . import q_analysis, q_catalog, q_decisions, q_extras, q_marts, q_more, q_quality, q_stream  # noqa: F401
    from .registry import ORACLE, QUERIES
    return QUERIES, ORACLE
