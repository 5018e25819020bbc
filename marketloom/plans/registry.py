"""Names of all queries, their functions and their SQL."""

from marketloom.plans import analog, announcements, articles, base, daily, extended, feeds, frames, grading, intervals, intraday, kernels, library, move_tables, moves, news, panel, paths, profiles, records, reports, scoring, screening, session_polls, shapes, sources, streams  # noqa: F401

QUERIES = base.QUERIES
ORACLES = base.ORACLES
FLAGSHIP = daily.o114_panel
