"""All queries of the core, by name, and the SQL of those that SQL can state."""

from __future__ import annotations

from fairlead.plans import problems, sheet, workflow

QUERIES = {**problems.QUERIES, **sheet.QUERIES, **workflow.QUERIES}
ORACLES = {**problems.ORACLES, **sheet.ORACLES, **workflow.ORACLES}
