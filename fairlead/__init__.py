"""fairlead: curation and reconciliation of wide, hand-edited tables on PySpark."""

__all__ = ["session", "schema"]
