"""Relational building blocks of the report (roster, activity pairs, batch hop,
report shaping)."""
