"""Pipeline stages as DataFrame transformations and idempotent writes."""
