"""Layer jobs and query plans, composed lazily so Catalyst sees the whole chain."""
