"""Versioned catalogs as Spark jobs: latest-per-key windows, as-of state, audits, ledgers."""
