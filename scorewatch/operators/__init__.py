"""DataFrame -> DataFrame diagnostics."""
