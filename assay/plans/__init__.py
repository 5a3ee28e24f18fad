"""Job plans: suites, checkpoint runs, per-day validation, validated publish."""
