"""The queries the driver checks: operators and models over the shared test tables."""
