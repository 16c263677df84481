"""The warehouse models: staging, core and marts."""
