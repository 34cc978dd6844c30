"""Writers and keep-latest upserts."""
