"""The models: staging, star schema, daily reports, audio features, declared checks."""
