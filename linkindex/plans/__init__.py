"""The jobs, in the order they run: ingest, match_and_number, link_and_derive, publish/extract."""
