"""Readers: adapter views over the driver tables, landed JSON/CSV payloads, backfill planning."""
