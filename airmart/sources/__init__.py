"""Landed payloads, catalog tables and the sensor view of an event table."""
