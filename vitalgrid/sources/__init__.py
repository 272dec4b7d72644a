"""Readers, routers, schema detection, profiles and sinks."""
