"""Readers, sinks, scratch tables and the test binding."""
