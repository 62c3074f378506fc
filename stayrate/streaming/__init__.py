"""Continuous delivery of event payloads."""
