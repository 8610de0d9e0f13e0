"""Interferogram networks and the registered queries."""
