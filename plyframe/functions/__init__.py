"""Subpackage of plyframe."""
