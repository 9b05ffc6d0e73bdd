"""Readers for files, Bronze tables and warehouse tables."""
