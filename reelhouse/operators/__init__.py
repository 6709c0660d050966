"""Reusable DataFrame operators (all lazy; no driver-side loops over data)."""
