"""shotframe."""
