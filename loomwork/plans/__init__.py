"""The whole queries a user calls."""
