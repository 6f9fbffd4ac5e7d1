"""Logical building blocks shared by operators (skew-safe scans) and the named query catalog."""
