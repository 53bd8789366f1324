"""Helpers shared by the operators: expressions, staging, exact ranks."""
