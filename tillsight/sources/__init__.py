"""Typed readers, sinks and the views that bridge the test tables."""
