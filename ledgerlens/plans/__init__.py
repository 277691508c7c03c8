"""Jobs, report views and the query catalog."""
