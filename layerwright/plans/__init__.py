"""Compositions of operators: silver and gold models, change log, feeds, process configs."""
