"""Jobs and the registered query catalog."""
