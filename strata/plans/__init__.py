"""Jobs over the control tables: configuration, loads, views, audit and cleanup."""
