"""DataFrame -> DataFrame operators. None of them names a path, a session or an input table."""
