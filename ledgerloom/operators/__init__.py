"""DataFrame -> DataFrame operators. They start no action and keep no session."""
