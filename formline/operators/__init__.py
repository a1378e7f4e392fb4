"""DataFrame operators. Column names are parameters; the defaults are those of the game logs."""
