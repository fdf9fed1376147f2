"""Column -> Column builders. Everything here stays inside Catalyst: no Python on the row path."""
