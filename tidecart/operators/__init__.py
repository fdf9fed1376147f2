"""DataFrame -> DataFrame operators and fit/transform pairs."""
