"""The cleaning and daily aggregation operators on unbounded input."""
