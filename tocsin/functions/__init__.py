"""Column expressions: the scheduling rule and the JSON codecs."""
