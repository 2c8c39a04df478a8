"""Column functions: colour, coordinates, codecs, text."""
