"""Column expressions: name cleaning, threshold labels, vectors as text."""
