"""Column functions for text and labels."""
