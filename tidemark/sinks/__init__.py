"""Writers; the places where jobs start."""
